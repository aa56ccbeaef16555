"""Reachability, components, peeling and centrality as bounded DataFrame fixpoints.

Edges are (src, dst) pairs, prerequisite to topic.  Every round is cut into a table in the shared
folder, so plans stay small, lost executors cost one round, and the optimizer sees true sizes.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepstone.operators.components import smallest_members
from stepstone.session import cut, cut_counted

COUNTED_KINDS = ("concept", "skill")
#: Connected pieces of at most so many edges are finished inside one task each; 1.4 million took 49 s and 620 MB.
PIECE_EDGES = 2_000_000


def links(edges: DataFrame) -> DataFrame:
    """Distinct (src, dst) of an edge table."""
    return edges.select(F.col("prerequisite_id").alias("src"), F.col("topic_id").alias("dst")).distinct()


def reverse(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *[c for c in pairs.columns if c not in ("src", "dst")])


def endpoints(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def shortcuts(pairs: DataFrame, doublings: int = 2, max_growth: int = 8) -> DataFrame:
    """Add paths of 2, then 4 hops, while the composed table stays within ``max_growth`` times the edges.

    Rounds of a fixpoint over the result drop by the number of hops; the size is checked before each
    composition, so hubs cannot blow it up.
    """
    current, rows = cut_counted(pairs.select("src", "dst").distinct(), "links")
    budget = max(rows, 1) * max_growth
    for _ in range(doublings):
        into = current.groupBy(F.col("dst").alias("mid")).agg(F.count("*").alias("i"))
        out = current.groupBy(F.col("src").alias("mid")).agg(F.count("*").alias("o"))
        # merged, as a table of all nodes or edges that is broadcast would pass through the driver whole
        made = into.join(out.hint("merge"), "mid").agg(F.sum(F.col("i") * F.col("o"))).first()[0] or 0
        if made == 0 or made > budget:
            break
        a = current.select("src", F.col("dst").alias("mid"))
        b = current.select(F.col("src").alias("mid"), "dst")
        current = cut(current.union(a.join(b.hint("merge"), "mid").select("src", "dst")).distinct(), "hops")
    return current


def peel(edges: DataFrame, both_sides: bool = False) -> DataFrame:
    """Repeatedly drop edges whose source has no incoming edge; what is left holds the cycles.

    With ``both_sides`` edges whose target has no outgoing edge go too.
    """

    def step(e: DataFrame) -> DataFrame:
        kept = e.join(e.select(F.col("dst").alias("src")), "src", "left_semi")
        if both_sides:
            kept = kept.join(e.select(F.col("src").alias("dst")), "dst", "left_semi")
        return kept.select(*e.columns)

    current, size = cut_counted(step(edges), "peel")
    while size:
        following, left = cut_counted(step(step(current)), "peel")
        if left == size:
            return following
        current, size = following, left
    return current


def reach(starts: DataFrame, pairs: DataFrame, compact_every: int = 6) -> DataFrame:
    """All (start, node) with a path of at least one edge; a start on a cycle reaches itself."""
    hops = shortcuts(pairs).select(F.col("src").alias("node"), F.col("dst").alias("next"))
    begin = starts.select(F.col("id").alias("start")).distinct()
    frontier = cut(
        begin.join(hops, F.col("start") == F.col("node")).select("start", F.col("next").alias("node")).distinct(),
        "frontier",
    )
    seen = [frontier]
    for done in count(1):
        known = seen[0]
        for more in seen[1:]:
            known = known.union(more)
        fresh = (
            frontier.join(hops, "node")
            .select("start", F.col("next").alias("node"))
            .distinct()
            .join(known, ["start", "node"], "left_anti")
        )
        frontier, rows = cut_counted(fresh, "frontier")
        if rows == 0:
            return known
        seen.append(frontier)
        if done % compact_every == 0:
            seen = [cut(known.union(frontier), "reached")]


def spread_extreme(state: DataFrame, hops: DataFrame, largest: bool = True) -> DataFrame:
    """Spread ``value`` along (src, dst) until every node holds the extreme of itself and its ancestors.

    Only nodes whose value changed in the last round are sent on.
    """
    pick = F.max if largest else F.min
    better = (F.col("offer") > F.col("value")) if largest else (F.col("offer") < F.col("value"))
    current = cut(state.select("id", "value", F.lit(True).alias("moved")), "spread")
    while True:
        offers = (
            current.where("moved")
            .join(hops, F.col("id") == F.col("src"))
            .groupBy(F.col("dst").alias("id"))
            .agg(pick("value").alias("offer"))
        )
        current, moved = cut_counted(
            current.select("id", "value")
            .join(offers, "id", "left")
            .select(
                "id",
                F.when(better, F.col("offer")).otherwise(F.col("value")).alias("value"),
                F.coalesce(better, F.lit(False)).alias("moved"),
            ),
            "spread",
            F.col("moved"),
        )
        if moved == 0:
            return current.select("id", "value")


def leads_to(start: int, goal: int, ahead: Sequence[set[int]], behind: Sequence[set[int]]) -> bool:
    """Whether ``goal`` can be reached from ``start``, searched from both ends in turn, the side with fewer open nodes first."""
    if start == goal:
        return True
    sides, met = ([start], [goal]), ({start}, {goal})
    steps = (ahead, behind)
    while sides[0] and sides[1]:
        side = int(len(sides[1]) < len(sides[0]))
        fresh = []
        for node in sides[side]:
            for other in steps[side][node]:
                if other in met[1 - side]:
                    return True
                if other not in met[side]:
                    met[side].add(other)
                    fresh.append(other)
        sides = (fresh, sides[1]) if side == 0 else (sides[0], fresh)
    return False


def strong_roots(ahead: Sequence[Sequence[int]]) -> list[int]:
    """The smallest member of each node's strongly connected component, in time that grows with nodes and edges."""
    found, low, root = [-1] * len(ahead), [0] * len(ahead), [-1] * len(ahead)
    stack: list[int] = []
    clock = 0
    for begin in range(len(ahead)):
        if found[begin] >= 0:
            continue
        found[begin] = low[begin] = clock
        clock += 1
        stack.append(begin)
        walk = [(begin, iter(ahead[begin]))]
        while walk:
            node, rest = walk[-1]
            for other in rest:
                if found[other] < 0:
                    found[other] = low[other] = clock
                    clock += 1
                    stack.append(other)
                    walk.append((other, iter(ahead[other])))
                    break
                if root[other] < 0:
                    low[node] = min(low[node], found[other])
            else:
                walk.pop()
                if walk:
                    low[walk[-1][0]] = min(low[walk[-1][0]], low[node])
                if low[node] == found[node]:
                    at = len(stack) - 1
                    while stack[at] != node:
                        at -= 1
                    least = min(stack[at:])
                    for member in stack[at:]:
                        root[member] = least
                    del stack[at:]
    return root


def _components_of_piece(piece: pd.DataFrame) -> pd.DataFrame:
    names = np.unique(np.concatenate([piece.src.to_numpy(), piece.dst.to_numpy()]))
    ahead: list[list[int]] = [[] for _ in names]
    for s, d in zip(np.searchsorted(names, piece.src).tolist(), np.searchsorted(names, piece.dst).tolist(), strict=True):
        ahead[s].append(d)
    root = np.array(strong_roots(ahead), dtype=int)
    cyclic = np.bincount(root, minlength=len(names))[root] > 1
    return pd.DataFrame({"id": names[cyclic], "scc": names[root[cyclic]]})


def weak_components(pairs: DataFrame) -> DataFrame:
    """(id, value): smallest id connected to ``id`` in any direction."""
    hung = smallest_members(pairs).select(F.col("node").alias("id"), F.col("root").alias("value"))
    return endpoints(pairs).join(hung, "id", "left").select("id", F.coalesce("value", "id").alias("value"))


def components(pairs: DataFrame, piece_edges: int = PIECE_EDGES) -> DataFrame:
    """Strongly connected components with more than one node: (id, scc), scc = smallest member id.

    What cannot be on a cycle is trimmed away first, which leaves many small disconnected pieces.
    Pieces of at most ``piece_edges`` edges are finished in one task each; larger ones by coloring.
    """
    spark = pairs.sparkSession
    rest = peel(pairs.select("src", "dst").where("src <> dst").distinct(), both_sides=True)
    if rest.isEmpty():
        return spark.createDataFrame([], "id string, scc string")
    weak = weak_components(rest).select(F.col("id").alias("src"), F.col("value").alias("piece"))
    placed = rest.join(weak, "src")
    sized = cut(
        placed.join(placed.groupBy("piece").agg((F.count("*") > piece_edges).alias("big")), "piece"), "pieces"
    )
    small = sized.where("NOT big").groupBy("piece").applyInPandas(_components_of_piece, "id string, scc string")
    large = sized.where("big").select("src", "dst")
    if large.isEmpty():
        return cut(small, "scc")
    return cut(small.union(color_components(large)), "scc")


def color_components(pairs: DataFrame) -> DataFrame:
    """Components of trimmed edges of any size.

    Coloring: give every node the largest id among its ancestors, and collect, from each node that kept
    its own id, the nodes of its color that lead back to it; go on with what is left.
    """
    rest = pairs.select("src", "dst")
    found: list[DataFrame] = []
    while not rest.isEmpty():
        own = endpoints(rest).select("id", F.col("id").alias("value"))
        color = spread_extreme(own, shortcuts(rest))
        cs = color.select(F.col("id").alias("src"), F.col("value").alias("src_color"))
        cd = color.select(F.col("id").alias("dst"), F.col("value").alias("dst_color"))
        inside = cut(
            rest.join(cs, "src").join(cd, "dst").where("src_color = dst_color").select("src", "dst"), "inside"
        )
        roots = color.where("id = value").select("id")
        members = cut(
            reach(roots, reverse(inside)).select(F.col("node").alias("id"), F.col("start").alias("root")), "members"
        )
        found.append(members)
        gone = members.select("id")
        rest = peel(
            inside.join(gone, F.col("src") == F.col("id"), "left_anti")
            .join(gone, F.col("dst") == F.col("id"), "left_anti"),
            both_sides=True,
        )
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    label = every.groupBy("root").agg(F.min("id").alias("scc"), F.count("*").alias("n")).where("n > 1")
    return every.join(label, "root").select("id", "scc")


def graph_stats(pairs: DataFrame, scc: DataFrame) -> DataFrame:
    """Nodes, edges, density, cyclic components, nodes in cycles and the largest component."""
    sizes = scc.groupBy("scc").agg(F.count("*").alias("n"))
    nodes = endpoints(pairs).agg(F.count("*")).scalar()
    edges = pairs.agg(F.count("*")).scalar()
    return sizes.agg(
        F.count("*").alias("cyclic_components"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("nodes_in_cycles"),
        F.coalesce(F.max("n"), F.lit(0)).alias("largest_component"),
    ).select(
        nodes.alias("nodes"),
        edges.alias("edges"),
        F.when(nodes > 0, F.round(edges / nodes, 6)).otherwise(F.lit(0.0)).alias("density"),
        "cyclic_components",
        "nodes_in_cycles",
        "largest_component",
    )


def stale_centrality(stored: DataFrame, computed: DataFrame) -> DataFrame:
    """Topics whose stored centrality differs from the computed one, null included."""
    new = computed.select("id", F.col("centrality").alias("expected"))
    old = stored.select("id", F.col("centrality").alias("stored"))
    return old.join(new.hint("merge"), "id").where(~F.col("stored").eqNullSafe(F.col("expected")))


def unsortable(pairs: DataFrame) -> DataFrame:
    """Nodes a topological sort cannot place: on a cycle or downstream of one."""
    return peel(pairs.select("src", "dst").distinct()).select(F.col("dst").alias("id")).distinct()


def nearest_unmastered(
    starts: DataFrame, mastered: DataFrame, pairs: DataFrame, nodes: DataFrame
) -> DataFrame:
    """Nearest topic a learner has not mastered: prerequisites level by level, then dependents.

    ``starts`` (learner, id), ``mastered`` (learner, id), ``nodes`` (id, age, name).
    """
    info = nodes.select("id", F.struct(F.coalesce(F.col("age").cast("double"), F.lit(float("inf"))).alias("age"), F.coalesce("name", "id").alias("name"), F.col("id").alias("id")).alias("rank"))

    def search(begin: DataFrame, steps: DataFrame, direction: str) -> list[DataFrame]:
        hops = steps.select(F.col("src").alias("node"), F.col("dst").alias("next"))
        level = cut(begin.select("learner", F.col("id").alias("node")), "level")
        seen, answers = [level], []
        while True:
            known = seen[0]
            for more in seen[1:]:
                known = known.union(more)
            following, rows = cut_counted(
                level.join(hops, "node").select("learner", F.col("next").alias("node")).distinct()
                .join(known, ["learner", "node"], "left_anti"),
                "level",
            )
            if rows == 0:
                return answers
            open_nodes = following.join(
                mastered.select("learner", F.col("id").alias("node")), ["learner", "node"], "left_anti"
            )
            best = cut(
                open_nodes.join(info, F.col("node") == F.col("id"))
                .groupBy("learner")
                .agg(F.min("rank").alias("rank"))
                .select("learner", F.col("rank.id").alias("next_id"), F.lit(direction).alias("direction")),
                "best",
            )
            answers.append(best)
            level = cut(following.join(best, "learner", "left_anti"), "level")
            seen.append(level)

    def together(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for part in parts[1:]:
            out = out.union(part)
        return out

    empty = starts.select("learner", F.col("id").alias("next_id"), F.lit("").alias("direction")).limit(0)
    back = together([empty, *search(starts, reverse(pairs), "prerequisite")])
    ahead = search(starts.join(back, "learner", "left_anti"), pairs, "dependent")
    return together([back, *ahead])


def sequence(nodes: DataFrame, pairs: DataFrame, scope: str, order: Sequence[str]) -> DataFrame:
    """Topological order per scope that always takes the smallest ready node by ``order``.

    Adds ``path``, an array whose order inside a scope is the sequence, and ``sortable``.  Taking the
    smallest ready node places v after exactly those nodes whose record (the largest key among the node
    and its ancestors) is smaller; nodes with one record follow the node that set it and are ordered the
    same way among themselves.  So each round spreads the largest key along the remaining edges, places
    the nodes that hold their own key, and goes on inside the groups.  Nodes that cannot be sorted come
    last in plain key order.
    """
    key = F.struct(*[F.col(c) for c in order])
    base = nodes.select(scope, "id", key.alias("key"))
    in_scope = (
        pairs.select("src", "dst").where("src <> dst").distinct()
        .join(base.select(F.col("id").alias("src"), F.col(scope).alias("_a")), "src")
        .join(base.select(F.col("id").alias("dst"), F.col(scope).alias("_b")), "dst")
        .where("_a = _b")
        .select("src", "dst")
    )
    in_scope = cut(in_scope, "scope_edges")
    loops = pairs.where("src = dst").select("src", "dst").join(base.select(F.col("id").alias("src")), "src", "left_semi")
    stuck = cut(unsortable(in_scope.union(loops.select("src", "dst"))), "stuck")
    tail = base.join(stuck, "id", "left_semi").select(
        scope, "id", F.array("key").alias("path"), F.lit(False).alias("sortable")
    )
    live = base.join(stuck, "id", "left_anti").select(
        scope, "id", "key", F.array().cast(f"array<{base.schema['key'].dataType.simpleString()}>").alias("path")
    )
    live, open_nodes = cut_counted(live, "live")
    edges, open_edges = cut_counted(in_scope.join(stuck, F.col("dst") == F.col("id"), "left_anti"), "live_edges")
    hops = shortcuts(edges)
    placed: list[DataFrame] = [tail]
    while open_nodes:
        own = live.select("id", F.col("key").alias("value"))
        record = spread_extreme(own, hops) if open_edges else own
        step = cut(
            live.join(record, "id").select(
                scope, "id", "key", F.concat("path", F.array("value")).alias("path"),
                (F.col("value") == F.col("key")).alias("head"), "value",
            ),
            "step",
        )
        placed.append(step.where("head").select(scope, "id", "path", F.lit(True).alias("sortable")))
        live, open_nodes = cut_counted(step.where("NOT head").select(scope, "id", "key", "path", "value"), "live")
        edges, open_edges = cut_counted(
            edges.join(live.select(F.col("id").alias("src"), F.col("value").alias("_a")), "src")
            .join(live.select(F.col("id").alias("dst"), F.col("value").alias("_b")), "dst")
            .where("_a = _b")
            .select("src", "dst"),
            "live_edges",
        )
        # the groups that are left are shallow, so plain edges do
        hops, live = edges, live.drop("value")
    out = placed[0]
    for more in placed[1:]:
        out = out.union(more)
    return out
