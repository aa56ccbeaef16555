"""Breaking cycles with the fewest regrets, gates on the result, and appends that keep a graph acyclic."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepstone.operators.graph import PIECE_EDGES, components, leads_to, links
from stepstone.operators.stats import edge_degrees
from stepstone.session import cut, cut_counted

# Weights of the removal score.
WEIGHT_SOFT, WEIGHT_TEMPLATE, WEIGHT_LOW_DEGREE = 1.0, 0.5, 0.3
KEY = ["topic_id", "prerequisite_id"]


def template_reason(templates: Sequence[str]) -> Column:
    hit = F.lit(False)
    for text in templates:
        hit = hit | F.coalesce(F.col("reason").contains(text), F.lit(False))
    return hit


def removal_score(soft: Column, template: Column, degree: Column) -> Column:
    return (
        soft.cast("int") * WEIGHT_SOFT + template.cast("int") * WEIGHT_TEMPLATE + (F.lit(1.0) / degree) * WEIGHT_LOW_DEGREE
    )


def removed_reason(soft: Column, template: Column) -> Column:
    return F.when(soft, "cycle-soft").when(template, "cycle-template").otherwise("cycle-lowdeg")


def scored_edges(edges: DataFrame, templates: Sequence[str]) -> DataFrame:
    """Edges with degree, removal score and the reason a removal would carry."""
    soft, template = F.col("strength") == "soft", template_reason(templates)
    return edge_degrees(edges).withColumns(
        {
            "score": removal_score(soft, template, F.col("degree")),
            "removed_reason": removed_reason(soft, template),
        }
    )


def _neighbours(size: int, src: Iterable[int], dst: Iterable[int]) -> tuple[list[set[int]], list[set[int]]]:
    """The nodes ahead of and behind each node of one small piece of a graph."""
    ahead, behind = [set() for _ in range(size)], [set() for _ in range(size)]
    for s, d in zip(src, dst, strict=True):
        ahead[s].add(d)
        behind[d].add(s)
    return ahead, behind


def _greedy(group: pd.DataFrame) -> pd.DataFrame:
    """Edges of one small component in, the edges the greedy rule removes out.

    Components never touch each other's scores, so one queue serves all that the group falls apart into.  The best edge of the
    queue is on a cycle if its end still leads to its start: then it goes and the scores at its ends rise, else it can never be
    on a cycle again and is not walked any more, nor are edges from nodes nothing leads to or to nodes that lead nowhere.
    """
    names = pd.unique(pd.concat([group.src, group.dst]))
    index = {n: i for i, n in enumerate(names)}
    s, d = group.src.map(index).tolist(), group.dst.map(index).tolist()
    base = (group.soft.to_numpy() * WEIGHT_SOFT + group.template.to_numpy() * WEIGHT_TEMPLATE).tolist()
    into, out = dict(zip(d, group.into.tolist())), dict(zip(s, group.out.tolist()))
    keys = (group.src + "->" + group.dst).tolist()
    ahead, behind = _neighbours(len(names), s, d)
    number = {pair: i for i, pair in enumerate(zip(s, d))}

    def entry(i: int) -> tuple[float, str, int, int]:
        degree = into[d[i]] + out[s[i]]
        score = base[i] + (1.0 / degree) * WEIGHT_LOW_DEGREE
        # an unknown strength sorts first, as it does where rounds run on the whole cluster
        return (-score if score == score else -math.inf), keys[i], i, degree

    def drop(u: int, v: int) -> None:
        ahead[u].discard(v)
        behind[v].discard(u)
        ends = [u, v]
        while ends:
            node = ends.pop()
            if not ahead[node]:
                for w in behind[node]:
                    ahead[w].discard(node)
                    ends.append(w)
                behind[node].clear()
            if not behind[node]:
                for w in ahead[node]:
                    behind[w].discard(node)
                    ends.append(w)
                ahead[node].clear()

    queue = [entry(i) for i in range(len(keys))]
    heapq.heapify(queue)
    gone = []
    while queue:
        _, _, i, degree = heapq.heappop(queue)
        u, v = s[i], d[i]
        if v not in ahead[u] or degree != into[v] + out[u]:
            continue
        on_cycle = leads_to(v, u, ahead, behind)
        if on_cycle:
            gone.append(i)
            into[v] -= 1
            out[u] -= 1
        drop(u, v)
        if on_cycle:
            for w in behind[v]:
                heapq.heappush(queue, entry(number[w, v]))
            for w in ahead[u]:
                heapq.heappush(queue, entry(number[u, w]))
    return group.iloc[gone][["src", "dst"]]


def break_cycles(
    edges: DataFrame, templates: Sequence[str] = (), group_edges: int = PIECE_EDGES, within: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): per cyclic component drop the best-scored edge until no component is left.

    Choices in different components do not touch each other's scores, so every component loses one
    edge per round.  Components of at most ``group_edges`` edges finish inside one task each; larger
    ones take a round over the whole cluster and come back smaller.  ``within`` (id) holds the nodes of all
    cycles where they are known; degrees are those of the whole graph all the same.
    """
    rest_of_row = [c for c in edges.columns if c not in KEY]
    # of rows with one key the smallest stays, and an edge of a node to itself is no cycle of the graph
    single = edges.groupBy(*KEY).agg(F.min(F.struct(*rest_of_row)).alias("_row")).select(*KEY, "_row.*").select(*edges.columns)
    distinct, own = single.where("topic_id <> prerequisite_id"), single.where("topic_id = prerequisite_id")
    weighed = edge_degrees_both(distinct).select(
        F.col("prerequisite_id").alias("src"), F.col("topic_id").alias("dst"),
        (F.col("strength") == "soft").cast("int").alias("soft"),
        template_reason(templates).cast("int").alias("template"), "into", "out",
    )
    if within is not None:
        for end in ("src", "dst"):
            weighed = weighed.join(within.select(F.col("id").alias(end)), end, "left_semi")
    work = cut(weighed, "work")
    removed = work.select("src", "dst").limit(0)
    while True:
        scc = components(work)
        inner = cut(
            work.join(scc.select(F.col("id").alias("src"), "scc"), "src")
            .join(scc.select(F.col("id").alias("dst"), F.col("scc").alias("_b")), "dst")
            .where("scc = _b").drop("_b"),
            "inner",
        )
        if inner.isEmpty():
            break
        sizes = inner.groupBy("scc").agg((F.count("*") > group_edges).alias("big"))
        sized = inner.join(sizes, "scc")
        small = sized.where("NOT big").groupBy("scc").applyInPandas(_greedy, "src string, dst string")
        score = removal_score(F.col("soft"), F.col("template"), F.col("into") + F.col("out"))
        best = (
            sized.where("big")
            .groupBy("scc")
            .agg(F.min_by(F.struct("src", "dst"), F.struct(-score, F.concat("src", F.lit("->"), "dst"))).alias("e"))
            .select("e.src", "e.dst")
        )
        gone = cut(small.union(best), "gone")
        removed = cut(removed.union(gone), "removed")
        rest = sized.where("big").drop("big", "scc")
        if rest.isEmpty():
            break
        lost_out = gone.groupBy("src").agg(F.count("*").alias("_o"))
        lost_in = gone.groupBy("dst").agg(F.count("*").alias("_i"))
        work = cut(
            rest.join(gone, ["src", "dst"], "left_anti")
            .join(lost_out, "src", "left").join(lost_in, "dst", "left")
            .select("src", "dst", "soft", "template",
                    (F.col("into") - F.coalesce("_i", F.lit(0))).alias("into"),
                    (F.col("out") - F.coalesce("_o", F.lit(0))).alias("out")),
            "work",
        )
    dropped = removed.select(F.col("dst").alias("topic_id"), F.col("src").alias("prerequisite_id"))
    reason = removed_reason(F.col("strength") == "soft", template_reason(templates))
    return (
        distinct.join(dropped, KEY, "left_anti").unionByName(own),
        distinct.join(dropped, KEY, "left_semi").withColumn("removed_reason", reason),
    )


def _led_to(starts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id): ``starts`` and all nodes they lead to; a round reads only the nodes that the last one met first.

    It takes as many rounds as the longest of the shortest ways.
    """
    steps = cut(pairs.select(F.col("src").alias("id"), "dst"), "steps")
    met, fresh = cut_counted(starts.distinct(), "met")
    rounds, newest = [met], met
    while fresh:
        found = newest.join(steps, "id").select(F.col("dst").alias("id")).distinct()
        for old in rounds:
            found = found.join(old, "id", "left_anti")
        newest, fresh = cut_counted(found, "met")
        rounds.append(newest)
        if len(rounds) > 6:
            rounds = [cut(reduce(DataFrame.union, rounds), "met")]
    return reduce(DataFrame.union, rounds)


def cycles_of_inserted(inserted: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id): the nodes that lie between the ends of inserted edges, in a graph that had no cycle before them.

    Every cycle takes an inserted edge, so its nodes are led to from the head of one and lead to the tail of one.  The
    rest of the graph is neither sorted nor searched for components.
    """
    ahead = cut(_led_to(inserted.select(F.col("dst").alias("id")), pairs), "ahead")
    inside = pairs
    for end in ("src", "dst"):
        inside = inside.join(ahead.select(F.col("id").alias(end)), end, "left_semi")
    tails = inserted.select(F.col("src").alias("id")).join(ahead, "id", "left_semi")
    return _led_to(tails, inside.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def insert_and_break(
    existing: DataFrame, decided: DataFrame, templates: Sequence[str] = (), group_edges: int = PIECE_EDGES
) -> tuple[DataFrame, DataFrame]:
    """(kept, removed) after the curated edges with no ``skipped`` reason joined a graph without cycles.

    The result is that of :func:`break_cycles` over the whole graph; only the region of the inserted edges is worked on.
    ``existing`` must have no cycle, as cycle breaking leaves it, and both tables hold its columns.
    """
    added = cut(decided.where("skipped IS NULL").select(*existing.columns), "added")
    merged = cut(existing.unionByName(added), "merged")
    ends = merged.select(F.col("prerequisite_id").alias("src"), F.col("topic_id").alias("dst")).distinct()
    inserted = added.select(F.col("prerequisite_id").alias("src"), F.col("topic_id").alias("dst")).distinct()
    return break_cycles(merged, templates, group_edges, within=cut(cycles_of_inserted(inserted, ends), "region"))


def edge_degrees_both(edges: DataFrame) -> DataFrame:
    into = edges.groupBy("topic_id").agg(F.count("*").alias("into"))
    out = edges.groupBy("prerequisite_id").agg(F.count("*").alias("out"))
    return edges.join(into, "topic_id").join(out, "prerequisite_id")


def removal_gate(
    stats: DataFrame, removed: Column, antiparallel: Column, factor: float = 1.6, floor: int = 320,
    density: tuple[float, float] = (1.35, 1.55),
) -> DataFrame:
    """Violations of the write gate on the graph after cycle breaking; no row means it may be written."""
    checks = F.array(
        F.struct(F.lit("too-many-removals").alias("rule"), (removed > F.greatest(antiparallel * factor, F.lit(floor))).alias("broken")),
        F.struct(F.lit("density-out-of-range").alias("rule"), (~F.col("density").between(*density)).alias("broken")),
        F.struct(F.lit("still-cyclic").alias("rule"), (F.col("cyclic_components") > 0).alias("broken")),
    )
    return stats.select(F.inline(checks)).where("broken").select("rule")


def _bottlenecks(asked: DataFrame, weighted: DataFrame) -> DataFrame:
    """Smallest possible largest weight on a path from ``src`` to ``dst`` for every asked pair."""
    starts = asked.select(F.col("src").alias("start")).distinct()
    steps = weighted.select(F.col("src").alias("node"), F.col("dst").alias("next"), "weight")
    best = cut(
        starts.join(steps, F.col("start") == F.col("node")).groupBy("start", F.col("next").alias("node"))
        .agg(F.min("weight").alias("cost")).withColumn("moved", F.lit(True)),
        "bottleneck",
    )
    while True:
        offers = (
            best.where("moved").join(steps, "node")
            .groupBy("start", F.col("next").alias("node")).agg(F.min(F.greatest("cost", "weight")).alias("offer"))
        )
        better = F.col("cost").isNull() | (F.col("offer") < F.col("cost"))
        best, moved = cut_counted(
            best.select("start", "node", "cost").join(offers, ["start", "node"], "full_outer").select(
                "start", "node", F.when(better & F.col("offer").isNotNull(), F.col("offer")).otherwise(F.col("cost")).alias("cost"),
                F.coalesce(F.col("offer").isNotNull() & better, F.lit(False)).alias("moved"),
            ),
            "bottleneck",
            F.col("moved"),
        )
        if moved == 0:
            return asked.join(
                best.select(F.col("start").alias("src"), F.col("node").alias("dst"), "cost"), ["src", "dst"], "left"
            )


def _append_in_order(piece: pd.DataFrame) -> pd.DataFrame:
    """Proposals of one small component in key order; returns those that would close a cycle."""
    number, names = pd.factorize(pd.concat([piece.src, piece.dst], ignore_index=True))
    src, dst = number[: len(piece)], number[len(piece) :]
    # edges are only added, and a second one between two nodes changes nothing, so lists do
    ahead: list[list[int]] = [[] for _ in range(len(names))]
    behind: list[list[int]] = [[] for _ in range(len(names))]
    new = (piece.weight != "").to_numpy()
    for u, v in zip(src[~new].tolist(), dst[~new].tolist(), strict=True):
        ahead[u].append(v)
        behind[v].append(u)
    refused = []
    at = np.flatnonzero(new)
    for i in at[np.argsort(piece.weight.to_numpy()[at], kind="stable")].tolist():
        u, v = int(src[i]), int(dst[i])
        if leads_to(v, u, ahead, behind):
            refused.append((names[u], names[v]))
        else:
            ahead[u].append(v)
            behind[v].append(u)
    return pd.DataFrame(refused, columns=["src", "dst"])


STAGE_RANK = {"primary": 0, "junior": 1, "senior": 2}


def age_regression() -> Column:
    """Prerequisite meant for an older age than the topic, both in one stage."""
    return F.coalesce(
        (F.col("t_stage") == F.col("p_stage")) & (F.col("p_age") > F.col("t_age")), F.lit(False)
    )


def with_ends(edges: DataFrame, topics: DataFrame) -> DataFrame:
    """Edges with stage and age of both ends; unknown ends stay null."""
    t = topics.select(F.col("id").alias("topic_id"), F.col("stage").alias("t_stage"), F.col("age_start").alias("t_age"), F.lit(True).alias("t_known"))
    p = topics.select(F.col("id").alias("prerequisite_id"), F.col("stage").alias("p_stage"), F.col("age_start").alias("p_age"), F.lit(True).alias("p_known"))
    return edges.join(t, "topic_id", "left").join(p, "prerequisite_id", "left")


def stage_rank(col: str, ranks: dict[str, int] = STAGE_RANK) -> Column:
    out = F.lit(None).cast("int")
    for name, rank in ranks.items():
        out = F.when(F.col(col) == name, rank).otherwise(out)
    return out


def safe_append(
    existing: DataFrame, proposals: DataFrame, topics: DataFrame, batch_id: str | None = None, piece_edges: int = PIECE_EDGES
) -> DataFrame:
    """Verdict per proposal in key order: accepted as machine edge, or rejected with a reason.

    A proposal closes a cycle when its prerequisite can be reached from its topic over old edges and
    earlier accepted proposals.  Proposals outside every component of (old + proposed) edges can never do
    so.  For the others the cheapest path back, priced by the latest proposal it needs, decides: only
    accepted edges, reject; needs a later proposal, accept; otherwise wait for the earlier verdicts.
    Components of at most ``piece_edges`` edges are decided in one task each, in the same key order.
    """
    named = with_ends(proposals, topics)
    old = existing.select(*KEY, F.lit(True).alias("_old"))
    swapped = existing.select(F.col("prerequisite_id").alias("topic_id"), F.col("topic_id").alias("prerequisite_id"), F.lit(True).alias("_back"))
    marked = named.join(old.distinct(), KEY, "left").join(swapped.distinct(), KEY, "left")
    reason = (
        F.when(F.col("t_known").isNull() | F.col("p_known").isNull() | (F.col("topic_id") == F.col("prerequisite_id")), "invalid-endpoint")
        .when(stage_rank("p_stage") > stage_rank("t_stage"), "stage-regression")
        .when(F.col("_old"), "duplicate")
        .when(F.col("_back"), "reverse-conflict")
    )
    judged = cut(
        marked.select(*proposals.columns, age_regression().alias("age_regression"), reason.alias("rejected_reason")), "judged"
    )
    keyed = judged.where("rejected_reason IS NULL").dropDuplicates(KEY).select(
        F.col("prerequisite_id").alias("src"), F.col("topic_id").alias("dst"),
        F.concat("topic_id", F.lit("|"), "prerequisite_id").alias("weight"),
    )
    base = links(existing).withColumn("weight", F.lit(""))
    wide = cut(base.unionByName(keyed), "wide")
    scc = components(wide)

    def contested(df: DataFrame) -> DataFrame:
        return (
            df.join(scc.select(F.col("id").alias("src"), "scc"), "src")
            .join(scc.select(F.col("id").alias("dst"), F.col("scc").alias("_b")), "dst")
            .where("scc = _b").select("src", "dst", "weight", "scc")
        )

    touched = contested(wide)
    sizes = touched.groupBy("scc").agg((F.count("*") > piece_edges).alias("big"))
    sized = cut(touched.join(sizes, "scc"), "contested")
    small = sized.where("NOT big").groupBy("scc").applyInPandas(_append_in_order, "src string, dst string")
    refused = [cut(small, "refused")]
    large = sized.where("big").select("src", "dst", "weight")
    settled, waiting = large.where("weight = ''"), large.where("weight <> ''")
    while not waiting.isEmpty():
        # the way back runs from the topic (dst) to the prerequisite (src)
        asked = waiting.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("weight").alias("own"))
        cost = cut(_bottlenecks(asked, settled.unionByName(waiting)), "cost")
        verdict = cost.select(
            F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("own").alias("weight"),
            F.when(F.col("cost") == "", "cycle").when(F.col("cost").isNull() | (F.col("cost") > F.col("own")), "ok").alias("v"),
        )
        refused.append(cut(verdict.where("v = 'cycle'").select("src", "dst"), "refused"))
        settled = cut(settled.unionByName(verdict.where("v = 'ok'").select("src", "dst", F.lit("").alias("weight"))), "settled")
        waiting = cut(verdict.where("v IS NULL").select("src", "dst", "weight"), "waiting")
    out = judged
    closing = keyed.select("src", "dst").limit(0)
    for part in refused:
        closing = closing.union(part)
    closing = closing.select(F.col("dst").alias("topic_id"), F.col("src").alias("prerequisite_id"), F.lit(True).alias("_cycle"))
    accepted_back = keyed.select(
        F.col("src").alias("topic_id"), F.col("dst").alias("prerequisite_id"), F.col("weight").alias("_other")
    )
    accepted_back = accepted_back.join(
        closing.select(F.col("topic_id"), F.col("prerequisite_id")).select(F.col("prerequisite_id").alias("topic_id"), F.col("topic_id").alias("prerequisite_id")),
        KEY, "left_anti",
    )
    own = F.concat("topic_id", F.lit("|"), "prerequisite_id")
    final = (
        F.when(F.col("rejected_reason").isNotNull(), F.col("rejected_reason"))
        .when(F.col("_cycle") & (F.col("_other") < own), "reverse-conflict")
        .when(F.col("_cycle"), "cycle")
    )
    out = out.join(closing, KEY, "left").join(accepted_back, KEY, "left")
    return out.select(
        *proposals.columns,
        F.when(final.isNull(), "accepted").otherwise("rejected").alias("verdict"),
        final.alias("rejected_reason"),
        F.when(final.isNull(), "machine").alias("review_status"),
        (F.col("age_regression") & final.isNull()).alias("age_regression"),
        F.when(final.isNull(), F.lit(batch_id)).alias("generation_batch_id"),
    )
