"""How much of a graph each node leads to, and whether one node leads to another, without a table of all pairs.

Counts come from sets that are united along the edges: words of 64 bits for exact counts, sketches for approximate ones.  A set is one
row for each node and part that it has members in, and only nodes whose set has grown in a round are read again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepstone.operators.graph import COUNTED_KINDS, shortcuts
from stepstone.session import cut, cut_counted

#: Logarithm of a sketch's registers; the standard error of a count is 1.04 / sqrt(registers).
SKETCH_BITS = 12
#: Paths of up to 2^DOUBLINGS edges become edges before sets are united, while their number stays bounded.
DOUBLINGS = 4


def _either(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for more in tables[1:]:
        out = out.union(more)
    return out


def _united(direct: DataFrame, hops: DataFrame, unite: Callable[[str], Column], size: Callable[[str], Column], compact_every: int = 6) -> DataFrame:
    """(node, part, n): the size of every node's set, united with the sets of all nodes it leads to.

    ``direct`` has (node, part, members) as the edges give them.  A set never shrinks, so older and newer rows of a set may be kept
    side by side: united they are the newest.
    """
    back = hops.select(F.col("src").alias("before"), F.col("dst").alias("node"))
    moved, rows = cut_counted(direct.withColumn("n", size("members")), "members")
    known = [moved]
    for done in count(1):
        if not rows:
            break
        offers = moved.join(back, "node").select(F.col("before").alias("node"), "part", "members", F.lit(0).cast("bigint").alias("n"))
        own = _either(known).join(offers.select("node", "part").distinct(), ["node", "part"], "left_semi").select("node", "part", "members", "n")
        both = offers.union(own).groupBy("node", "part").agg(unite("members").alias("members"), F.max("n").alias("was"))
        grown = both.withColumn("n", size("members")).where(F.col("n") > F.col("was"))
        moved, rows = cut_counted(grown.select("node", "part", "members", "n"), "members")
        known.append(moved)
        if done % compact_every == 0:
            newest = _either(known).groupBy("node", "part").agg(unite("members").alias("members"), F.max("n").alias("n"))
            known = [cut(newest, "sets")]
    return _either(known).groupBy("node", "part").agg(F.max("n").alias("n"))


def numbered(nodes: DataFrame) -> DataFrame:
    """(id, part, bit) of distinct nodes: 64 neighbours in the order of ids share a part, each with a bit of its own."""
    dealt = nodes.select("id").distinct().repartitionByRange("id").withColumn("place", F.monotonically_increasing_id())
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % 64).cast("int"))
    return cut(dealt.select("id", F.shiftright("place", 6).alias("part"), bit.alias("bit")), "numbered")


def reached(counted: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, reach): how many of ``counted`` each node leads to by a path of at least one edge; nodes with none are left out.

    All nodes are passed through.  A set is rows of 64 bits, one for each part that it has members in: a row holds up to 64
    pairs, and where members lie far apart there are no more rows than pairs.
    """
    hops = shortcuts(pairs, DOUBLINGS)
    members = F.bit_or("bit").alias("members")
    direct = hops.join(numbered(counted).hint("merge"), F.col("dst") == F.col("id")).groupBy(F.col("src").alias("node"), "part").agg(members)
    sets = _united(direct, hops, F.bit_or, lambda c: F.bit_count(c).cast("bigint"))
    return sets.groupBy(F.col("node").alias("id")).agg(F.sum("n").alias("reach"))


def reached_sketch(counted: DataFrame, pairs: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """(id, reach): like :func:`reached`, estimated by one sketch of 2^``bits`` registers for each node.

    A set's growth is passed on while it changes the rounded estimate, so small sets are exact but for collisions.
    """
    hops = shortcuts(pairs, DOUBLINGS)
    members = F.hll_sketch_agg("dst", F.lit(bits)).alias("members")
    ends = counted.select("id").distinct()
    direct = hops.join(ends, F.col("dst") == F.col("id"), "left_semi").groupBy(F.col("src").alias("node"), F.lit(0).alias("part")).agg(members)
    sets = _united(direct, hops, F.hll_union_agg, F.hll_sketch_estimate)
    return sets.select(F.col("node").alias("id"), F.col("n").alias("reach"))


def reach_counts(topics: DataFrame, pairs: DataFrame, kinds: Sequence[str] = COUNTED_KINDS, exact: bool = True) -> DataFrame:
    """Counted topics reachable from each counted topic; other kinds are passed through, not counted."""
    counted = topics.where(F.col("node_kind").isNull() | F.col("node_kind").isin(*kinds)).select("id")
    hits = reached(counted, pairs) if exact else reached_sketch(counted, pairs)
    return counted.join(hits.hint("merge"), "id", "left").select("id", F.coalesce("reach", F.lit(0)).alias("reach"))


def centrality(topics: DataFrame, pairs: DataFrame, kinds: Sequence[str] = COUNTED_KINDS) -> DataFrame:
    """Reach over the largest reach (at least 1), six decimals; null for kinds that are not counted."""
    counts = cut(reach_counts(topics, pairs, kinds), "reach_counts")
    top = counts.agg(F.greatest(F.max("reach"), F.lit(1))).scalar()
    return topics.select("id").join(counts.hint("merge"), "id", "left").select(
        "id", F.round(F.col("reach") / top, 6).alias("centrality")
    )


def descent_labels(pairs: DataFrame, seed: int = 5) -> DataFrame:
    """(id, low, high): the smallest and largest hash of each node and all nodes it leads to.

    A node can only lead to nodes whose interval lies within its own, which refutes most pairs by a look.
    """
    ends = pairs.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    own = F.xxhash64("id", F.lit(seed))
    state = cut(ends.select("id", own.alias("low"), own.alias("high")), "labels")
    back = pairs.select(F.col("src").alias("before"), F.col("dst").alias("id"))
    moved, rows = state, 1
    while rows:
        offers = moved.join(back, "id").groupBy(F.col("before").alias("id")).agg(F.min("low").alias("l"), F.max("high").alias("h"))
        wider = state.join(offers, "id").where((F.col("l") < F.col("low")) | (F.col("h") > F.col("high")))
        moved, rows = cut_counted(wider.select("id", F.least("low", "l").alias("low"), F.greatest("high", "h").alias("high")), "labels")
        if rows:
            state = cut(state.join(moved, "id", "left_anti").union(moved), "labels")
    return state


def reachable_pairs(requested: DataFrame, pairs: DataFrame) -> DataFrame:
    """Flag distinct (src, dst) requests by whether dst can be reached from src; a node reaches itself.

    Intervals refute most requests.  The others are searched from both ends, a step at a time on the side with fewer rows;
    nodes whose interval rules the request out are not entered, and a request leaves both sides when they meet or one of
    them can go no further.  What is read grows with the requests, not with what their ends lead to.
    """
    asked = cut(requested.select("src", "dst").distinct(), "asked")
    links = shortcuts(pairs, DOUBLINGS)
    labels = descent_labels(links)
    key = ["src", "dst"]

    def named(*names: str) -> DataFrame:
        return labels.select(*[F.col(c).alias(n) for c, n in zip(("id", "low", "high"), names, strict=True)])

    within = (F.col("s_low") <= F.col("d_low")) & (F.col("s_high") >= F.col("d_high"))
    both = asked.where("src <> dst").join(named("src", "s_low", "s_high"), "src").join(named("dst", "d_low", "d_high"), "dst").where(within)
    begun = cut(both, "searched")
    # a row has the interval of the other end; hops have that of the node they lead to
    ahead = begun.select(*key, F.col("src").alias("node"), F.col("d_low").alias("low"), F.col("d_high").alias("high"))
    behind = begun.select(*key, F.col("dst").alias("node"), F.col("s_low").alias("low"), F.col("s_high").alias("high"))
    steps = [
        links.select(F.col("src").alias("node"), F.col("dst").alias("next")).join(named("next", "n_low", "n_high"), "next"),
        links.select(F.col("dst").alias("node"), F.col("src").alias("next")).join(named("next", "n_low", "n_high"), "next"),
    ]
    steps = [cut(x, "steps") for x in steps]
    may = [
        (F.col("n_low") <= F.col("low")) & (F.col("n_high") >= F.col("high")),
        (F.col("n_low") >= F.col("low")) & (F.col("n_high") <= F.col("high")),
    ]
    fresh, seen = [ahead, behind], [[ahead], [behind]]
    rows = [begun.count()] * 2
    found = [asked.where("src = dst")]
    while all(rows):
        side = int(rows[1] < rows[0])
        new = fresh[side].join(steps[side], "node").where(may[side]).select(*key, F.col("next").alias("node"), "low", "high").distinct()
        new = cut(new.join(_either(seen[side]), [*key, "node"], "left_anti"), "step")
        met = cut(new.join(_either(seen[1 - side]), [*key, "node"], "left_semi").select(*key).distinct(), "met")
        found.append(met)
        seen[side].append(new)
        going = new.join(met, key, "left_anti")
        fresh[side], rows[side] = cut_counted(going, "step")
        other = fresh[1 - side].join(fresh[side].select(*key).distinct(), key, "left_semi")
        fresh[1 - side], rows[1 - side] = cut_counted(other, "step")
    hits = _either(found).withColumn("_hit", F.lit(True))
    return requested.join(hits, key, "left").select(*key, F.coalesce("_hit", F.lit(False)).alias("reachable"))
