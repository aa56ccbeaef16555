"""Edges from ordering rules, windows and votes; union, remap and curated inserts of edge tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepstone.functions.columns import age_stage
from stepstone.operators.ordering import with_position, with_previous

KEY = ["topic_id", "prerequisite_id"]

# Groups of parallel subfields whose members never require each other.
PARALLEL_SUBFIELDS = (
    ("美术", "音乐"), ("美术", "戏曲"), ("美术", "舞蹈"), ("音乐", "戏曲"), ("音乐", "舞蹈"),
    ("体操", "球类"), ("体操", "田径"), ("球类", "田径"), ("武术", "球类"), ("武术", "体操"),
    ("武术", "田径"), ("游泳", "球类"), ("游泳", "体操"), ("游泳", "田径"),
)


def age_chain(topics: DataFrame) -> DataFrame:
    """Link neighbours of each (subject, domain) by age: soft inside a stage, hard across stages."""
    keyed = topics.select(
        "subject", "domain", "id", "name",
        F.coalesce("age_start", F.lit(0)).alias("a"), F.coalesce("age_end", F.lit(0)).alias("b"),
    )
    linked = with_previous(keyed, ["subject", "domain"], ["a", "b", "id"], ["id", "name", "a"])
    now, then = age_stage("a"), age_stage(F.col("prev.a"))
    arrow = F.concat(F.col("prev.name"), F.lit(" → "), F.col("name"))
    return linked.where(F.col("prev.id") != F.col("id")).select(
        F.col("id").alias("topic_id"),
        F.col("prev.id").alias("prerequisite_id"),
        F.when(now == then, "soft").otherwise("hard").alias("strength"),
        F.when(now == then, F.concat("domain", F.lit(": "), arrow))
        .otherwise(F.concat(then, F.lit("→"), now, F.lit(": "), arrow))
        .alias("reason"),
    )


def rule_edges(topics: DataFrame, rules: DataFrame) -> DataFrame:
    """One hard edge per (subject, from_domain, to_domain) rule.

    From the youngest topic of one domain to the first topic of the other that starts when the source
    ends, or else to its youngest topic.
    """
    item = F.struct(F.coalesce("age_start", F.lit(0)).alias("a"), "id", "name", F.coalesce("age_end", F.lit(0)).alias("b"))
    source = (
        topics.groupBy("subject", F.col("domain").alias("from_domain")).agg(F.min(item).alias("s"))
        .join(rules, ["subject", "from_domain"])
    )
    late = F.when(F.col("age_start") >= F.col("s.b"), 0).otherwise(1)
    order = F.struct(late.alias("late"), F.coalesce("age_start", F.lit(0)).alias("a"), "id", "name")
    target = (
        topics.select("subject", F.col("domain").alias("to_domain"), "id", "name", "age_start")
        .join(source, ["subject", "to_domain"])
        .groupBy("subject", "from_domain", "to_domain", "s")
        .agg(F.min(order).alias("t"))
    )
    return target.where(F.col("s.id") != F.col("t.id")).select(
        F.col("t.id").alias("topic_id"),
        F.col("s.id").alias("prerequisite_id"),
        F.lit("hard").alias("strength"),
        F.concat("from_domain", F.lit(" before "), "to_domain", F.lit(": "), "s.name", F.lit(" → "), "t.name").alias("reason"),
    )


def row_windows(
    rows: DataFrame, bucket: Sequence[str], order: Sequence[str], whole: int = 30, size: int = 25, step: int = 15
) -> DataFrame:
    """Overlapping row windows: small buckets whole, larger ones cut every ``step`` rows; singles dropped."""
    counts = rows.groupBy(*bucket).agg(F.count("*").alias("n"))
    placed = with_position(rows, bucket, order).join(counts, list(bucket)).withColumn("i", F.col("pos") - 1)
    first = F.greatest(F.lit(0), F.ceil((F.col("i") - (size - 1)) / step)).cast("int")
    windows = F.when(F.col("n") <= whole, F.array(F.lit(0))).otherwise(
        F.sequence(first, F.floor(F.col("i") / step).cast("int"))
    )
    spread = placed.withColumn("window", F.explode(windows))
    in_window = F.when(F.col("n") <= whole, F.col("n")).otherwise(
        F.least(F.lit(size), F.col("n") - F.col("window") * step)
    )
    return spread.withColumn("window_rows", in_window).where(F.col("window_rows") >= 2).drop("n", "i")


def fixed_batches(
    rows: DataFrame, bucket: Sequence[str], order: Sequence[str], size: int = 20
) -> DataFrame:
    """Batches of ``size`` rows inside each bucket."""
    return with_position(rows, bucket, order).withColumn("batch", F.floor((F.col("pos") - 1) / size)).drop("pos")


def first_wins(sources: Sequence[DataFrame], key: Sequence[str] = KEY) -> DataFrame:
    """Union where the first source that has a key decides; one shuffle, combined before it."""
    rest = [c for c in sources[0].columns if c not in key]
    ranked = [s.select(*key, F.struct(F.lit(i).alias("rank"), *rest).alias("v")) for i, s in enumerate(sources)]
    union = ranked[0]
    for more in ranked[1:]:
        union = union.unionByName(more)
    return union.groupBy(*key).agg(F.min("v").alias("v")).select(*key, *[F.col(f"v.{c}").alias(c) for c in rest], F.col("v.rank").alias("source_rank"))


def merge_votes(votes: DataFrame, valid_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, dropped): majority strength (a tie is hard) and the first non-empty reason per edge.

    ``votes`` has (topic_id, prerequisite_id, strength, reason, arrival); votes naming unknown topics are
    counted and dropped.
    """
    ids = valid_ids.select("id")
    known = votes.join(ids, F.col("topic_id") == F.col("id"), "left_semi").join(
        ids, F.col("prerequisite_id") == F.col("id"), "left_semi"
    )
    said = F.when(F.col("reason") != "", F.struct("arrival", "reason"))
    edges = known.groupBy(*KEY).agg(
        F.when(F.count_if(F.col("strength") == "hard") >= F.count_if(F.col("strength") == "soft"), "hard")
        .otherwise("soft")
        .alias("strength"),
        F.min(said)["reason"].alias("reason"),
        F.count("*").alias("votes"),
    )
    total, kept = votes.agg(F.count("*")).scalar(), known.agg(F.count("*").alias("kept"))
    return edges, kept.select((total - F.col("kept")).alias("dropped"))


def subfield(name: Column) -> Column:
    """Text before the middle dot of a name, when it has one and no bracket comes first."""
    return F.trim(F.regexp_extract(name, r"^([^·\[（(]+)·", 1))


def drop_parallel_subfields(
    edges: DataFrame, topics: DataFrame, pairs: Sequence[tuple[str, str]] = PARALLEL_SUBFIELDS
) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): edges between two subfields listed as parallel are removed."""
    keys = [f"{a}|{b}" for a, b in pairs] + [f"{b}|{a}" for a, b in pairs]
    t = topics.select(F.col("id").alias("topic_id"), subfield(F.col("name")).alias("_t"))
    p = topics.select(F.col("id").alias("prerequisite_id"), subfield(F.col("name")).alias("_p"))
    wide = edges.join(t, "topic_id", "left").join(p, "prerequisite_id", "left")
    hit = F.coalesce(
        (F.col("_t") != "") & (F.col("_p") != "") & (F.col("_t") != F.col("_p"))
        & F.concat_ws("|", "_t", "_p").isin(*keys),
        F.lit(False),
    )
    removed = wide.where(hit).withColumn("removed_reason", F.concat(F.lit("parallel subfields "), "_p", F.lit("↔"), "_t"))
    return wide.where(~hit).drop("_t", "_p"), removed.drop("_t", "_p")


def remap_endpoints(edges: DataFrame, mapping: DataFrame, order: Sequence[str]) -> DataFrame:
    """Replace both ends through a (dup_id, keep_id) map, drop self loops, keep the first of duplicates."""
    m = mapping.select("dup_id", "keep_id")
    rest = [c for c in edges.columns if c not in KEY]
    moved = (
        edges.join(m.select(F.col("dup_id").alias("topic_id"), F.col("keep_id").alias("_t")), "topic_id", "left")
        .join(m.select(F.col("dup_id").alias("prerequisite_id"), F.col("keep_id").alias("_p")), "prerequisite_id", "left")
        .select(
            F.coalesce("_t", "topic_id").alias("topic_id"),
            F.coalesce("_p", "prerequisite_id").alias("prerequisite_id"),
            F.struct(*order, *[c for c in rest if c not in order]).alias("v"),
        )
        .where(F.col("topic_id") != F.col("prerequisite_id"))
    )
    return moved.groupBy(*KEY).agg(F.min("v").alias("v"), F.count("*").alias("merged")).select(
        *KEY, *[F.col(f"v.{c}").alias(c) for c in rest], "merged"
    )


def insert_curated(
    curated: DataFrame, existing: DataFrame, topics: DataFrame, source_stage: str, target_stage: str
) -> DataFrame:
    """Each curated edge with the reason it is skipped, or null when it is to be added."""
    t = topics.select(F.col("id").alias("topic_id"), F.col("stage").alias("_ts"))
    p = topics.select(F.col("id").alias("prerequisite_id"), F.col("stage").alias("_ps"))
    old = existing.select(*KEY, F.lit(True).alias("_old")).distinct()
    joined = curated.join(t, "topic_id", "left").join(p, "prerequisite_id", "left").join(old, KEY, "left")
    skip = (
        F.when(F.col("_ts").isNull() | F.col("_ps").isNull(), "unknown-endpoint")
        .when(F.col("topic_id") == F.col("prerequisite_id"), "self")
        .when(F.col("_old"), "duplicate")
        .when(F.col("_ps") != source_stage, "source-stage")
        .when(F.col("_ts") != target_stage, "target-stage")
    )
    return joined.withColumn("skipped", skip).drop("_ts", "_ps", "_old")
