"""De-duplication by content and by name, id allocation and first-come proposal conflicts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepstone.operators.ordering import with_position
from stepstone.session import cut, cut_counted

# Which origin survives among equal names, highest first.
ORIGIN_PRIORITY = {"cn_only": 5, "upstream_adapt": 4, "cross_domain": 3, "progression": 2, "textbook": 1}


def content_key(*cols: str) -> Column:
    """Digest of the columns that make two rows the same; nulls and texts cannot run into each other."""
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in cols]
    return F.sha2(F.concat(*parts), 256)


def exact_duplicates(rows: DataFrame, key: Sequence[str], split_flag: Column, order: str = "num") -> DataFrame:
    """(dup_id, keep_id) per copy: rows that are not splits come first, then the smallest ``order``.

    The keeper of a group is a minimum, so copies are combined before the shuffle and even a group with
    a third of all rows stays one small record; the copies then look their keeper up.
    """
    keyed = rows.select("id", content_key(*key).alias("key"), F.struct(split_flag.alias("split"), F.col(order).alias("ord"), "id").alias("v"))
    keep = keyed.groupBy("key").agg(F.min("v").alias("k"), F.count("*").alias("copies")).where("copies > 1")
    return (
        keyed.join(keep, "key")
        .where(F.col("id") != F.col("k.id"))
        .select(F.col("id").alias("dup_id"), F.col("k.id").alias("keep_id"))
    )


def same_name(
    rows: DataFrame, priority: Mapping[str, int] = ORIGIN_PRIORITY, age_gap: int = 3,
    suffixes: tuple[int, str, str] = (12, "（初中）", "（高中）"),
) -> DataFrame:
    """Survivor per name: best origin, longest description, smallest id; renamed when ages span too far.

    Returns one row per name with copies: (name, keep_id, copies, new_name).
    """
    rank = F.lit(0)
    for origin, value in priority.items():
        rank = F.when(F.col("origin") == origin, value).otherwise(rank)
    age = F.coalesce("age_start", F.lit(0))
    best = F.struct((-rank).alias("r"), (-F.coalesce(F.length("description"), F.lit(0))).alias("l"), F.col("id"), age.alias("a"))
    group = rows.groupBy("name").agg(
        F.min(best).alias("b"), F.min(age).alias("lo"), F.max(age).alias("hi"), F.count("*").alias("copies")
    )
    limit, young, old = suffixes
    far = F.greatest(F.col("hi") - F.col("b.a"), F.col("b.a") - F.col("lo")) > age_gap
    suffix = F.when(F.col("b.a") <= limit, young).otherwise(old)
    return group.where("copies > 1").select(
        "name", F.col("b.id").alias("keep_id"), "copies",
        F.when(far, F.concat("name", suffix)).otherwise(F.col("name")).alias("new_name"),
    )


def allocate_ids(new_rows: DataFrame, existing: DataFrame, order: Sequence[str], prefix: str = "mtc_") -> DataFrame:
    """Running ids after the largest numeric suffix in use."""
    suffix = F.regexp_extract("id", f"^{prefix}(\\d+)$", 1)
    last = existing.agg(F.coalesce(F.max(F.when(suffix != "", suffix.cast("bigint"))), F.lit(0))).scalar()
    placed = with_position(new_rows, [], order, "_n")
    return placed.withColumn("new_id", F.concat(F.lit(prefix), (F.col("_n") + last).cast("string"))).drop("_n")


def resolve_name_conflicts(proposals: DataFrame, names: DataFrame, complete: DataFrame | None = None) -> DataFrame:
    """First proposal of a bucket to claim a name keeps it; a later one with a claimed name is for review.

    ``proposals`` (bucket, ord, id), ``names`` (bucket, id, name).  A proposal that loses frees its other
    names again, so the answer depends on the order.  A name with one claim in its bucket can't keep anyone waiting, so
    only claims on contested names go through rounds; all other proposals are accepted.  Each round decides, with two
    aggregations, every proposal that is first in line for all of its contested names; no bucket is gathered in one place.
    Buckets not in ``complete`` are withheld.
    """
    if complete is not None:
        proposals = proposals.join(complete, "bucket", "left_semi")
    # by (bucket, id) from the start: equal claims meet there, and so do their proposals
    different = names.select("bucket", "id", "name").where("name IS NOT NULL").repartition("bucket", "id").distinct()
    claims = cut(different.join(proposals, ["bucket", "id"]).select("bucket", "ord", "id", "name"), "claims")
    contested = cut(claims.groupBy("bucket", "name").agg(F.count("*").alias("n")).where("n > 1").select("bucket", "name"), "contested")
    waiting, left = cut_counted(claims.join(contested, ["bucket", "name"]).select("bucket", "ord", "id", "name"), "waiting")
    accepted = proposals.select("bucket", "id").join(waiting.select("bucket", "id").distinct(), ["bucket", "id"], "left_anti")
    lost = accepted.limit(0)
    while left:
        head = waiting.groupBy("bucket", "name").agg(F.min("ord").alias("head"))
        won = cut(
            waiting.join(head, ["bucket", "name"])
            .groupBy("bucket", "id")
            .agg(F.min(F.col("ord") == F.col("head")).alias("first"))
            .where("first")
            .select("bucket", "id"),
            "won",
        )
        taken = waiting.join(won, ["bucket", "id"]).select("bucket", "name")
        late = waiting.join(won, ["bucket", "id"], "left_anti").join(taken, ["bucket", "name"], "left_semi")
        losers = cut(late.select("bucket", "id").distinct(), "lost")
        waiting, left = cut_counted(
            waiting.join(won, ["bucket", "id"], "left_anti").join(losers, ["bucket", "id"], "left_anti"), "waiting"
        )
        accepted, lost = accepted.union(won), lost.union(losers)
    return accepted.withColumn("verdict", F.lit("split")).union(lost.withColumn("verdict", F.lit("review")))
