"""Snapshots that carry a hash tree, so that two states of a table are compared by reading only what differs.

Rows lie in ``tops`` folders by the hash of their key and are sorted by one of ``leaves`` leaves inside a folder.  A leaf's digest
is the sum of its rows' digests, a top's digest the hash of its leaves.  Both levels are small tables, bounded by the two
parameters, not by the rows; take about as many leaves as the table has blocks of 128 MB.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepstone.functions.columns import fingerprint

TOPS, LEAVES = 64, 64
TOPS_SCHEMA, LEAVES_SCHEMA = "top int, digest string", "top int, leaf int, n bigint, digest string"


def _tops(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOPS_SCHEMA).parquet(f"{path}/tops")


def _leaves(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEAVES_SCHEMA).parquet(f"{path}/leaves")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/rows")


def create_tree_snapshot(df: DataFrame, path: str, key: Sequence[str], tops: int = TOPS, leaves: int = LEAVES) -> str:
    """Write ``df`` with the digests of its leaves and tops.

    A row is kept as one struct, so its columns may have any names.  Null keys are keys.  The digests show accidental changes;
    they are sums of 60-bit numbers and no defence against forgery.
    """
    place = F.pmod(F.xxhash64(*key), F.lit(tops * leaves))
    digest = F.conv(F.substring(fingerprint(*df.columns), 1, 15), 16, 10).cast("bigint")
    placed = df.select(
        F.struct(*df.columns).alias("row"), digest.alias("digest"),
        F.floor(place / leaves).cast("int").alias("top"), (place % leaves).cast("int").alias("leaf"),
    )
    rows = placed.repartition("top", "leaf").sortWithinPartitions("top", "leaf")
    spark = df.sparkSession
    spark.createDataFrame([], placed.schema).write.parquet(f"{path}/schema")  # a table without rows leaves no other file
    rows.write.partitionBy("top").parquet(f"{path}/rows")
    summed = _rows(spark, path).groupBy("top", "leaf").agg(F.count("*").alias("n"), F.sum(F.col("digest").cast("decimal(38,0)")).cast("string").alias("digest"))
    summed.write.parquet(f"{path}/leaves")
    entry = F.struct("leaf", F.concat_ws(":", "leaf", "n", "digest").alias("text"))
    # at most ``leaves`` entries each
    _leaves(spark, path).groupBy("top").agg(F.array_sort(F.collect_list(entry)).alias("x")).select(
        "top", F.sha2(F.array_join(F.transform("x", lambda e: e["text"]), "|"), 256).alias("digest")
    ).write.parquet(f"{path}/tops")
    return path


def _unequal(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    a = before.withColumnsRenamed({"n": "n_before", "digest": "digest_before"})
    b = after.withColumnsRenamed({"n": "n_after", "digest": "digest_after"})
    both = a.join(b, list(keys), "full_outer")
    same = F.col("digest_before").eqNullSafe(F.col("digest_after"))
    if "n" in before.columns:
        same = same & F.col("n_before").eqNullSafe(F.col("n_after"))
    return both.where(~same)


def differing_leaves(spark: SparkSession, before: str, after: str) -> DataFrame:
    """(top, leaf, n_before, n_after, …) of the leaves that are not the same in both snapshots; no row is read for it.

    Both snapshots must have been written with the same key and numbers of tops and leaves.
    """
    tops = _unequal(_tops(spark, before), _tops(spark, after), ["top"]).select("top")
    a, b = (_leaves(spark, p).join(tops, "top", "left_semi") for p in (before, after))
    return _unequal(a, b, ["top", "leaf"])


def rows_of_leaves(spark: SparkSession, path: str, places: Sequence[tuple[int, int]]) -> DataFrame:
    """(top, leaf, row, digest) of the rows in the given leaves: other folders and other row groups are skipped."""
    rows = _rows(spark, path)
    by_top: dict[int, list[int]] = {}
    for top, leaf in places:
        by_top.setdefault(top, []).append(leaf)
    wanted = F.lit(False)
    if by_top:
        wanted = F.col("top").isin(*by_top) & F.col("leaf").isin(*sorted({leaf for _, leaf in places}))
    exact = spark.createDataFrame(list(places), "top int, leaf int")
    return rows.where(wanted).join(exact, ["top", "leaf"], "left_semi")


def diff_trees(spark: SparkSession, before: str, after: str, key: Sequence[str]) -> DataFrame:
    """Added, removed, changed and unchanged row counts between two tree snapshots; changes without rows are left out.

    Only the differing leaves, at most tops × leaves of them, are named to the driver, and only their rows are read.  Rows that
    share a key are compared together: they are changed when their numbers or any of them differ.
    """
    places = [(r.top, r.leaf) for r in differing_leaves(spark, before, after).select("top", "leaf").collect()]

    def side(path: str, name: str) -> DataFrame:
        keys = [F.col(f"row.{k}").alias(f"k{i}") for i, k in enumerate(key)]
        found = rows_of_leaves(spark, path, places).select(*keys, "digest")
        return found.groupBy(*[f"k{i}" for i in range(len(key))]).agg(
            F.struct(F.count("*").alias("n"), F.sum(F.col("digest").cast("decimal(38,0)")).alias("sum")).alias(name)
        ).alias(name)

    a, b = side(before, "a"), side(after, "b")
    match = reduce(lambda x, y: x & y, [F.col(f"a.k{i}").eqNullSafe(F.col(f"b.k{i}")) for i in range(len(key))])
    change = (
        F.when(F.col("a.a").isNull(), "added").when(F.col("b.b").isNull(), "removed")
        .when(F.col("a.a") != F.col("b.b"), "changed").otherwise("unchanged")
    )
    read = a.join(b, match, "full_outer").select(
        change.alias("change"), F.greatest(F.coalesce("a.a.n", F.lit(0)), F.coalesce("b.b.n", F.lit(0))).alias("n")
    )
    differing = spark.createDataFrame(places, "top int, leaf int")
    skipped = _leaves(spark, before).join(differing, ["top", "leaf"], "left_anti").select(F.lit("unchanged").alias("change"), "n")
    return read.union(skipped).groupBy("change").agg(F.sum("n").alias("n"))
