"""Positions and neighbours inside ordered groups, whatever share of the rows a group holds.

A window over ``partitionBy(group)`` would sort a whole group in one task.  Rows are range-partitioned by (group, order)
instead, so a hot group is spread over many tasks, and the pieces are stitched together with what is known of each piece,
of which there are at most (groups + partitions).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from stepstone.session import cut


def _join_pieces(rows: DataFrame, pieces: DataFrame, group: Sequence[str]) -> DataFrame:
    """Join what is known of each piece of a group to the piece's rows; a null group is a group."""
    keys = [*group, "_piece"]
    named = pieces.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return rows.join(named, match)


def _ranged(df: DataFrame, group: Sequence[str], order: Sequence[str], parts: int | None) -> DataFrame:
    keys = [*group, *order]
    spread = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    numbered = spread.sortWithinPartitions(*keys).select(
        "*", F.spark_partition_id().alias("_piece"), F.monotonically_increasing_id().alias("_row")
    )
    return cut(numbered, "ranged")


def with_position(
    df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "pos", parts: int | None = None
) -> DataFrame:
    """Add the 1-based position of each row in its group; ``order`` must be a total order.

    Rows of a group are consecutive in a piece, so their place in the piece is enough; no second sort is needed.
    """
    ranged = _ranged(df, group, order, parts)
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        ranged.groupBy(*group, "_piece")
        .agg(F.count("*").alias("_rows"), F.min("_row").alias("_first"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)) + 1 - F.col("_first"))
    )
    return _join_pieces(ranged, runs, group).select(*df.columns, (F.col("_row") + F.col("_offset")).alias(name))


def _following(columns: Sequence[str], names: Sequence[str]) -> Callable[[Iterable[pa.RecordBatch]], Iterable[pa.RecordBatch]]:
    """Batches of sorted rows in, the same rows with ``columns`` of the row before, and marks on a piece's first and last row, out."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held = before = None

        def marked(batch: pa.RecordBatch, last: bool) -> pa.RecordBatch:
            nonlocal before
            n, own = batch.num_rows, [batch.column(batch.schema.get_field_index(c)) for c in columns]
            if before is None:
                lead = [pa.nulls(1, c.type) for c in own]
            else:
                lead = before
            moved = [pa.concat_arrays([x, c.slice(0, n - 1)]) for x, c in zip(lead, own, strict=True)]
            first = pa.array([before is None] + [False] * (n - 1))
            end = pa.array([False] * (n - 1) + [last])
            before = [c.slice(n - 1, 1) for c in own]
            return pa.RecordBatch.from_arrays([*batch.columns, *moved, first, end], names=[*batch.schema.names, *names])

        for batch in batches:
            if batch.num_rows:
                if held is not None:
                    yield marked(held, False)
                held = batch
        if held is not None:
            yield marked(held, True)

    return step


def with_previous(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    name: str = "prev",
    parts: int | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Add struct ``name`` holding ``values`` of the row before, null on the first row of a group.

    With ``where``, a condition on the result, only rows that meet it are returned; the others are not written either, but for the
    ends of pieces.

    The rows of a piece are in order, so each takes its values from the one before it as they pass, without another shuffle.
    Only the first row of a piece looks at the last row of the piece before, and there is one such row for each piece.
    """
    keys = [*group, *order]
    spread = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    carried = list(dict.fromkeys([*group, *values]))
    moved = {c: f"_before_{i}" for i, c in enumerate(carried)}
    placed = spread.sortWithinPartitions(*keys).withColumn("_piece", F.spark_partition_id())
    fields = [StructField(moved[c], placed.schema[c].dataType) for c in carried]
    marks = [StructField(c, BooleanType()) for c in ("_head", "_tail")]
    shifted = placed.mapInArrow(
        _following(carried, [*moved.values(), "_head", "_tail"]), StructType([*placed.schema.fields, *fields, *marks])
    )

    def taken(known: Column, of: Callable[[str], Column]) -> Column:
        """The values of the row before, if it is one of the same group; a null group is a group."""
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(of(c)) for c in group], known)
        return F.when(same, F.struct(*[of(c).alias(c) for c in values]))

    within = shifted.select(*df.columns, "_piece", "_head", "_tail", taken(~F.col("_head"), lambda c: F.col(moved[c])).alias(name))
    ranged = cut(within if where is None else within.where(where | F.col("_head") | F.col("_tail")), "ranged")
    ends = ranged.where("_tail").select("_piece", F.struct(*[F.col(c).alias(moved[c]) for c in carried]).alias("_end"))
    before = ends.select(F.col("_piece"), F.lag("_end").over(Window.orderBy("_piece")).alias("_end"))
    edge = cut(before.where("_end IS NOT NULL").select("_piece", F.lit(True).alias("_head"), "_end"), "ends")
    across = taken(F.col("_end").isNotNull(), lambda c: F.col(f"_end.{moved[c]}"))
    found = ranged.join(edge, ["_piece", "_head"], "left").select(*df.columns, F.coalesce(name, across).alias(name))
    return found if where is None else found.where(where)
