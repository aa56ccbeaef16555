"""Per-key state over event streams: admission by a sliding log, learner state and recent trails."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegerType, StructField, StructType

from stepstone.operators.recommend import STATES
from stepstone.session import cut, scratch_path

#: Buckets of a keyed table; a batch that touches few keys rewrites few of them.
BUCKETS = 64


def event_stream(spark: SparkSession, folder: str, file: str, files_per_batch: int = 1) -> DataFrame:
    """File stream of one table; a micro-batch takes a bounded number of files."""
    schema = spark.read.parquet(f"{folder}/{file}").schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", file)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def run_to_table(stream: DataFrame, tag: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now and return what it wrote; every batch carries its number.

    A batch replayed after a failure overwrites its own folder, so the table holds each batch once.
    """
    spark = stream.sparkSession
    out, state = scratch_path(spark, tag), scratch_path(spark, f"{tag}-state")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", state)
        .trigger(availableNow=True).foreachBatch(keep).start()
    )
    query.awaitTermination()
    schema = stream.schema.add("batch", "long")
    return spark.read.schema(schema).parquet(out)


def _ordered(frames: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    return pd.concat(list(frames), ignore_index=True).sort_values(by, kind="stable")


def _judged(times: Sequence[int], recent: list[int], limit: int, span: int) -> tuple[list[bool], list[int]]:
    """Answers to events in order, and the times of allowed ones that may still count."""
    allowed = []
    for at in times:
        recent = [t for t in recent if at - t < span]
        allowed.append(len(recent) < limit)
        if allowed[-1]:
            recent.append(at)
    return allowed, recent


ADMITTED = "key bigint, event_id bigint, allowed boolean"


def admit(stream: DataFrame, limit: int, window_seconds: int) -> DataFrame:
    """Allow an event while fewer than ``limit`` allowed ones of its key lie less than the window back.

    ``stream`` has (key, event_id, ts).  Refused events leave no trace, so the state of a key is at most
    ``limit`` times.  There is no watermark: events that come late are judged when they come, none is dropped.
    """
    span = window_seconds * 1_000_000

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = _ordered(frames, ["at", "event_id"])
        allowed, recent = _judged(rows["at"], list(state.get[0]) if state.exists else [], limit, span)
        state.update((recent,))
        yield pd.DataFrame({"key": rows["key"], "event_id": rows["event_id"], "allowed": allowed})

    timed = stream.select("key", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    return timed.groupBy("key").applyInPandasWithState(step, ADMITTED, "recent array<bigint>", "append", GroupStateTimeout.NoTimeout)


def admit_and_forget(stream: DataFrame, limit: int, window_seconds: int, lateness_seconds: int) -> DataFrame:
    """:func:`admit`, where the state of idle keys leaves.

    A key goes once the largest time seen, less ``lateness_seconds``, lies the window past its newest allowed event: none of its
    times could count for an event that comes no later than that.  Events that come later still are judged like a new key's,
    but none is dropped: the watermark sets off timers only, as it is driven by a copy of each row that goes no further, and the
    rows that go on have no event time.  The events of one key in one micro-batch, as two numbers each, must fit a task.
    """
    span = window_seconds * 1_000_000

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = _ordered(frames, ["at", "event_id"])
        allowed, recent = _judged(rows["at"].tolist(), list(state.get[0]) if state.exists else [], limit, span)
        state.update((recent,))
        idle = -(-(max(recent, default=0) + span) // 1000)  # milliseconds, rounded up
        state.setTimeoutTimestamp(max(idle, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"key": rows["key"], "event_id": rows["event_id"], "allowed": allowed})

    ts = F.col("ts").cast("timestamp")
    clock = F.explode(F.array(ts, F.lit(None).cast("timestamp"))).alias("clock")
    timed = stream.select("key", "event_id", F.unix_micros(ts).alias("at"), clock)
    timed = timed.withWatermark("clock", f"{lateness_seconds} seconds").where("clock IS NULL")
    return timed.groupBy("key").applyInPandasWithState(step, ADMITTED, "recent array<bigint>", "append", GroupStateTimeout.EventTimeTimeout)


def trail(stream: DataFrame, keep: int = 8) -> DataFrame:
    """Last ``keep`` distinct topics per learner after each batch, newest first.

    ``stream`` has (learner, topic_id, event_id, ts).
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = list(state.get[0]) if state.exists else []
        for topic in _ordered(frames, ["at", "event_id"])["topic_id"]:
            if topic in seen:
                seen.remove(topic)
            seen = [*seen, topic][-keep:]
        state.update((seen,))
        yield pd.DataFrame({"learner": [key[0]], "topics": [seen[::-1]]})

    timed = stream.select("learner", "topic_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    return timed.groupBy("learner").applyInPandasWithState(
        step, "learner bigint, topics array<string>", "seen array<string>", "update", GroupStateTimeout.NoTimeout
    )


def decisions_of(stream: DataFrame) -> DataFrame:
    """The decisions of a stream that set a state, with what orders them."""
    return stream.where(F.col("decision").isin(*STATES)).select("learner", "topic_id", "decision", "ts", "event_id")


class KeyedTable:
    """A table with one row for each key, kept up to date by batches of changes.

    Rows lie in a fixed number of buckets by the hash of their key; a batch rewrites only the buckets that it touches.  The
    row with the largest ``order`` wins, whenever it comes, so a batch that is applied again changes nothing, and the table
    never holds more rows than keys.
    """

    def __init__(self, path: str, schema: StructType, keys: Sequence[str], order: Sequence[str], buckets: int = BUCKETS):
        self.path, self.schema, self.keys, self.order, self.buckets = path, schema, list(keys), list(order), buckets

    def _with_bucket(self) -> StructType:
        return StructType([*self.schema.fields, StructField("bucket", IntegerType())])

    def create(self, spark: SparkSession) -> None:
        spark.createDataFrame([], self._with_bucket()).write.partitionBy("bucket").parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self._with_bucket()).parquet(self.path)

    def upsert(self, batch: DataFrame, number: int = 0) -> None:
        spark, names = batch.sparkSession, self.schema.fieldNames()
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")
        changes = cut(self._newest(batch.select(*names, bucket)), "changes")
        touched = [r["bucket"] for r in changes.select("bucket").distinct().collect()]  # at most ``buckets``
        if not touched:
            return
        changes = changes.union(self.read(spark).where(F.col("bucket").isin(touched)))
        merged = cut(self._newest(changes), "merged")  # what is overwritten must not be read any more
        merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path)

    def _newest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in self.schema.fieldNames() if c not in self.keys]
        best = rows.groupBy(*self.keys, "bucket").agg(F.max_by(F.struct(*rest), F.struct(*self.order)).alias("v"))
        return best.select(*[F.col(c if c in self.keys else f"v.{c}") for c in self.schema.fieldNames()], "bucket")


def run_to_keys(stream: DataFrame, tag: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Run a stream of changes over what is there now into a :class:`KeyedTable` and return its rows."""
    spark = stream.sparkSession
    table = KeyedTable(scratch_path(spark, tag), stream.schema, keys, order)
    table.create(spark)
    query = (
        stream.writeStream.outputMode("append").option("checkpointLocation", scratch_path(spark, f"{tag}-state"))
        .trigger(availableNow=True).foreachBatch(table.upsert).start()
    )
    query.awaitTermination()
    return table.read(spark).drop("bucket")


def latest(table: DataFrame, *key: str) -> DataFrame:
    """Last row per key over the batches of an update stream."""
    rest = [c for c in table.columns if c not in (*key, "batch")]
    return table.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch").alias("v")).select(*key, *[F.col(f"v.{c}").alias(c) for c in rest])
