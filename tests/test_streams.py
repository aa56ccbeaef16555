"""Admission over several batches against a plain loop, and the state that idle keys leave."""

import datetime as dt
import random

import pytest
from pyspark.errors import StreamingQueryException

from stepstone.session import scratch_path
from stepstone.streaming import learner_streams as streams

START = dt.datetime(2024, 1, 1)


def plain_loop(batches, limit, span):
    """What each event gets, batch by batch, in order of time and id; nothing is ever forgotten."""
    recent, answers = {}, {}
    for batch in batches:
        for key, event, second in sorted(batch, key=lambda r: (r[2], r[1])):
            seen = [t for t in recent.get(key, []) if second - t < span]
            answers[event] = len(seen) < limit
            recent[key] = seen + [second] * answers[event]
    return answers


def run(spark, batches, limit, span, lateness, fails_at=None):
    """Each batch comes in a folder of its own and is run from the same checkpoint; (answers, keys kept after each).

    The batch that ``fails_at`` names is written and then fails once, so it is run again from the state before it.
    """
    folder, out, state = (scratch_path(spark, f"test-{t}") for t in ("in", "out", "state"))
    schema, kept, failed = "key bigint, event_id bigint, ts timestamp", [], []

    def keep(rows, number):
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")
        if number == fails_at and not failed:
            failed.append(number)
            raise RuntimeError("lost after it was written")

    def start():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
        query = (
            streams.admit_and_forget(stream, limit, span, lateness).writeStream.outputMode("append")
            .option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(keep).start()
        )
        query.awaitTermination()
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])

    for number, batch in enumerate(batches):
        rows = [(k, e, START + dt.timedelta(seconds=s)) for k, e, s in batch]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/b{number}")
        try:
            start()
        except StreamingQueryException:
            start()
    assert (fails_at is None) == (not failed)
    rows = spark.read.parquet(out).collect()
    assert len(rows) == len({r.event_id for r in rows})
    return {r.event_id: r.allowed for r in rows}, kept


@pytest.mark.parametrize("fails_at", [None, 2])
def test_answers_equal_a_plain_loop_and_idle_keys_leave(spark, fails_at):
    rng = random.Random(5)
    limit, span, lateness = 3, 100, 40
    ids = iter(range(10**6))
    # keys 0 to 19 stop after the first batch; 20 to 23 go on; late events come within the lateness
    first = [(rng.randrange(24), next(ids), rng.randrange(0, 60)) for _ in range(300)]
    second = [(rng.randrange(20, 24), next(ids), rng.randrange(30, 400)) for _ in range(200)]
    third = [(rng.randrange(20, 24), next(ids), rng.randrange(380, 500)) for _ in range(100)] + [(2, next(ids), 470)]
    batches = [first, second, third]
    answers, kept = run(spark, batches, limit, span, lateness, fails_at)
    assert answers == plain_loop(batches, limit, span)
    assert kept == [24, 4, 5]


def test_an_event_later_than_the_bound_is_judged_not_dropped(spark):
    answers, _ = run(spark, [[(1, 1, 0)], [(2, 2, 10_000)], [(1, 3, 5)]], 1, 100, 10)
    assert answers == {1: True, 2: True, 3: True}


def test_a_limit_of_none_refuses_all(spark):
    answers, _ = run(spark, [[(1, 1, 0), (1, 2, 50)]], 0, 100, 10)
    assert answers == {1: False, 2: False}
