"""Learner state from decision logs, next-topic ranking, trails and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepstone.operators.ordering import with_position

STATES = ("mastered", "needs-review", "clear")


def fold_decisions(log: DataFrame) -> DataFrame:
    """Last decision per learner and topic; mastered and needs-review exclude each other by construction."""
    return (
        log.where(F.col("decision").isin(*STATES))
        .groupBy("learner", "topic_id")
        .agg(F.max_by("decision", F.struct("ts", "event_id")).alias("decision"))
    )


def fold_toggles(log: DataFrame) -> DataFrame:
    """Mastery when ``toggle`` rows flip it: parity of the toggles after the last explicit decision."""
    stamp = F.struct("ts", "event_id")
    set_rows = log.where(F.col("decision").isin(*STATES))
    last = set_rows.groupBy("learner", "topic_id").agg(
        F.max_by("decision", stamp).alias("base"), F.max(stamp).alias("at")
    )
    toggles = log.where(F.col("decision") == "toggle").select("learner", "topic_id", stamp.alias("when"))
    flips = (
        toggles.join(last.select("learner", "topic_id", "at"), ["learner", "topic_id"], "left")
        .where(F.col("at").isNull() | (F.col("when") > F.col("at")))
        .groupBy("learner", "topic_id")
        .agg(F.count("*").alias("flips"))
    )
    start = F.coalesce(F.col("base") == "mastered", F.lit(False)).cast("int")
    return last.join(flips, ["learner", "topic_id"], "full_outer").select(
        "learner",
        "topic_id",
        ((start + F.coalesce("flips", F.lit(0))) % 2 == 1).alias("mastered"),
    )


def undo_last(log: DataFrame) -> DataFrame:
    """State after taking back each learner's last decision."""
    last = log.where(F.col("decision").isin(*STATES)).groupBy("learner").agg(F.max(F.struct("ts", "event_id")).alias("at"))
    kept = log.join(last, "learner").where(F.struct("ts", "event_id") < F.col("at"))
    return fold_decisions(kept.drop("at"))


def next_topics(mastered: DataFrame, edges: DataFrame, topics: DataFrame, top: int = 12) -> DataFrame:
    """Successors of mastered topics by readiness, the share of their prerequisites already mastered."""
    total = edges.groupBy("topic_id").agg(F.count("*").alias("total"))
    known = mastered.select("learner", F.col("topic_id").alias("prerequisite_id"))
    hits = (
        known.join(edges.select("topic_id", "prerequisite_id", "cross_subject"), "prerequisite_id")
        .groupBy("learner", "topic_id")
        .agg(F.count("*").alias("hit"), F.max("cross_subject").alias("via_cross"))
        .join(mastered.select("learner", "topic_id"), ["learner", "topic_id"], "left_anti")
    )
    age = topics.select(F.col("id").alias("topic_id"), F.coalesce("age_start", F.lit(-1)).alias("age"))
    ready = F.col("hit").cast("double") / F.greatest("total", F.lit(1))
    ranked = hits.join(total, "topic_id").join(age, "topic_id").withColumn("readiness", ready)
    order = Window.partitionBy("learner").orderBy(F.desc("readiness"), "age", "topic_id")
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "learner", "topic_id", "hit", "total", F.round("readiness", 6).alias("readiness"), "via_cross", "rank"
    )


def recent_trail(log: DataFrame, keep: int = 8) -> DataFrame:
    """Last distinct topics per learner; a new visit moves a topic to the end."""
    last = log.groupBy("learner", "topic_id").agg(F.max(F.struct("ts", "event_id")).alias("at"))
    order = Window.partitionBy("learner").orderBy(F.desc("at"))
    return last.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep).select(
        "learner", "topic_id", "rank"
    )


def merge_profiles(memory: DataFrame, list_field: str = "interests") -> DataFrame:
    """Profile per learner: last non-empty value of each field, and each distinct list entry in order.

    ``memory`` has (learner, seq, field, value); a list field has one row per entry.  The result is long:
    (learner, field, value, place), so that no learner's list has to fit into one row.
    """
    filled = memory.where(F.col("value").isNotNull() & (F.col("value") != ""))
    plain = (
        filled.where(F.col("field") != list_field)
        .groupBy("learner", "field")
        .agg(F.max_by("value", "seq").alias("value"), F.lit(0).cast("bigint").alias("place"))
    )
    entries = (
        filled.where(F.col("field") == list_field)
        .groupBy("learner", "field", "value")
        .agg(F.min("seq").alias("place"))
    )
    return plain.unionByName(entries)


def resume_position(sequence: DataFrame, mastered: DataFrame, learners: DataFrame) -> DataFrame:
    """First unmastered position in each scope's sequence per learner, else the first position.

    ``learners`` has (learner, subject).  Positions without gaps: the first unmastered one is the first
    position whose mastered predecessors are fewer than it, so only mastered rows are looked at.
    """
    size = sequence.groupBy("subject").agg(F.max("pos").alias("size"))
    done = mastered.join(sequence.select("subject", F.col("id").alias("topic_id"), "pos"), "topic_id")
    run = (
        with_position(done, ["learner", "subject"], ["pos"], "n")
        .where(F.col("n") == F.col("pos"))
        .groupBy("learner", "subject")
        .agg(F.max("pos").alias("run"))
    )
    at = F.coalesce("run", F.lit(0)) + 1
    placed = learners.join(run, ["learner", "subject"], "left").join(size, "subject").withColumn(
        "pos", F.when(at > F.col("size"), 1).otherwise(at)
    )
    return placed.join(sequence.select("subject", "pos", "id"), ["subject", "pos"]).select(
        "learner", "subject", "pos", F.col("id").alias("topic_id")
    )
