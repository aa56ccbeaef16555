"""Counts, coverage, quality metrics and distributions as single aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepstone.functions.columns import review_state
from stepstone.operators.merge import cross_subject

MISSING = "missing"


def ratio(part: Column, whole: Column, digits: int = 6) -> Column:
    """Guarded division: null when the whole is 0."""
    return F.when(whole != 0, F.round(part / whole, digits))


def tally(df: DataFrame, column: str, values: Sequence[str], default: str | None = None) -> DataFrame:
    """Row count and one counter per listed value; other values are counted nowhere."""
    col = F.coalesce(F.col(column), F.lit(default)) if default else F.col(column)
    counters = [F.count_if(col == v).alias(v.replace("-", "_")) for v in values]
    return df.agg(F.count("*").alias("rows"), *counters)


def merge_counters(previous: DataFrame, derived: DataFrame) -> DataFrame:
    """Derived values over previous ones by counter name; counters kept by hand survive."""
    old = previous.select("counter", F.col("value").alias("_old"))
    new = derived.select("counter", F.col("value").alias("_new"))
    return old.join(new, "counter", "full_outer").select("counter", F.coalesce("_new", "_old").alias("value"))


def directory_tree(topics: DataFrame) -> DataFrame:
    """Counts, translated counts and sorted distinct ages per subject and per (subject, domain)."""
    # distinct first: an age list per group then has one entry per age, never one per row
    per_age = topics.groupBy("subject", "domain", "age_start").agg(
        F.count("*").alias("n"), F.count_if("translated").alias("t")
    )
    return per_age.groupingSets([["subject"], ["subject", "domain"]], "subject", "domain").agg(
        F.sum("n").alias("topics"),
        F.sum("t").alias("translated"),
        F.array_join(F.transform(F.array_sort(F.collect_set("age_start")), lambda a: a.cast("string")), ",")
        .alias("ages"),
        F.grouping("domain").alias("is_subject_total"),
    )


def dimension_summary(visible: DataFrame, all_edges: DataFrame, public_edges: DataFrame) -> DataFrame:
    """Totals per dimension; the edge totals are those of the whole graph."""
    edge_total = all_edges.agg(F.count("*")).scalar()
    public_total = public_edges.agg(F.count("*")).scalar()
    return visible.groupBy("dimension").agg(
        F.count("*").alias("topics"),
        F.count_if("translated").alias("translated"),
        F.countDistinct("subject").alias("subjects"),
    ).withColumns({"edges": edge_total, "published_edges": public_total})


def gap_summary(gaps: DataFrame) -> DataFrame:
    """Total and counts by three independent keys in one pass."""
    sets = [["gap_type"], ["subject"], ["grade"], []]
    return (
        gaps.groupingSets(sets, "gap_type", "subject", "grade")
        .agg(F.count("*").alias("n"), F.grouping_id().alias("gid"))
        .select(
            F.when(F.col("gid") == 3, "gap_type").when(F.col("gid") == 5, "subject")
            .when(F.col("gid") == 6, "grade").otherwise("total").alias("key"),
            F.coalesce("gap_type", "subject", "grade", F.lit("all")).alias("value"),
            "n",
        )
    )


def review_coverage(edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    state = review_state("review_status")
    total, reviewed = F.count("*"), F.count_if(state == "reviewed")
    return edges.groupBy(*by).agg(
        reviewed.alias("reviewed"),
        F.count_if(state == "machine").alias("machine"),
        F.count_if(state == "rejected").alias("rejected"),
        F.coalesce(ratio(reviewed * 100.0, total), F.lit(0.0)).alias("reviewed_pct"),
    )


def antiparallel_pairs(edges: DataFrame) -> DataFrame:
    """Unordered pairs linked in both directions: two directions survive under one sorted key."""
    a, b = F.col("topic_id"), F.col("prerequisite_id")
    pairs = (
        edges.where(a != b)
        .groupBy(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .agg(F.min(a < b).alias("all_up"), F.max(a < b).alias("any_up"))
    )
    return pairs.agg(F.count_if(F.col("any_up") & ~F.col("all_up")).alias("antiparallel_pairs"))


def degrees(topics: DataFrame, edges: DataFrame) -> DataFrame:
    """In, out and total degree of every topic, zero included."""
    ends = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("topic_id").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")),
                F.struct(F.col("prerequisite_id").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")),
            )
        )
    )
    sums = ends.groupBy("id").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))
    return topics.select("id").join(sums, "id", "left").select(
        "id",
        F.coalesce("in_degree", F.lit(0)).alias("in_degree"),
        F.coalesce("out_degree", F.lit(0)).alias("out_degree"),
        F.coalesce(F.col("in_degree") + F.col("out_degree"), F.lit(0)).alias("degree"),
    )


def edge_degrees(edges: DataFrame) -> DataFrame:
    """Edges with degree = in-degree of the topic + out-degree of the prerequisite."""
    into = edges.groupBy("topic_id").agg(F.count("*").alias("_in"))
    out = edges.groupBy("prerequisite_id").agg(F.count("*").alias("_out"))
    return (
        edges.join(into, "topic_id")
        .join(out, "prerequisite_id")
        .withColumn("degree", F.col("_in") + F.col("_out"))
        .drop("_in", "_out")
    )


def preset_entries(edges: DataFrame, topics: DataFrame, exclude_subject: str, top: int = 5) -> DataFrame:
    """Topics with the highest cross-subject degree; edges touching one subject are ignored."""
    cross = cross_subject(edges, topics).where(
        F.col("cross_subject")
        & (F.col("topic_subject") != exclude_subject)
        & (F.col("prerequisite_subject") != exclude_subject)
    )
    ends = cross.select(F.explode(F.array("topic_id", "prerequisite_id")).alias("id"))
    return ends.groupBy("id").agg(F.count("*").alias("cross_degree")).orderBy(F.desc("cross_degree"), "id").limit(top)


def cross_stage_edges(edges: DataFrame, topics: DataFrame, stage: str) -> DataFrame:
    """Edges whose prerequisite is in ``stage`` while the topic is not (null counts as not)."""
    t = topics.select(F.col("id").alias("topic_id"), F.col("stage").alias("ts"))
    p = topics.select(F.col("id").alias("prerequisite_id"), F.col("stage").alias("ps"))
    joined = edges.join(t, "topic_id", "left").join(p, "prerequisite_id", "left")
    hit = F.col("ps").eqNullSafe(stage) & ~F.col("ts").eqNullSafe(stage)
    return joined.agg(F.count_if(hit).alias("cross_stage_edges"))


def bucket_plan(rows: DataFrame, bucket: Sequence[str], batch: int, big: int) -> DataFrame:
    return rows.groupBy(*bucket).agg(
        F.count("*").alias("rows"),
        F.ceil(F.count("*") / batch).cast("bigint").alias("batches"),
        (F.count("*") > big).alias("is_big"),
    )


def centrality_distribution(centrality: DataFrame) -> DataFrame:
    """Max, non-zero share, P50 and P90 by position in descending order, mean of the top decile.

    Values are rounded to six decimals, so at most 1,000,001 distinct ones exist: the counts per value
    are summed up instead of ordering the rows.
    """
    # one row per value, at most 1,000,001 of them
    per_value = centrality.where("centrality IS NOT NULL").groupBy("centrality").agg(F.count("*").alias("n"))
    upto = Window.orderBy(F.desc("centrality")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = per_value.withColumn("last", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(whole))
    first = F.col("last") - F.col("n")
    top = F.greatest(F.floor(F.col("total") * 0.1), F.lit(1))

    def at(index: Column) -> Column:
        return F.max(F.when((first <= index) & (index < F.col("last")), F.col("centrality")))

    in_top = F.greatest(F.least(F.col("last"), top) - first, F.lit(0))
    return placed.agg(
        F.sum("n").alias("nodes"),
        F.max("centrality").alias("max_centrality"),
        F.round(F.sum(F.when(F.col("centrality") > 0, F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("nonzero_share"),
        at(F.floor(F.col("total") * 0.5)).alias("p50"),
        at(F.floor(F.col("total") * 0.1)).alias("p90"),
        F.round(F.sum(F.col("centrality") * in_top) / F.max(top), 6).alias("top_decile_mean"),
    )


def mastery_progress(mastered: DataFrame, visible: DataFrame) -> DataFrame:
    """Mastered topics among the visible ones per learner and dimension, in percent to one decimal."""
    totals = visible.groupBy("dimension").agg(F.count("*").alias("visible"))
    hits = (
        mastered.join(visible.select("dimension", F.col("id").alias("topic_id")), "topic_id")
        .groupBy("learner", "dimension")
        .agg(F.count("*").alias("mastered"))
    )
    return hits.join(totals, "dimension").select(
        "learner",
        "dimension",
        "mastered",
        "visible",
        F.coalesce(ratio(F.col("mastered") * 100.0, F.col("visible"), 1), F.lit(0.0)).alias("percent"),
    )


def mastered_by_subject(mastered: DataFrame, topics: DataFrame) -> DataFrame:
    """Mastered topics per (learner, subject, age) and the rank of each subject by count."""
    info = topics.select(F.col("id").alias("topic_id"), "subject", F.coalesce("age_start", F.lit(-1)).alias("age"))
    per_age = mastered.join(info, "topic_id").groupBy("learner", "subject", "age").agg(F.count("*").alias("n"))
    # one row per (learner, subject): as many as there are subjects
    per_subject = per_age.groupBy("learner", "subject").agg(F.sum("n").alias("subject_n"))
    ranked = per_subject.withColumn(
        "subject_rank",
        F.row_number().over(Window.partitionBy("learner").orderBy(F.desc("subject_n"), "subject")),
    )
    return per_age.join(ranked, ["learner", "subject"])


def gold_quality(gold: DataFrame, sample_min: int = 30) -> DataFrame:
    """Agreed rows, tp/fp/fn, precision, recall, F1 overall, per subject and per (subject, kind)."""
    positive = F.when(F.col("kind") == "split", "split").otherwise("prerequisite")
    agreed = F.col("reviewer_a") == F.col("reviewer_b")
    predicted, actual = F.col("predicted") == positive, F.col("reviewer_a") == positive
    counts = gold.groupingSets([[], ["subject"], ["subject", "kind"]], "subject", "kind").agg(
        F.count("*").alias("total"),
        F.count_if(agreed).alias("agreed"),
        F.count_if(agreed & predicted & actual).alias("tp"),
        F.count_if(agreed & predicted & ~actual).alias("fp"),
        F.count_if(agreed & ~predicted & actual).alias("fn"),
        F.grouping_id().alias("gid"),
    )
    p = F.col("tp") / F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") + F.col("fp"))
    r = F.col("tp") / F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") + F.col("fn"))
    f1 = F.when(p.isNull() | r.isNull(), None).when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    return counts.select(
        F.when(F.col("gid") == 3, "overall").when(F.col("gid") == 1, "subject").otherwise("subject_kind").alias("level"),
        F.coalesce("subject", F.lit("*")).alias("subject"),
        F.coalesce("kind", F.lit("*")).alias("kind"),
        "total", "agreed", (F.col("total") - F.col("agreed")).alias("disagreed"), "tp", "fp", "fn",
        F.round(p, 6).alias("precision"),
        F.round(r, 6).alias("recall"),
        F.round(f1, 6).alias("f1"),
        (F.col("agreed") >= sample_min).alias("sample_ready"),
    )


def cohen_kappa(gold: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Chance-corrected agreement of two reviewers; 1 when agreement by chance is already certain."""
    keys = list(by)
    cells = gold.groupBy(*keys, "reviewer_a", "reviewer_b").agg(F.count("*").alias("n"))
    sides = cells.select(
        *keys,
        "n",
        F.inline(
            F.array(
                F.struct(F.col("reviewer_a").alias("label"), F.lit(1).alias("a"), F.lit(0).alias("b")),
                F.struct(F.col("reviewer_b").alias("label"), F.lit(0).alias("a"), F.lit(1).alias("b")),
            )
        ),
    )
    marginal = sides.groupBy(*keys, "label").agg(
        F.sum(F.col("n") * F.col("a")).alias("na"), F.sum(F.col("n") * F.col("b")).alias("nb")
    )
    chance = marginal.groupBy(*keys).agg(
        F.sum("na").alias("total"), F.sum((F.col("na") * F.col("nb")).cast("double")).alias("cross")
    )
    same = cells.groupBy(*keys).agg(
        F.sum(F.when(F.col("reviewer_a") == F.col("reviewer_b"), F.col("n")).otherwise(0)).alias("same")
    )
    total = F.col("total")
    observed, expected = F.col("same") / total, F.col("cross") / (total * total)
    value = F.when(expected == 1, 1.0).otherwise((observed - expected) / (1 - expected))
    joined = chance.join(same, keys) if keys else chance.withColumn("same", same.scalar())
    return joined.select(*keys, "total", F.round(value, 6).alias("kappa"))


def tier_audit(rows: DataFrame, expected: Mapping[str, int] | DataFrame, column: str = "confidence") -> DataFrame:
    """Measured rows per tier against expected counters, and what neither explains."""
    measured = rows.groupBy(F.col(column).alias("tier")).agg(F.count("*").alias("measured"))
    out = measured.join(expected, "tier", "full_outer").na.fill(0, ["measured", "expected"])
    return out.withColumn("difference", F.col("measured") - F.col("expected"))


def audit_rollup(results: DataFrame, bucket: str) -> DataFrame:
    counts = [F.count_if(F.col("verdict") == v).alias(f"{v}_n") for v in ("split", "covered", "review")]
    return results.rollup(bucket).agg(F.count("*").alias("evaluated"), *counts).withColumn(
        bucket, F.coalesce(bucket, F.lit("all"))
    )


def class_distribution(rows: DataFrame, label: str, id_col: str, samples: int = 8, order: str | None = None) -> DataFrame:
    """Rows and percentage per class with the first sample ids; only ``samples`` rows are collected."""
    total = rows.agg(F.count("*")).scalar()
    first = Window.partitionBy(label).orderBy(order or id_col)
    picked = (
        rows.select(label, id_col, *([order] if order else []))
        .withColumn("_n", F.row_number().over(first))
        .where(F.col("_n") <= samples)
        .groupBy(label)
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", id_col))), lambda s: s[id_col]), ",").alias("samples"))
    )
    counts = rows.groupBy(label).agg(F.count("*").alias("n"))
    return counts.join(picked, label).select(
        label, "n", F.round(F.col("n") * 100.0 / total, 4).alias("percent"), "samples"
    )


def change_summary(changes: DataFrame, samples: int = 3) -> DataFrame:
    """Rows per (from, to) mapping with the first sample ids."""
    keyed = changes.withColumn("mapping", F.concat_ws(" -> ", "from_value", "to_value"))
    return class_distribution(keyed, "mapping", "id", samples).drop("percent")


def drift_coverage(topics: DataFrame, overlay: DataFrame, samples: int = 3) -> DataFrame:
    """Translated share per domain and the first ids still pending."""
    state = topics.join(overlay.select("id", F.lit(True).alias("_hit")), "id", "left").withColumn(
        "pending", F.col("_hit").isNull()
    )
    cover = state.groupBy("domain").agg(
        F.count("*").alias("topics"),
        F.count_if("pending").alias("pending"),
        ratio(F.count_if(~F.col("pending")) * 100.0, F.count("*"), 4).alias("translated_pct"),
    )
    sample = class_distribution(state.where("pending"), "domain", "id", samples).select("domain", "samples")
    return cover.join(sample, "domain", "left").withColumn("samples", F.coalesce("samples", F.lit("")))


def migration_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """Demoted, rescoped and age-regressed edges between two states of one edge table."""
    keys = ["topic_id", "prerequisite_id"]
    old = before.select(*keys, F.col("review_status").alias("_old"))
    joined = after.join(old, keys)
    return joined.agg(
        F.count_if((F.col("_old") == "reviewed") & (F.col("review_status") == "machine")).alias("demoted_reviewed"),
        F.count_if(F.coalesce("rescope_required", F.lit(False))).alias("rescoped"),
        F.count_if(F.coalesce("age_regression", F.lit(False))).alias("age_regressions"),
        F.count("*").alias("edges"),
    )
