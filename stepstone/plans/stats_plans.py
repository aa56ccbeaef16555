"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepstone.operators import lookup, merge, stats
from stepstone.plans.graph_plans import learner_state
from stepstone.plans.merge_plans import DIMENSIONS, DIMS, located_topics
from stepstone.plans.registry import query
from stepstone.sources import tables as src
from stepstone.sources.tables import with_views


@query(
    "a1_table_counts",
    with_views("edges", "topics")
    + """
SELECT 'edges.' || k AS counter, n AS value FROM (SELECT count(*) AS rows, count(*) FILTER (WHERE review_status = 'machine') AS machine,
  count(*) FILTER (WHERE review_status = 'reviewed') AS reviewed FROM edges) x, LATERAL (VALUES ('rows', rows), ('machine', machine), ('reviewed', reviewed)) v(k, n)
UNION ALL SELECT 'topics.' || k, n FROM (SELECT count(*) AS rows, count(*) FILTER (WHERE status = 'covered') AS covered,
  count(*) FILTER (WHERE status IS NULL) AS active FROM topics) x, LATERAL (VALUES ('rows', rows), ('covered', covered), ('active', active)) v(k, n)""",
)
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = stats.tally(src.edges(spark, sf_dir), "review_status", ["machine", "reviewed"], "machine")
    topics = stats.tally(src.topics(spark, sf_dir), "status", ["covered", "active"], "active")

    def long(wide: DataFrame, prefix: str) -> DataFrame:
        return wide.unpivot([], wide.columns, "counter", "value").withColumn(
            "counter", F.concat(F.lit(f"{prefix}."), "counter")
        )

    return long(edges, "edges").union(long(topics, "topics"))


@query(
    "a2_merge_counters",
    """
WITH new AS (SELECT l_returnflag || '.' || l_linestatus AS counter, count(*) AS value FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1),
old AS (SELECT l_returnflag || '.' || l_linestatus AS counter, 7 AS value FROM lineitem GROUP BY 1)
SELECT coalesce(o.counter, n.counter) AS counter, coalesce(n.value, o.value) AS value FROM old o FULL JOIN new n ON o.counter = n.counter""",
)
def merge_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = src.table(spark, sf_dir, "lineitem").select(
        F.concat_ws(".", "l_returnflag", "l_linestatus").alias("counter"), "l_linestatus"
    )
    previous = lines.select("counter").distinct().withColumn("value", F.lit(7).cast("bigint"))
    derived = lines.where("l_linestatus = 'O'").groupBy("counter").agg(F.count("*").alias("value"))
    return stats.merge_counters(previous, derived)


@query(
    "a3_directory_tree",
    with_views("topics")
    + """
, t AS (SELECT *, num % 3 = 0 AS translated FROM topics WHERE status IS DISTINCT FROM 'covered')
SELECT subject, domain, count(*) AS topics, count(*) FILTER (WHERE translated) AS translated,
  array_to_string(list_sort(list(DISTINCT age_start)), ',') AS ages, grouping(domain) AS is_subject_total
FROM t GROUP BY GROUPING SETS ((subject), (subject, domain))""",
)
def directory_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.directory_tree(merge.published_topics(located_topics(spark, sf_dir)))


@query(
    "a4_dimension_summary",
    with_views("edges", "pub_edges")
    + f""", {DIMS}
SELECT dimension, count(*) AS topics, count(*) FILTER (WHERE translated) AS translated, count(DISTINCT subject) AS subjects,
  (SELECT count(*) FROM edges) AS edges, (SELECT count(*) FROM pub_edges) AS published_edges
FROM dims WHERE visible AND status IS DISTINCT FROM 'covered' GROUP BY dimension""",
)
def dimension_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stepstone.plans.merge_plans import published

    shown = lookup.topics_in_dimension(located_topics(spark, sf_dir), DIMENSIONS)
    return stats.dimension_summary(shown, src.edges(spark, sf_dir), published(spark, sf_dir)[1])


@query(
    "a5_gap_summary",
    with_views("gaps")
    + """
SELECT 'total' AS key, 'all' AS value, count(*) AS n FROM gaps UNION ALL SELECT 'gap_type', gap_type, count(*) FROM gaps GROUP BY 2
UNION ALL SELECT 'subject', subject, count(*) FROM gaps GROUP BY 2 UNION ALL SELECT 'grade', grade, count(*) FROM gaps GROUP BY 2""",
)
def gap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.gap_summary(src.gaps(spark, sf_dir))


@query(
    "a6_review_coverage",
    with_views("edges")
    + """
SELECT t_num % 2 AS origin, count(*) FILTER (WHERE review_status = 'reviewed') AS reviewed, count(*) FILTER (WHERE review_status = 'machine') AS machine,
  count(*) FILTER (WHERE review_status = 'rejected') AS rejected, round(count(*) FILTER (WHERE review_status = 'reviewed') * 100.0::DOUBLE / count(*), 6) AS reviewed_pct
FROM edges GROUP BY 1""",
)
def review_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.review_coverage(src.edges(spark, sf_dir).withColumn("origin", F.col("t_num") % 2), ["origin"])


@query(
    "a11_mastery_progress",
    with_views("topics", "mastered")
    + f""", {DIMS}, vis AS (SELECT id, dimension FROM dims WHERE visible AND status IS DISTINCT FROM 'covered'),
tot AS (SELECT dimension, count(*) AS visible FROM vis GROUP BY 1)
SELECT learner, v.dimension, count(*) AS mastered, max(t.visible) AS visible, round(count(*) * 100.0::DOUBLE / max(t.visible), 1) AS percent
FROM mastered m JOIN vis v ON v.id = m.topic_id JOIN tot t ON t.dimension = v.dimension GROUP BY 1, 2""",
)
def mastery_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    mastered, _ = learner_state(spark, sf_dir)
    return stats.mastery_progress(mastered, lookup.topics_in_dimension(located_topics(spark, sf_dir), DIMENSIONS))


@query(
    "a12_mastered_by_subject",
    with_views("topics", "mastered")
    + """
, per AS (SELECT learner, subject, age_start AS age, count(*) AS n FROM mastered m JOIN topics t ON t.id = m.topic_id GROUP BY 1, 2, 3),
sub AS (SELECT learner, subject, sum(n)::BIGINT AS subject_n FROM per GROUP BY 1, 2)
SELECT p.learner, p.subject, p.age, p.n, s.subject_n, s.subject_rank FROM per p JOIN
  (SELECT *, row_number() OVER (PARTITION BY learner ORDER BY subject_n DESC, subject) AS subject_rank FROM sub) s USING (learner, subject)""",
)
def mastered_by_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    mastered, _ = learner_state(spark, sf_dir)
    return stats.mastered_by_subject(mastered, src.topics(spark, sf_dir))


@query(
    "a13_gold_quality",
    with_views("gold")
    + """
, g AS (SELECT *, CASE WHEN kind = 'split' THEN 'split' ELSE 'prerequisite' END AS pos, reviewer_a = reviewer_b AS ok FROM gold),
c AS (SELECT CASE WHEN grouping(subject) = 1 THEN 'overall' WHEN grouping(kind) = 1 THEN 'subject' ELSE 'subject_kind' END AS level,
  coalesce(subject, '*') AS subject, coalesce(kind, '*') AS kind, count(*) AS total, count(*) FILTER (WHERE ok) AS agreed,
  count(*) FILTER (WHERE ok AND predicted = pos AND reviewer_a = pos) AS tp, count(*) FILTER (WHERE ok AND predicted = pos AND reviewer_a <> pos) AS fp,
  count(*) FILTER (WHERE ok AND predicted <> pos AND reviewer_a = pos) AS fn FROM g GROUP BY GROUPING SETS ((), (subject), (subject, kind))),
r AS (SELECT *, tp::DOUBLE / nullif(tp + fp, 0) AS p, tp::DOUBLE / nullif(tp + fn, 0) AS r FROM c)
SELECT level, subject, kind, total, agreed, total - agreed AS disagreed, tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall,
  round(CASE WHEN p IS NULL OR r IS NULL THEN NULL WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1, agreed >= 30 AS sample_ready FROM r""",
)
def gold_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.gold_quality(src.gold(spark, sf_dir))


@query(
    "a14_cohen_kappa",
    with_views("gold")
    + """
, t AS (SELECT kind, count(*) AS total, count(*) FILTER (WHERE reviewer_a = reviewer_b)::DOUBLE / count(*) AS po FROM gold GROUP BY 1),
a AS (SELECT kind, reviewer_a AS l, count(*) AS n FROM gold GROUP BY 1, 2), b AS (SELECT kind, reviewer_b AS l, count(*) AS n FROM gold GROUP BY 1, 2),
e AS (SELECT t.kind, t.total, po, coalesce((SELECT sum(a.n * b.n) FROM a JOIN b ON a.kind = b.kind AND a.l = b.l WHERE a.kind = t.kind), 0)::DOUBLE / (t.total * t.total) AS pe FROM t)
SELECT kind, total, round(CASE WHEN pe = 1 THEN 1 ELSE (po - pe) / (1 - pe) END, 6) AS kappa FROM e""",
)
def cohen_kappa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.cohen_kappa(src.gold(spark, sf_dir), ["kind"])


TIER = "CASE WHEN n_chars > 3000 THEN 'high' WHEN n_chars > 1000 THEN 'medium' ELSE 'low' END"


def _tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("n_chars")
    return src.text_topics(spark, sf_dir).withColumn(
        "confidence", F.when(size > 3000, "high").when(size > 1000, "medium").otherwise("low")
    )


@query(
    "a15_tier_audit",
    f"""
WITH m AS (SELECT {TIER} AS tier, count(*) AS measured FROM documents GROUP BY 1),
e AS (SELECT CASE quality WHEN 1 THEN 'high' ELSE 'undisposed' END AS tier, count(*) AS expected FROM labels GROUP BY 1)
SELECT coalesce(m.tier, e.tier) AS tier, coalesce(measured, 0) AS measured, coalesce(expected, 0) AS expected,
  coalesce(measured, 0) - coalesce(expected, 0) AS difference FROM m FULL JOIN e ON m.tier = e.tier""",
)
def tier_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = (
        src.table(spark, sf_dir, "labels")
        .groupBy(F.when(F.col("quality") == 1, "high").otherwise("undisposed").alias("tier"))
        .agg(F.count("*").alias("expected"))
    )
    return stats.tier_audit(_tiers(spark, sf_dir), expected)


@query(
    "a16_bucket_plan",
    with_views("topics")
    + " SELECT subject, stage, count(*) AS rows, ceil(count(*) / 20)::BIGINT AS batches, count(*) > 30 AS is_big FROM topics GROUP BY 1, 2",
)
def bucket_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.bucket_plan(src.topics(spark, sf_dir), ["subject", "stage"], 20, 30)


AUDIT_SQL = """, audit AS (SELECT 'doc_' || doc_id AS id, source AS bucket, n_chars // 40 AS minutes,
  CASE WHEN n_chars > 3600 THEN 'split' WHEN doc_id % 9 = 0 THEN 'covered' WHEN doc_id % 7 = 0 THEN 'review' ELSE 'ok' END AS verdict FROM documents)"""


def audit_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("num")
    return src.text_topics(spark, sf_dir).select(
        "id",
        F.col("subject").alias("bucket"),
        F.floor(F.col("n_chars") / 40).cast("bigint").alias("minutes"),
        F.when(F.col("n_chars") > 3600, "split").when(key % 9 == 0, "covered").when(key % 7 == 0, "review")
        .otherwise("ok").alias("verdict"),
    )


@query(
    "a17_audit_rollup",
    "WITH x AS (SELECT 1)" + AUDIT_SQL
    + """
SELECT coalesce(bucket, 'all') AS bucket, count(*) AS evaluated, count(*) FILTER (WHERE verdict = 'split') AS split_n,
  count(*) FILTER (WHERE verdict = 'covered') AS covered_n, count(*) FILTER (WHERE verdict = 'review') AS review_n FROM audit GROUP BY ROLLUP (bucket)""",
)
def audit_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.audit_rollup(audit_results(spark, sf_dir), "bucket")


@query(
    "a17_longest_items",
    "WITH x AS (SELECT 1)" + AUDIT_SQL + " SELECT id, bucket, minutes FROM audit WHERE verdict = 'split' ORDER BY minutes DESC, id LIMIT 10",
)
def longest_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = audit_results(spark, sf_dir).where("verdict = 'split'")
    return rows.select("id", "bucket", "minutes").orderBy(F.desc("minutes"), "id").limit(10)


@query(
    "a18_class_distribution",
    with_views("topics")
    + """
SELECT node_kind, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM topics), 4) AS percent,
  array_to_string(list(id ORDER BY num)[1:8], ',') AS samples FROM topics GROUP BY node_kind""",
)
def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.class_distribution(src.topics(spark, sf_dir), "node_kind", "id", 8, "num")


@query(
    "a19_degrees",
    with_views("topics", "edges")
    + """
, i AS (SELECT topic_id AS id, count(*) AS n FROM edges GROUP BY 1), o AS (SELECT prerequisite_id AS id, count(*) AS n FROM edges GROUP BY 1)
SELECT t.id, coalesce(i.n, 0) AS in_degree, coalesce(o.n, 0) AS out_degree, coalesce(i.n, 0) + coalesce(o.n, 0) AS degree
FROM topics t LEFT JOIN i ON i.id = t.id LEFT JOIN o ON o.id = t.id""",
)
def degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.degrees(src.topics(spark, sf_dir), src.edges(spark, sf_dir))


@query(
    "a20_preset_entries",
    with_views("topics", "edges")
    + """
, x AS (SELECT e.* FROM edges e JOIN topics a ON a.id = topic_id JOIN topics b ON b.id = prerequisite_id
  WHERE a.domain <> b.domain AND a.domain <> 'PROMO' AND b.domain <> 'PROMO')
SELECT id, count(*) AS cross_degree FROM (SELECT topic_id AS id FROM x UNION ALL SELECT prerequisite_id FROM x) y GROUP BY id ORDER BY 2 DESC, 1 LIMIT 5""",
)
def preset_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = src.topics(spark, sf_dir).select("id", F.col("domain").alias("subject"))
    return stats.preset_entries(src.edges(spark, sf_dir), topics, "PROMO")


@query(
    "a21_cross_stage_edges",
    with_views("topics", "edges")
    + """
SELECT count(*) AS cross_stage_edges FROM edges LEFT JOIN topics a ON a.id = topic_id LEFT JOIN topics b ON b.id = prerequisite_id
WHERE b.stage IS NOT DISTINCT FROM 'primary' AND a.stage IS DISTINCT FROM 'primary'""",
)
def cross_stage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.cross_stage_edges(src.edges(spark, sf_dir), src.topics(spark, sf_dir), "primary")


@query(
    "a22_change_summary",
    with_views("topics")
    + """
SELECT domain || ' -> ' || node_kind AS mapping, count(*) AS n, array_to_string(list(id ORDER BY id)[1:3], ',') AS samples FROM topics GROUP BY 1""",
)
def change_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = src.topics(spark, sf_dir).select(
        "id", F.col("domain").alias("from_value"), F.col("node_kind").alias("to_value")
    )
    return stats.change_summary(changes)


@query(
    "a23_drift_coverage",
    with_views("topics", "overlay")
    + """
, s AS (SELECT t.*, o.id IS NULL AS pending FROM topics t LEFT JOIN overlay o ON t.id = o.id)
SELECT domain, count(*) AS topics, count(*) FILTER (WHERE pending) AS pending,
  round(count(*) FILTER (WHERE NOT pending) * 100.0::DOUBLE / count(*), 4) AS translated_pct,
  coalesce(array_to_string((list(id ORDER BY id) FILTER (WHERE pending))[1:3], ','), '') AS samples FROM s GROUP BY domain""",
)
def drift_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.drift_coverage(src.topics(spark, sf_dir), src.overlay(spark, sf_dir))
