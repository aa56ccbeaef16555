"""Graph-shaped views over the given tables, each with the same view written as plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepstone.operators.ordering import with_previous
from stepstone.session import cut

_written: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give text-heavy work one task per core when the files alone would start fewer; else leave it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def written(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Build a shared intermediate once per session and keep it as a table in the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        _written[key] = cut(build(), name)
    return _written[key]


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("mtc_"), key).alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("subject"),
        F.col("p_type").alias("domain"),
        size.alias("age_start"),
        (size + 2).alias("age_end"),
        F.when(size <= 16, "primary").when(size <= 33, "junior").otherwise("senior").alias("stage"),
        F.when(key % 7 == 0, "text").when(key % 3 == 0, "skill").otherwise("concept").alias("node_kind"),
        F.when(key % 41 == 0, "covered").alias("status"),
        F.when(key % 10 == 1, F.concat(F.lit("mtc_"), key - 1)).alias("split_from"),
        key.alias("num"),
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
        lines = (
            table(spark, sf_dir, "lineitem")
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .drop("p_partkey")
        )
        # equal (line, part) rows of an order can swap places, so the flag is part of the order
        pairs = with_previous(
            lines,
            ["l_orderkey"],
            ["l_linenumber", "l_partkey", "l_returnflag"],
            ["l_partkey", "p_brand"],
            where=(F.col("prev.p_brand") == F.col("p_brand")) & (F.col("prev.l_partkey") != F.col("l_partkey")),
        )
        both = F.col("t") + F.col("p")
        return (
            pairs.groupBy(F.col("l_partkey").alias("t"), F.col("prev.l_partkey").alias("p"))
            .agg(F.min("l_returnflag").alias("flag"))
            .select(
                F.concat(F.lit("mtc_"), "t").alias("topic_id"),
                F.concat(F.lit("mtc_"), "p").alias("prerequisite_id"),
                F.when(F.col("flag") == "A", "hard").otherwise("soft").alias("strength"),
                F.concat(F.lit("order "), F.col("flag")).alias("reason"),
                F.when(both % 13 == 0, "rejected").when(both % 4 == 0, "machine").otherwise("reviewed")
                .alias("review_status"),
                (both % 17 == 0).alias("rescope_required"),
                F.col("t").alias("t_num"),
                F.col("p").alias("p_num"),
            )
        )

    return written(spark, sf_dir, "edges", build)


def overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).select(
        F.concat(F.lit("mtc_"), F.col("doc_id") * 3).alias("id"),
        F.col("text").alias("name"),
        F.col("text").alias("description"),
        F.when(F.col("lang") == "en", "reviewed").otherwise("machine").alias("translation_status"),
        F.col("lang"),
        F.col("source"),
        (F.col("doc_id") * 3).alias("num"),
    )


def text_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).select(
        F.concat(F.lit("doc_"), "doc_id").alias("id"),
        F.col("source").alias("subject"),
        F.col("lang").alias("domain"),
        F.col("text").alias("description"),
        F.col("n_chars"),
        F.col("doc_id").alias("num"),
    )


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    kind = F.when(F.col("lang") == "en", "relation").otherwise("split")
    word = F.when(F.col("lang") == "en", "prerequisite").otherwise("split")
    flipped = F.when(F.col("doc_id") % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    return labels.join(docs.select("doc_id", "lang", "source", "n_chars"), "doc_id").select(
        F.col("doc_id").alias("item"),
        F.col("source").alias("subject"),
        kind.alias("kind"),
        F.when(F.col("n_chars") > 500, word).otherwise("none").alias("predicted"),
        F.when(F.col("quality") == 1, word).otherwise("none").alias("reviewer_a"),
        F.when(flipped == 1, word).otherwise("none").alias("reviewer_b"),
    )


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    n_part = table(spark, sf_dir, "part").agg(F.count("*")).scalar()
    return events.select(
        F.col("event_id"),
        F.col("user_id").alias("learner"),
        F.concat(F.lit("mtc_"), F.col("event_id") % n_part).alias("topic_id"),
        F.when(F.col("event_type").isin("click", "purchase"), "mastered")
        .when(F.col("event_type") == "error", "needs-review")
        .when(F.col("event_type") == "signup", "clear")
        .otherwise("visit")
        .alias("decision"),
        F.col("ts"),
    )


def standards(spark: SparkSession, sf_dir: str) -> DataFrame:
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(F.lower("r_name").alias("slug"))
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        F.concat(F.lower("r_name"), F.lit(":N"), F.col("n_nationkey")).alias("key"),
                        F.concat(F.lit("N"), F.col("n_nationkey")).alias("code"),
                        F.col("n_name").alias("note"),
                    )
                )
            ).alias("topics")
        )
    )


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation, region = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    bal = F.col("s_acctbal")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("r_name").alias("subject"),
            F.concat(F.lit(" "), F.col("n_name")).alias("grade"),
            F.when(bal < 0, "missing").when(bal < 5000, "covered").otherwise("textbook-only").alias("gap_type"),
            F.when(F.col("s_suppkey") % 2 == 0, "junior").otherwise("senior").alias("stage"),
            F.col("s_name").alias("topic"),
            F.concat_ws("/", "r_name", "n_name", "s_name").alias("path"),
            F.concat(F.lit("Book "), F.col("n_name")).alias("textbook"),
        )
    )


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three role votes per order; the packet is the customer, the edge is the order."""
    role_verdict = F.explode(
        F.array(
            F.struct(
                F.lit("necessity").alias("role"),
                (F.col("o_orderstatus") != "F").alias("yes"),
            ),
            F.struct(F.lit("direction").alias("role"), (F.col("o_totalprice") > 50000).alias("yes")),
            F.struct(
                F.lit("adversary").alias("role"),
                (~F.col("o_orderpriority").startswith("5")).alias("yes"),
            ),
        )
    )
    key = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .select("*", role_verdict.alias("v"))
        .select(
            F.concat(F.lit("packet_"), F.col("o_custkey")).alias("packet_id"),
            F.concat(F.lit("mtc_"), key + 1).alias("topic_id"),
            F.concat(F.lit("mtc_"), key).alias("prerequisite_id"),
            F.col("v.role").alias("role"),
            F.when(F.col("v.yes"), "reviewed").otherwise("rejected").alias("verdict"),
            F.when(key % 3 == 0, "hard").when(key % 3 == 1, "soft").otherwise("unchanged")
            .alias("resolved_strength"),
            F.col("o_orderpriority").alias("reason"),
            F.concat(
                F.lit("model-"),
                F.when((F.col("o_custkey") % 11 == 0) & (F.col("v.role") == "adversary"), "necessity")
                .otherwise(F.col("v.role")),
            ).alias("model"),
            key.alias("num"),
        )
    )


def raw_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes as they arrive: some missing, doubled, for unknown edges, with bad verdicts or no reason."""
    base, num = votes(spark, sf_dir), F.col("num")
    spoiled = base.withColumns(
        {
            "verdict": F.when((num % 109 == 0) & (F.col("role") == "adversary"), "maybe").otherwise(F.col("verdict")),
            "reason": F.when(num % 113 == 0, "").otherwise(F.col("reason")),
        }
    )
    kept = spoiled.where(~((num % 101 == 0) & (F.col("role") == "direction")))
    doubled = spoiled.where((num % 103 == 0) & (F.col("role") == "necessity"))
    extra = spoiled.where(num % 107 == 0).withColumn("topic_id", F.lit("mtc_none"))
    return kept.union(doubled).union(extra)


def packet_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("packet_"), F.col("o_custkey")).alias("packet_id"),
        F.concat(F.lit("mtc_"), key + 1).alias("topic_id"),
        F.concat(F.lit("mtc_"), key).alias("prerequisite_id"),
        F.when(F.col("o_totalprice") > 200000, "hard").otherwise("soft").alias("strength"),
        F.col("o_orderpriority").alias("reason"),
        key.alias("num"),
    )


SQL_VIEWS: dict[str, str] = {
    "topics": """
SELECT 'mtc_' || p_partkey AS id, p_name AS name, p_brand AS subject, p_type AS domain,
  p_size AS age_start, p_size + 2 AS age_end,
  CASE WHEN p_size <= 16 THEN 'primary' WHEN p_size <= 33 THEN 'junior' ELSE 'senior' END AS stage,
  CASE WHEN p_partkey % 7 = 0 THEN 'text' WHEN p_partkey % 3 = 0 THEN 'skill' ELSE 'concept' END AS node_kind,
  CASE WHEN p_partkey % 41 = 0 THEN 'covered' END AS status,
  CASE WHEN p_partkey % 10 = 1 THEN 'mtc_' || (p_partkey - 1) END AS split_from, p_partkey AS num
FROM part""",
    "edges": """
SELECT 'mtc_' || t AS topic_id, 'mtc_' || p AS prerequisite_id,
  CASE WHEN flag = 'A' THEN 'hard' ELSE 'soft' END AS strength, 'order ' || flag AS reason,
  CASE WHEN (t + p) % 13 = 0 THEN 'rejected' WHEN (t + p) % 4 = 0 THEN 'machine' ELSE 'reviewed' END AS review_status,
  (t + p) % 17 = 0 AS rescope_required, t AS t_num, p AS p_num
FROM (SELECT t, p, min(l_returnflag) AS flag FROM (
  SELECT l_partkey AS t, p_brand AS tb, l_returnflag,
    lag(l_partkey) OVER w AS p, lag(p_brand) OVER w AS pb
  FROM lineitem JOIN part ON l_partkey = p_partkey
  WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_returnflag)) x
  WHERE tb = pb AND t <> p GROUP BY t, p) y""",
    "overlay": """
SELECT 'mtc_' || (doc_id * 3) AS id, text AS name, text AS description,
  CASE WHEN lang = 'en' THEN 'reviewed' ELSE 'machine' END AS translation_status, lang, source, doc_id * 3 AS num
FROM documents""",
    "text_topics": """
SELECT 'doc_' || doc_id AS id, source AS subject, lang AS domain, text AS description, n_chars, doc_id AS num
FROM documents""",
    "gold": """
SELECT doc_id AS item, source AS subject, CASE WHEN lang = 'en' THEN 'relation' ELSE 'split' END AS kind,
  CASE WHEN n_chars > 500 THEN w ELSE 'none' END AS predicted,
  CASE WHEN quality = 1 THEN w ELSE 'none' END AS reviewer_a,
  CASE WHEN (CASE WHEN doc_id % 5 = 0 THEN 1 - quality ELSE quality END) = 1 THEN w ELSE 'none' END AS reviewer_b
FROM (SELECT l.doc_id, quality, source, lang, n_chars,
  CASE WHEN lang = 'en' THEN 'prerequisite' ELSE 'split' END AS w
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id) x""",
    "decisions": """
SELECT event_id, user_id AS learner, 'mtc_' || (event_id % (SELECT count(*) FROM part)) AS topic_id,
  CASE WHEN event_type IN ('click', 'purchase') THEN 'mastered' WHEN event_type = 'error' THEN 'needs-review'
    WHEN event_type = 'signup' THEN 'clear' ELSE 'visit' END AS decision, ts
FROM events""",
    "standards_flat": """
SELECT lower(r_name) AS slug, lower(r_name) || ':N' || n_nationkey AS key, 'N' || n_nationkey AS code, n_name AS note
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "gaps": """
SELECT r_name AS subject, ' ' || n_name AS grade,
  CASE WHEN s_acctbal < 0 THEN 'missing' WHEN s_acctbal < 5000 THEN 'covered' ELSE 'textbook-only' END AS gap_type,
  CASE WHEN s_suppkey % 2 = 0 THEN 'junior' ELSE 'senior' END AS stage, s_name AS topic,
  r_name || '/' || n_name || '/' || s_name AS path, 'Book ' || n_name AS textbook
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "votes": """
SELECT 'packet_' || o_custkey AS packet_id, 'mtc_' || (o_orderkey + 1) AS topic_id, 'mtc_' || o_orderkey AS prerequisite_id,
  role, CASE WHEN yes THEN 'reviewed' ELSE 'rejected' END AS verdict,
  CASE o_orderkey % 3 WHEN 0 THEN 'hard' WHEN 1 THEN 'soft' ELSE 'unchanged' END AS resolved_strength,
  o_orderpriority AS reason,
  'model-' || CASE WHEN o_custkey % 11 = 0 AND role = 'adversary' THEN 'necessity' ELSE role END AS model, o_orderkey AS num
FROM (SELECT *, 'necessity' AS role, o_orderstatus <> 'F' AS yes FROM orders
  UNION ALL SELECT *, 'direction', o_totalprice > 50000 FROM orders
  UNION ALL SELECT *, 'adversary', NOT starts_with(o_orderpriority, '5') FROM orders) x""",
    "packet_edges": """
SELECT 'packet_' || o_custkey AS packet_id, 'mtc_' || (o_orderkey + 1) AS topic_id, 'mtc_' || o_orderkey AS prerequisite_id,
  CASE WHEN o_totalprice > 200000 THEN 'hard' ELSE 'soft' END AS strength, o_orderpriority AS reason, o_orderkey AS num
FROM orders""",
    "raw_votes": """
SELECT * FROM (SELECT packet_id, topic_id, prerequisite_id, role, CASE WHEN num % 109 = 0 AND role = 'adversary' THEN 'maybe' ELSE verdict END AS verdict,
  resolved_strength, CASE WHEN num % 113 = 0 THEN '' ELSE reason END AS reason, model, num FROM votes) v WHERE NOT (num % 101 = 0 AND role = 'direction')
UNION ALL SELECT packet_id, topic_id, prerequisite_id, role, verdict, resolved_strength, CASE WHEN num % 113 = 0 THEN '' ELSE reason END, model, num FROM votes WHERE num % 103 = 0 AND role = 'necessity'
UNION ALL SELECT packet_id, 'mtc_none', prerequisite_id, role, CASE WHEN num % 109 = 0 AND role = 'adversary' THEN 'maybe' ELSE verdict END, resolved_strength, CASE WHEN num % 113 = 0 THEN '' ELSE reason END, model, num FROM votes WHERE num % 107 = 0""",
    "pub_topics": "SELECT * FROM topics WHERE status IS DISTINCT FROM 'covered'",
    "pub_edges": """
SELECT * FROM edges WHERE review_status = 'reviewed' AND NOT rescope_required
  AND topic_id IN (SELECT id FROM pub_topics) AND prerequisite_id IN (SELECT id FROM pub_topics)""",
    "mastered": """
SELECT learner, topic_id FROM (SELECT learner, topic_id, arg_max(decision, event_id) AS decision
  FROM decisions WHERE decision <> 'visit' GROUP BY learner, topic_id) d WHERE decision = 'mastered'""",
}

_NEEDS = {
    "pub_topics": ["topics"],
    "pub_edges": ["topics", "edges", "pub_topics"],
    "mastered": ["decisions"],
    "raw_votes": ["votes"],
}


def with_views(*names: str) -> str:
    """``WITH`` clause defining the named SQL views and the views they use."""
    wanted: list[str] = []
    for name in names:
        for need in [*_NEEDS.get(name, []), name]:
            if need not in wanted:
                wanted.append(need)
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({SQL_VIEWS[n].strip()})" for n in wanted)
