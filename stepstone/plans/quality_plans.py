"""Data-quality queries over topic and edge views that carry known faults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepstone.operators import lookup
from stepstone.operators import quality as q
from stepstone.operators.cycles import with_ends
from stepstone.operators.graph import links, stale_centrality, unsortable
from stepstone.plans.consensus_plans import PROBLEM_SQL, PUBLISH_SQL, publish_problems
from stepstone.plans.edge_plans import ORIGIN_SQL, with_origin
from stepstone.plans.graph_plans import CENTRALITY, REACH, STORED_SQL, published_centrality, stored_centrality
from stepstone.plans.merge_plans import published
from stepstone.plans.registry import query
from stepstone.sources import export
from stepstone.sources import tables as src
from stepstone.sources.tables import with_views

FAULTY_TOPICS = f""", ft0 AS (SELECT CASE WHEN num % 71 = 0 THEN 'x_' || num ELSE id END AS id, num, subject, CASE WHEN num % 83 = 0 THEN '' ELSE domain END AS domain, stage, age_start,
  CASE WHEN num % 73 = 0 THEN age_start - 1 ELSE age_end END AS age_end, CASE WHEN num % 53 = 0 THEN 'ODD' ELSE 'CONCEPTUAL' END AS type, CASE WHEN num % 51 = 0 THEN 'page' ELSE node_kind END AS node_kind,
  CASE WHEN num % 59 = 0 THEN 'alien' ELSE {ORIGIN_SQL} END AS origin, CASE WHEN num % 61 = 0 THEN '' ELSE name END AS description, CASE WHEN num % 67 = 0 THEN 0 ELSE 1 + num % 3 END AS n_evidence,
  CASE WHEN num % 79 = 0 THEN 1.5 ELSE 0.5 END AS centrality, status, CASE WHEN num % 82 = 0 THEN 1 ELSE 2 END AS n_cover FROM topics),
ft AS (SELECT * FROM ft0 UNION ALL SELECT * FROM ft0 WHERE num % 97 = 0)"""
FAULTY_EDGES = """, fe AS (SELECT CASE WHEN p_num % 47 = 0 THEN 'mtc_gone' ELSE topic_id END AS topic_id, CASE WHEN p_num % 41 = 0 THEN (CASE WHEN p_num % 47 = 0 THEN 'mtc_gone' ELSE topic_id END) ELSE prerequisite_id END AS prerequisite_id, t_num, p_num,
  CASE WHEN p_num % 43 = 0 THEN 'firm' ELSE strength END AS strength, CASE WHEN p_num % 37 = 0 THEN 'done' ELSE review_status END AS review_status, rescope_required,
  CASE WHEN rescope_required AND p_num % 2 = 0 THEN 'b1' END AS rescope_batch_id, CASE WHEN p_num % 29 = 0 THEN 'reviewed' END AS previous_review_status, p_num % 11 = 0 AS age_regression,
  CASE p_num % 6 WHEN 0 THEN 'rule' WHEN 1 THEN 'human' WHEN 2 THEN 'ai-consensus' WHEN 3 THEN CASE WHEN p_num % 31 = 0 THEN 'upstream' ELSE 'magic' END END AS review_provenance,
  CASE WHEN p_num % 4 = 1 THEN 'someone' END AS reviewed_by, CASE WHEN p_num % 8 = 1 THEN '2024-01-01' END AS reviewed_at, CASE WHEN p_num % 5 = 0 THEN 'note' END AS review_note,
  CASE p_num % 7 WHEN 0 THEN 'teacher' WHEN 1 THEN 'curator' WHEN 2 THEN 'robot' END AS reviewer_role, CASE WHEN p_num % 2 = 0 THEN 'rubric' END AS review_rubric, CASE WHEN p_num % 3 = 0 THEN 'ref' END AS review_evidence_ref FROM edges)"""


def faulty_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("num")
    base = with_origin(src.topics(spark, sf_dir)).select(
        F.when(n % 71 == 0, F.concat(F.lit("x_"), n)).otherwise(F.col("id")).alias("id"),
        "num", "subject", "stage", "age_start", "status",
        F.when(n % 83 == 0, "").otherwise(F.col("domain")).alias("domain"),
        F.when(n % 73 == 0, F.col("age_start") - 1).otherwise(F.col("age_end")).alias("age_end"),
        F.when(n % 53 == 0, "ODD").otherwise("CONCEPTUAL").alias("type"),
        F.when(n % 51 == 0, "page").otherwise(F.col("node_kind")).alias("node_kind"),
        F.when(n % 59 == 0, "alien").otherwise(F.col("origin")).alias("origin"),
        F.when(n % 61 == 0, "").otherwise(F.col("name")).alias("description"),
        F.array_repeat(F.lit("e"), F.when(n % 67 == 0, 0).otherwise(1 + n % 3).cast("int")).alias("evidence"),
        F.when(n % 79 == 0, 1.5).otherwise(0.5).alias("centrality"),
        F.array_repeat(F.lit("mtc_1"), F.when(n % 82 == 0, 1).otherwise(2)).alias("covered_by"),
    )
    return base.union(base.where(n % 97 == 0))


def faulty_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_num")
    topic = F.when(p % 47 == 0, "mtc_gone").otherwise(F.col("topic_id"))
    return src.edges(spark, sf_dir).select(
        topic.alias("topic_id"),
        F.when(p % 41 == 0, topic).otherwise(F.col("prerequisite_id")).alias("prerequisite_id"),
        "t_num", "p_num", "rescope_required",
        F.when(p % 43 == 0, "firm").otherwise(F.col("strength")).alias("strength"),
        F.when(p % 37 == 0, "done").otherwise(F.col("review_status")).alias("review_status"),
        F.when(F.col("rescope_required") & (p % 2 == 0), "b1").alias("rescope_batch_id"),
        F.when(p % 29 == 0, "reviewed").alias("previous_review_status"),
        (p % 11 == 0).alias("age_regression"),
        F.when(p % 6 == 0, "rule").when(p % 6 == 1, "human").when(p % 6 == 2, "ai-consensus")
        .when((p % 6 == 3) & (p % 31 == 0), "upstream").when(p % 6 == 3, "magic").alias("review_provenance"),
        F.when(p % 4 == 1, "someone").alias("reviewed_by"),
        F.when(p % 8 == 1, "2024-01-01").alias("reviewed_at"),
        F.when(p % 5 == 0, "note").alias("review_note"),
        F.when(p % 7 == 0, "teacher").when(p % 7 == 1, "curator").when(p % 7 == 2, "robot").alias("reviewer_role"),
        F.when(p % 2 == 0, "rubric").alias("review_rubric"),
        F.when(p % 3 == 0, "ref").alias("review_evidence_ref"),
    )


def _rule_sql(source: str, key: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS rule, {key} AS key FROM {source} WHERE {cond}" for name, cond in rules.items())


EDGE_KEY_SQL = "topic_id || '->' || prerequisite_id"


@query(
    "q1_declared_counts",
    with_views("topics")
    + """
, h AS (SELECT 'o_' || o_custkey AS key, count(*) FILTER (WHERE o_orderkey % 50 <> 0) AS declared, count(*) AS n FROM orders GROUP BY 1)
SELECT 'declared-count' AS rule, key FROM h WHERE declared <> n""",
)
def declared_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = src.table(spark, sf_dir, "orders").select(F.concat(F.lit("o_"), "o_custkey").alias("key"), "o_orderkey")
    headers = orders.groupBy("key").agg(F.count_if(F.col("o_orderkey") % 50 != 0).alias("declared"))
    return q.declared_counts(headers, orders.groupBy("key").agg(F.count("*").alias("n")))


@query("q2_id_pattern", with_views("topics") + FAULTY_TOPICS + r" SELECT 'topic-id' AS rule, id AS key FROM ft WHERE NOT regexp_matches(id, '^mtc_\d+$')")
def id_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.id_pattern(faulty_topics(spark, sf_dir), "id", r"^mtc_\d+$", "topic-id")


CLUSTER_SQL = """, st AS (SELECT DISTINCT subject, domain, age_start FROM topics),
ov AS (SELECT subject, CASE WHEN age_start % 23 = 0 THEN domain || ' (old)' ELSE domain END AS domain, age_start, CASE age_start % 19 WHEN 0 THEN 'draft' WHEN 1 THEN 'machine' WHEN 2 THEN 'reviewed' END AS state FROM st),
oo AS (SELECT * FROM ov UNION ALL SELECT * FROM ov WHERE age_start % 29 = 0)"""


@query(
    "q2_cluster_problems",
    with_views("topics") + CLUSTER_SQL
    + """
SELECT 'unknown-cluster' AS rule, subject || '|' || domain || '|' || age_start AS key FROM oo WHERE age_start % 23 = 0
UNION ALL SELECT DISTINCT 'duplicate-cluster', subject || '|' || domain || '|' || age_start FROM oo WHERE age_start % 29 = 0
UNION ALL SELECT 'translation-status', subject || '|' || domain || '|' || age_start FROM oo WHERE age_start % 19 = 0""",
)
def cluster_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of topics and their overlay, of which some have other names, come twice or have an odd state."""
    age = F.col("age_start")
    structure = src.topics(spark, sf_dir).select("subject", "domain", "age_start").distinct()
    overlay = structure.withColumns({
        "domain": F.when(age % 23 == 0, F.concat("domain", F.lit(" (old)"))).otherwise(F.col("domain")),
        "translation_status": F.when(age % 19 == 0, "draft").when(age % 19 == 1, "machine").when(age % 19 == 2, "reviewed"),
    })
    return q.cluster_problems(overlay.union(overlay.where(age % 29 == 0)), structure)


@query(
    "q2_end_patterns",
    with_views("edges") + FAULTY_EDGES
    + f""" SELECT 'topic-end' AS rule, {EDGE_KEY_SQL} AS key FROM fe WHERE p_num % 47 = 0 UNION ALL SELECT 'prerequisite-end', {EDGE_KEY_SQL} FROM fe WHERE p_num % 41 = 0 AND p_num % 47 = 0""",
)
def end_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.end_patterns(faulty_edges(spark, sf_dir), r"^mtc_\d+$", r"^mtc_\d+$")


@query(
    "q3_duplicates",
    with_views("topics", "edges") + FAULTY_TOPICS + FAULTY_EDGES
    + f""" SELECT 'duplicate-topic' AS rule, id AS key FROM ft GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'duplicate-edge', {EDGE_KEY_SQL} FROM fe GROUP BY topic_id, prerequisite_id HAVING count(*) > 1""",
)
def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.union_all([
        q.duplicates(faulty_topics(spark, sf_dir), ["id"], "duplicate-topic"),
        q.duplicates(faulty_edges(spark, sf_dir), ["topic_id", "prerequisite_id"], "duplicate-edge"),
    ])


@query(
    "q4_dangling",
    with_views("topics", "edges") + FAULTY_TOPICS + FAULTY_EDGES
    + f""", d AS (SELECT 'unknown-topic' AS rule, {EDGE_KEY_SQL} AS key FROM fe WHERE topic_id NOT IN (SELECT id FROM ft)
  UNION ALL SELECT 'unknown-prerequisite', {EDGE_KEY_SQL} FROM fe WHERE prerequisite_id NOT IN (SELECT id FROM ft)),
r AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY key) AS rn, count(*) OVER (PARTITION BY rule) AS n FROM d)
SELECT rule, key FROM r WHERE rn <= 5 UNION ALL SELECT DISTINCT rule, 'and ' || (n - 5) || ' more' FROM r WHERE n > 5""",
)
def dangling(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges, topics = faulty_edges(spark, sf_dir), faulty_topics(spark, sf_dir)
    found = q.union_all([
        q.dangling(edges, "topic_id", topics, "id", "unknown-topic", q.edge_key()),
        q.dangling(edges, "prerequisite_id", topics, "id", "unknown-prerequisite", q.edge_key()),
    ])
    return q.first_and_rest(found)


REFERENCE_SQL = """, rt AS (SELECT id, num, status, [(SELECT lower(r_name) FROM region WHERE r_regionkey = num % 5) || ':N' || (num % 25), CASE WHEN num % 77 = 5 THEN 'none:' || num % 4 END] AS standards,
  ['mtc_' || (num - 1), CASE WHEN num % 3 = 0 THEN 'mtc_0' END] AS covered_by FROM topics),
rs AS (SELECT DISTINCT id, s.s AS item FROM rt, unnest(standards) s(s)), rc AS (SELECT DISTINCT id, c.c AS item FROM rt, unnest(covered_by) c(c) WHERE status = 'covered'),
re AS (SELECT topic_id, prerequisite_id, CASE WHEN p_num % 3 > 0 THEN 'batch' || (p_num % 90) END AS batch FROM edges)"""


@query(
    "q4_reference_problems",
    with_views("topics", "edges", "standards_flat") + REFERENCE_SQL
    + """
SELECT 'unknown-standard' AS rule, id || ':' || item AS key FROM rs WHERE item IS NOT NULL AND item NOT IN (SELECT key FROM standards_flat)
UNION ALL SELECT 'unknown-cover', id || ':' || item FROM rc WHERE item IS NOT NULL AND item NOT IN (SELECT id FROM topics)
UNION ALL SELECT 'unknown-batch', topic_id || '->' || prerequisite_id FROM re WHERE batch IS NOT NULL AND batch NOT IN (SELECT 'batch' || s_suppkey % 80 FROM supplier)""",
)
def reference_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics with standards and covering topics, edges with batches: some of them name nothing."""
    num = F.col("num")
    region = src.table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("_r"), F.lower("r_name").alias("_slug"))
    topics = src.topics(spark, sf_dir).join(region, num % 5 == F.col("_r"), "left").select(
        "id", "status",
        F.array(F.concat("_slug", F.lit(":N"), num % 25), F.when(num % 77 == 5, F.concat(F.lit("none:"), num % 4))).alias("standards"),
        F.array(F.concat(F.lit("mtc_"), num - 1), F.when(num % 3 == 0, "mtc_0")).alias("covered_by"),
    )
    p = F.col("p_num")
    edges = src.edges(spark, sf_dir).select("topic_id", "prerequisite_id", F.when(p % 3 > 0, F.concat(F.lit("batch"), p % 90)).alias("generation_batch_id"))
    batches = src.table(spark, sf_dir, "supplier").select(F.concat(F.lit("batch"), F.col("s_suppkey") % 80).alias("id")).distinct()
    return q.reference_problems(topics, edges, lookup.flatten_curricula(src.standards(spark, sf_dir)), batches)


@query(
    "q5_paired_lengths",
    with_views("topics") + FAULTY_TOPICS + " SELECT 'paired-length' AS rule, id AS key FROM ft0 WHERE n_evidence <> 1 + num % 3",
)
def paired_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = faulty_topics(spark, sf_dir).dropDuplicates(["id"])
    paired = rows.select("id", F.array_repeat(F.lit("u"), (1 + F.col("num") % 3).cast("int")).alias("evidence"))
    return q.paired_lengths(rows, paired, "evidence")


@query(
    "q6_codes_only",
    """
WITH c AS (SELECT lower(c_mktsegment) || c_nationkey AS slug, bool_or(c_custkey % 40 = 0) AS text_included FROM customer GROUP BY 1),
e AS (SELECT lower(c_mktsegment) || c_nationkey AS slug, 'C' || c_custkey AS code, CASE WHEN c_custkey % 61 = 0 THEN 'odd' ELSE lower(c_mktsegment) || c_nationkey || ':C' || c_custkey END AS key, CASE WHEN c_custkey % 67 = 0 THEN c_name END AS payload FROM customer)
SELECT 'text-included' AS rule, slug AS key FROM c WHERE text_included UNION ALL SELECT 'unregistered-source', slug FROM c WHERE starts_with(slug, 'building')
UNION ALL SELECT 'standard-key', key FROM e WHERE key <> slug || ':' || code UNION ALL SELECT 'text-payload', key FROM e WHERE payload IS NOT NULL""",
)
def codes_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, slug = F.col("c_custkey"), F.concat(F.lower("c_mktsegment"), "c_nationkey")
    customer = src.table(spark, sf_dir, "customer").withColumn("slug", slug)
    curricula = customer.groupBy("slug").agg(F.max(key % 40 == 0).alias("text_included"))
    code = F.concat(F.lit("C"), key)
    entries = customer.select(
        "slug", code.alias("code"),
        F.when(key % 61 == 0, "odd").otherwise(F.concat_ws(":", "slug", code)).alias("key"),
        F.when(key % 67 == 0, F.col("c_name")).alias("payload"),
    )
    registered = curricula.where(~F.col("slug").startswith("building")).select("slug")
    return q.codes_only(curricula, entries, registered)


TOPIC_RULES_SQL = {
    "type": "type NOT IN ('CONCEPTUAL', 'PROCEDURAL', 'REPRESENTATIONAL', 'LANGUAGE', 'META')",
    "node-kind": "node_kind = 'page'",
    "origin": "origin = 'alien'",
    "domain": "domain = ''",
    "description": "description = ''",
    "evidence": "n_evidence = 0",
    "age-order": "age_start > age_end",
    "centrality-range": "centrality > 1",
    "covered-by": "status = 'covered' AND n_cover < 2",
}
ENUM_RULES = ("type", "node-kind", "origin")


@query("q7_enums", with_views("topics") + FAULTY_TOPICS + " " + _rule_sql("ft", "id", {k: TOPIC_RULES_SQL[k] for k in ENUM_RULES}))
def enums(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = q.topic_rules()
    return q.check_rows(faulty_topics(spark, sf_dir), F.col("id"), {k: rules[k] for k in ENUM_RULES})


@query("q8_topic_values", with_views("topics") + FAULTY_TOPICS + " " + _rule_sql("ft", "id", {k: v for k, v in TOPIC_RULES_SQL.items() if k not in ENUM_RULES}))
def topic_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {k: v for k, v in q.topic_rules().items() if k not in ENUM_RULES}
    return q.check_rows(faulty_topics(spark, sf_dir), F.col("id"), rules)


@query("q9_self_edges", with_views("edges") + FAULTY_EDGES + f" SELECT 'self-edge' AS rule, {EDGE_KEY_SQL} AS key FROM fe WHERE topic_id = prerequisite_id")
def self_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.check_rows(faulty_edges(spark, sf_dir), q.edge_key(), {"self-edge": q.edge_rules()["self-edge"]})


FINAL = "review_status IN ('reviewed', 'rejected')"
SIGNED = "(coalesce(length(reviewed_by), 0) > 0 AND coalesce(length(reviewed_at), 0) > 0)"
REVIEW_SQL = {
    "strength": "strength NOT IN ('hard', 'soft')",
    "review-status": "review_status = 'done'",
    "reviewed-with-rescope": "review_status = 'reviewed' AND rescope_required",
    "rescope-not-machine": f"rescope_required AND {FINAL}",
    "rescope-without-batch": "rescope_required AND rescope_batch_id IS NULL",
    "previous-without-rescope": "previous_review_status IS NOT NULL AND NOT rescope_required",
    "audit-incomplete": f"(reviewed_by IS NOT NULL OR reviewed_at IS NOT NULL OR review_note IS NOT NULL) AND NOT ({FINAL} AND {SIGNED})",
}
PROVENANCE_SQL = {
    "provenance": "review_provenance = 'magic'",
    "provenance-upstream": "review_provenance = 'upstream'",
    "provenance-not-final": f"review_provenance IS NOT NULL AND NOT {FINAL}",
    "provenance-reviewer": "review_provenance IS NOT NULL AND (review_provenance = 'rule') <> (reviewed_by IS NULL)",
    "provenance-unsigned": f"review_provenance IN ('human', 'ai-consensus') AND NOT {SIGNED}",
    "provenance-missing": f"{FINAL} AND review_provenance IS NULL",
}


@query("q10_review_state", with_views("edges") + FAULTY_EDGES + " " + _rule_sql("fe", EDGE_KEY_SQL, REVIEW_SQL))
def review_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = q.edge_rules()
    return q.check_rows(faulty_edges(spark, sf_dir), q.edge_key(), {k: rules[k] for k in REVIEW_SQL})


@query(
    "q11_age_regression",
    with_views("edges", "topics") + FAULTY_EDGES
    + f""" SELECT 'age-regression' AS rule, {EDGE_KEY_SQL} AS key FROM fe LEFT JOIN topics a ON a.id = topic_id LEFT JOIN topics b ON b.id = prerequisite_id
WHERE age_regression AND NOT (review_status NOT IN ('reviewed', 'rejected') AND a.stage IS NOT DISTINCT FROM b.stage AND coalesce(b.age_start > a.age_start, FALSE))""",
)
def age_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_ends(faulty_edges(spark, sf_dir), src.topics(spark, sf_dir))
    return q.check_rows(rows, q.edge_key(), q.age_flag_rule())


@query("q12_provenance", with_views("edges") + FAULTY_EDGES + " " + _rule_sql("fe", EDGE_KEY_SQL, PROVENANCE_SQL))
def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = q.edge_rules(publish=True)
    return q.check_rows(faulty_edges(spark, sf_dir), q.edge_key(), {k: rules[k] for k in PROVENANCE_SQL})


@query(
    "q13_reviewer_roles",
    with_views("edges") + FAULTY_EDGES + " " + _rule_sql("fe", EDGE_KEY_SQL, {
        "role": "reviewer_role = 'robot'",
        "role-not-human": "reviewer_role IS NOT NULL AND review_provenance IS DISTINCT FROM 'human'",
        "teacher-rubric": "reviewer_role = 'teacher' AND review_rubric IS NULL",
        "teacher-reference": "reviewer_role = 'teacher' AND review_evidence_ref IS NULL",
    }),
)
def reviewer_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.check_rows(faulty_edges(spark, sf_dir), q.edge_key(), q.reviewer_rules())


@query(
    "q14_unaligned_clusters",
    with_views("topics")
    + """
, z AS (SELECT DISTINCT p_brand AS s, CASE WHEN p_partkey % 9 = 0 THEN 'OLD' ELSE p_type END AS d, p_size AS a FROM part)
SELECT 'cluster-unknown' AS rule, s || '|' || d || '|' || a AS key FROM z WHERE NOT EXISTS (SELECT 1 FROM topics t WHERE t.subject = s AND t.domain = d AND t.age_start = a)""",
)
def unaligned_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["subject", "domain", "age_start"]
    topics = src.topics(spark, sf_dir)
    domain = F.when(F.col("num") % 9 == 0, "OLD").otherwise(F.col("domain"))
    return q.unaligned_clusters(topics.withColumn("domain", domain).select(*keys).distinct(), topics.select(*keys).distinct(), keys)


@query(
    "q15_unknown_fields",
    with_views("edges")
    + f""" SELECT 'unknown-field' AS rule, {EDGE_KEY_SQL} || '.review_status' AS key FROM edges WHERE p_num % 3 = 0 UNION ALL SELECT 'unknown-field', {EDGE_KEY_SQL} || '.flag' FROM edges WHERE p_num % 5 = 0""",
)
def unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_num")
    row = F.struct(
        "topic_id", "prerequisite_id", "strength", "reason",
        F.when(p % 3 == 0, F.col("review_status")).alias("review_status"), F.when(p % 5 == 0, 1).alias("flag"),
    )
    raw = src.edges(spark, sf_dir).select(q.edge_key().alias("id"), F.to_json(row).alias("raw"))
    return q.unknown_fields(raw, "id", "raw", ("topic_id", "prerequisite_id", "strength", "reason"))


@query(
    "q16_versions",
    "SELECT 'version' AS rule, 'o_' || o_orderkey AS key FROM orders WHERE o_orderstatus <> 'O'",
)
def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = src.table(spark, sf_dir, "orders")
    headers = orders.select(F.concat(F.lit("o_"), "o_orderkey").alias("key"), F.col("o_orderstatus").alias("version"))
    upstream = orders.agg(F.min(F.when(F.col("o_orderstatus") == "O", F.col("o_orderstatus"))).alias("version"))
    return q.version_mismatch(headers, upstream)


@query(
    "q17_acyclic",
    with_views("edges") + REACH.format(edges="edges")
    + " SELECT DISTINCT 'not-sortable' AS rule, d AS key FROM reach WHERE s IN (SELECT s FROM reach WHERE s = d)",
)
def acyclic(spark: SparkSession, sf_dir: str) -> DataFrame:
    stuck = unsortable(links(src.edges(spark, sf_dir)))
    return stuck.select(F.lit("not-sortable").alias("rule"), F.col("id").alias("key"))


TEXT_TABLES = ("region", "nation", "documents", "pages", "benchmark", "labels", "conversations")
_COLUMNS = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey", "documents": "doc_id text lang source n_chars",
    "pages": "page_id url html", "benchmark": "item_id text", "labels": "doc_id quality toxic", "conversations": "conv_id turn role text",
}

FLOAT_TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")
_COLUMNS |= {
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment", "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props", "embeddings": "vec_id embedding label",
}


def _exact_sql(x: str) -> str:
    units = f"floor({x} * 1048576)"
    return (
        f"CASE WHEN abs({x}) BETWEEN 1 / 1048576.0::DOUBLE AND 4398046511104 THEN CAST({units} AS BIGINT) || '.' || CAST(({x} * 1048576 - {units}) * 4503599627370496 AS BIGINT)"
        f" WHEN {x} = 0 THEN CAST({x} AS VARCHAR) ELSE replace(printf('%a', {x}), 'p+', 'p') END"
    )


_FLOATS = {c: _exact_sql(c) for c in "c_acctbal s_acctbal p_retailprice o_totalprice l_quantity l_extendedprice l_discount l_tax value".split()}
_FLOATS["embedding"] = f"array_to_string([coalesce({_exact_sql('CAST(x AS DOUBLE)')}, '~') FOR x IN embedding], ',')"


def _digest_sql(table: str, source: str | None = None) -> str:
    texts = [_FLOATS.get(c, f"CAST({c} AS VARCHAR)") for c in _COLUMNS[table].split()]
    row = " || '|' || ".join(f"coalesce(length({t}) || ':' || {t}, '~')" for t in texts)
    return f"SELECT '{table}' AS \"table\", count(*) AS rows, CAST(sum(CAST('0x' || substr(md5({row}), 1, 15) AS HUGEINT)) AS VARCHAR) AS digest FROM {source or table}"


ALL_TABLES = TEXT_TABLES + FLOAT_TABLES
MANIFEST_SQL = " UNION ALL ".join(_digest_sql(t) for t in ALL_TABLES)


@query("s5_content_manifest", MANIFEST_SQL)
def content_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.content_manifest({t: src.table(spark, sf_dir, t) for t in ALL_TABLES})


_OLD = {
    "documents": "(SELECT * FROM documents WHERE doc_id <> 0) x",
    "labels": "(SELECT doc_id, quality, CASE WHEN doc_id = 0 THEN 1 - toxic ELSE toxic END AS toxic FROM labels) x",
    "orders": "(SELECT * REPLACE (CASE WHEN o_orderkey = 0 THEN o_totalprice + 0.00001::DOUBLE ELSE o_totalprice END AS o_totalprice) FROM orders) x",
    "embeddings": "(SELECT * FROM embeddings WHERE vec_id <> 0) x",
}
OLD_MANIFEST_SQL = " UNION ALL ".join(_digest_sql(t, _OLD.get(t)) for t in ALL_TABLES)


@query(
    "q18_manifest",
    f"""WITH o AS ({OLD_MANIFEST_SQL}), n AS ({MANIFEST_SQL})
SELECT 'content' AS rule, o."table" AS key FROM o JOIN n ON o."table" = n."table" WHERE o.digest <> n.digest""",
)
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored manifest taken before a document and a vector were dropped, a label flipped and a price changed."""
    tables = {t: src.table(spark, sf_dir, t) for t in ALL_TABLES}
    price = F.col("o_totalprice")
    old = tables | {
        "documents": tables["documents"].where("doc_id <> 0"),
        "labels": tables["labels"].withColumn("toxic", F.when(F.col("doc_id") == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))),
        "orders": tables["orders"].withColumn("o_totalprice", F.when(F.col("o_orderkey") == 0, price + 0.00001).otherwise(price)),
        "embeddings": tables["embeddings"].where("vec_id <> 0"),
    }
    return export.manifest_problems(export.content_manifest(old), export.content_manifest(tables))


GATE_SQL = """SELECT 'edges-need-rescope' AS rule, CAST(count(*) AS VARCHAR) AS key FROM edges WHERE rescope_required HAVING count(*) > 0
UNION ALL SELECT 'bridges-need-rescope', CAST(count(*) AS VARCHAR) FROM edges WHERE rescope_required AND t_num % 5 = 0 HAVING count(*) > 0
UNION ALL SELECT 'stale-centrality', CAST(count(*) AS VARCHAR) FROM stored s JOIN central c ON s.id = c.id WHERE s.centrality IS DISTINCT FROM c.centrality HAVING count(*) > 0"""


def _gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = src.edges(spark, sf_dir)
    stale = stale_centrality(stored_centrality(spark, sf_dir), published_centrality(spark, sf_dir))
    return q.publication_problems(edges, edges.where("t_num % 5 = 0"), stale)


@query("c9_publication_problems", with_views("pub_edges") + CENTRALITY + STORED_SQL + " " + GATE_SQL)
def publication_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gate(spark, sf_dir)


@query(
    "q19_publication_gate",
    with_views("pub_edges", "packet_edges", "raw_votes") + CENTRALITY + STORED_SQL + FAULTY_EDGES + PUBLISH_SQL + " " + GATE_SQL
    + f" UNION ALL SELECT problem, {EDGE_KEY_SQL} FROM ({PROBLEM_SQL}) x UNION ALL " + _rule_sql("fe", EDGE_KEY_SQL, PROVENANCE_SQL),
)
def publication_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both gates of a publication, that of states and that of consensus evidence, and the provenance rules."""
    consensus = publish_problems(spark, sf_dir).select(F.col("problem").alias("rule"), q.edge_key().alias("key"))
    return q.union_all([_gate(spark, sf_dir), consensus, provenance(spark, sf_dir)])


@query(
    "q20_package",
    with_views("pub_edges")
    + """
SELECT 'item-field' AS rule, id AS key FROM pub_topics WHERE num % 101 = 0 UNION ALL SELECT 'item-uuid', id FROM pub_topics WHERE num % 103 = 0
UNION ALL SELECT 'association-type', prerequisite_id || '->' || topic_id FROM pub_edges WHERE p_num % 19 = 0""",
)
def package(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, kept = published(spark, sf_dir)
    num = F.regexp_extract("humanCodingScheme", r"(\d+)", 1).cast("bigint")
    items = export.competency_items(nodes, "https://example.org", "2024-01-01").withColumns(
        {
            "fullStatement": F.when(num % 101 != 0, F.col("fullStatement")),
            "identifier": F.when(num % 103 == 0, "no-uuid").otherwise(F.col("identifier")),
        }
    )
    ties = export.competency_associations(kept, nodes, "https://example.org", "2024-01-01")
    ends = F.regexp_extract_all(F.url_decode("uri"), F.lit(r"(mtc_\d+)"), F.lit(1))
    odd = F.regexp_extract(ends[0], r"(\d+)", 1).cast("bigint") % 19 == 0
    ties = ties.withColumn("associationType", F.when(odd, "comesBefore").otherwise(F.col("associationType")))
    return q.union_all([
        q.check_rows(items, F.col("humanCodingScheme"), q.package_items()),
        q.check_rows(ties, F.concat_ws("->", ends), q.package_associations()),
    ])


@query(
    "q21_metric_drift",
    """
WITH m AS (SELECT lang AS metric, count(*) AS value FROM documents GROUP BY 1), d AS (SELECT lang AS metric, count(*) + CASE WHEN lang = 'fr' THEN 1 ELSE 0 END AS value FROM documents GROUP BY 1 UNION ALL SELECT 'it', 3)
SELECT 'metric-drift' AS rule, d.metric AS key FROM d LEFT JOIN m ON m.metric = d.metric WHERE d.value IS DISTINCT FROM m.value""",
)
def metric_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = src.table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("metric")).agg(F.count("*").alias("value"))
    late = measured.withColumn("value", F.col("value") + F.when(F.col("metric") == "fr", 1).otherwise(0))
    gone = spark.range(1).select(F.lit("it").alias("metric"), F.lit(3).cast("bigint").alias("value"))
    return q.metric_drift(late.union(gone), measured)
