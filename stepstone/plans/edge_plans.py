"""Window, ranking, paging and de-duplication queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepstone.functions.columns import normalised_name
from stepstone.operators import cycles, dedupe, edges, merge, recommend
from stepstone.plans.graph_plans import TEMPLATES, broken_cycles, learner_state, topic_sequence
from stepstone.plans.merge_plans import published
from stepstone.plans.registry import query
from stepstone.sources import tables as src
from stepstone.sources.tables import with_views

STAGE5 = """CASE WHEN {0} <= 8 THEN 'primary' WHEN {0} <= 10 THEN 'primary-mid' WHEN {0} <= 12 THEN 'primary-hi' WHEN {0} <= 15 THEN 'junior' ELSE 'senior' END"""
CHAIN_SQL = f""", ch AS (SELECT subject, domain, id, name, {STAGE5.format('age_start')} AS st, lag(id) OVER w AS pid, lag(name) OVER w AS pname,
  {STAGE5.format('lag(age_start) OVER w')} AS pst FROM topics WINDOW w AS (PARTITION BY subject, domain ORDER BY age_start, age_end, id)),
chain AS (SELECT id AS topic_id, pid AS prerequisite_id, CASE WHEN st = pst THEN 'soft' ELSE 'hard' END AS strength,
  CASE WHEN st = pst THEN domain || ': ' ELSE pst || '→' || st || ': ' END || pname || ' → ' || name AS reason FROM ch WHERE pid IS NOT NULL)"""


@query("w1_age_chain", with_views("topics") + CHAIN_SQL + " SELECT * FROM chain")
def age_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges.age_chain(src.topics(spark, sf_dir))


# Domain order used by the rule queries.
DOMAIN_ORDER = (("ECONOMY", "STANDARD"), ("STANDARD", "PROMO"), ("SMALL", "MEDIUM"), ("MEDIUM", "LARGE"))
RULES_SQL = """, chains(from_domain, to_domain) AS (VALUES ('ECONOMY', 'STANDARD'), ('STANDARD', 'PROMO'), ('SMALL', 'MEDIUM'), ('MEDIUM', 'LARGE')),
src AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subject, domain ORDER BY age_start, id) AS rn FROM topics) x WHERE rn = 1),
cand AS (SELECT s.subject, from_domain, to_domain, s.id AS sid, s.name AS sname, t.id AS tid, t.name AS tname,
  row_number() OVER (PARTITION BY s.subject, from_domain, to_domain ORDER BY CASE WHEN t.age_start >= s.age_end THEN 0 ELSE 1 END, t.age_start, t.id) AS rn
  FROM chains c JOIN src s ON s.domain = c.from_domain JOIN topics t ON t.subject = s.subject AND t.domain = c.to_domain),
ruled AS (SELECT tid AS topic_id, sid AS prerequisite_id, 'hard' AS strength, from_domain || ' before ' || to_domain || ': ' || sname || ' → ' || tname AS reason FROM cand WHERE rn = 1)"""


def _rule_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = src.topics(spark, sf_dir)
    pairs = F.inline(F.array(*[F.struct(F.lit(a).alias("from_domain"), F.lit(b).alias("to_domain")) for a, b in DOMAIN_ORDER]))
    rules = topics.select("subject").distinct().select("subject", pairs)
    return edges.rule_edges(topics, rules)


@query("w2_rule_edges", with_views("topics") + RULES_SQL + " SELECT * FROM ruled")
def rule_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rule_edges(spark, sf_dir)


@query(
    "w3_row_windows",
    with_views("topics")
    + """
, n AS (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY age_start, id) - 1 AS i, count(*) OVER (PARTITION BY subject) AS n FROM topics),
wr AS (SELECT subject, id, i, n, CAST(unnest(CASE WHEN n <= 30 THEN [0] ELSE list_filter(generate_series(0, i // 15), lambda x: i < x * 15 + 25) END) AS BIGINT) AS win FROM n)
SELECT subject, id, i + 1 AS pos, win AS window, CASE WHEN n <= 30 THEN n ELSE least(25, n - win * 15) END AS window_rows
FROM wr WHERE CASE WHEN n <= 30 THEN n ELSE least(25, n - win * 15) END >= 2""",
)
def row_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.topics(spark, sf_dir).select("subject", "id", "age_start")
    return edges.row_windows(rows, ["subject"], ["age_start", "id"]).drop("age_start")


@query(
    "w4_fixed_batches",
    with_views("topics")
    + " SELECT subject, stage, id, (row_number() OVER (PARTITION BY subject, stage ORDER BY num) - 1) // 20 AS batch FROM topics",
)
def fixed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.topics(spark, sf_dir).select("subject", "stage", "id", "num")
    return edges.fixed_batches(rows, ["subject", "stage"], ["num"]).drop("num")


@query(
    "w5_exact_duplicates",
    with_views("text_topics")
    + """
, k AS (SELECT id, first_value(id) OVER (PARTITION BY domain, description ORDER BY CASE WHEN num % 10 = 1 THEN 1 ELSE 0 END, num) AS keep_id FROM text_topics)
SELECT id AS dup_id, keep_id FROM k WHERE id <> keep_id""",
)
def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.exact_duplicates(
        src.text_topics(spark, sf_dir), ["domain", "description"], (F.col("num") % 10 == 1).cast("int")
    )


ORIGIN_SQL = "CASE num % 5 WHEN 0 THEN 'cn_only' WHEN 1 THEN 'upstream_adapt' WHEN 2 THEN 'cross_domain' WHEN 3 THEN 'progression' ELSE 'textbook' END"


def with_origin(topics: DataFrame) -> DataFrame:
    names = list(dedupe.ORIGIN_PRIORITY)
    return topics.withColumn("origin", F.element_at(F.array(*map(F.lit, names)), (F.col("num") % 5 + 1).cast("int")))


@query(
    "w6_same_name",
    with_views("topics")
    + f"""
, r AS (SELECT *, row_number() OVER (PARTITION BY name, subject ORDER BY CASE num % 5 WHEN 0 THEN 5 WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 2 ELSE 1 END DESC, length(domain) DESC, id) AS rn FROM topics),
b AS (SELECT name, subject, id, age_start FROM r WHERE rn = 1)
SELECT b.subject || ' ' || b.name AS name, b.id AS keep_id, count(*) AS copies,
  b.subject || ' ' || b.name || CASE WHEN max(abs(t.age_start - b.age_start)) > 3 THEN CASE WHEN b.age_start <= 12 THEN '（初中）' ELSE '（高中）' END ELSE '' END AS new_name
FROM b JOIN topics t ON t.name = b.name AND t.subject = b.subject GROUP BY b.subject, b.name, b.id, b.age_start HAVING count(*) > 1""",
)
def same_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_origin(src.topics(spark, sf_dir)).select(
        "id", F.concat_ws(" ", "subject", "name").alias("name"), "origin", "age_start", F.col("domain").alias("description")
    )
    return dedupe.same_name(rows)


@query(
    "w7_first_wins",
    with_views("topics", "edges") + CHAIN_SQL + RULES_SQL
    + """
, u AS (SELECT topic_id, prerequisite_id, strength, reason, 0 AS source_rank FROM chain UNION ALL SELECT *, 1 FROM ruled
  UNION ALL SELECT topic_id, prerequisite_id, strength, reason, 2 FROM edges)
SELECT topic_id, prerequisite_id, strength, reason, source_rank FROM (SELECT *, row_number() OVER (PARTITION BY topic_id, prerequisite_id ORDER BY source_rank, strength, reason) AS rn FROM u) x WHERE rn = 1""",
)
def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    mined = src.edges(spark, sf_dir).select("topic_id", "prerequisite_id", "strength", "reason")
    return edges.first_wins([edges.age_chain(src.topics(spark, sf_dir)), _rule_edges(spark, sf_dir), mined])


VOTE_SQL = """, v AS (SELECT 'mtc_' || l_partkey AS topic_id, 'mtc_' || (l_suppkey * 25) AS prerequisite_id, CASE WHEN l_returnflag = 'N' THEN 'soft' ELSE 'hard' END AS strength,
  CASE WHEN l_linestatus = 'O' THEN '' ELSE l_returnflag || l_linenumber END AS reason, l_orderkey AS a1, l_linenumber AS a2 FROM lineitem),
k AS (SELECT * FROM v WHERE topic_id IN (SELECT id FROM topics) AND prerequisite_id IN (SELECT id FROM topics))"""


def _edge_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("mtc_"), "l_partkey").alias("topic_id"),
        F.concat(F.lit("mtc_"), F.col("l_suppkey") * 25).alias("prerequisite_id"),
        F.when(F.col("l_returnflag") == "N", "soft").otherwise("hard").alias("strength"),
        F.when(F.col("l_linestatus") == "O", "").otherwise(F.concat("l_returnflag", "l_linenumber")).alias("reason"),
        F.struct("l_orderkey", "l_linenumber").alias("arrival"),
    )


@query(
    "w8_merge_votes",
    with_views("topics") + VOTE_SQL
    + """
SELECT topic_id, prerequisite_id, CASE WHEN count(*) FILTER (WHERE strength = 'hard') >= count(*) FILTER (WHERE strength = 'soft') THEN 'hard' ELSE 'soft' END AS strength,
  (list(reason ORDER BY a1, a2, reason) FILTER (WHERE reason <> ''))[1] AS reason, count(*) AS votes FROM k GROUP BY 1, 2""",
)
def merge_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges.merge_votes(_edge_votes(spark, sf_dir), src.topics(spark, sf_dir))[0]


@query(
    "w8_dropped_votes",
    with_views("topics") + VOTE_SQL + " SELECT (SELECT count(*) FROM v) - (SELECT count(*) FROM k) AS dropped",
)
def dropped_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges.merge_votes(_edge_votes(spark, sf_dir), src.topics(spark, sf_dir))[1]


@query(
    "w9_page",
    with_views("edges")
    + " SELECT topic_id, prerequisite_id, strength FROM edges WHERE review_status = 'machine' ORDER BY topic_id, prerequisite_id LIMIT 50 OFFSET 10",
)
def page(spark: SparkSession, sf_dir: str) -> DataFrame:
    machine = src.edges(spark, sf_dir).where("review_status = 'machine'")
    return machine.select("topic_id", "prerequisite_id", "strength").orderBy("topic_id", "prerequisite_id").offset(10).limit(50)


@query(
    "w10_allocate_ids",
    with_views("topics")
    + """
SELECT 'doc_' || doc_id AS id, 'mtc_' || ((SELECT max(num) FROM topics) + row_number() OVER (ORDER BY doc_id)) AS new_id FROM documents""",
)
def allocate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.text_topics(spark, sf_dir).select("id", "num")
    return dedupe.allocate_ids(rows, src.topics(spark, sf_dir), ["num"]).drop("num")


@query(
    "w11_next_topics",
    with_views("pub_edges", "mastered")
    + """
, tot AS (SELECT topic_id, count(*) AS total FROM pub_edges GROUP BY 1),
hit AS (SELECT m.learner, e.topic_id, count(*) AS hit, bool_or(a.domain <> b.domain) AS via_cross FROM mastered m JOIN pub_edges e ON e.prerequisite_id = m.topic_id
  JOIN topics a ON a.id = e.topic_id JOIN topics b ON b.id = e.prerequisite_id
  WHERE NOT EXISTS (SELECT 1 FROM mastered x WHERE x.learner = m.learner AND x.topic_id = e.topic_id) GROUP BY 1, 2)
SELECT * FROM (SELECT h.learner, h.topic_id, h.hit, t.total, round(h.hit::DOUBLE / t.total, 6) AS readiness, h.via_cross,
  row_number() OVER (PARTITION BY h.learner ORDER BY h.hit::DOUBLE / t.total DESC, a.age_start, h.topic_id) AS rank
  FROM hit h JOIN tot t ON t.topic_id = h.topic_id JOIN topics a ON a.id = h.topic_id) x WHERE rank <= 12""",
)
def next_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    mastered, _ = learner_state(spark, sf_dir)
    nodes, kept = published(spark, sf_dir)
    kind = nodes.select("id", F.col("domain").alias("subject"))
    return recommend.next_topics(mastered, merge.cross_subject(kept, kind), nodes)


@query(
    "w12_recent_trail",
    with_views("decisions")
    + """
, l AS (SELECT learner, topic_id, max(event_id) AS last_event FROM decisions GROUP BY 1, 2)
SELECT learner, topic_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY learner ORDER BY last_event DESC) AS rank FROM l) x WHERE rank <= 8""",
)
def recent_trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.recent_trail(src.decisions(spark, sf_dir))


def child_name() -> Column:
    """A line's part as its return flag spells it; which part two names mean shows only after normalising."""
    part, flag = F.col("l_partkey"), F.col("l_returnflag")
    return (
        F.when(flag == "A", F.concat(F.lit("Part ("), part, F.lit(")")))
        .when(flag == "R", F.concat(F.lit("Part 的 "), part))
        .otherwise(F.concat(F.lit("Part："), part))
    )


def name_claims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders propose splits; the children's names come from the parts of the lines, each spelled as its line has it."""
    lines = src.table(spark, sf_dir, "lineitem")
    names = lines.select(
        F.concat(F.lit("bucket_"), F.floor(F.col("l_orderkey") / 100)).alias("bucket"),
        F.concat(F.lit("order_"), "l_orderkey").alias("id"),
        normalised_name(child_name()).alias("name"),
        F.col("l_orderkey").alias("ord"),
    )
    proposals = src.written(spark, sf_dir, "split_proposals", lambda: names.select("bucket", "ord", "id").distinct())
    return proposals, names.select("bucket", "id", "name")


@query("w13_name_conflicts")
def name_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    proposals, names = name_claims(spark, sf_dir)
    complete = proposals.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    return dedupe.resolve_name_conflicts(proposals, names, complete)


@query(
    "g14_remap_endpoints",
    with_views("edges", "topics")
    + """
, m AS (SELECT id AS dup_id, split_from AS keep_id FROM topics WHERE split_from IS NOT NULL),
r AS (SELECT coalesce(a.keep_id, e.topic_id) AS topic_id, coalesce(b.keep_id, e.prerequisite_id) AS prerequisite_id, strength, t_num, p_num
  FROM edges e LEFT JOIN m a ON a.dup_id = e.topic_id LEFT JOIN m b ON b.dup_id = e.prerequisite_id)
SELECT topic_id, prerequisite_id, (list(strength ORDER BY t_num, p_num))[1] AS strength, count(*) AS merged FROM r WHERE topic_id <> prerequisite_id GROUP BY 1, 2""",
)
def remap_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = src.topics(spark, sf_dir).where("split_from IS NOT NULL").select(
        F.col("id").alias("dup_id"), F.col("split_from").alias("keep_id")
    )
    rows = src.edges(spark, sf_dir).select("topic_id", "prerequisite_id", "t_num", "p_num", "strength")
    return edges.remap_endpoints(rows, mapping, ["t_num", "p_num"]).drop("t_num", "p_num")


@query(
    "g15_insert_curated",
    with_views("topics", "edges")
    + """
, c AS (SELECT DISTINCT 'mtc_' || l_partkey AS topic_id, 'mtc_' || (l_partkey + l_linenumber * l_linenumber - 9) AS prerequisite_id FROM lineitem)
SELECT c.topic_id, c.prerequisite_id, CASE WHEN t.id IS NULL OR p.id IS NULL THEN 'unknown-endpoint' WHEN c.topic_id = c.prerequisite_id THEN 'self'
  WHEN EXISTS (SELECT 1 FROM edges e WHERE e.topic_id = c.topic_id AND e.prerequisite_id = c.prerequisite_id) THEN 'duplicate'
  WHEN p.stage <> 'primary' THEN 'source-stage' WHEN t.stage <> 'junior' THEN 'target-stage' END AS skipped
FROM c LEFT JOIN topics t ON t.id = c.topic_id LEFT JOIN topics p ON p.id = c.prerequisite_id""",
)
def insert_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges.insert_curated(_curated(spark, sf_dir), src.edges(spark, sf_dir), src.topics(spark, sf_dir), "primary", "junior")


def _curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    lines = src.table(spark, sf_dir, "lineitem")
    # numbers are told apart before they are made texts, which are the same only where these are
    ends = lines.select(F.col("l_partkey").alias("t"), (F.col("l_partkey") + line * line - 9).alias("p")).distinct()
    return ends.select(F.concat(F.lit("mtc_"), "t").alias("topic_id"), F.concat(F.lit("mtc_"), "p").alias("prerequisite_id"))


@query("g15_rebroken_after_insert")
def rebroken_after_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated edges put into the graph that cycle breaking left, and what its second run removes."""
    cols = ["topic_id", "prerequisite_id", "strength", "reason"]
    existing = src.written(spark, sf_dir, "unbroken", lambda: broken_cycles(spark, sf_dir)[0].select(*cols))
    decided = edges.insert_curated(_curated(spark, sf_dir), existing, src.topics(spark, sf_dir), "primary", "junior")
    added = decided.withColumns({"strength": F.lit("soft"), "reason": F.lit("stage bridge")})
    removed = cycles.insert_and_break(existing, added, TEMPLATES)[1]
    return removed.select("topic_id", "prerequisite_id", "removed_reason")


@query(
    "t14_parallel_subfields",
    with_views("edges", "topics")
    + """
, f AS (SELECT id, CASE num % 4 WHEN 0 THEN '美术' WHEN 1 THEN '音乐' WHEN 2 THEN '体操' ELSE NULL END AS pre FROM topics)
SELECT e.topic_id, e.prerequisite_id, 'parallel subfields ' || b.pre || '↔' || a.pre AS removed_reason FROM edges e JOIN f a ON a.id = e.topic_id JOIN f b ON b.id = e.prerequisite_id
WHERE (a.pre = '美术' AND b.pre = '音乐') OR (a.pre = '音乐' AND b.pre = '美术')""",
)
def parallel_subfields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.col("num") % 4
    prefix = F.when(rest == 0, "美术·").when(rest == 1, "音乐·").when(rest == 2, "体操·").otherwise("")
    topics = src.topics(spark, sf_dir).select("id", F.concat(prefix, "name").alias("name"))
    removed = edges.drop_parallel_subfields(src.edges(spark, sf_dir), topics)[1]
    return removed.select("topic_id", "prerequisite_id", "removed_reason")


@query("d18_resume_position")
def resume_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    mastered, current = learner_state(spark, sf_dir)
    subject = src.topics(spark, sf_dir).select("id", "subject")
    learners = current.join(subject, "id").select("learner", "subject")
    return recommend.resume_position(topic_sequence(spark, sf_dir), mastered, learners)
