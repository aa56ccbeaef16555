"""Change queries: normalisation, splits, rescopes, migrations, decisions, parsing and diffs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepstone.operators import change, recommend
from stepstone.operators.edges import KEY
from stepstone.plans.registry import query
from stepstone.sources import tables as src
from stepstone.sources.tables import with_views

DOMAINS = {"ECONOMY": "STANDARD", "PROMO": "LARGE"}


@query(
    "d1_normalise_domains",
    with_views("topics")
    + """
SELECT id, CASE domain WHEN 'ECONOMY' THEN 'STANDARD' WHEN 'PROMO' THEN 'LARGE' ELSE domain END AS domain,
  CASE WHEN domain IN ('ECONOMY', 'PROMO') THEN domain END AS from_value FROM topics""",
)
def normalise_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change.normalise_domains(src.topics(spark, sf_dir), DOMAINS).select("id", "domain", "from_value")


@query(
    "d1_migrate_labels",
    with_views("topics")
    + """
, l AS (SELECT subject, domain, min(id) AS label FROM topics GROUP BY 1, 2),
m AS (SELECT *, CASE domain WHEN 'ECONOMY' THEN 'STANDARD' WHEN 'PROMO' THEN 'LARGE' ELSE domain END AS nd FROM l)
SELECT subject, nd AS domain, (list(label ORDER BY domain <> nd, domain))[1] AS label FROM m GROUP BY 1, 2""",
)
def migrate_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = src.topics(spark, sf_dir)
    labels = old.groupBy("subject", "domain").agg(F.min("id").alias("label"))
    return change.migrate_labels(labels, DOMAINS)


@query(
    "d2_split_by_mapping",
    with_views("topics")
    + """
, c AS (SELECT id, num, subject, CASE WHEN num % 6 = 0 THEN name || '和' || domain ELSE name END AS name FROM topics),
m AS (SELECT *, CASE WHEN num % 10 = 3 THEN 'first ' || num WHEN subject = 'Brand#3' AND contains(name, '和') THEN split_part(name, '和', 1) END AS a,
  CASE WHEN num % 10 = 3 THEN 'second ' || num WHEN subject = 'Brand#3' AND contains(name, '和') THEN split_part(name, '和', 2) END AS b FROM c)
SELECT id, coalesce(a, name) AS name, CASE WHEN a IS NOT NULL THEN 'a' END AS split_part, CAST(NULL AS VARCHAR) AS split_from FROM m
UNION ALL SELECT 'mtc_' || ((SELECT max(num) FROM topics) + row_number() OVER (ORDER BY num)), b, 'b', id FROM m WHERE b IS NOT NULL""",
)
def split_by_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    num = F.col("num")
    topics = src.topics(spark, sf_dir).select(
        "id", "num", "subject",
        F.when(num % 6 == 0, F.concat("name", F.lit("和"), "domain")).otherwise(F.col("name")).alias("name"),
        F.lit(None).cast("string").alias("split_from"),
    )
    mapping = topics.where(num % 10 == 3).select(
        "id", F.concat(F.lit("first "), "num").alias("part_a"), F.concat(F.lit("second "), "num").alias("part_b")
    )
    return change.split_by_mapping(topics, mapping, "Brand#3").select("id", "name", "split_part", "split_from")


@query(
    "d3_drop_fragments",
    with_views("topics") + " SELECT id, name FROM topics WHERE name NOT IN ('red widget', 'hot gear')",
)
def drop_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change.drop_fragments(src.topics(spark, sf_dir), ("red widget", "hot gear")).select("id", "name")


AUDIT_SQL = """, ch AS (SELECT id, num, name, unnest(generate_series(1, num % 7)) AS k FROM topics),
kids AS (SELECT id, k, CASE WHEN num % 11 = 0 AND k = 1 THEN 'red widget' ELSE 'Piece ' || k || ' of ' || name || ' ' || num END AS cname, 15 + (num * k) % 35 AS cmin FROM ch),
res AS (SELECT t.*, CASE WHEN num % 17 = 0 THEN 'split-45min' END AS gran, CASE num % 4 WHEN 0 THEN 'covered' WHEN 3 THEN 'ok' ELSE 'split' END AS verdict, 40 + num % 30 AS minutes,
  (SELECT count(*) FROM kids k WHERE k.id = t.id AND cmin > 45) AS bad_kids FROM topics t),
reason AS (SELECT id, verdict, CASE WHEN minutes <= 45 THEN 'parent-too-short' WHEN num % 7 NOT BETWEEN 2 AND 5 THEN 'children-count' WHEN bad_kids > 0 OR num % 13 = 0 THEN 'children-incomplete' END AS problem FROM res),
act AS (SELECT r.id, r.num, CASE WHEN r.verdict = 'covered' AND r.num % 8 = 0 AND r.num + 2 <= (SELECT max(num) FROM topics) THEN 'covered'
  WHEN r.verdict = 'split' AND gran IS NULL AND problem IS NULL AND NOT (r.num % 11 = 0 AND EXISTS (SELECT 1 FROM topics o WHERE o.name = 'red widget' AND o.id <> r.id)) THEN 'split' END AS action
  FROM res r JOIN reason USING (id))"""


def granular_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.topics(spark, sf_dir).withColumns(
        {
            "granularity": F.when(F.col("num") % 17 == 0, change.SPLIT_GRANULARITY),
            "covered_by": F.lit(None).cast("array<string>"),
        }
    )


def described_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics of which every column that an audit may touch is filled, touched or not."""
    num = F.col("num")
    return granular_topics(spark, sf_dir).withColumns(
        {
            "description": F.concat(F.lit("old "), "name"),
            "evidence": F.array(F.concat(F.lit("proof "), num), F.lit("more")),
            "assessment_prompt": F.concat(F.lit("ask "), num),
            "centrality": (num % 100) / 100,
            "covered_by": F.when(num % 5 == 0, F.array(F.lit("mtc_2"), F.lit("mtc_1"))),
        }
    )


def audit_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    num = F.col("num")

    def child(k: F.Column) -> F.Column:
        name = F.when((num % 11 == 0) & (k == 1), "red widget").otherwise(
            F.concat(F.lit("Piece "), k, F.lit(" of "), "name", F.lit(" "), num)
        )
        return F.struct(
            name.alias("name"),
            F.concat(F.lit("about "), k).alias("description"),
            (15 + (num * k) % 35).alias("minutes"),
            F.when(num % 13 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("shows "), k))).alias("evidence"),
        )

    # all children of an item, at most six
    kids = F.when(num % 7 > 0, F.transform(F.sequence(F.lit(1), (num % 7).cast("int")), child))
    near = [F.concat(F.lit("mtc_"), num + 1)]
    full = [*near, F.concat(F.lit("mtc_"), num + 2), F.col("id")]
    return src.topics(spark, sf_dir).select(
        "id",
        F.when(num % 4 == 0, "covered").when(num % 4 == 3, "ok").otherwise("split").alias("verdict"),
        (40 + num % 30).alias("minutes"),
        kids.alias("children"),
        F.when(num % 8 == 0, F.array(*full)).otherwise(F.array(*near)).alias("covered_by"),
    )


@query("d4_split_problems", with_views("topics") + AUDIT_SQL + " SELECT id, problem FROM reason WHERE verdict = 'split'")
def split_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = audit_input(spark, sf_dir).where("verdict = 'split'")
    return results.select("id", change.split_problem().alias("problem"))


@query(
    "d5_apply_audit",
    with_views("topics") + AUDIT_SQL
    + """
SELECT t.id, CASE WHEN a.action = 'split' THEN (SELECT cname FROM kids k WHERE k.id = t.id AND k.k = 1) ELSE t.name END AS name,
  CASE WHEN a.action = 'split' THEN 'about 1' ELSE 'old ' || t.name END AS description, CASE WHEN a.action = 'split' THEN 'shows 1' ELSE 'proof ' || t.num || ',more' END AS evidence,
  CASE WHEN a.action = 'split' THEN '让 {{name}} 展示：shows 1' ELSE 'ask ' || t.num END AS assessment_prompt, CASE WHEN a.action IS DISTINCT FROM 'split' THEN (t.num % 100) / 100.0::DOUBLE END AS centrality,
  t.subject, t.node_kind,
  CASE WHEN a.action = 'split' THEN NULL WHEN a.action = 'covered' THEN 'covered' ELSE t.status END AS status,
  CASE WHEN a.action = 'split' THEN 'split-45min' WHEN t.num % 17 = 0 THEN 'split-45min' END AS granularity, t.split_from,
  CASE WHEN a.action = 'covered' THEN array_to_string(list_sort(['mtc_' || (t.num + 1), 'mtc_' || (t.num + 2)]), ',')
    WHEN a.action IS DISTINCT FROM 'split' AND t.num % 5 = 0 THEN 'mtc_2,mtc_1' END AS covered_by FROM topics t JOIN act a USING (id)
UNION ALL SELECT 'mtc_' || ((SELECT max(num) FROM topics) + row_number() OVER (ORDER BY k.id, k.k)), cname,
  'about ' || k.k, 'shows ' || k.k, '让 {{name}} 展示：shows ' || k.k, NULL, p.subject, p.node_kind, NULL, 'split-45min', k.id, NULL
  FROM kids k JOIN act a ON a.id = k.id JOIN topics p ON p.id = k.id WHERE a.action = 'split' AND k.k > 1""",
)
def apply_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = described_topics(spark, sf_dir)
    actions = change.audit_actions(audit_input(spark, sf_dir), topics)
    done = change.apply_audit(topics, actions)
    lists = [F.array_join(c, ",").alias(c) for c in ("evidence", "covered_by")]
    texts = "id name description assessment_prompt centrality subject node_kind status granularity split_from".split()
    return done.select(*texts, *lists)


@query(
    "d6_rescope_edges",
    with_views("topics", "edges") + AUDIT_SQL
    + """
, s AS (SELECT id FROM act WHERE action = 'split'), e AS (SELECT *, topic_id IN (SELECT id FROM s) OR prerequisite_id IN (SELECT id FROM s) AS hit FROM edges)
SELECT topic_id, prerequisite_id, CASE WHEN hit THEN 'machine' ELSE review_status END AS review_status, CASE WHEN hit THEN TRUE ELSE rescope_required END AS rescope_required,
  CASE WHEN hit AND review_status = 'reviewed' THEN 'reviewed' END AS previous_review_status, CASE WHEN hit THEN 'batch-7' END AS rescope_batch_id FROM e""",
)
def rescope_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions = change.audit_actions(audit_input(spark, sf_dir), granular_topics(spark, sf_dir))
    done = change.rescope(src.edges(spark, sf_dir), actions.where("action = 'split'"), "batch-7")
    return done.select(*KEY, "review_status", "rescope_required", "previous_review_status", "rescope_batch_id")


MIGRATE_SQL = """, rp AS (SELECT DISTINCT split_from AS id FROM topics WHERE split_from IS NOT NULL AND CAST(substr(split_from, 5) AS BIGINT) % 17 = 0),
mv AS (SELECT e.*, t_num + p_num AS position, e.topic_id IN (SELECT id FROM rp) OR e.prerequisite_id IN (SELECT id FROM rp) AS hit FROM edges e),
mg AS (SELECT mv.topic_id, mv.prerequisite_id, mv.review_status AS old_status, CASE WHEN hit THEN 'machine' ELSE review_status END AS review_status, hit OR rescope_required AS rescope_required,
  (CASE WHEN hit THEN 'machine' ELSE review_status END) = 'machine' AND a.stage = b.stage AND b.age_start > a.age_start AS age_regression,
  CASE WHEN position >= 1500 AND (CASE WHEN hit THEN 'machine' ELSE review_status END) = 'machine' THEN 'historical' END AS generation_batch_id
  FROM mv JOIN topics a ON a.id = mv.topic_id JOIN topics b ON b.id = mv.prerequisite_id)"""


def _migrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = src.edges(spark, sf_dir).withColumn("position", F.col("t_num") + F.col("p_num"))
    return change.safety_migration(granular_topics(spark, sf_dir), edges, "rescope-1", "historical", 1500)


@query(
    "d7_safety_migration",
    with_views("topics", "edges") + MIGRATE_SQL + " SELECT topic_id, prerequisite_id, review_status, rescope_required, age_regression, generation_batch_id FROM mg",
)
def safety_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _migrated(spark, sf_dir).select(*KEY, "review_status", "rescope_required", "age_regression", "generation_batch_id")


@query(
    "a24_migration_stats",
    with_views("topics", "edges") + MIGRATE_SQL
    + """ SELECT count(*) FILTER (WHERE old_status = 'reviewed' AND review_status = 'machine') AS demoted_reviewed, count(*) FILTER (WHERE rescope_required) AS rescoped,
  count(*) FILTER (WHERE age_regression) AS age_regressions, count(*) AS edges FROM mg""",
)
def migration_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stepstone.operators.stats import migration_stats as measured

    return measured(src.edges(spark, sf_dir), _migrated(spark, sf_dir))


PROV_SQL = """, pv AS (SELECT *, p_num % 2 = 0 AS is_bridge, CASE WHEN t_num % 5 = 0 THEN 'model-consensus' WHEN t_num % 31 = 0 THEN 'stranger' END AS reviewed_by,
  CASE WHEN t_num % 7 = 0 THEN 'human' WHEN t_num % 37 = 0 THEN 'upstream' END AS prov FROM edges),
pe AS (SELECT *, CASE WHEN review_status = 'machine' THEN CASE WHEN prov IS NOT NULL THEN 'machine-with-provenance' END
  WHEN prov IS NOT NULL THEN CASE WHEN prov = 'upstream' THEN 'unknown-provenance' END
  WHEN reviewed_by = 'stranger' THEN 'unknown-reviewer' WHEN reviewed_by IS NULL AND review_status = 'rejected' THEN 'rejected-without-reviewer' END AS error FROM pv),
pb AS (SELECT *, CASE WHEN error IS NOT NULL THEN NULL WHEN review_status = 'machine' THEN 'machine' WHEN prov IS NOT NULL THEN 'already-stamped'
  WHEN reviewed_by IS NOT NULL THEN 'ai-consensus' WHEN is_bridge THEN 'human' ELSE 'rule' END AS bucket FROM pe)"""


@query(
    "d8_provenance_migration",
    with_views("edges") + PROV_SQL
    + """
SELECT topic_id, prerequisite_id, error, bucket, coalesce(prov, CASE WHEN bucket IN ('ai-consensus', 'human', 'rule') THEN bucket END) AS review_provenance,
  CASE WHEN bucket = 'human' THEN 'curation' ELSE reviewed_by END AS reviewed_by, CASE WHEN bucket = 'human' THEN 'curator' END AS reviewer_role FROM pb""",
)
def provenance_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, none = F.col("t_num"), F.lit(None).cast("string")
    edges = src.edges(spark, sf_dir).withColumns(
        {
            "is_bridge": F.col("p_num") % 2 == 0,
            "reviewed_by": F.when(t % 5 == 0, "model-consensus").when(t % 31 == 0, "stranger"),
            "review_provenance": F.when(t % 7 == 0, "human").when(t % 37 == 0, "upstream"),
            "reviewer_role": none,
            "reviewed_at": none,
        }
    )
    done = change.provenance_migration(edges, "model-consensus", "curation", "2000-01-01T00:00:00Z")
    return done.select(*KEY, "error", "bucket", "review_provenance", "reviewed_by", "reviewer_role")


DECISION_SQL = """, dc AS (SELECT 'mtc_' || l_partkey AS topic_id, l_orderkey, l_linenumber, l_suppkey,
  CASE l_returnflag WHEN 'A' THEN 'reviewed' WHEN 'R' THEN 'rejected' ELSE 'maybe' END AS status, CASE WHEN l_linenumber = 7 THEN ' ' ELSE 'r' || l_suppkey END AS reviewer,
  CASE WHEN l_suppkey % 9 = 0 THEN 'ai-consensus' END AS prov, CASE WHEN l_suppkey % 8 = 0 THEN 'consensus/x' END AS ref FROM lineitem),
good AS (SELECT * FROM dc WHERE status <> 'maybe' AND trim(reviewer) <> '' AND prov IS NULL AND ref IS NULL),
ed AS (SELECT e.topic_id, e.prerequisite_id, g.status, g.reviewer, row_number() OVER (PARTITION BY e.topic_id, e.prerequisite_id ORDER BY l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, g.status DESC) AS rn
  FROM edges e JOIN good g ON g.topic_id = e.topic_id)"""


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, supplier = F.col("l_returnflag"), F.col("l_suppkey")
    lines = src.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("mtc_"), "l_partkey").alias("topic_id"),
        F.when(flag == "A", "reviewed").when(flag == "R", "rejected").otherwise("maybe").alias("status"),
        F.when(F.col("l_linenumber") == 7, " ").otherwise(F.concat(F.lit("r"), supplier)).alias("reviewer"),
        F.when(supplier % 9 == 0, "ai-consensus").alias("provenance"),
        F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("note"),
        F.when(supplier % 8 == 0, "consensus/x").alias("evidence_ref"),
        "l_orderkey", "l_linenumber", "l_suppkey",
    )
    lines = lines.withColumn("at", F.struct("l_orderkey", "l_linenumber", "l_suppkey", "status"))
    return src.edges(spark, sf_dir).select(*KEY).join(lines, "topic_id")


@query(
    "d9_review_edges",
    with_views("edges") + DECISION_SQL
    + """
SELECT e.topic_id, e.prerequisite_id, coalesce(d.status, e.review_status) AS review_status, d.reviewer AS reviewed_by, CASE WHEN d.status IS NOT NULL THEN 'human' END AS review_provenance,
  CASE WHEN d.status IS NOT NULL THEN 'curator' END AS reviewer_role, CASE WHEN d.status IS NULL THEN e.rescope_required END AS rescope_required
FROM edges e LEFT JOIN (SELECT * FROM ed WHERE rn = 1) d ON d.topic_id = e.topic_id AND d.prerequisite_id = e.prerequisite_id""",
)
def review_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = change.review_edges(src.edges(spark, sf_dir), _decisions(spark, sf_dir))
    return done.select(*KEY, "review_status", "reviewed_by", "review_provenance", "reviewer_role", "rescope_required")


@query(
    "d9_refused_decisions",
    DECISION_SQL.replace(", dc AS", "WITH dc AS", 1).split(",\ngood AS")[0]
    + """
SELECT why, count(*) AS n FROM (SELECT CASE WHEN status = 'maybe' THEN 'bad-status' WHEN trim(reviewer) = '' THEN 'no-reviewer' WHEN prov IS NOT NULL THEN 'bad-provenance'
  WHEN ref IS NOT NULL THEN 'consensus-evidence' END AS why FROM dc) x WHERE why IS NOT NULL GROUP BY 1""",
)
def refused_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = src.table(spark, sf_dir, "lineitem")
    flag, supplier = F.col("l_returnflag"), F.col("l_suppkey")
    rows = lines.select(
        F.when(flag == "A", "reviewed").when(flag == "R", "rejected").otherwise("maybe").alias("status"),
        F.when(F.col("l_linenumber") == 7, " ").otherwise(F.concat(F.lit("r"), supplier)).alias("reviewer"),
        F.when(supplier % 9 == 0, "ai-consensus").alias("provenance"),
        F.when(supplier % 8 == 0, "consensus/x").alias("evidence_ref"),
    )
    why = change.decision_problem("consensus/")
    return rows.select(why.alias("why")).where("why IS NOT NULL").groupBy("why").agg(F.count("*").alias("n"))


TARGET_SQL = """, rp AS (SELECT DISTINCT split_from AS id FROM topics WHERE split_from IS NOT NULL AND CAST(substr(split_from, 5) AS BIGINT) % 17 = 0),
ends AS (SELECT topic_id AS id, rescope_required AS r FROM edges UNION ALL SELECT prerequisite_id, rescope_required FROM edges),
tgt AS (SELECT id, subject, stage FROM topics t WHERE status IS DISTINCT FROM 'covered' AND ((split_from IS NOT NULL AND id NOT IN (SELECT id FROM ends))
  OR (id IN (SELECT id FROM ends WHERE r) AND id IN (SELECT id FROM rp))))"""


@query("d10_relation_targets", with_views("topics", "edges") + TARGET_SQL + " SELECT id, subject, stage FROM tgt")
def relation_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = change.relation_targets(granular_topics(spark, sf_dir), src.edges(spark, sf_dir))
    return found.select("id", "subject", "stage")


@query(
    "d11_missing_targets",
    with_views("topics", "edges") + TARGET_SQL + " SELECT id FROM tgt WHERE CAST(substr(id, 5) AS BIGINT) % 3 <> 0",
)
def missing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = change.relation_targets(granular_topics(spark, sf_dir), src.edges(spark, sf_dir))
    return change.missing_targets(expected, src.topics(spark, sf_dir).where("num % 3 = 0"))


@query(
    "d11_own_proposals",
    with_views("edges")
    + """
SELECT * FROM (SELECT CASE WHEN t_num % 3 = 0 THEN topic_id WHEN t_num % 3 = 1 THEN prerequisite_id ELSE 'mtc_other' END AS id, topic_id, prerequisite_id FROM edges) x WHERE id <> 'mtc_other'""",
)
def own_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.col("t_num") % 3
    work = src.edges(spark, sf_dir).select(
        F.when(rest == 0, F.col("topic_id")).when(rest == 1, F.col("prerequisite_id")).otherwise("mtc_other").alias("id"), *KEY
    )
    return change.own_proposals(work)


RELATION_SQL = """, rl AS (SELECT topic_id, CASE WHEN p_num % 23 = 0 THEN prerequisite_id || 'x' ELSE prerequisite_id END AS prerequisite_id, CASE p_num % 4 WHEN 0 THEN 'related' WHEN 3 THEN 'none' ELSE 'prerequisite' END AS type,
  (p_num % 10) / 10 AS confidence, t_num, p_num, row_number() OVER (PARTITION BY topic_id, p_num // 500 ORDER BY p_num) AS rn, count(*) OVER (PARTITION BY topic_id, p_num // 500) AS n FROM edges),
kept AS (SELECT * FROM rl WHERE NOT (t_num % 6 = 1 AND rn = n))"""


def _slice() -> F.Column:
    return F.floor(F.col("p_num") / 500)


def relation_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON answer per topic over its prerequisites: every third fenced, some cut off in the last object."""
    p = F.col("p_num")
    relation = F.struct(
        F.col("p_num").alias("o"),
        F.struct(
            F.col("topic_id").alias("topicId"),
            F.when(p % 23 == 0, F.concat("prerequisite_id", F.lit("x"))).otherwise(F.col("prerequisite_id")).alias("prerequisiteId"),
            F.when(p % 4 == 0, "related").when(p % 4 == 3, "none").otherwise("prerequisite").alias("type"),
            F.lit("soft").alias("strength"),
            ((p % 10) / 10).alias("confidence"),
            F.lit("because").alias("reason"),
        ).alias("r"),
    )
    # an answer covers one topic and one slice of part numbers, so it holds at most 500 relations
    answers = src.edges(spark, sf_dir).groupBy("topic_id", "t_num", _slice().alias("slice")).agg(F.array_sort(F.collect_list(relation)).alias("x"))
    body = F.to_json(F.struct(F.transform("x", lambda e: e["r"]).alias("relations")))
    text = F.when(F.col("t_num") % 3 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(
        F.col("t_num") % 6 == 1, F.substring(body, F.lit(1), F.length(body) - 20)
    ).otherwise(body)
    return answers.select(F.concat_ws(":", "topic_id", "slice").alias("task"), text.alias("content"))


@query(
    "d12_parse_relations",
    with_views("edges", "topics") + RELATION_SQL
    + """
SELECT topic_id || ':' || (p_num // 500) AS task, topic_id, prerequisite_id, class, why FROM (SELECT topic_id, prerequisite_id, type, p_num,
  CASE WHEN p_num % 23 = 0 THEN 'rejected' WHEN type = 'related' THEN 'related' WHEN type = 'prerequisite' THEN CASE WHEN confidence >= 0.8 THEN 'prerequisite' ELSE 'rejected' END END AS class,
  CASE WHEN p_num % 23 = 0 THEN 'outside-candidates' WHEN type = 'prerequisite' AND confidence < 0.8 THEN 'low-confidence-or-invalid' END AS why FROM kept) x WHERE class IS NOT NULL
UNION ALL SELECT topic_id || ':' || (p_num // 500), NULL, NULL, 'rejected', 'invalid-json' FROM rl WHERE t_num % 6 = 1 AND n = 1""",
)
def parse_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    allowed = src.edges(spark, sf_dir).select(F.concat_ws(":", "topic_id", _slice()).alias("task"), *KEY)
    return change.parse_relations(relation_responses(spark, sf_dir), allowed, src.topics(spark, sf_dir))


@query(
    "d13_sync_diff",
    with_views("topics", "overlay")
    + """
, u AS (SELECT id, 1 + num % 3 AS n FROM topics), z AS (SELECT id, CASE WHEN lang = 'en' THEN 1 + num % 3 ELSE 2 END AS n FROM overlay)
SELECT coalesce(u.id, z.id) AS id, CASE WHEN z.id IS NULL THEN 'pending' WHEN u.id IS NULL THEN 'orphaned' ELSE 'item-drift' END AS state
FROM u FULL JOIN z ON u.id = z.id WHERE u.id IS NULL OR z.id IS NULL OR u.n <> z.n""",
)
def sync_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = (1 + F.col("num") % 3).cast("int")
    up = src.topics(spark, sf_dir).select("id", F.array_repeat(F.lit("x"), count).alias("evidence"))
    zh = src.overlay(spark, sf_dir).select(
        "id", F.array_repeat(F.lit("y"), F.when(F.col("lang") == "en", count).otherwise(2)).alias("evidence")
    )
    return change.sync_diff(up, zh)


@query(
    "d14_merge_translations",
    with_views("topics", "overlay")
    + """
, n AS (SELECT id, 'new ' || name AS name FROM topics WHERE num % 2 = 0)
SELECT coalesce(t.id, o.id) AS id, CASE WHEN t.id IS NULL OR o.translation_status = 'reviewed' THEN o.name ELSE coalesce(n.name, o.name) END AS name,
  CASE WHEN t.id IS NULL OR o.translation_status = 'reviewed' THEN o.translation_status WHEN n.id IS NOT NULL THEN 'machine' ELSE o.translation_status END AS translation_status, t.id IS NULL AS orphaned
FROM topics t FULL JOIN overlay o ON o.id = t.id LEFT JOIN n ON n.id = coalesce(t.id, o.id) WHERE o.id IS NOT NULL OR n.id IS NOT NULL""",
)
def merge_translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = src.topics(spark, sf_dir)
    progress = topics.where("num % 2 = 0").select(
        "id", F.concat(F.lit("new "), "name").alias("name"), F.lit("machine").alias("translation_status")
    )
    return change.merge_translations(topics, src.overlay(spark, sf_dir), progress)


@query(
    "d14_merge_edge_translations",
    with_views("edges")
    + """
SELECT topic_id, prerequisite_id, strength, CASE WHEN p_num % 4 = 0 THEN 'new ' || p_num WHEN p_num % 3 = 0 THEN 'old ' || p_num ELSE reason END AS reason FROM edges""",
)
def merge_edge_translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = src.edges(spark, sf_dir)
    new = edges.where("p_num % 4 = 0").select(*KEY, F.concat(F.lit("new "), "p_num").alias("reason"))
    old = edges.where("p_num % 3 = 0").select(*KEY, F.concat(F.lit("old "), "p_num").alias("reason"))
    return change.merge_edge_translations(edges, old, new)


@query(
    "d15_pending_rows",
    with_views("topics", "overlay")
    + """
SELECT t.id, t.subject, t.stage FROM topics t LEFT JOIN overlay o ON o.id = t.id WHERE o.translation_status IS DISTINCT FROM 'reviewed' AND t.num % 17 <> 0 AND t.stage <> 'primary'
  AND t.id NOT IN (SELECT topic_id FROM (SELECT 'mtc_' || l_partkey AS topic_id FROM lineitem WHERE l_quantity = 50) x)""",
)
def pending_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = src.overlay(spark, sf_dir).select("id", "translation_status")
    topics = granular_topics(spark, sf_dir).join(status, "id", "left")
    done = src.table(spark, sf_dir, "lineitem").where("l_quantity = 50").select(F.concat(F.lit("mtc_"), "l_partkey").alias("id"))
    return change.pending_rows(topics, done).select("id", "subject", "stage")


@query(
    "d16_learner_state",
    with_views("decisions")
    + " SELECT learner, topic_id, arg_max(decision, event_id) AS decision FROM decisions WHERE decision <> 'visit' GROUP BY 1, 2",
)
def learner_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.fold_decisions(src.decisions(spark, sf_dir))


@query(
    "d16_toggles",
    with_views("decisions")
    + """
, d AS (SELECT learner, 't' || (event_id % 20) AS topic_id, event_id, CASE WHEN decision = 'visit' THEN 'toggle' ELSE decision END AS decision FROM decisions),
b AS (SELECT learner, topic_id, max(event_id) AS last_set, arg_max(decision, event_id) AS base FROM d WHERE decision <> 'toggle' GROUP BY 1, 2)
SELECT d.learner, d.topic_id, (CASE WHEN any_value(b.base) = 'mastered' THEN 1 ELSE 0 END + count(*) FILTER (WHERE d.decision = 'toggle' AND (b.last_set IS NULL OR d.event_id > b.last_set))) % 2 = 1 AS mastered
FROM d LEFT JOIN b ON b.learner = d.learner AND b.topic_id = d.topic_id GROUP BY 1, 2""",
)
def toggles(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = src.decisions(spark, sf_dir).withColumns(
        {
            "topic_id": F.concat(F.lit("t"), F.col("event_id") % 20),
            "decision": F.when(F.col("decision") == "visit", "toggle").otherwise(F.col("decision")),
        }
    )
    return recommend.fold_toggles(log)


@query(
    "d16_undo_last",
    with_views("decisions")
    + """
, s AS (SELECT * FROM decisions WHERE decision <> 'visit'), l AS (SELECT learner, max(event_id) AS last_event FROM s GROUP BY 1)
SELECT s.learner, s.topic_id, arg_max(s.decision, s.event_id) AS decision FROM s JOIN l ON l.learner = s.learner WHERE s.event_id < l.last_event GROUP BY 1, 2""",
)
def undo_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.undo_last(src.decisions(spark, sf_dir))


@query(
    "d17_merge_profiles",
    """
WITH m AS (SELECT user_id AS learner, event_id AS seq, CASE event_id % 4 WHEN 0 THEN 'age' WHEN 1 THEN 'grade' WHEN 2 THEN 'region' ELSE 'interests' END AS field,
  CASE WHEN event_id % 9 = 0 THEN '' ELSE event_type END AS value FROM events WHERE event_id % 10 <> 0)
SELECT learner, field, arg_max(value, seq) AS value, 0::BIGINT AS place FROM m WHERE value <> '' AND field <> 'interests' GROUP BY 1, 2
UNION ALL SELECT learner, field, value, min(seq) FROM m WHERE value <> '' AND field = 'interests' GROUP BY 1, 2, 3""",
)
def merge_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    memory = src.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("learner"),
        key.alias("seq"),
        F.when(key % 4 == 0, "age").when(key % 4 == 1, "grade").when(key % 4 == 2, "region").otherwise("interests").alias("field"),
        F.when(key % 10 == 0, None).when(key % 9 == 0, "").otherwise(F.col("event_type")).alias("value"),
    )
    return recommend.merge_profiles(memory)


