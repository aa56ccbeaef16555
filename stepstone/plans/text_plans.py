"""Text similarity, terminology, classification and task queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepstone.functions import columns as fn
from stepstone.operators import edges as edge_ops
from stepstone.operators import text as ops
from stepstone.plans.edge_plans import ORIGIN_SQL, with_origin
from stepstone.plans.merge_plans import published
from stepstone.plans.registry import query
from stepstone.sources import tables as src
from stepstone.sources.tables import with_views

NOISE_SQL = "'[\\s（）()·、,，。:：；;《》“”\"'']'"


def grams_sql(source: str, text: str, keep: str) -> str:
    """CTE body: ``keep`` columns and ``g``, the distinct bigrams of ``text``."""
    return f"""SELECT {keep}, list_distinct(list_transform(generate_series(1, len(c) - 1), lambda i: c[i] || c[i + 1])) AS g
  FROM (SELECT {keep}, string_split(regexp_replace({text}, {NOISE_SQL}, '', 'g'), '') AS c FROM {source}) z"""


COSINE = "CASE WHEN len({a}) * len({b}) > 0 THEN len(list_intersect({a}, {b})) / sqrt(len({a})::DOUBLE * len({b})) ELSE 0 END"

# topic text: the name and, where a document overlays the topic, its whole text
TEXT_SQL = """, full_text AS (SELECT t.id, t.name || coalesce(o.description, '') AS text FROM topics t LEFT JOIN overlay o ON o.id = t.id)"""


def topic_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    over = src.overlay(spark, sf_dir).select("id", "description")
    return src.topics(spark, sf_dir).join(over, "id", "left").withColumn(
        "text", F.concat("name", F.coalesce("description", F.lit("")))
    ).drop("description")


@query(
    "t1_bigrams",
    with_views("text_topics") + ", g AS (" + grams_sql("text_topics", "description", "id")
    + ") SELECT id, len(g) AS grams, md5(array_to_string(list_sort(g), '|')) AS digest FROM g",
)
def bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = src.text_topics(spark, sf_dir).select("id", fn.bigrams("description").alias("g"))
    return g.select("id", F.size("g").alias("grams"), F.md5(F.array_join(F.array_sort("g"), "|")).alias("digest"))


@query(
    "t2_pair_similarity",
    with_views("topics", "edges", "overlay") + TEXT_SQL + ", g AS (" + grams_sql("full_text", "text", "id")
    + f""") SELECT topic_id AS "left", prerequisite_id AS "right", round({COSINE.format(a='a.g', b='b.g')}, 6) AS score
FROM edges JOIN g a ON a.id = topic_id JOIN g b ON b.id = prerequisite_id""",
)
def pair_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ops.pair_similarity(ops.edge_pairs(src.edges(spark, sf_dir)), topic_text(spark, sf_dir).select("id", "text"))
    return scored.withColumn("score", F.round("score", 6))


STANDARDS_SQL = "['s' || (num % 211), 't' || (num % 97)]"


def candidate_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic_text(spark, sf_dir).withColumn(
        "standards",
        F.array(F.concat(F.lit("s"), F.col("num") % 211), F.concat(F.lit("t"), F.col("num") % 97)),
    )


@query(
    "t3_candidates",
    with_views("topics", "edges", "overlay") + TEXT_SQL + ", g AS (" + grams_sql("full_text", "text", "id")
    + f"""), w AS (SELECT t.*, g.g, {STANDARDS_SQL} AS std, CASE stage WHEN 'primary' THEN 0 WHEN 'junior' THEN 1 ELSE 2 END AS rk FROM topics t JOIN g ON g.id = t.id),
tg AS (SELECT * FROM w WHERE split_from IS NOT NULL AND status IS DISTINCT FROM 'covered'), op AS (SELECT * FROM w WHERE status IS DISTINCT FROM 'covered'),
vp AS (SELECT tg.id, tg.split_from FROM tg JOIN w p ON p.id = tg.split_from WHERE p.subject = tg.subject AND p.stage = tg.stage),
sim AS (SELECT a.id, b.id AS c, a.stage = b.stage AS same_stage, {COSINE.format(a='a.g', b='b.g')} AS score FROM tg a JOIN op b
  ON a.subject = b.subject AND a.domain = b.domain AND abs(a.rk - b.rk) <= 1 AND a.id <> b.id),
rk AS (SELECT *, row_number() OVER (PARTITION BY id, same_stage ORDER BY score DESC, c) AS rn FROM sim WHERE score > 0),
seed AS (SELECT s.* FROM (SELECT id, split_from AS c, 1.0::DOUBLE AS score, 'split-parent' AS source FROM vp
  UNION ALL SELECT vp.id, e.prerequisite_id, 1.0, 'parent-edge' FROM vp JOIN edges e ON e.topic_id = vp.split_from
  UNION ALL SELECT vp.id, e.topic_id, 1.0, 'parent-edge' FROM vp JOIN edges e ON e.prerequisite_id = vp.split_from
  UNION ALL SELECT a.id, b.id, 1.0, 'sibling' FROM tg a JOIN w b ON a.split_from = b.split_from AND a.subject = b.subject AND a.stage = b.stage
  UNION ALL SELECT id, c, score, CASE WHEN same_stage THEN 'local' ELSE 'cross-stage' END FROM rk WHERE rn <= CASE WHEN same_stage THEN 8 ELSE 4 END) s
  JOIN op ON op.id = s.c WHERE s.id <> s.c),
sd AS (SELECT DISTINCT id, c FROM seed),
hop AS (SELECT DISTINCT t.id, CASE WHEN p.c IS NOT NULL THEN e.topic_id ELSE e.prerequisite_id END AS c FROM edges e JOIN (SELECT DISTINCT id FROM sd) t ON TRUE
  LEFT JOIN sd d ON d.id = t.id AND d.c = e.topic_id LEFT JOIN sd p ON p.id = t.id AND p.c = e.prerequisite_id WHERE d.c IS NOT NULL OR p.c IS NOT NULL),
hs AS (SELECT h.id, h.c, b.subject = a.subject AS same, {COSINE.format(a='a.g', b='b.g')} AS score FROM hop h JOIN tg a ON a.id = h.id JOIN op b ON b.id = h.c
  WHERE h.id <> h.c AND (a.subject = b.subject OR a.stage = b.stage)),
hr AS (SELECT *, row_number() OVER (PARTITION BY id, same ORDER BY score DESC, c) AS rn FROM hs),
cs AS (SELECT a.id, b.id AS c, {COSINE.format(a='a.g', b='b.g')} AS score FROM tg a JOIN op b ON a.subject = b.subject AND a.id <> b.id AND len(list_intersect(a.std, b.std)) > 0),
cr AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, c) AS rn FROM cs),
every AS (SELECT * FROM seed UNION ALL SELECT id, c, score, CASE WHEN same THEN 'structural' ELSE 'cross-subject-structural' END FROM hr WHERE rn <= CASE WHEN same THEN 4 ELSE 2 END
  UNION ALL SELECT id, c, score, 'curriculum' FROM cr WHERE rn <= 4)
SELECT id, c AS candidate, round(max(score), 6) AS score, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM every GROUP BY 1, 2""",
)
def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = candidate_topics(spark, sf_dir)
    targets = topics.where("split_from IS NOT NULL AND status IS NULL")
    found = ops.build_candidates(targets, topics, src.edges(spark, sf_dir))
    return found.withColumn("score", F.round("score", 6))


@query(
    "t4_recall_topics",
    with_views("topics") + ", cl AS (SELECT conv_id || ':' || turn AS claim, text FROM conversations WHERE role = 'user'), q AS ("
    + grams_sql("cl", "text", "claim") + "), nm AS (SELECT DISTINCT name FROM topics), n AS (" + grams_sql("nm", "name", "name")
    + """), s AS (SELECT claim, name, len(list_intersect(q.g, n.g)) AS hit, len(q.g) AS qn, len(n.g) AS gn FROM q JOIN n ON TRUE),
f AS (SELECT s.claim, t.id, round(hit / greatest(qn, 2) + hit / (gn + 2), 9) AS score FROM s JOIN topics t ON t.name = s.name WHERE hit > 0)
SELECT * FROM (SELECT claim, id, score, row_number() OVER (PARTITION BY claim ORDER BY score DESC, id) AS rank FROM f) x WHERE rank <= 15""",
)
def recall_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = src.table(spark, sf_dir, "conversations").where("role = 'user'").select(
        F.concat_ws(":", "conv_id", "turn").alias("claim"), "text"
    )
    return ops.recall_topics(claims, src.topics(spark, sf_dir), fn.GRAM_NOISE)


@query(
    "t5_claim_matches",
    with_views("topics", "mastered")
    + """
, p AS (SELECT user_id AS claim, event_id AS ord, 'mtc_' || ((event_id * 7) % (SELECT max(num) + 1 FROM topics)) AS topic_id, CASE WHEN event_id % 6 = 0 THEN NULL ELSE least(value / 20, 1) END AS confidence FROM events),
k AS (SELECT claim, ord, topic_id, coalesce(confidence, 0.5) AS confidence FROM p WHERE topic_id IN (SELECT id FROM topics)),
r AS (SELECT *, row_number() OVER (PARTITION BY claim ORDER BY confidence DESC, ord) = 1 AS is_top FROM k)
SELECT claim, ord, topic_id, round(confidence, 6) AS confidence, is_top, is_top AND confidence >= 0.8
  AND NOT EXISTS (SELECT 1 FROM mastered m WHERE m.learner = claim AND m.topic_id = r.topic_id) AS auto_tick FROM r""",
)
def claim_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stepstone.plans.graph_plans import learner_state

    key = F.col("event_id")
    size = src.topics(spark, sf_dir).agg(F.max("num") + 1).first()[0]
    picks = src.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("claim"),
        key.alias("ord"),
        F.concat(F.lit("mtc_"), (key * 7) % size).alias("topic_id"),
        F.when(key % 6 != 0, F.least(F.col("value") / 20, F.lit(1.0))).alias("confidence"),
    )
    mastered = learner_state(spark, sf_dir)[0].withColumnRenamed("learner", "claim")
    found = ops.claim_matches(picks, src.topics(spark, sf_dir), mastered)
    return found.withColumn("confidence", F.round("confidence", 6))


# Words of the documents that the terminology queries treat as wrong, and their replacements.
TERM_RULES = (
    ("thereand", "there and"), ("tionhe", "tion he"), ("eauaux", "eau aux"), ("menter", "mentir"), ("queque", "quelque"),
    ("thethe", "the"), ("ingin", "in"), ("derder", "der"), ("ichich", "ich"), ("cioncion", "cion"), ("losde", "los de"),
    ("enleau", "en eau"), ("hahaha", "haha"), ("ndnd", "nd"), ("shsh", "sh"),
)
RULES_SQL = ", rules(ord, bad, good) AS (VALUES " + ", ".join(f"({i}, '{b}', '{g}')" for i, (b, g) in enumerate(TERM_RULES)) + ")"


@query(
    "t6_lint_terms",
    with_views("text_topics") + RULES_SQL
    + """
, lines AS (SELECT id, unnest(string_split(description, chr(10))) AS text, generate_subscripts(string_split(description, chr(10)), 1) - 1 AS index FROM text_topics),
parts AS (SELECT id, 'description' AS field, -1 AS index, description AS text FROM text_topics UNION ALL SELECT id, 'evidence', index, text FROM lines)
SELECT p.id, p.field, p.index, r.bad, r.good FROM parts p JOIN rules r ON contains(p.text, r.bad)""",
)
def lint_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.text_topics(spark, sf_dir).withColumn("evidence", F.split("description", "\n"))
    return ops.lint_terms(rows, ["description"], TERM_RULES, "evidence")


_FIXED = "description"
for _bad, _good in TERM_RULES:
    _FIXED = f"replace({_FIXED}, '{_bad}', '{_good}')"


@query(
    "t7_fix_terms",
    with_views("text_topics") + f" SELECT id, md5({_FIXED}) AS fixed_md5, {_FIXED} <> description AS changed FROM text_topics",
)
def fix_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = ops.fix_terms(src.text_topics(spark, sf_dir), "description", TERM_RULES)
    return fixed.select("id", F.md5("description").alias("fixed_md5"), (F.col("changes") > 0).alias("changed"))


# Frequent words of the documents standing in for term nouns.
DOCUMENT_NOUNS = ("inea", "nter", "ndst", "ontion", "pation")
# the same rule in the words of another regex dialect, which has \b but no look-around
WORD_SQL = "[a-zA-Z][-_''a-zA-Z0-9]+"
TERM_SQL = rf"(?i)\b({WORD_SQL}(?:\s+{WORD_SQL}){{0,3}}?\s+(?:inea|nter|ndst|ontion|pation))\b"


@query(
    "t8_discover_terms",
    with_views("text_topics")
    + f"""
, f AS (SELECT num, unnest(l) AS hit, generate_subscripts(l, 1) AS pos FROM (SELECT num, regexp_extract_all(description, '{TERM_SQL}', 1) AS l FROM text_topics) z),
n AS (SELECT num, pos, regexp_replace(hit, '\\s+', ' ', 'g') AS form FROM f)
SELECT lower(form) AS term, arg_min(form, num * 1000000 + pos) AS first_form, count(*) AS mentions FROM n WHERE lower(form) NOT IN ('the inea', 'of inea') GROUP BY 1""",
)
def discover_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.discover_terms(src.text_topics(spark, sf_dir), "description", ["The Inea", "of inea"], DOCUMENT_NOUNS)


GLOSSARY = (("the", "le"), ("inea", "in ea"), ("of the", "du"), ("les", "los"), ("und", "y"))
_GLOSSED = "replace('{{name}} ' || description, '{{name}}', '孩子X名X')"
_GLOSSED = f"regexp_replace({_GLOSSED}, '孩子X?名X?', '{{{{name}}}}', 'g')"
for _word, _good in GLOSSARY:
    _GLOSSED = f"regexp_replace({_GLOSSED}, '\\b{_word}\\b', '{_good}', 'gi')"


@query("t9_glossary_replace", with_views("text_topics") + f" SELECT id, md5({_GLOSSED}) AS text_md5 FROM text_topics")
def glossary_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    guarded = fn.guard_placeholder(F.concat(F.lit("{{name}} "), "description"))
    text = fn.whole_word_replace(fn.restore_placeholder(guarded), GLOSSARY)
    return src.text_topics(spark, sf_dir).select("id", F.md5(text).alias("text_md5"))


KEYWORDS = (
    ("en", "whou", "questions"), ("en", "thinin", "thinking"), ("en", "rest", "rest"), ("fr", "vili", "city"), ("fr", "eauier", "water"),
    ("fr", "pré", "field"), ("de", "ung", "noun"), ("es", "cion", "action"),
)
_CHAIN = "CASE " + " ".join(f"WHEN domain = '{b}' AND contains(description, '{k}') THEN '{t}'" for b, k, t in KEYWORDS) + " ELSE 'other ' || domain END"


@query("t10_reclassify", with_views("text_topics") + f" SELECT id, {_CHAIN} AS target FROM text_topics")
def reclassify(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.text_topics(spark, sf_dir)
    done = ops.reclassify(rows, "domain", F.col("description"), KEYWORDS, F.concat(F.lit("other "), "domain"))
    return done.select("id", "target")


SHAPES = ("{0}", "《{0}》", "读懂{0}", "{0}·雪", "{0}/李白", "区分{0}与{0}", "{0}和{0}的关系", "{0}与{0}", "《{0}》与读书方法")
_SHAPED = "CASE num % 9 " + " ".join(f"WHEN {i} THEN '" + s.replace("{0}", "' || name || '") + "'" for i, s in enumerate(SHAPES)) + " END"
SHAPED_SQL = f""", shaped AS (SELECT id, num, {_SHAPED} AS title, CASE num % 4 WHEN 0 THEN 'Reading Materials' WHEN 1 THEN 'Classical Poetry' WHEN 2 THEN 'Literary Reading' ELSE domain END AS dom,
  CASE WHEN num % 3 = 0 THEN 'PROCEDURAL' ELSE 'CONCEPTUAL' END AS kind, CASE WHEN num % 2 = 0 THEN 'Chinese' ELSE subject END AS subj, {ORIGIN_SQL} AS origin FROM topics)"""


def shaped_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics whose names carry title marks, verbs and conjunctions for the title classifiers."""
    title = F.lit(None).cast("string")
    for i, shape in enumerate(SHAPES):
        pieces = [x for part in shape.split("{0}") for x in (F.lit(part), F.col("name"))][:-1]
        title = F.when(F.col("num") % 9 == i, F.concat(*pieces)).otherwise(title)
    rest = F.col("num") % 4
    return with_origin(src.topics(spark, sf_dir)).select(
        "id", "origin", title.alias("title"),
        F.when(rest == 0, "Reading Materials").when(rest == 1, "Classical Poetry").when(rest == 2, "Literary Reading")
        .otherwise(F.col("domain")).alias("dom"),
        F.when(F.col("num") % 3 == 0, "PROCEDURAL").otherwise("CONCEPTUAL").alias("kind"),
        F.when(F.col("num") % 2 == 0, "Chinese").otherwise(F.col("subject")).alias("subj"),
    )


_VERBS = "|".join(ops.SKILL_VERBS)


@query(
    "t11_node_kind",
    with_views("topics") + SHAPED_SQL
    + f"""
SELECT id, title, CASE WHEN dom = 'Reading Materials' AND NOT regexp_matches(title, '{_VERBS}') THEN 'text' WHEN regexp_matches(title, '《[^》]+》') THEN 'text'
  WHEN regexp_matches(title, '.+/\\s*《') OR regexp_matches(title, '.+/\\s*[\\x{{4e00}}-\\x{{9fff}}]{{2,4}}$') THEN 'text'
  WHEN dom IN ('Reading Materials', 'Classical Poetry') AND regexp_matches(title, '·.{{1,4}}$') AND NOT regexp_matches(title, '{_VERBS}') THEN 'text'
  WHEN dom IN ('Classical Poetry', 'Literary Reading') AND NOT contains(title, '·') AND NOT regexp_matches(title, '{_VERBS}') THEN 'text'
  WHEN kind = 'PROCEDURAL' THEN 'skill' ELSE 'concept' END AS node_kind FROM shaped""",
)
def node_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shaped_topics(spark, sf_dir)
    return rows.select("id", "title", ops.node_kind(F.col("title"), F.col("dom"), F.col("kind")).alias("node_kind"))


# Patterns for the shapes of these titles.
TITLES, NO_TITLES, ONE_IDEA = ("《.+》",), "方法|读书", ("区分.{0,40}与", "的关系$")


@query(
    "t12_compound_class",
    with_views("topics") + SHAPED_SQL
    + f"""
SELECT id, title, CASE WHEN subj = 'Chinese' AND title LIKE '%《_%》%' AND (origin = 'textbook' OR NOT (contains(title, '方法') OR contains(title, '读书'))) THEN 'C'
  WHEN regexp_matches(title, '区分.{{0,40}}与') OR suffix(title, '的关系') THEN 'B' ELSE 'A' END AS class FROM shaped WHERE regexp_matches(title, '[和与]')""",
)
def compound_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shaped_topics(spark, sf_dir)
    label = ops.compound_class(F.col("title"), F.col("subj"), F.col("origin"), TITLES, NO_TITLES, ONE_IDEA)
    return rows.select("id", "title", label.alias("class")).where("class IS NOT NULL")


DIGEST = "CAST(sum(CAST('0x' || substr(md5({0}), 1, 15) AS HUGEINT)) AS VARCHAR)"


def _row(*cols: str) -> str:
    return " || '|' || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '~')" for c in cols)


TOPIC_ROW = _row("id", "name", "subject", "age_start", "split_from")
EDGE_ROW = _row("topic_id", "prerequisite_id", "strength", "review_status", "rescope_required")
PRINT_SQL = f"""SELECT 'topics' AS part, count(*) AS rows, {DIGEST.format(TOPIC_ROW)} AS digest FROM topics
UNION ALL SELECT 'edges', count(*), {DIGEST.format(EDGE_ROW)} FROM edges"""


def fingerprint_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.graph_fingerprint(
        src.topics(spark, sf_dir), src.edges(spark, sf_dir),
        ["id", "name", "subject", "age_start", "split_from"],
        ["topic_id", "prerequisite_id", "strength", "review_status", "rescope_required"],
    )


@query("t18_graph_fingerprint", with_views("topics", "edges") + PRINT_SQL)
def graph_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_now(spark, sf_dir)


@query(
    "t18_stale_work",
    with_views("topics", "edges") + f""", now AS ({PRINT_SQL}) SELECT subject AS bucket, part FROM (SELECT DISTINCT subject FROM topics) b JOIN now ON subject LIKE '%2'""",
)
def stale_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = fingerprint_now(spark, sf_dir)
    buckets = src.topics(spark, sf_dir).select(F.col("subject").alias("bucket")).distinct()
    old = F.col("bucket").endswith("2")
    works = buckets.select("bucket", F.explode(F.array(F.lit("topics"), F.lit("edges"))).alias("part")).join(now, "part")
    works = works.withColumn("digest", F.when(old, F.lit("0")).otherwise(F.col("digest"))).drop("rows")
    return ops.stale_work(works, now)


@query(
    "t19_task_payloads",
    with_views("topics")
    + """
, n AS (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY age_start, id) - 1 AS i, count(*) OVER (PARTITION BY subject) AS n FROM topics),
wr AS (SELECT subject, id, name, age_start, i, n, CAST(unnest(CASE WHEN n <= 30 THEN [0] ELSE list_filter(generate_series(0, i // 15), lambda x: i < x * 15 + 25) END) AS BIGINT) AS win FROM n)
SELECT subject, win AS window, 'Topics of ' || subject || chr(10) || string_agg(id || ' | ' || name || ' | ' || age_start, chr(10) ORDER BY i) AS payload, count(*) AS rows
FROM wr WHERE CASE WHEN n <= 30 THEN n ELSE least(25, n - win * 15) END >= 2 GROUP BY subject, win""",
)
def task_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.topics(spark, sf_dir).select("subject", "id", "name", "age_start")
    windows = edge_ops.row_windows(rows, ["subject"], ["age_start", "id"])
    line = F.concat_ws(" | ", "id", "name", F.col("age_start").cast("string"))
    return ops.task_payloads(windows, ["subject", "window"], ["pos"], line, F.concat(F.lit("Topics of "), "subject"))


@query(
    "t22_aligned_codes",
    with_views("topics")
    + """
, a AS (SELECT 'mtc_' || l_partkey AS id, l_orderkey * 10 + l_linenumber AS ord, 'K' || l_suppkey AS code, CASE WHEN l_quantity > 40 THEN 'high' WHEN l_quantity > 20 THEN 'medium' ELSE 'low' END AS confidence FROM lineitem),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord DESC, code DESC, confidence DESC) AS rn FROM a) x WHERE rn = 1)
SELECT t.id, CASE WHEN confidence <> 'low' THEN code END AS code, confidence FROM topics t LEFT JOIN l ON l.id = t.id""",
)
def aligned_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity, code = F.col("l_quantity"), F.concat(F.lit("K"), "l_suppkey")
    tier = F.when(quantity > 40, "high").when(quantity > 20, "medium").otherwise("low")
    # (order, line) is not unique in the table, so code and tier settle the last answer
    answers = src.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("mtc_"), "l_partkey").alias("id"),
        F.struct((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("o"), code.alias("c"), tier.alias("t")).alias("ord"),
        code.alias("code"),
        tier.alias("confidence"),
    )
    return ops.aligned_codes(answers, src.topics(spark, sf_dir))


@query(
    "t16_stable_uuid",
    with_views("pub_topics")
    + """
, h AS (SELECT id, sha1(unhex('4b6f5c55c9c64b2da5d8bf17f9b53e20') || CAST('item:' || id AS BLOB)) AS d FROM pub_topics)
SELECT id, d[1:8] || '-' || d[9:12] || '-5' || d[14:16] || '-' || CASE WHEN d[17] IN ('0','4','8','c') THEN '8' WHEN d[17] IN ('1','5','9','d') THEN '9' WHEN d[17] IN ('2','6','a','e') THEN 'a' ELSE 'b' END || d[18:20] || '-' || d[21:32] AS uuid FROM h""",
)
def stable_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = published(spark, sf_dir)[0]
    return nodes.select("id", fn.stable_uuid(F.concat(F.lit("item:"), "id")).alias("uuid"))


@query(
    "t17_edge_fingerprint",
    with_views("edges")
    + """
SELECT topic_id, prerequisite_id, sha256('{"prerequisite_id":"' || prerequisite_id || '","reason":"' || reason || '","review_status":"' || review_status || '","strength":"' || strength
  || '","topic_id":"' || topic_id || '"}') AS fingerprint FROM edges""",
)
def edge_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    print_ = fn.fingerprint("topic_id", "prerequisite_id", "strength", "reason", "review_status")
    return src.edges(spark, sf_dir).select("topic_id", "prerequisite_id", print_.alias("fingerprint"))


@query(
    "t21_conjunction_split",
    with_views("topics") + SHAPED_SQL
    + """
SELECT id, regexp_extract(title, '^(.+?)[与和](.+)$', 1) AS part_a, regexp_extract(title, '^(.+?)[与和](.+)$', 2) AS part_b FROM shaped WHERE regexp_matches(title, '^(.+?)[与和](.+)$')""",
)
def conjunction_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shaped_topics(spark, sf_dir)
    parts = [fn.conjunction_split("title", i).alias(f"part_{n}") for i, n in ((1, "a"), (2, "b"))]
    return rows.select("id", *parts).where("part_a <> ''")
