"""Merge, projection, filter and lookup queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepstone.functions.columns import reviewer_label
from stepstone.operators import lookup, merge
from stepstone.plans.registry import query
from stepstone.sources import tables as src
from stepstone.sources.tables import with_views

DIMENSIONS = (
    lookup.Dimension("all"),
    lookup.Dimension(
        "primary",
        whitelist=True,
        include=("Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5"),
        exclude_domains={"Brand#6": ("ECONOMY", "SMALL"), "Brand#7": ("LARGE",)},
    ),
    lookup.Dimension("junior", whitelist=True, stage="junior"),
    lookup.Dimension("senior", whitelist=True, stage="senior"),
)
SUBJECT_LABELS = {"Brand#1": "First", "Brand#2": "Second"}
DOMAIN_LABELS = {"Brand#1 / SMALL": "First small", "Brand#3 / LARGE": "Third large"}

DIM_ROWS = """
SELECT t.*, d.dimension, CASE d.dimension
    WHEN 'all' THEN NOT local_origin
    WHEN 'primary' THEN CASE WHEN local_origin THEN stage IS NULL OR stage = 'primary'
      ELSE subject IN ('Brand#1','Brand#2','Brand#3','Brand#4','Brand#5')
        OR (subject = 'Brand#6' AND domain NOT IN ('ECONOMY','SMALL')) OR (subject = 'Brand#7' AND domain <> 'LARGE') END
    ELSE local_origin AND stage IS NOT DISTINCT FROM d.dimension END AS visible
  FROM located t CROSS JOIN (VALUES ('all'), ('primary'), ('junior'), ('senior')) d(dimension)"""
LOCATED = "located AS (SELECT *, num % 2 = 1 AS local_origin, num % 3 = 0 AS translated FROM topics)"
DIMS = f"{LOCATED}, dims AS ({DIM_ROWS})"


def located_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.topics(spark, sf_dir).withColumns(
        {"local_origin": F.col("num") % 2 == 1, "translated": F.col("num") % 3 == 0}
    )


def published(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    nodes, kept = merge.published_graph(src.topics(spark, sf_dir), src.edges(spark, sf_dir))
    return nodes, src.written(spark, sf_dir, "published_edges", lambda: kept)


@query(
    "m1_overlay_merge",
    with_views("topics", "overlay")
    + """
SELECT coalesce(t.id, o.id) AS id, CASE WHEN o.id IS NULL THEN t.name ELSE o.name END AS name,
  md5(o.description) AS description_md5, t.subject AS subject, t.age_start AS age_start,
  CASE WHEN o.id IS NULL THEN 'untranslated' ELSE o.translation_status END AS translation_status,
  o.id IS NOT NULL AS translated, t.id IS NULL AS orphaned, FALSE AS local_origin
FROM topics t FULL JOIN overlay o ON t.id = o.id
UNION ALL SELECT 'loc_' || s_suppkey, s_name, NULL, 'supplier', NULL, 'local-origin', TRUE, FALSE, TRUE FROM supplier""",
)
def overlay_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = src.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("loc_"), "s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.lit("supplier").alias("subject"),
    )
    merged = merge.merge_topics(
        src.topics(spark, sf_dir), src.overlay(spark, sf_dir), local
    )
    return merged.select(
        "id", "name", F.md5("description").alias("description_md5"), "subject", "age_start",
        "translation_status", "translated", "orphaned", "local_origin",
    )


@query(
    "m2_edge_overlay_merge",
    with_views("edges")
    + """
, up AS (SELECT * FROM edges WHERE t_num % 2 = 0), own AS (SELECT * FROM edges WHERE t_num % 2 = 1),
zh AS (SELECT topic_id, prerequisite_id, CASE WHEN p_num % 3 = 0 THEN NULL WHEN p_num % 3 = 1 THEN '' ELSE 'text ' || p_num END AS reason
  FROM up WHERE p_num % 5 <> 0)
SELECT up.topic_id, up.prerequisite_id, CASE WHEN zh.topic_id IS NOT NULL THEN zh.reason ELSE up.reason END AS reason,
  'reviewed' AS review_status, 'upstream' AS review_provenance
FROM up LEFT JOIN zh ON up.topic_id = zh.topic_id AND up.prerequisite_id = zh.prerequisite_id
UNION ALL SELECT topic_id, prerequisite_id, reason, review_status, NULL FROM own""",
)
def edge_overlay_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = src.edges(spark, sf_dir)
    up, own = edges.where("t_num % 2 = 0"), edges.where("t_num % 2 = 1")
    zh = up.where("p_num % 5 <> 0").select(
        "topic_id",
        "prerequisite_id",
        F.when(F.col("p_num") % 3 == 0, None)
        .when(F.col("p_num") % 3 == 1, "")
        .otherwise(F.concat(F.lit("text "), "p_num"))
        .alias("reason"),
    )
    return merge.merge_edges(up, zh, own).select(
        "topic_id", "prerequisite_id", "reason", "review_status", "review_provenance"
    )


CLUSTER_SQL = with_views("topics") + """
, up AS (SELECT subject, domain, age_start, count(*) || ' topics' AS summary FROM topics GROUP BY ALL),
zh AS (SELECT p_brand AS subject, p_type AS domain, p_size AS age_start, max(p_name) AS summary FROM part WHERE p_partkey % 3 = 0 GROUP BY ALL)"""


def _clusters(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    topics, keys = src.topics(spark, sf_dir), ["subject", "domain", "age_start"]
    up = topics.groupBy(*keys).agg(F.concat(F.count("*"), F.lit(" topics")).alias("summary"))
    zh = topics.where("num % 3 = 0").groupBy(*keys).agg(F.max("name").alias("summary"))
    return up, zh


@query(
    "m3_cluster_overlay",
    CLUSTER_SQL
    + """
SELECT up.subject, up.domain, up.age_start, coalesce(zh.summary, up.summary) AS summary, zh.subject IS NOT NULL AS translated
FROM up LEFT JOIN zh USING (subject, domain, age_start)""",
)
def cluster_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    up, zh = _clusters(spark, sf_dir)
    return merge.merge_clusters(up, zh, ["subject", "domain", "age_start"])


@query(
    "m3_cluster_build",
    CLUSTER_SQL
    + """
SELECT up.subject, up.domain, up.age_start, coalesce(zh.summary, 'generated ' || up.summary) AS summary,
  CASE WHEN zh.subject IS NOT NULL THEN 'existing' ELSE 'generated' END AS text_source
FROM up LEFT JOIN zh USING (subject, domain, age_start)""",
)
def cluster_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    up, zh = _clusters(spark, sf_dir)
    orphan = zh.withColumn("subject", F.concat(F.lit("gone "), "subject"))
    made = up.withColumn("summary", F.concat(F.lit("generated "), "summary"))
    return merge.build_clusters(up, zh.unionByName(orphan), made, ["subject", "domain", "age_start"])


@query(
    "m4_label_topics",
    with_views("topics")
    + """
SELECT id, CASE subject WHEN 'Brand#1' THEN 'First' WHEN 'Brand#2' THEN 'Second' ELSE subject END AS subject_label,
  CASE subject || ' / ' || domain WHEN 'Brand#1 / SMALL' THEN 'First small' WHEN 'Brand#3 / LARGE' THEN 'Third large' ELSE domain END AS domain_label
FROM topics""",
)
def label_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = merge.label_topics(src.topics(spark, sf_dir), SUBJECT_LABELS, DOMAIN_LABELS)
    return labelled.select("id", "subject_label", "domain_label")


@query("m5_published_topics", with_views("pub_topics") + " SELECT id, name, subject FROM pub_topics")
def published_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.published_topics(src.topics(spark, sf_dir)).select("id", "name", "subject")


@query(
    "m6_published_edges",
    with_views("edges")
    + " SELECT topic_id, prerequisite_id, strength FROM edges WHERE review_status = 'reviewed' AND NOT rescope_required",
)
def published_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.published_edges(src.edges(spark, sf_dir)).select("topic_id", "prerequisite_id", "strength")


@query(
    "m7_published_graph",
    with_views("pub_edges") + " SELECT topic_id, prerequisite_id, strength, reason FROM pub_edges",
)
def published_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(spark, sf_dir)[1].select("topic_id", "prerequisite_id", "strength", "reason")


@query(
    "m8_public_edges",
    with_views("pub_edges") + " SELECT topic_id, prerequisite_id, strength, reason, review_status FROM pub_edges",
)
def public_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.public_edge(published(spark, sf_dir)[1])


@query(
    "m8_path_edges",
    with_views("pub_edges")
    + """
SELECT prerequisite_id AS f, topic_id AS t, reason AS r, CASE WHEN a.subject <> b.subject THEN 1 ELSE 0 END AS x,
  CAST(NULL AS VARCHAR) AS p, CAST(NULL AS VARCHAR) AS q
FROM pub_edges e JOIN pub_topics a ON a.id = topic_id JOIN pub_topics b ON b.id = prerequisite_id""",
)
def path_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, kept = published(spark, sf_dir)
    return merge.path_edge(kept, nodes)


@query(
    "m8_public_topics",
    with_views("pub_topics") + " SELECT id, name, subject, domain, age_start, age_end, node_kind FROM pub_topics",
)
def public_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.public_topic(published(spark, sf_dir)[0])


@query(
    "m9_dimension_visibility",
    with_views("topics") + f", {DIMS} SELECT id, dimension, visible FROM dims",
)
def dimension_visibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookup.visibility(located_topics(spark, sf_dir), DIMENSIONS)
    return rows.select("id", "dimension", "visible")


@query(
    "m10_topic_query",
    with_views("topics")
    + f""", {LOCATED}
SELECT id, name, subject, age_start FROM located WHERE status IS DISTINCT FROM 'covered' AND NOT local_origin
  AND age_start BETWEEN 5 AND 30 AND translated AND (contains(lower(name), 're') OR contains(lower(id), 're') OR contains(lower(domain), 're'))""",
)
def topic_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = lookup.topics_in_dimension(located_topics(spark, sf_dir), DIMENSIONS[:1])
    shown = shown.withColumn("description", F.col("domain"))
    found = lookup.query_topics(shown, age_range=(5, 30), translated=True, text="RE")
    return found.select("id", "name", "subject", "age_start")


@query(
    "m11_gap_query",
    with_views("gaps")
    + """
SELECT subject, grade, gap_type, topic, path FROM gaps WHERE stage = 'junior' AND gap_type = 'textbook-only'
  AND (contains(lower(topic), '1') OR contains(lower(path), '1') OR contains(lower(textbook), '1'))""",
)
def gap_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookup.query_gaps(src.gaps(spark, sf_dir), stage="junior", gap_type="textbook-only", text="1")
    return found.select("subject", "grade", "gap_type", "topic", "path")


@query(
    "m12_gap_sort",
    with_views("gaps")
    + """
SELECT gap_type, grade, path, row_number() OVER (ORDER BY CASE WHEN gap_type = 'missing' THEN 0 ELSE 1 END,
  replace(grade, ' ', ''), path) AS pos FROM gaps""",
)
def gap_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stepstone.operators.ordering import with_position

    first, grade, path = lookup.gap_order()
    keyed = src.gaps(spark, sf_dir).select("gap_type", "grade", "path", first.alias("_a"), grade.alias("_b"))
    return with_position(keyed, [], ["_a", "_b", "path"]).drop("_a", "_b")


EGO = f"""{DIMS}, pe AS (SELECT * FROM edges WHERE review_status = 'reviewed' AND NOT rescope_required),
both_ways AS (SELECT topic_id AS id, prerequisite_id AS nid, 'prerequisite' AS direction, strength FROM pe
  UNION ALL SELECT prerequisite_id, topic_id, 'dependent', strength FROM pe),
ego AS (SELECT b.id, o.subject, nid AS neighbour_id, n.name AS neighbour_name, n.subject AS neighbour_subject,
  n.age_start AS neighbour_age, direction, strength, n.dimension, n.visible
  FROM both_ways b JOIN pub_topics o ON o.id = b.id JOIN dims n ON n.id = b.nid WHERE n.status IS DISTINCT FROM 'covered')"""


def _ego(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.ego_view(located_topics(spark, sf_dir), src.edges(spark, sf_dir), DIMENSIONS)


@query(
    "m14_ego_view",
    with_views("topics", "edges", "pub_topics")
    + f", {EGO} SELECT id, neighbour_id, neighbour_name, direction, strength, dimension, visible FROM ego",
)
def ego_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ego(spark, sf_dir).select(
        "id", "neighbour_id", "neighbour_name", "direction", "strength", "dimension", "visible"
    )


@query(
    "m15_ego_groups",
    with_views("topics", "edges", "pub_topics")
    + f""", {EGO} SELECT id, dimension, direction, subject <> neighbour_subject AS is_cross, neighbour_id,
  row_number() OVER (PARTITION BY id, dimension, direction, subject <> neighbour_subject ORDER BY neighbour_age, neighbour_id) AS rank,
  count(*) OVER (PARTITION BY id, dimension, direction, subject <> neighbour_subject) AS in_group, label
FROM (SELECT *, 'curated' AS label FROM ego) x""",
)
def ego_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = lookup.ego_groups(_ego(spark, sf_dir))
    label = reviewer_label(F.lit("curator"), F.lit(None).cast("string"))
    return grouped.select(
        "id", "dimension", "direction", "is_cross", "neighbour_id", "rank", "in_group", label.alias("label")
    )


@query(
    "m16_standards_lookup",
    with_views("topics", "standards_flat")
    + """
, refs AS (SELECT id, unnest([(SELECT lower(r_name) FROM region WHERE r_regionkey = num % 5) || ':N' || (num % 30), 'none:' || (num % 4)]) AS key FROM topics)
SELECT r.id, r.key, s.code, coalesce(s.note, '(not listed)') AS note FROM refs r LEFT JOIN standards_flat s ON r.key = s.key""",
)
def standards_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = src.table(spark, sf_dir, "region").select(F.col("r_regionkey"), F.lower("r_name").alias("slug"))
    topics = src.topics(spark, sf_dir)
    refs = topics.join(region, F.col("num") % 5 == F.col("r_regionkey"), "left").select(
        "id",
        F.array(
            F.concat("slug", F.lit(":N"), F.col("num") % 30), F.concat(F.lit("none:"), F.col("num") % 4)
        ).alias("standards"),
    )
    return lookup.standards_of(refs, lookup.flatten_curricula(src.standards(spark, sf_dir)))


@query("m17_flatten_curricula", with_views("standards_flat") + " SELECT slug, key, code, note FROM standards_flat")
def flatten_curricula(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.flatten_curricula(src.standards(spark, sf_dir)).select("slug", "key", "code", "note")


@query(
    "m20_cross_subject",
    with_views("edges", "topics")
    + """
SELECT topic_id, prerequisite_id, a.domain <> b.domain AS cross_subject
FROM edges JOIN topics a ON a.id = topic_id JOIN topics b ON b.id = prerequisite_id""",
)
def cross_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the edge view links parts of one brand, so the part type plays the subject here
    topics = src.topics(spark, sf_dir).select("id", F.col("domain").alias("subject"))
    return merge.cross_subject(src.edges(spark, sf_dir), topics).select(
        "topic_id", "prerequisite_id", "cross_subject"
    )
