"""Reading, exporting, snapshot and streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepstone.operators import lookup, stats
from stepstone.plans.merge_plans import DIMENSIONS, DIMS, located_topics, published
from stepstone.plans.registry import query
from stepstone.session import scratch_path
from stepstone.sources import documents, export, hashtree
from stepstone.sources import tables as src
from stepstone.sources.tables import with_views
from stepstone.streaming import learner_streams as streams

URL, AT = "https://example.org/graph", "2024-01-01T00:00:00.000Z"


@query(
    "s1_read_documents",
    """
WITH d AS (SELECT conv_id, turn // 100 AS part, count(*) AS declared FROM conversations GROUP BY 1, 2)
SELECT c.conv_id, d.declared, c.turn, c.role, md5(c.text) AS text_md5 FROM conversations c JOIN d ON d.conv_id = c.conv_id AND d.part = c.turn // 100""",
)
def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations wrapped into documents of at most 100 turns, written as JSON and read back."""
    talks = src.table(spark, sf_dir, "conversations")
    wrapped = talks.groupBy("conv_id", F.floor(F.col("turn") / 100).alias("part")).agg(
        F.count("*").alias("declared"), F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    path = scratch_path(spark, "documents")
    wrapped.write.json(path)
    header = T.StructType().add("conv_id", T.LongType()).add("declared", T.LongType())
    row = T.StructType().add("turn", T.LongType()).add("role", T.StringType()).add("text", T.StringType())
    rows = documents.read_documents(spark, path, header, "turns", row)[1]
    return rows.select("conv_id", "declared", "turn", "role", F.md5("text").alias("text_md5"))


@query(
    "s2_read_report",
    with_views("gaps") + """ SELECT subject, grade, gap_type, 'say "' || topic || '", twice' AS topic FROM gaps WHERE gap_type <> 'missing'""",
)
def read_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap rows as quoted CSV lines; missing-type lines lose a field, blank lines and headers are mixed in."""
    quoted = F.concat(F.lit('"say ""'), "topic", F.lit('"", twice"'))
    line = F.concat_ws(",", "subject", "grade", "gap_type", quoted)
    short = F.concat_ws(",", "subject", "grade", "gap_type")
    gaps = src.gaps(spark, sf_dir)
    lines = gaps.select(F.when(F.col("gap_type") == "missing", short).otherwise(line).alias("value"))
    noise = gaps.where("gap_type = 'missing'").select(F.explode(F.array(F.lit(",,,"), F.lit("subject,grade,gap_type,topic"))).alias("value"))
    path = scratch_path(spark, "report")
    lines.union(noise).write.text(path)
    return documents.read_report(spark, path, ["subject", "grade", "gap_type", "topic"])


NODE_SQL = """SELECT id, 'MicroTopic,LocalOrigin' AS labels, '{"name":"' || name || '","subject":"' || subject || '","domain":"' || domain || '","age_start":' || age_start || ',"age_end":' || age_end || ',"node_kind":"' || node_kind || '"}' AS properties FROM pub_topics"""


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.node_rows(published(spark, sf_dir)[0])


@query("s3_node_rows", with_views("pub_topics") + " " + NODE_SQL)
def node_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nodes(spark, sf_dir).withColumn("labels", F.array_join("labels", ","))


@query(
    "s3_relationship_rows",
    with_views("pub_edges")
    + """
SELECT 'PREREQUISITE_OF' AS type, prerequisite_id AS "from", topic_id AS "to", '{"strength":"' || strength || '","reason":"' || reason || '","review_status":"' || review_status || '"}' AS properties FROM pub_edges""",
)
def relationship_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written in key order as JSON lines and read back."""
    path = scratch_path(spark, "relationships")
    rows = export.relationship_rows(published(spark, sf_dir)[1])
    export.write_sorted(rows, path, "from", "to")
    return spark.read.schema(rows.schema).json(path)


@query(
    "s3_export_manifest",
    with_views("pub_edges") + f" SELECT '1' AS version, '{AT}' AS generated_at, (SELECT count(*) FROM pub_topics) AS nodes, (SELECT count(*) FROM pub_edges) AS relationships",
)
def export_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = export.relationship_rows(published(spark, sf_dir)[1])
    return export.export_manifest(_nodes(spark, sf_dir), rows, "1", AT)


def uuid_sql(name: str) -> str:
    d = f"sha1(unhex('4b6f5c55c9c64b2da5d8bf17f9b53e20') || CAST({name} AS BLOB))"
    return f"""(SELECT d[1:8] || '-' || d[9:12] || '-5' || d[14:16] || '-' || CASE WHEN d[17] IN ('0','4','8','c') THEN '8' WHEN d[17] IN ('1','5','9','d') THEN '9' WHEN d[17] IN ('2','6','a','e') THEN 'a' ELSE 'b' END || d[18:20] || '-' || d[21:32] FROM (SELECT {d} AS d) u)"""


@query(
    "s4_competency_items",
    with_views("pub_topics")
    + f"""
SELECT {uuid_sql("'item:' || id")} AS identifier, name AS "fullStatement", node_kind AS "CFItemType", '{URL}/case/items/' || id AS uri, id AS "humanCodingScheme", subject, 'age-' || age_start AS "educationLevel" FROM pub_topics""",
)
def competency_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = export.competency_items(published(spark, sf_dir)[0], URL, AT)
    return items.drop("lastChangeDateTime").withColumns(
        {"subject": F.col("subject")[0], "educationLevel": F.col("educationLevel")[0]}
    )


@query(
    "s4_competency_associations",
    with_views("pub_edges")
    + f"""
SELECT {uuid_sql("'association:' || prerequisite_id || '->' || topic_id")} AS identifier, 'precedes' AS "associationType", '{URL}/case/associations/' || prerequisite_id || '-%3E' || topic_id AS uri,
  {uuid_sql("'item:' || prerequisite_id")} AS origin, {uuid_sql("'item:' || topic_id")} AS destination, a.name AS origin_title, e.reason AS notes
FROM pub_edges e JOIN pub_topics a ON a.id = prerequisite_id""",
)
def competency_associations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, kept = published(spark, sf_dir)
    ties = export.competency_associations(kept, nodes, URL, AT)
    return ties.select(
        "identifier", "associationType", "uri", F.col("originNodeURI.identifier").alias("origin"),
        F.col("destinationNodeURI.identifier").alias("destination"), F.col("originNodeURI.title").alias("origin_title"), "notes",
    )


@query(
    "s6_materialised_views",
    with_views("topics") + f", {DIMS} SELECT dimension, subject, count(*) AS topics FROM dims WHERE visible AND status IS DISTINCT FROM 'covered' GROUP BY 1, 2",
)
def materialised_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics of every dimension written as one partition each, and read back for its directory."""
    shown = lookup.topics_in_dimension(located_topics(spark, sf_dir), DIMENSIONS)
    path = scratch_path(spark, "views")
    shown.write.partitionBy("dimension").parquet(path)
    return spark.read.schema(shown.schema).parquet(path).groupBy("dimension", "subject").agg(F.count("*").alias("topics"))


@query(
    "s7_review_packet",
    with_views("edges", "topics")
    + """
, c AS (SELECT e.*, a.name AS topic_name, b.name AS prerequisite_name FROM edges e JOIN topics a ON a.id = topic_id JOIN topics b ON b.id = prerequisite_id
  WHERE review_status = 'machine' AND NOT rescope_required AND a.domain = 'PROMO')
SELECT topic_id, prerequisite_id, strength, reason, sha256('{"prerequisite_id":"' || prerequisite_id || '","reason":"' || reason || '","strength":"' || strength || '","topic_id":"' || topic_id || '"}') AS content_fingerprint,
  topic_name, prerequisite_name, (SELECT count(*) FROM c) AS total FROM c ORDER BY topic_id, prerequisite_id LIMIT 20 OFFSET 5""",
)
def review_packet(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ("topic_id", "prerequisite_id", "strength", "reason")
    return export.review_packet(src.edges(spark, sf_dir), src.topics(spark, sf_dir), cols, 5, 20, domain="PROMO")


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame, DataFrame]:
    edges = src.edges(spark, sf_dir).select("topic_id", "prerequisite_id", "strength", "p_num")
    turned = F.when(F.col("p_num") % 5 == 0, "hard").otherwise(F.col("strength"))
    new = edges.where("p_num % 7 = 0").withColumn("topic_id", F.concat("topic_id", F.lit("_new")))
    after = edges.where("p_num % 9 <> 0").withColumn("strength", turned).union(new)
    root = scratch_path(spark, "snapshots")
    for label, df in (("before", edges), ("after", after)):
        export.create_snapshot(df, root, "edges", label)
    read = [spark.read.schema(edges.schema).parquet(f"{root}/edges/label={label}") for label in ("before", "after")]
    return root, *read


SNAP_SQL = """, b AS (SELECT topic_id, prerequisite_id, strength, p_num FROM edges),
a AS (SELECT topic_id, prerequisite_id, CASE WHEN p_num % 5 = 0 THEN 'hard' ELSE strength END AS strength, p_num FROM b WHERE p_num % 9 <> 0 UNION ALL SELECT topic_id || '_new', prerequisite_id, strength, p_num FROM b WHERE p_num % 7 = 0)"""


@query(
    "s8_snapshot_list",
    with_views("edges") + SNAP_SQL + " SELECT 'before' AS label, count(*) AS rows FROM b UNION ALL SELECT 'after', count(*) FROM a",
)
def snapshot_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.list_snapshots(spark, _snapshots(spark, sf_dir)[0], "edges")


@query(
    "s8_snapshot_diff",
    with_views("edges") + SNAP_SQL
    + """ SELECT CASE WHEN b.topic_id IS NULL THEN 'added' WHEN a.topic_id IS NULL THEN 'removed' WHEN a.strength <> b.strength THEN 'changed' ELSE 'unchanged' END AS change, count(*) AS n
FROM b FULL JOIN a ON a.topic_id = b.topic_id AND a.prerequisite_id = b.prerequisite_id GROUP BY 1""",
)
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, before, after = _snapshots(spark, sf_dir)
    return export.diff_snapshots(before, after, ["topic_id", "prerequisite_id"])


@query(
    "s8_tree_diff",
    """
WITH b AS (SELECT o_orderkey AS k, o_totalprice AS v FROM orders),
a AS (SELECT k, CASE WHEN k % 997 = 5 THEN v + 1 ELSE v END AS v FROM b WHERE k % 1009 <> 7 UNION ALL SELECT -k, v FROM b WHERE k % 1013 = 9)
SELECT CASE WHEN b.k IS NULL THEN 'added' WHEN a.k IS NULL THEN 'removed' WHEN a.v <> b.v THEN 'changed' ELSE 'unchanged' END AS change, count(*) AS n FROM b FULL JOIN a ON a.k = b.k GROUP BY 1""",
)
def tree_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before and after few changes; the rest is known to be equal from the digests alone."""
    before, key = src.table(spark, sf_dir, "orders"), F.col("o_orderkey")
    price = F.when(key % 997 == 5, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    kept = before.where(key % 1009 != 7).withColumn("o_totalprice", price)
    after = kept.unionByName(before.where(key % 1013 == 9).withColumn("o_orderkey", -key))
    root = scratch_path(spark, "trees")
    paths = [hashtree.create_tree_snapshot(df, f"{root}/{label}", ["o_orderkey"]) for label, df in (("before", before), ("after", after))]
    return hashtree.diff_trees(spark, *paths, ["o_orderkey"])


LIMIT, WINDOW_SECONDS = 5, 3 * 86400


ADMISSION_SQL = f"""
WITH RECURSIVE e AS (SELECT user_id AS key, event_id, epoch_us(ts) AS stamp, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
r AS (SELECT key, event_id, rn, TRUE AS allowed, [stamp] AS recent FROM e WHERE rn = 1
  UNION ALL SELECT e.key, e.event_id, e.rn, len(list_filter(r.recent, lambda t: e.stamp - t < {WINDOW_SECONDS * 1_000_000})) < {LIMIT},
    CASE WHEN len(list_filter(r.recent, lambda t: e.stamp - t < {WINDOW_SECONDS * 1_000_000})) < {LIMIT} THEN list_append(list_filter(r.recent, lambda t: e.stamp - t < {WINDOW_SECONDS * 1_000_000}), e.stamp)
      ELSE list_filter(r.recent, lambda t: e.stamp - t < {WINDOW_SECONDS * 1_000_000}) END FROM r JOIN e ON e.key = r.key AND e.rn = r.rn + 1)
SELECT key, event_id, allowed FROM r"""


@query("st1_admission", ADMISSION_SQL)
def admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = streams.event_stream(spark, sf_dir, "events.parquet")
    keyed = events.select(F.col("user_id").alias("key"), "event_id", "ts")
    return streams.run_to_table(streams.admit(keyed, LIMIT, WINDOW_SECONDS), "admission").drop("batch")


@query("st1_idle_admission", ADMISSION_SQL)
def idle_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same answers from a state that idle keys leave a window and a day after their last allowed event."""
    keyed = streams.event_stream(spark, sf_dir, "events.parquet").select(F.col("user_id").alias("key"), "event_id", "ts")
    return streams.run_to_table(streams.admit_and_forget(keyed, LIMIT, WINDOW_SECONDS, 86400), "idle-admission").drop("batch")


def _decision_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = src.table(spark, sf_dir, "part").count()
    kind = F.col("event_type")
    return streams.event_stream(spark, sf_dir, "events.parquet").select(
        F.col("user_id").alias("learner"),
        F.concat(F.lit("mtc_"), F.col("event_id") % size).alias("topic_id"),
        F.when(kind.isin("click", "purchase"), "mastered").when(kind == "error", "needs-review")
        .when(kind == "signup", "clear").otherwise("visit").alias("decision"),
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
    )


@query(
    "st2_learner_state",
    with_views("decisions") + " SELECT learner, topic_id, arg_max(decision, event_id) AS decision FROM decisions WHERE decision <> 'visit' GROUP BY 1, 2",
)
def learner_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = streams.decisions_of(_decision_stream(spark, sf_dir))
    return streams.run_to_keys(changes, "learner_state", ["learner", "topic_id"], ["ts", "event_id"]).select("learner", "topic_id", "decision")


@query(
    "st3_recent_trail",
    with_views("decisions")
    + """
, l AS (SELECT learner, topic_id, max(event_id) AS last_event FROM decisions GROUP BY 1, 2)
SELECT learner, topic_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY learner ORDER BY last_event DESC) AS rank FROM l) x WHERE rank <= 8""",
)
def recent_trail_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = _decision_stream(spark, sf_dir).select("learner", "topic_id", "event_id", "ts")
    trails = streams.latest(streams.run_to_table(streams.trail(visits), "trail_stream", "update"), "learner")
    return trails.select("learner", F.posexplode("topics").alias("pos", "topic_id")).select(
        "learner", "topic_id", (F.col("pos") + 1).alias("rank")
    )


@query(
    "s6_dimension_directories",
    with_views("topics")
    + f""", {DIMS} SELECT dimension, subject, count(*) AS topics, count(*) FILTER (WHERE translated) AS translated, array_to_string(list_sort(list(DISTINCT age_start)), ',') AS ages
FROM dims WHERE visible AND status IS DISTINCT FROM 'covered' GROUP BY 1, 2""",
)
def dimension_directories(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = lookup.topics_in_dimension(located_topics(spark, sf_dir), DIMENSIONS)
    tagged = shown.withColumn("domain", F.col("dimension"))
    tree = stats.directory_tree(tagged).where("is_subject_total = 0")
    return tree.select(F.col("domain").alias("dimension"), "subject", "topics", "translated", "ages")
