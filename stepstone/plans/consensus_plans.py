"""Review packets, consensus and the publish gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepstone.functions.columns import fingerprint
from stepstone.operators import consensus as ops
from stepstone.operators import evidence
from stepstone.plans.registry import query
from stepstone.sources import tables as src
from stepstone.sources.tables import with_views

FORMAT = "edge-review-packet/v1"
PRINT_COLS = ("topic_id", "prerequisite_id", "strength", "reason")


def print_sql(reason: str = "reason") -> str:
    return f"""sha256('{{"prerequisite_id":"' || prerequisite_id || '","reason":"' || {reason} || '","strength":"' || strength || '","topic_id":"' || topic_id || '"}}')"""


PACKET_SQL = """, pk AS (SELECT 'packet_' || c_custkey AS packet_id, CASE WHEN c_custkey % 50 = 3 THEN 'other' ELSE 'edge-review-packet/v1' END AS format,
  CASE WHEN c_custkey % 40 = 7 THEN 'none' ELSE sha256(c_name) END AS checksum FROM customer),
pe AS (SELECT packet_id, topic_id, prerequisite_id, CASE WHEN num % 97 = 0 THEN 'weak' ELSE strength END AS strength, reason, CASE WHEN num % 89 = 0 THEN 'x' ELSE sha256(reason) END AS fingerprint,
  CASE WHEN num % 83 = 0 THEN 'mtc_0' ELSE topic_id END AS topic_context, prerequisite_id AS prerequisite_context FROM packet_edges
  UNION ALL SELECT packet_id, topic_id, prerequisite_id, CASE WHEN num % 97 = 0 THEN 'weak' ELSE strength END, reason, CASE WHEN num % 89 = 0 THEN 'x' ELSE sha256(reason) END,
  CASE WHEN num % 83 = 0 THEN 'mtc_0' ELSE topic_id END, prerequisite_id FROM packet_edges WHERE num % 211 = 0)"""


def packets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    key, num = F.col("c_custkey"), F.col("num")
    head = src.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("packet_"), key).alias("packet_id"),
        F.when(key % 50 == 3, "other").otherwise(FORMAT).alias("format"),
        F.when(key % 40 == 7, "none").otherwise(F.sha2("c_name", 256)).alias("checksum"),
    )
    edges = src.packet_edges(spark, sf_dir).withColumns(
        {
            "strength": F.when(num % 97 == 0, "weak").otherwise(F.col("strength")),
            "fingerprint": F.when(num % 89 == 0, "x").otherwise(F.sha2("reason", 256)),
            "topic_context": F.when(num % 83 == 0, "mtc_0").otherwise(F.col("topic_id")),
            "prerequisite_context": F.col("prerequisite_id"),
        }
    )
    return head, edges.union(edges.where(num % 211 == 0)).drop("num")


@query(
    "c1_packet_problems",
    with_views("packet_edges") + PACKET_SQL
    + """
SELECT packet_id, 'format' AS rule, '' AS key FROM pk WHERE format <> 'edge-review-packet/v1' UNION ALL SELECT packet_id, 'checksum', '' FROM pk WHERE checksum = 'none'
UNION ALL SELECT packet_id, 'strength', topic_id || '<-' || prerequisite_id FROM pe WHERE strength NOT IN ('hard', 'soft') UNION ALL SELECT packet_id, 'fingerprint', topic_id || '<-' || prerequisite_id FROM pe WHERE fingerprint = 'x'
UNION ALL SELECT packet_id, 'topic-context', topic_id || '<-' || prerequisite_id FROM pe WHERE topic_context <> topic_id
UNION ALL SELECT packet_id, 'duplicate-edge', topic_id || '<-' || prerequisite_id FROM pe GROUP BY packet_id, topic_id, prerequisite_id HAVING count(*) > 1
UNION ALL SELECT packet_id, 'no-edges', '' FROM pk WHERE packet_id NOT IN (SELECT packet_id FROM pe)""",
)
def packet_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.packet_problems(*packets(spark, sf_dir), FORMAT)


@query(
    "c1_packet_identity",
    with_views("packet_edges") + PACKET_SQL
    + """
, pj AS (SELECT packet_id, topic_id, prerequisite_id, sha256('{"fingerprint":"' || fingerprint || '","prerequisite_context":"' || prerequisite_context || '","prerequisite_id":"' || prerequisite_id || '","reason":"' || reason
  || '","strength":"' || strength || '","topic_context":"' || topic_context || '","topic_id":"' || topic_id || '"}') AS h FROM pe),
po AS (SELECT packet_id, row_number() OVER (PARTITION BY packet_id ORDER BY topic_id, prerequisite_id, h) - 1 AS place, h FROM pj),
lv AS (SELECT packet_id, 0 AS level, place, h FROM po
  UNION ALL SELECT packet_id, level + 1, place // 4, CASE WHEN count(*) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY place)) END FROM lv WHERE level < 12 GROUP BY packet_id, level, place // 4)
SELECT pk.packet_id, 'packet-v1:' || sha256(format || '|' || checksum || '|' || (SELECT count(*) FROM pe WHERE pe.packet_id = pk.packet_id) || '|' || h) AS identity FROM pk JOIN lv ON lv.packet_id = pk.packet_id AND level = 12""",
)
def packet_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets hold few edges here, so four hashes make one."""
    return ops.packet_identity(*packets(spark, sf_dir), fan=4)


@query(
    "c1_field_problems",
    with_views("packet_edges")
    + """
SELECT packet_id, rule, topic_id || '<-' || prerequisite_id AS key FROM packet_edges, (VALUES ('edge-field', 67, 3), ('topic-field', 71, 3), ('prerequisite-field', 73, 3), ('topic-object', 61, 0), ('prerequisite-object', 59, 0)) r(rule, every, rest)
WHERE num % every = rest AND NOT (rule = 'topic-field' AND num % 61 = 0) AND NOT (rule = 'prerequisite-field' AND num % 59 = 0)""",
)
def field_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packet edges as JSON documents with topics inside; some have fields of other names or no object for a topic."""
    num = F.col("num")

    def odd(every: int, name: str) -> Column:
        return F.when(num % every == 3, "x").alias(name)

    def topic(id: str, gone: int, every: int) -> Column:
        return F.when(num % gone != 0, F.struct(F.col(id).alias("id"), F.lit("t").alias("name"), F.lit(6).alias("ageRangeStart"), odd(every, "rank"))).otherwise(F.lit(None))

    document = F.to_json(F.struct(
        F.col("topic_id").alias("topicId"), F.col("prerequisite_id").alias("prerequisiteId"), "strength", "reason",
        topic("topic_id", 61, 71).alias("topic"), topic("prerequisite_id", 59, 73).alias("prerequisite"), odd(67, "comment"),
    ))
    rows = src.packet_edges(spark, sf_dir).select("packet_id", F.concat_ws("<-", "topic_id", "prerequisite_id").alias("key"), document.alias("document"))
    inner = {name: (F.get_json_object("document", f"$.{name}"), ops.PACKET_TOPIC_FIELDS) for name in ("topic", "prerequisite")}
    return ops.field_problems(rows, {"edge": (F.col("document"), ops.PACKET_EDGE_FIELDS), **inner})


RESPONSE_SQL = """, ex AS (SELECT packet_id, topic_id, prerequisite_id, role FROM packet_edges, (VALUES ('necessity'), ('direction'), ('adversary')) r(role)),
cv AS (SELECT packet_id, topic_id, prerequisite_id, role, count(*) AS n, min(model) AS model,
  count(*) FILTER (WHERE verdict NOT IN ('reviewed', 'rejected') OR length(reason) < 1 OR length(reason) > 2000) AS bad FROM raw_votes GROUP BY 1, 2, 3, 4),
rs AS (SELECT coalesce(ex.packet_id, cv.packet_id) AS packet_id, coalesce(ex.role, cv.role) AS role, count(*) FILTER (WHERE n IS NULL) AS missing, count(*) FILTER (WHERE ex.role IS NULL) AS extra,
  count(*) FILTER (WHERE ex.role IS NOT NULL AND n > 1) AS doubled, coalesce(sum(bad), 0)::BIGINT AS malformed, min(model) AS model
  FROM ex FULL JOIN cv ON ex.packet_id = cv.packet_id AND ex.topic_id = cv.topic_id AND ex.prerequisite_id = cv.prerequisite_id AND ex.role = cv.role GROUP BY 1, 2),
rv AS (SELECT *, missing + extra + doubled + malformed = 0 AS valid FROM rs),
pv AS (SELECT packet_id, count(*) FILTER (WHERE valid) AS valid_roles, count(DISTINCT model) FILTER (WHERE valid) AS models FROM rv GROUP BY 1),
pf AS (SELECT *, CASE WHEN valid_roles < 3 THEN 'invalid-role' WHEN models < 3 THEN 'shared-model' END AS failure FROM pv)"""


def _ballots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges and votes of all packets by edge, shuffled and written once for all that follows from them."""
    return src.written(
        spark, sf_dir, "ballots", lambda: ops.ballots(src.packet_edges(spark, sf_dir).drop("num"), src.raw_votes(spark, sf_dir))
    )


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.judged(_ballots(spark, sf_dir))


@query(
    "c2_response_verdicts",
    with_views("packet_edges", "raw_votes") + RESPONSE_SQL + " SELECT packet_id, role, missing, extra, doubled, malformed, model, valid FROM rv",
)
def response_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _responses(spark, sf_dir)


RESPONSE_FORMAT = "edge-review-response/v1"
ECHO_SQL = """, rq AS (SELECT DISTINCT packet_id, role, CAST(substr(packet_id, 8) AS BIGINT) AS pn, CASE role WHEN 'necessity' THEN 0 WHEN 'direction' THEN 1 ELSE 2 END AS rn FROM packet_edges, (VALUES ('necessity'), ('direction'), ('adversary')) r(role)),
ep AS (SELECT packet_id, role, 'unanswered' AS rule FROM rq WHERE (pn + rn) % 31 = 0 UNION ALL SELECT packet_id, role, 'format' FROM rq WHERE (pn + rn) % 31 <> 0 AND (pn + rn) % 29 = 0
  UNION ALL SELECT packet_id, role, 'request-id' FROM rq WHERE (pn + rn) % 31 <> 0 AND (pn + rn) % 23 = 0 UNION ALL SELECT packet_id, role, 'configured-model' FROM rq WHERE (pn + rn) % 31 <> 0 AND (pn + rn) % 19 = 0
  UNION ALL SELECT packet_id, role, 'answered-twice' FROM rq WHERE (pn + rn) % 31 <> 0 AND (pn + rn) % 37 = 0 UNION ALL SELECT DISTINCT packet_id, 'referee', 'unasked' FROM rq WHERE pn % 41 = 0)"""


def _echo_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for every packet and role, and answers of which some repeat them wrongly, twice or not at all."""
    roles = F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.lit(n).alias("rn")) for n, r in enumerate(ops.ROLES)]))
    base = src.packet_edges(spark, sf_dir).select("packet_id").distinct().select("packet_id", roles.alias("r")).select("packet_id", "r.role", "r.rn")
    pn = F.substring("packet_id", 8, 20).cast("bigint")
    requests = base.select(
        "packet_id", "role", F.concat_ws(":", "packet_id", "role").alias("request_id"), F.concat(F.lit("model-"), "role").alias("configured_model"),
        (pn + F.col("rn")).alias("num"), pn.alias("pn"),
    )
    num = F.col("num")
    answers = requests.where(num % 31 != 0).select(
        "packet_id", "role",
        F.when(num % 29 != 0, RESPONSE_FORMAT).alias("format"),
        F.when(num % 23 == 0, F.concat("request_id", F.lit("x"))).otherwise(F.col("request_id")).alias("request_id"),
        F.when(num % 19 != 0, F.col("configured_model")).alias("configured_model"), "num",
    )
    foreign = requests.where((F.col("pn") % 41 == 0) & (F.col("role") == ops.ROLES[0])).select(
        "packet_id", F.lit("referee").alias("role"), F.lit(RESPONSE_FORMAT).alias("format"), "request_id", "configured_model", "num"
    )
    answers = answers.union(answers.where(num % 37 == 0)).union(foreign).drop("num")
    return ops.echo_problems(requests, answers, RESPONSE_FORMAT, ["request_id", "configured_model"])


@query("c2_echo_problems", with_views("packet_edges") + ECHO_SQL + " SELECT packet_id, role, rule FROM ep")
def echo_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _echo_problems(spark, sf_dir)


@query(
    "c2_checked_responses",
    with_views("packet_edges", "raw_votes")
    + RESPONSE_SQL.replace("length(reason) > 2000)", "length(reason) > 2000 OR num % 17 < 4)").split(",\nrv AS")[0] + ECHO_SQL
    + """
SELECT rs.packet_id, rs.role, missing, extra, doubled, malformed, model, coalesce(e.echo, 0) AS echo, missing + extra + doubled + malformed + coalesce(e.echo, 0) = 0 AS valid
FROM rs LEFT JOIN (SELECT packet_id, role, count(*) AS echo FROM ep GROUP BY 1, 2) e ON e.packet_id = rs.packet_id AND e.role = rs.role""",
)
def checked_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes with references, of which some are none, too many, too long or empty, judged with the answers' echo."""
    num = F.col("num") % 17
    cited = F.when(num == 0, F.lit(None)).when(num == 1, F.array_repeat(F.lit("r"), 9)).when(num == 2, F.array(F.repeat(F.lit("r"), 501))).when(
        num == 3, F.array(F.lit("r"), F.lit(""))
    ).when(num == 4, F.array_repeat(F.repeat(F.lit("r"), 500), 8)).otherwise(F.array().cast("array<string>"))
    votes = src.raw_votes(spark, sf_dir).withColumn("references", cited)
    return ops.echoed(ops.response_verdicts(votes, src.packet_edges(spark, sf_dir)), _echo_problems(spark, sf_dir))


@query(
    "c3_packet_verdicts",
    with_views("packet_edges", "raw_votes") + RESPONSE_SQL + " SELECT packet_id, valid_roles, models, failure FROM pf",
)
def packet_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.packet_verdicts(_responses(spark, sf_dir))


DECIDE_SQL = RESPONSE_SQL + """,
nv AS (SELECT e.packet_id, e.topic_id, e.prerequisite_id, e.strength, v.role, v.verdict, v.model, CASE WHEN v.resolved_strength = 'unchanged' THEN e.strength ELSE v.resolved_strength END AS rs
  FROM packet_edges e JOIN raw_votes v ON v.packet_id = e.packet_id AND v.topic_id = e.topic_id AND v.prerequisite_id = e.prerequisite_id),
dd AS (SELECT e.packet_id, e.topic_id, e.prerequisite_id, e.strength, count(DISTINCT n.verdict || n.rs) AS kinds, min(n.verdict) AS verdict, min(n.rs) AS rs
  FROM packet_edges e LEFT JOIN nv n ON n.packet_id = e.packet_id AND n.topic_id = e.topic_id AND n.prerequisite_id = e.prerequisite_id GROUP BY 1, 2, 3, 4),
dc AS (SELECT dd.packet_id, topic_id, prerequisite_id, strength, CASE WHEN pf.packet_id IS NULL OR failure IS NOT NULL THEN 'packet-failed' WHEN kinds > 1 THEN 'disagreement' WHEN verdict = 'rejected' THEN 'unanimous-rejected' ELSE 'unanimous-reviewed' END AS consensus, rs
  FROM dd LEFT JOIN pf ON pf.packet_id = dd.packet_id)"""
PROPOSE_SQL = DECIDE_SQL + f""",
gp AS (SELECT d.packet_id, d.topic_id, d.prerequisite_id, d.rs AS resolved_strength, f.fp AS content_fingerprint FROM dc d JOIN (SELECT packet_id, topic_id, prerequisite_id, {print_sql()} AS fp FROM packet_edges) f
  ON f.packet_id = d.packet_id AND f.topic_id = d.topic_id AND f.prerequisite_id = d.prerequisite_id WHERE consensus = 'unanimous-reviewed'),
pp AS (SELECT g.packet_id, g.topic_id, g.prerequisite_id, g.resolved_strength, g.content_fingerprint, 'ai-consensus-v1:' || sha256('{{"content_fingerprint":"' || g.content_fingerprint || '","packet_id":"' || g.packet_id || '","prerequisite_id":"' || g.prerequisite_id || '","roles":['
  || string_agg('{{"model":"' || n.model || '","resolved_strength":"' || n.rs || '","role":"' || n.role || '","verdict":"' || n.verdict || '"}}', ',' ORDER BY n.role) || '],"topic_id":"' || g.topic_id || '"}}') AS reviewed_by
  FROM gp g JOIN nv n ON n.packet_id = g.packet_id AND n.topic_id = g.topic_id AND n.prerequisite_id = g.prerequisite_id GROUP BY 1, 2, 3, 4, 5)"""


def _printed(rows: DataFrame) -> DataFrame:
    """Rows of ballots whose edges have a fingerprint in place of their reason."""
    def content(e: Column) -> Column:
        fields = {"strength": e["strength"], "reason": e["reason"], **{c: F.col(c) for c in ops.EDGE_KEY}}
        return F.sha2(F.to_json(F.struct(*[fields[c].alias(c) for c in sorted(PRINT_COLS)]), {"ignoreNullFields": "true"}), 256)

    return rows.withColumn(
        "edges", ops.each(F.col("edges"), lambda e: F.struct(e["strength"].alias("strength"), content(e).alias("content_fingerprint")))
    )


def _decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.decided(_ballots(spark, sf_dir), ops.packet_verdicts(_responses(spark, sf_dir)))


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decided(spark, sf_dir).select(*ops.PACKET_KEY, F.inline("decisions"))


def proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.written(spark, sf_dir, "proposals", lambda: ops.proposals(_printed(_decided(spark, sf_dir))))


@query(
    "c4_edge_decisions",
    with_views("packet_edges", "raw_votes") + DECIDE_SQL
    + " SELECT packet_id, topic_id, prerequisite_id, consensus, CASE WHEN consensus = 'unanimous-reviewed' THEN rs END AS resolved_strength FROM dc",
)
def edge_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions(spark, sf_dir).drop("strength")


@query("c5_proposals", with_views("packet_edges", "raw_votes") + PROPOSE_SQL + " SELECT * FROM pp")
def derived_reviewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proposals(spark, sf_dir)


def _stored(found: DataFrame) -> DataFrame:
    """Proposals as kept on file: some strengths were changed afterwards."""
    num = F.regexp_extract("prerequisite_id", r"(\d+)", 1).cast("bigint")
    return found.withColumn("resolved_strength", F.when(num % 5 == 0, "edited").otherwise(F.col("resolved_strength")))


@query(
    "c6_evidence_drift",
    with_views("packet_edges", "raw_votes") + PROPOSE_SQL
    + """
, x AS (SELECT *, CAST(substr(prerequisite_id, 5) AS BIGINT) % 5 = 0 AS edited FROM pp)
SELECT packet_id, topic_id, prerequisite_id, resolved_strength, content_fingerprint, reviewed_by, 'derived' AS side FROM x WHERE edited
UNION ALL SELECT packet_id, topic_id, prerequisite_id, 'edited', content_fingerprint, reviewed_by, 'stored' FROM x WHERE edited""",
)
def evidence_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = proposals(spark, sf_dir)
    return ops.evidence_drift(_stored(found), found)


EVIDENCE_FORMAT = "consensus-evidence/v1"
EVIDENCE_SQL = """, ps AS (SELECT DISTINCT packet_id, CAST(substr(packet_id, 8) AS BIGINT) AS pn FROM packet_edges),
dn AS (SELECT dc.packet_id, topic_id || '<-' || prerequisite_id AS key, CAST(substr(prerequisite_id, 5) AS BIGINT) AS num, consensus, pn FROM dc JOIN ps ON ps.packet_id = dc.packet_id),
pn AS (SELECT pp.packet_id, topic_id || '<-' || prerequisite_id AS key, pn FROM pp JOIN ps ON ps.packet_id = pp.packet_id)
SELECT packet_id, 'seal' AS rule, NULL AS key FROM ps WHERE pn % 11 = 0 OR pn % 13 = 0
UNION ALL SELECT packet_id, 'configured-models', NULL FROM ps WHERE pn % 31 = 0
UNION ALL SELECT ps.packet_id, 'error', NULL FROM ps JOIN pf ON pf.packet_id = ps.packet_id WHERE pn % 37 = 0 AND failure IS NULL
UNION ALL SELECT packet_id, 'decision', key FROM dn WHERE pn % 17 = 0 AND num % 2 = 0 AND consensus <> 'disagreement'
UNION ALL SELECT packet_id, 'decision-missing', key FROM dn WHERE pn % 19 = 0 AND num % 2 = 1
UNION ALL SELECT packet_id, 'proposal-binding', key FROM pn WHERE pn % 13 = 0 AND pn % 29 <> 0
UNION ALL SELECT packet_id, 'proposal-reviewer', key FROM pn WHERE pn % 23 = 0 AND pn % 29 <> 0
UNION ALL SELECT packet_id, 'proposal-missing', key FROM pn WHERE pn % 29 = 0"""


def evidence_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of all packets as a review run seals them: its votes by role, decisions and proposals."""
    given = _responses(spark, sf_dir)
    verdicts = ops.packet_verdicts(given)
    at, ref = F.lit("2024-05-01T00:00:00.000Z"), F.concat(F.lit("evidence/"), "packet_id")
    keys = [F.col(c) for c in ops.EDGE_KEY]
    decided = _printed(ops.decided(_ballots(spark, sf_dir), verdicts)).dropna(subset=ops.PACKET_KEY).withColumn("found", ops.proposals_of())

    def fields(row: Column, *names: str) -> list[Column]:
        return [row[n].alias(n) for n in names]

    def with_print(rows: str, *names: str) -> Column:
        """Each of a key's ``rows`` with each fingerprint of its edges."""
        return F.flatten(ops.each(F.col(rows), lambda r: ops.each(F.col("edges"), lambda e: F.struct(
            *keys, *fields(r, "strength"), *fields(e, "content_fingerprint"), *fields(r, *names)
        ))))

    lists = {
        "edges": with_print("edges"),
        "decisions": with_print("decisions", "consensus", "resolved_strength"),
        "proposals": F.transform("found", lambda p: F.struct(
            *keys, *fields(p, "content_fingerprint", "resolved_strength", "reviewed_by"), at.alias("reviewed_at"), ref.alias("evidence_ref")
        )),
        "votes": F.transform("votes", lambda v: F.struct(*fields(v, "role"), F.struct(*keys, *fields(v, "verdict", "resolved_strength")).alias("vote"))),
    }
    # rows of a packet came together when its verdict was joined, so the lists need no further shuffle
    rows = decided.select("packet_id", *[c.alias(name) for name, c in lists.items()])
    gathered = rows.groupBy("packet_id").agg(*[F.sort_array(F.flatten(F.collect_list(name))).alias(name) for name in lists])
    told = given.where(F.col("role").isin(*ops.ROLES)).groupBy("packet_id").agg(
        F.sort_array(F.collect_list(F.struct("role", "valid", "model"))).alias("told")
    )
    whole = verdicts.select("packet_id", "failure").join(told, "packet_id", "left").join(gathered, "packet_id", "left")

    def record(r: Column) -> Column:
        cast = F.filter("votes", lambda v: r["valid"] & (v["role"] == r["role"]))["vote"]
        return F.struct(
            r["role"].alias("role"), F.when(r["valid"], "valid").otherwise("invalid").alias("status"),
            F.concat(F.lit("model-"), r["role"]).alias("configured_model"), F.when(r["valid"], r["model"]).alias("actual_model"),
            F.coalesce(cast, F.array().cast(whole.schema["votes"].dataType)["vote"]).alias("votes"),
        )

    return whole.select(
        "packet_id", F.lit(EVIDENCE_FORMAT).alias("format"), F.when(F.col("failure").isNull(), "complete").otherwise("failed").alias("status"),
        F.col("failure").alias("error"), at.alias("completed_at"), ref.alias("evidence_ref"), "edges", F.transform("told", record).alias("roles"),
        "decisions", F.coalesce("proposals", F.array().cast(whole.schema["proposals"].dataType)).alias("proposals"),
    )


def _edited_documents(documents: DataFrame) -> DataFrame:
    """Documents of which some were changed before they were sealed, and some afterwards."""
    pn = F.substring("packet_id", 8, 20).cast("bigint")

    def odd(edge: Column) -> Column:
        return F.substring(edge["prerequisite_id"], 5, 20).cast("bigint") % 2 == 1

    flipped = F.transform("decisions", lambda d: d.withField("consensus", F.when(odd(d), d["consensus"]).otherwise("disagreement")))
    named = F.transform("proposals", lambda p: p.withField("reviewed_by", F.concat(p["reviewed_by"], F.lit("0"))))
    edits = {
        "decisions": [(17, flipped), (19, F.filter("decisions", lambda d: ~odd(d)))],
        "proposals": [(23, named), (29, F.slice("proposals", 1, 0))],
        "roles": [(31, F.transform("roles", lambda r: r.withField("configured_model", F.lit("same"))))],
        "error": [(37, F.coalesce("error", F.lit("none")))],
    }
    for name, changes in edits.items():
        for every, value in changes:
            documents = documents.withColumn(name, F.when(pn % every == 0, value).otherwise(F.col(name)))
    sealed = evidence.seal(documents)
    return sealed.withColumns({
        "evidence_hash": F.when(pn % 11 == 0, F.reverse("evidence_hash")).otherwise(F.col("evidence_hash")),
        "completed_at": F.when(pn % 13 == 0, "2024-05-02T00:00:00.000Z").otherwise(F.col("completed_at")),
    })


@query("c6_evidence_problems", with_views("packet_edges", "raw_votes") + PROPOSE_SQL + EVIDENCE_SQL)
def evidence_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seals, decisions and proposals of stored documents, derived anew from the votes that they hold."""
    documents = src.written(spark, sf_dir, "edited_evidence", lambda: _edited_documents(evidence_documents(spark, sf_dir)))
    return evidence.evidence_problems(documents, EVIDENCE_FORMAT)


LIVE_SQL = f""", lv AS (SELECT topic_id, prerequisite_id, CASE WHEN num % 6 = 0 THEN 'reviewed' ELSE 'machine' END AS st, num % 11 = 0 AS held,
  {print_sql("CASE WHEN num % 13 = 0 THEN reason || '!' ELSE reason END")} AS fp FROM packet_edges WHERE num % 7 <> 0),
ap AS (SELECT p.topic_id, p.prerequisite_id, CASE WHEN lv.st IS NULL THEN 'missing-edge' WHEN st <> 'machine' THEN 'not-machine' WHEN held THEN 'quarantined' WHEN fp <> content_fingerprint THEN 'stale-fingerprint' END AS conflict,
  p.resolved_strength, p.reviewed_by FROM pp p LEFT JOIN lv ON lv.topic_id = p.topic_id AND lv.prerequisite_id = p.prerequisite_id)"""


def live_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    num = F.col("num")
    return src.packet_edges(spark, sf_dir).where(num % 7 != 0).select(
        "topic_id", "prerequisite_id", "strength",
        F.when(num % 13 == 0, F.concat("reason", F.lit("!"))).otherwise(F.col("reason")).alias("reason"),
        F.when(num % 6 == 0, "reviewed").otherwise("machine").alias("review_status"),
        F.when(num % 11 == 0, True).alias("rescope_required"),
    )


@query(
    "c7_apply_proposals",
    with_views("packet_edges", "raw_votes") + PROPOSE_SQL + LIVE_SQL
    + """
SELECT topic_id, prerequisite_id, conflict, CASE WHEN conflict IS NULL THEN 'reviewed' END AS review_status, CASE WHEN conflict IS NULL THEN resolved_strength END AS strength,
  CASE WHEN conflict IS NULL THEN 'ai-consensus' END AS review_provenance, CASE WHEN conflict IS NULL THEN reviewed_by END AS reviewed_by FROM ap""",
)
def apply_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.apply_proposals(live_edges(spark, sf_dir), proposals(spark, sf_dir), PRINT_COLS)


@query(
    "c7_context_drift",
    with_views("packet_edges", "raw_votes") + PROPOSE_SQL
    + """
, en AS (SELECT packet_id, topic_id AS id, 'topic' AS "end" FROM pp UNION SELECT packet_id, prerequisite_id, 'prerequisite' FROM pp)
SELECT en.* FROM en LEFT JOIN part ON p_partkey = CAST(substr(id, 5) AS BIGINT) WHERE p_partkey IS NULL OR p_size > 45""",
)
def context_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = proposals(spark, sf_dir)
    topics = src.topics(spark, sf_dir).select("id", "name", "age_start")
    then = topics.withColumn("name", F.when(F.col("age_start") > 45, F.concat("name", F.lit(" v1"))).otherwise(F.col("name")))
    ends = found.select("packet_id", F.explode(F.array("topic_id", "prerequisite_id")).alias("id")).distinct()
    return ops.context_drift(found, ends.join(then, "id"), topics, ["id", "name"])


PUBLISH_SQL = PROPOSE_SQL + """
, pu AS (SELECT p.*, CAST(substr(p.prerequisite_id, 5) AS BIGINT) AS num, e.strength AS before FROM pp p JOIN packet_edges e ON e.packet_id = p.packet_id AND e.topic_id = p.topic_id AND e.prerequisite_id = p.prerequisite_id)"""
PROBLEM_SQL = """
SELECT topic_id, prerequisite_id, CASE WHEN num % 10 = 1 THEN 'foreign-evidence' WHEN num % 10 = 2 THEN 'legacy-with-evidence' WHEN num % 10 = 3 THEN 'unknown-reviewer' WHEN num % 10 = 4 THEN 'no-complete-evidence'
  WHEN num % 10 = 5 THEN 'no-unanimous-proposal' WHEN num % 10 = 6 THEN 'field-mismatch' WHEN num % 10 = 7 THEN 'preimage-mismatch' END AS problem FROM pu WHERE num % 10 BETWEEN 1 AND 7"""


@query("c8_publish_problems", with_views("packet_edges", "raw_votes") + PUBLISH_SQL + PROBLEM_SQL)
def publish_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applied proposals in which every tenth edge carries one kind of damage."""
    found = proposals(spark, sf_dir)
    before = src.packet_edges(spark, sf_dir).select(*ops.PACKET_KEY, F.col("strength").alias("before"), "reason", "num")
    wide = found.join(before, ops.PACKET_KEY)
    rest = F.col("num") % 10
    ref = F.concat(F.lit("consensus/"), "packet_id")
    edges = wide.select(
        "topic_id", "prerequisite_id", "before",
        F.when(rest == 6, "other").otherwise(F.col("resolved_strength")).alias("strength"),
        F.when(rest == 7, F.concat("reason", F.lit("?"))).otherwise(F.col("reason")).alias("reason"),
        F.lit("reviewed").alias("review_status"),
        F.when(rest == 1, "human").otherwise("ai-consensus").alias("review_provenance"),
        F.when(rest == 2, "legacy").when(rest == 3, "someone").otherwise(F.col("reviewed_by")).alias("reviewed_by"),
        F.lit("2024-01-01").alias("reviewed_at"),
        F.when(rest == 4, F.concat(ref, F.lit("-gone"))).otherwise(ref).alias("review_evidence_ref"),
    )
    evidence = wide.select(
        ref.alias("evidence_ref"), "topic_id", "prerequisite_id", F.lit(True).alias("complete"),
        F.when(rest == 5, "disagreement").otherwise("unanimous-reviewed").alias("consensus"),
        "resolved_strength", "reviewed_by", F.lit("2024-01-01").alias("reviewed_at"), "content_fingerprint",
    )
    preimage = F.sha2(
        F.to_json(F.struct("prerequisite_id", "reason", F.col("before").alias("strength"), "topic_id")), 256
    )
    return ops.publish_problems(edges, evidence, "legacy", "consensus/", preimage)
