"""Exports of the published graph, content manifests, review packets and snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType

from stepstone.functions.columns import exact_text, fingerprint, row_digest, stable_uuid
from stepstone.operators.merge import EDGE_KEY, PUBLISHED_EDGE, require_none

# Properties of exported nodes.
NODE_PROPERTIES = (
    "name", "subject", "domain", "age_start", "age_end", "type", "node_kind", "centrality", "translation_status",
    "standards", "description",
)


def _json(df: DataFrame, allowed: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in allowed if c in df.columns]), {"ignoreNullFields": "true"})


def node_rows(topics: DataFrame, local_prefix: str = "mtc_") -> DataFrame:
    origin = F.when(F.col("id").startswith(local_prefix), "LocalOrigin").otherwise("Upstream")
    return topics.select("id", F.array(F.lit("MicroTopic"), origin).alias("labels"), _json(topics, NODE_PROPERTIES).alias("properties"))


def relationship_rows(edges: DataFrame) -> DataFrame:
    return edges.select(
        F.lit("PREREQUISITE_OF").alias("type"), F.col("prerequisite_id").alias("from"), F.col("topic_id").alias("to"),
        _json(edges, PUBLISHED_EDGE).alias("properties"),
    )


def export_manifest(nodes: DataFrame, relationships: DataFrame, version: str, generated_at: str) -> DataFrame:
    total = relationships.agg(F.count("*")).scalar()
    return nodes.agg(F.count("*").alias("nodes")).select(
        F.lit(version).alias("version"), F.lit(generated_at).alias("generated_at"), "nodes", total.alias("relationships")
    )


def write_sorted(df: DataFrame, path: str, *order: str) -> None:
    """JSON lines in key order over many files; null fields are left out."""
    df.orderBy(*order).write.json(path)


def competency_items(topics: DataFrame, base_url: str, generated_at: str) -> DataFrame:
    """Competency items with deterministic identifiers; absent values stay null and are not written."""
    return topics.select(
        stable_uuid(F.concat(F.lit("item:"), "id")).alias("identifier"),
        F.col("name").alias("fullStatement"),
        F.coalesce("node_kind", F.lit("Competency")).alias("CFItemType"),
        uri(base_url, "items", F.col("id")).alias("uri"),
        F.col("id").alias("humanCodingScheme"),
        F.when(F.col("subject").isNotNull(), F.array("subject")).alias("subject"),
        F.when(F.col("age_start").isNotNull(), F.array(F.concat(F.lit("age-"), "age_start"))).alias("educationLevel"),
        F.lit(generated_at).alias("lastChangeDateTime"),
    )


def uri(base_url: str, kind: str, id: Column) -> Column:
    return F.concat(F.lit(f"{base_url.rstrip('/')}/case/{kind}/"), F.url_encode(id))


def competency_associations(edges: DataFrame, topics: DataFrame, base_url: str, generated_at: str) -> DataFrame:
    """``precedes`` associations; an edge with an unknown end stops the export."""
    t = topics.select(F.col("id").alias("topic_id"), F.col("name").alias("_t"))
    p = topics.select(F.col("id").alias("prerequisite_id"), F.col("name").alias("_p"))
    wide = edges.join(t, "topic_id", "left").join(p, "prerequisite_id", "left")
    ends = topics.select("id")
    missing = edges.join(ends, F.col("topic_id") == F.col("id"), "left_anti").select(*EDGE_KEY).union(
        edges.join(ends, F.col("prerequisite_id") == F.col("id"), "left_anti").select(*EDGE_KEY)
    )
    require_none(missing, "published edge without topic")
    key = F.concat_ws("->", "prerequisite_id", "topic_id")

    def node(id: str, title: str) -> Column:
        return F.struct(
            stable_uuid(F.concat(F.lit("item:"), id)).alias("identifier"), uri(base_url, "items", F.col(id)).alias("uri"), F.col(title).alias("title")
        )

    return wide.select(
        stable_uuid(F.concat(F.lit("association:"), key)).alias("identifier"),
        F.lit("precedes").alias("associationType"),
        uri(base_url, "associations", key).alias("uri"),
        node("prerequisite_id", "_p").alias("originNodeURI"),
        node("topic_id", "_t").alias("destinationNodeURI"),
        F.lit(generated_at).alias("lastChangeDateTime"),
        F.when(F.col("reason") != "", F.col("reason")).alias("notes"),
    )


def _content(name: str, kind: DataType) -> Column:
    """A column for digests; floating-point numbers in a text that does not differ between engines."""
    value = F.col(name)
    if isinstance(kind, (FloatType, DoubleType)):
        return exact_text(value)
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, (FloatType, DoubleType)):
        numbers = F.transform(value, lambda x: F.coalesce(exact_text(x), F.lit("~")))
        return F.when(value.isNotNull(), F.concat_ws(",", numbers))
    return value


def content_manifest(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count and order-independent content digest per table."""
    parts = [
        df.agg(F.lit(name).alias("table"), F.count("*").alias("rows"), F.coalesce(F.sum(row_digest(*(_content(f.name, f.dataType) for f in df.schema))), F.lit(0)).cast("string").alias("digest"))
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def manifest_problems(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Tables whose stored digest differs or that are on one side only."""
    a = stored.select("table", F.col("digest").alias("_stored"))
    b = current.select("table", F.col("digest").alias("_now"))
    return a.join(b, "table", "full_outer").where(~F.col("_stored").eqNullSafe(F.col("_now"))).select(
        F.lit("content").alias("rule"), F.col("table").alias("key")
    )


def review_packet(
    edges: DataFrame, topics: DataFrame, fingerprint_cols: Sequence[str], offset: int, limit: int,
    subject: str | None = None, domain: str | None = None,
) -> DataFrame:
    """Page of unreviewed, unflagged edges in key order with both contexts, fingerprint and total."""
    t = topics.select(F.col("id").alias("topic_id"), F.col("name").alias("topic_name"), F.col("subject").alias("_s"), F.col("domain").alias("_d"))
    p = topics.select(F.col("id").alias("prerequisite_id"), F.col("name").alias("prerequisite_name"))
    flags = [c for c in ("age_regression", "previous_review_status") if c in edges.columns]
    machine = edges.where((F.coalesce("review_status", F.lit("machine")) == "machine") & ~F.coalesce("rescope_required", F.lit(False)))
    for flag in flags:
        machine = machine.where(F.col(flag).isNull())
    chosen = machine.join(t, "topic_id", "left")
    for col, value in (("_s", subject), ("_d", domain)):
        if value is not None:
            chosen = chosen.where(F.col(col) == value)
    total = chosen.agg(F.count("*")).scalar()
    page = chosen.orderBy(*EDGE_KEY).offset(offset).limit(limit).join(p, "prerequisite_id", "left")
    return page.select(
        *EDGE_KEY, "strength", "reason", fingerprint(*fingerprint_cols).alias("content_fingerprint"),
        "topic_name", "prerequisite_name", total.alias("total"),
    )


def create_snapshot(df: DataFrame, root: str, table: str, label: str) -> str:
    path = f"{root}/{table}/label={label}"
    df.write.parquet(path)
    return path


def list_snapshots(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows per label; counts come from the file footers."""
    return spark.read.parquet(f"{root}/{table}").groupBy("label").agg(F.count("*").alias("rows"))


def diff_snapshots(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Added, removed, changed and unchanged row counts between two states of a table."""
    rest = sorted(c for c in before.columns if c not in key)
    a = before.select(*key, F.xxhash64(*rest).alias("_a"))
    b = after.select(*key, F.xxhash64(*rest).alias("_b"))
    change = (
        F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed")
        .when(F.col("_a") != F.col("_b"), "changed").otherwise("unchanged")
    )
    return a.join(b, list(key), "full_outer").groupBy(change.alias("change")).agg(F.count("*").alias("n"))


