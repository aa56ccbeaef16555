"""Overlay merges of structure tables with text tables, and the published graph."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EDGE_KEY = ["topic_id", "prerequisite_id"]

# Columns that may leave the system.
PUBLISHED_TOPIC = (
    "id", "name", "description", "subject", "domain", "age_start", "age_end", "type", "node_kind",
    "centrality", "translation_status", "standards", "evidence", "assessment_prompt", "translated",
    "subject_label", "domain_label",
)
PUBLISHED_EDGE = ("strength", "reason", "review_status", "review_provenance", "reviewer_role")


def require_none(df: DataFrame, message: str) -> None:
    """Stop when ``df`` has a row; only one key reaches the driver."""
    first = df.limit(1).collect()
    if first:
        raise ValueError(f"{message}: {first[0].asDict()}")


def merge_topics(structure: DataFrame, overlay: DataFrame, local: DataFrame | None = None) -> DataFrame:
    """Structure rows with overlay text on top; rows of one side only are untranslated or orphaned."""
    up, zh = structure.alias("up"), overlay.alias("zh")
    text = {"name", "description"}
    both = F.col("up.id").isNotNull() & F.col("zh.id").isNotNull()
    only_structure = F.col("zh.id").isNull()
    keep = [c for c in structure.columns if c not in text | {"id"}]
    merged = up.join(zh, F.col("up.id") == F.col("zh.id"), "full_outer").select(
        F.coalesce("up.id", "zh.id").alias("id"),
        F.when(only_structure, F.col("up.name")).otherwise(F.col("zh.name")).alias("name"),
        F.when(only_structure, F.col("up.description") if "description" in structure.columns else F.lit(None))
        .otherwise(F.col("zh.description")).alias("description"),
        *[F.col(f"up.{c}").alias(c) for c in keep],
        F.when(only_structure, "untranslated")
        .when(both, F.coalesce("zh.translation_status", F.lit("untranslated")))
        .otherwise(F.col("zh.translation_status"))
        .alias("translation_status"),
        (~only_structure).alias("translated"),
        F.col("up.id").isNull().alias("orphaned"),
        F.lit(False).alias("local_origin"),
    )
    if local is None:
        return merged
    known = structure.select("id").union(overlay.select("id"))
    require_none(local.join(known, "id", "left_semi").select("id"), "local topic id is already taken")
    own = local.select(
        "*",
        F.lit("local-origin").alias("translation_status"),
        F.lit(True).alias("translated"),
        F.lit(False).alias("orphaned"),
        F.lit(True).alias("local_origin"),
    )
    return merged.unionByName(own, allowMissingColumns=True)


def merge_edges(
    upstream: DataFrame | None, overlay: DataFrame, *own: DataFrame
) -> DataFrame:
    """Stamp upstream edges as published and take the overlay reason whenever an entry exists."""
    stamp = {"review_status": F.lit("reviewed"), "review_provenance": F.lit("upstream")}
    if upstream is None:
        merged = overlay.withColumns(stamp)
    else:
        entry = overlay.select(*EDGE_KEY, F.col("reason").alias("_reason"), F.lit(True).alias("_entry"))
        merged = (
            upstream.join(entry, EDGE_KEY, "left")
            .withColumn("reason", F.when(F.col("_entry"), F.col("_reason")).otherwise(F.col("reason")))
            .drop("_reason", "_entry")
            .withColumns(stamp)
        )
    for extra in own:
        merged = merged.unionByName(extra, allowMissingColumns=True)
    return merged


def merge_clusters(upstream: DataFrame, overlay: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cluster text from the overlay where the composite key exists, else the upstream text."""
    zh = overlay.select(*keys, F.col("summary").alias("_summary"), F.lit(True).alias("_hit"))
    return (
        upstream.join(zh, list(keys), "left")
        .withColumn("summary", F.when(F.col("_hit"), F.col("_summary")).otherwise(F.col("summary")))
        .withColumn("translated", F.coalesce("_hit", F.lit(False)))
        .drop("_summary", "_hit")
    )


def build_clusters(
    upstream: DataFrame, existing: DataFrame, generated: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Keep existing text, fill from generated text, drop orphans; a key with neither is an error."""
    old = existing.select(*keys, F.col("summary").alias("_old"))
    new = generated.select(*keys, F.col("summary").alias("_new"))
    filled = (
        upstream.select(*keys)
        .join(old, list(keys), "left")
        .join(new, list(keys), "left")
        .select(
            *keys,
            F.coalesce("_old", "_new").alias("summary"),
            F.when(F.col("_old").isNotNull(), "existing").otherwise("generated").alias("text_source"),
        )
    )
    require_none(filled.where("summary IS NULL").select(*keys), "cluster without text")
    return filled


def label_topics(topics: DataFrame, subjects: Mapping[str, str], domains: Mapping[str, str]) -> DataFrame:
    """Labels from the subject map and the "subject / domain" map, falling back to the raw value."""

    def lookup(mapping: Mapping[str, str], key: F.Column) -> F.Column:
        if not mapping:
            return F.lit(None).cast("string")
        flat = [F.lit(x) for pair in mapping.items() for x in pair]
        return F.element_at(F.create_map(*flat), key)

    pair = F.concat_ws(" / ", "subject", "domain")
    return topics.withColumns(
        {
            "subject_label": F.coalesce(lookup(subjects, F.col("subject")), F.col("subject")),
            "domain_label": F.coalesce(lookup(domains, pair), F.col("domain")),
        }
    )


def published_topics(topics: DataFrame) -> DataFrame:
    return topics.where(~F.col("status").eqNullSafe("covered"))


def published_edges(edges: DataFrame) -> DataFrame:
    return edges.where(
        (F.col("review_status") == "reviewed") & ~F.coalesce(F.col("rescope_required"), F.lit(False))
    )


def published_graph(topics: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Published topics, and published edges with both ends among them."""
    nodes = published_topics(topics)
    ids = nodes.select("id")
    kept = (
        published_edges(edges)
        .join(ids, F.col("topic_id") == F.col("id"), "left_semi")
        .join(ids, F.col("prerequisite_id") == F.col("id"), "left_semi")
    )
    return nodes, kept


def public_topic(topics: DataFrame) -> DataFrame:
    return topics.select(*[c for c in PUBLISHED_TOPIC if c in topics.columns])


def public_edge(edges: DataFrame) -> DataFrame:
    return edges.select(*EDGE_KEY, *[c for c in PUBLISHED_EDGE if c in edges.columns])


def cross_subject(edges: DataFrame, topics: DataFrame) -> DataFrame:
    """Edges with both subjects known, flagged when the subjects differ."""
    t = topics.select(F.col("id").alias("topic_id"), F.col("subject").alias("topic_subject"))
    p = topics.select(F.col("id").alias("prerequisite_id"), F.col("subject").alias("prerequisite_subject"))
    return (
        edges.join(t, "topic_id")
        .join(p, "prerequisite_id")
        .where(F.col("topic_subject").isNotNull() & F.col("prerequisite_subject").isNotNull())
        .withColumn("cross_subject", F.col("topic_subject") != F.col("prerequisite_subject"))
    )


def path_edge(edges: DataFrame, topics: DataFrame) -> DataFrame:
    """Compact edge: from, to, reason, cross flag, provenance, role."""
    wide = cross_subject(edges, topics)
    optional = {
        c: (F.col(c) if c in edges.columns else F.lit(None).cast("string"))
        for c in ("review_provenance", "reviewer_role")
    }
    return wide.select(
        F.col("prerequisite_id").alias("f"),
        F.col("topic_id").alias("t"),
        F.coalesce("reason", F.lit("")).alias("r"),
        F.col("cross_subject").cast("int").alias("x"),
        optional["review_provenance"].alias("p"),
        optional["reviewer_role"].alias("q"),
    )
