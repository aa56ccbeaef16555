"""Dimension visibility, topic and gap queries, neighbour views and curriculum look-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepstone.operators.merge import published_edges, published_topics
from stepstone.operators.ordering import with_position


@dataclass(frozen=True)
class Dimension:
    """One view rule: everything, or a whitelist by stage (local) and by subject (upstream)."""

    id: str
    whitelist: bool = False
    stage: str | None = None
    include: Sequence[str] = ()
    exclude_domains: Mapping[str, Sequence[str]] = field(default_factory=dict)
    default_stage: str = "primary"

    def visible(self) -> Column:
        local, stage = F.col("local_origin"), F.col("stage")
        if not self.whitelist:
            return ~local
        if self.stage is not None:
            return local & stage.eqNullSafe(self.stage)
        own = stage.isNull() | (stage == self.default_stage)
        upstream = F.col("subject").isin(*self.include) if self.include else F.lit(False)
        for subject, domains in self.exclude_domains.items():
            upstream = upstream | ((F.col("subject") == subject) & ~F.col("domain").isin(*domains))
        return F.coalesce(F.when(local, own).otherwise(upstream), F.lit(False))


def visibility(topics: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Long table (id, dimension, visible); one pass, no join."""
    entries = F.array(*[F.struct(F.lit(d.id).alias("dimension"), d.visible().alias("visible")) for d in dimensions])
    return topics.select("*", F.inline(entries))


def topics_in_dimension(topics: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    return visibility(published_topics(topics), dimensions).where("visible").drop("visible")


def _contains(text: str, *cols: str) -> Column:
    needle = text.lower()
    hit = F.lit(False)
    for c in cols:
        hit = hit | F.coalesce(F.lower(c).contains(needle), F.lit(False))
    return hit


def query_topics(
    topics: DataFrame,
    subject: str | None = None,
    domain: str | None = None,
    age: int | None = None,
    age_range: tuple[int, int] | None = None,
    translated: bool | None = None,
    text: str | None = None,
) -> DataFrame:
    out = topics
    if subject:
        out = out.where(F.col("subject") == subject)
    if domain:
        out = out.where(F.col("domain") == domain)
    if age is not None:
        out = out.where(F.col("age_start") == age)
    if age_range:
        out = out.where(F.col("age_start").between(*age_range))
    if translated is not None:
        out = out.where(F.col("translated") == translated)
    if text:
        out = out.where(_contains(text, "name", "description", "id"))
    return out


def query_gaps(
    gaps: DataFrame,
    stage: str | None = None,
    subject: str | None = None,
    gap_type: str | None = None,
    grade: str | None = None,
    text: str | None = None,
) -> DataFrame:
    out = gaps
    for name, value in (("stage", stage), ("subject", subject), ("gap_type", gap_type), ("grade", grade)):
        if value:
            out = out.where(F.col(name) == value)
    return out.where(_contains(text, "topic", "path", "textbook")) if text else out


def gap_order() -> list[Column]:
    """Missing rows first, then the grade without blanks, then the path."""
    return [
        F.when(F.col("gap_type") == "missing", 0).otherwise(1),
        F.regexp_replace("grade", r"\s", ""),
        F.col("path"),
    ]


def ego_view(topics: DataFrame, edges: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Prerequisites and dependents of every published topic with the neighbour's summary."""
    nodes = published_topics(topics)
    seen = visibility(nodes, dimensions).select(
        F.col("id").alias("neighbour_id"),
        F.col("name").alias("neighbour_name"),
        F.col("subject").alias("neighbour_subject"),
        F.col("age_start").alias("neighbour_age"),
        "dimension",
        "visible",
    )
    own = nodes.select(F.col("id"), F.col("subject"))
    both = published_edges(edges).select(
        F.inline(
            F.array(
                F.struct(
                    F.col("topic_id").alias("id"),
                    F.col("prerequisite_id").alias("neighbour_id"),
                    F.lit("prerequisite").alias("direction"),
                    F.col("strength"),
                ),
                F.struct(
                    F.col("prerequisite_id").alias("id"),
                    F.col("topic_id").alias("neighbour_id"),
                    F.lit("dependent").alias("direction"),
                    F.col("strength"),
                ),
            )
        )
    )
    return both.join(own, "id").join(seen, "neighbour_id")


def ego_groups(ego: DataFrame) -> DataFrame:
    """Neighbours numbered by age within (topic, direction, cross or same subject), with the count."""
    keys = ["id", "dimension", "direction", "is_cross"]
    wide = ego.withColumn("is_cross", F.col("subject") != F.col("neighbour_subject"))
    counts = wide.groupBy(*keys).agg(F.count("*").alias("in_group"))
    ranked = with_position(wide, keys, ["neighbour_age", "neighbour_id"], "rank")
    return ranked.join(counts, keys)


def flatten_curricula(curricula: DataFrame) -> DataFrame:
    return curricula.select("slug", F.inline("topics"))


def standards_of(topics: DataFrame, flat: DataFrame, missing_note: str = "(not listed)") -> DataFrame:
    """One row per referenced standard key; unknown keys carry a default note."""
    refs = topics.select("id", F.explode("standards").alias("key"))
    known = flat.select("key", "code", "note")
    return refs.join(known, "key", "left").select(
        "id", "key", "code", F.coalesce("note", F.lit(missing_note)).alias("note")
    )
