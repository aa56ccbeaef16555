"""Data-quality rules: every rule is a DataFrame of (rule, key); a table passes when all are empty."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepstone.functions.columns import review_state
from stepstone.operators.merge import EDGE_KEY
from stepstone.operators.ordering import with_position

# Closed value lists.
TOPIC_TYPES = ("CONCEPTUAL", "PROCEDURAL", "REPRESENTATIONAL", "LANGUAGE", "META")
NODE_KINDS = ("concept", "text", "skill")
ORIGINS = ("cn_only", "cross_domain", "upstream_adapt", "progression", "textbook")
STRENGTHS = ("hard", "soft")
PROVENANCES = ("upstream", "rule", "ai-consensus", "human")
ROLES = ("curator", "teacher")
ASSOCIATION_TYPES = (
    "isChildOf", "isPeerOf", "isPartOf", "exactMatchOf", "precedes", "isRelatedTo", "replacedBy", "exemplar",
    "hasSkillLevel", "isTranslationOf",
)
TRANSLATION_STATES = ("machine", "reviewed")
UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"


def edge_key() -> Column:
    return F.concat_ws("->", *EDGE_KEY)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """The violations of many rules as one table."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def check_rows(rows: DataFrame, key: Column, rules: Mapping[str, Column]) -> DataFrame:
    """All row rules of one table in a single pass; a rule names its broken condition, null is unbroken."""
    checks = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.coalesce(broken, F.lit(False)).alias("broken")) for name, broken in rules.items()
    ])
    return rows.select(key.alias("key"), F.inline(checks)).where("broken").select("rule", "key")


def outside(col: str | Column, values: Sequence[str]) -> Column:
    """Broken when the value is null or not in the list."""
    col = F.col(col) if isinstance(col, str) else col
    return ~F.coalesce(col.isin(*values), F.lit(False))


def outside_if_set(col: str, values: Sequence[str]) -> Column:
    return F.col(col).isNotNull() & outside(col, values)


def blank(col: str) -> Column:
    return F.coalesce(F.col(col) == "", F.lit(True))


def declared_counts(headers: DataFrame, actual: DataFrame) -> DataFrame:
    """Documents whose declared count differs from their rows; ``headers`` (key, declared), ``actual`` (key, n)."""
    both = headers.join(actual, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return both.where("declared <> n").select(F.lit("declared-count").alias("rule"), "key")


def id_pattern(rows: DataFrame, col: str, pattern: str, rule: str) -> DataFrame:
    return check_rows(rows, F.coalesce(F.col(col), F.lit("")), {rule: ~F.coalesce(F.col(col).rlike(pattern), F.lit(False))})


def duplicates(rows: DataFrame, key: Sequence[str], rule: str) -> DataFrame:
    return rows.groupBy(*key).count().where("count > 1").select(F.lit(rule).alias("rule"), F.concat_ws("->", *key).alias("key"))


def dangling(refs: DataFrame, ref: str, known: DataFrame, known_col: str, rule: str, key: Column | None = None) -> DataFrame:
    """References with no target."""
    targets = known.select(F.col(known_col).alias(ref))
    out = refs.where(F.col(ref).isNotNull()).join(targets, ref, "left_anti")
    return out.select(F.lit(rule).alias("rule"), (key if key is not None else F.col(ref)).alias("key"))


def cluster_problems(overlay: DataFrame, structure: DataFrame, key: Sequence[str] = ("subject", "domain", "age_start")) -> DataFrame:
    """Overlay clusters without a counterpart, doubled ones, and translation states that are set to no known one.

    Both tables have the ``key`` columns, ``overlay`` also ``translation_status``.  Clusters meet by the whole key; a null in it equals
    no other, so such a cluster has no counterpart.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key])
    unknown = overlay.join(structure.select(*key), list(key), "left_anti").select(F.lit("unknown-cluster").alias("rule"), text.alias("key"))
    doubled = overlay.groupBy(*key).count().where("count > 1").select(F.lit("duplicate-cluster").alias("rule"), text.alias("key"))
    states = check_rows(overlay, text, {"translation-status": outside_if_set("translation_status", TRANSLATION_STATES)})
    return union_all([unknown, doubled, states])


def end_patterns(edges: DataFrame, topic_pattern: str, prerequisite_pattern: str) -> DataFrame:
    """Edges with an end that is missing or not named by its pattern."""
    def odd(col: str, pattern: str) -> Column:
        return ~F.coalesce(F.col(col).rlike(pattern), F.lit(False))

    key = F.concat_ws("->", *[F.coalesce(c, F.lit("")) for c in EDGE_KEY])
    return check_rows(edges, key, {"topic-end": odd("topic_id", topic_pattern), "prerequisite-end": odd("prerequisite_id", prerequisite_pattern)})


def unknown_items(rows: DataFrame, items: str, known: DataFrame, known_col: str, rule: str, id: str = "id") -> DataFrame:
    """Items of an array column with no target, keyed by the row's id and the item; an item named twice in a row is one."""
    refs = rows.select(F.col(id).alias("_id"), F.explode(F.array_distinct(items)).alias("_item"))
    return dangling(refs, "_item", known.select(F.col(known_col).alias("_known")), "_known", rule, F.concat_ws(":", "_id", "_item")).distinct()


def reference_problems(topics: DataFrame, edges: DataFrame, entries: DataFrame, batches: DataFrame) -> DataFrame:
    """References of topics and edges that name nothing: standards, topics that cover a covered one, and generation batches.

    ``topics`` (id, status, standards, covered_by), ``edges`` (topic_id, prerequisite_id, generation_batch_id), ``entries`` (key),
    ``batches`` (id).  Null lists and batches name nothing and break no rule; a null inside a list is passed over.
    """
    covered = topics.where(F.col("status") == "covered")
    return union_all([
        unknown_items(topics, "standards", entries, "key", "unknown-standard"),
        unknown_items(covered, "covered_by", topics, "id", "unknown-cover"),
        dangling(edges, "generation_batch_id", batches, "id", "unknown-batch", edge_key()),
    ])


def first_and_rest(violations: DataFrame, show: int = 5) -> DataFrame:
    """The first ``show`` rows of each rule and one row saying how many more there are."""
    totals = violations.groupBy("rule").agg(F.count("*").alias("n"))
    few = with_position(violations, ["rule"], ["key"]).where(F.col("pos") <= show)
    rest = totals.where(F.col("n") > show).select("rule", F.concat(F.lit("and "), F.col("n") - show, F.lit(" more")).alias("key"))
    return few.select("rule", "key").union(rest)


def paired_lengths(rows: DataFrame, paired: DataFrame, col: str) -> DataFrame:
    other = paired.select("id", F.size(col).alias("_n"))
    return rows.join(other, "id").where(F.size(col) != F.col("_n")).select(F.lit("paired-length").alias("rule"), F.col("id").alias("key"))


def codes_only(curricula: DataFrame, entries: DataFrame, registered: DataFrame) -> DataFrame:
    """Sources that may hold codes only: flag false, slug registered, key built from the code, no text."""
    flags = check_rows(curricula, F.col("slug"), {"text-included": ~F.col("text_included").eqNullSafe(False)})
    unknown = dangling(curricula, "slug", registered, "slug", "unregistered-source")
    keys = check_rows(
        entries, F.col("key"),
        {"standard-key": F.col("key") != F.concat_ws(":", "slug", "code"), "text-payload": F.col("payload").isNotNull()},
    )
    return union_all([flags, unknown, keys])


def topic_rules() -> dict[str, Column]:
    """Value lists, filled texts, ages and centrality of topic rows."""
    return {
        "type": outside("type", TOPIC_TYPES),
        "node-kind": outside_if_set("node_kind", NODE_KINDS),
        "origin": outside("origin", ORIGINS),
        "subject": blank("subject"),
        "domain": blank("domain"),
        "description": blank("description"),
        "evidence": F.coalesce(F.size("evidence") == 0, F.lit(True)),
        "age-missing": F.col("age_start").isNull() | F.col("age_end").isNull(),
        "age-order": F.col("age_start") > F.col("age_end"),
        "centrality-range": ~F.col("centrality").between(0.0, 1.0),
        "covered-by": (F.col("status") == "covered") & ~F.coalesce(F.size("covered_by") >= 2, F.lit(False)),
    }


def edge_rules(publish: bool = False) -> dict[str, Column]:
    """Strength, self loops, review state, audit fields and provenance of edge rows."""
    state = review_state("review_status")
    flag = F.coalesce("rescope_required", F.lit(False))
    final = F.coalesce("review_status", F.lit("machine")).isin("reviewed", "rejected")
    prov, by, at = F.col("review_provenance"), F.col("reviewed_by"), F.col("reviewed_at")
    audit = by.isNotNull() | at.isNotNull() | F.col("review_note").isNotNull()
    signed = F.coalesce(F.length(by) > 0, F.lit(False)) & F.coalesce(F.length(at) > 0, F.lit(False))
    rules = {
        "self-edge": F.col("topic_id") == F.col("prerequisite_id"),
        "strength": outside("strength", STRENGTHS),
        "review-status": outside_if_set("review_status", ("machine", "reviewed", "rejected")),
        "reviewed-with-rescope": (F.col("review_status") == "reviewed") & flag,
        "rescope-not-machine": flag & (state != "machine"),
        "rescope-without-batch": flag & blank("rescope_batch_id"),
        "previous-without-rescope": F.col("previous_review_status").isNotNull()
        & ~(F.col("previous_review_status").eqNullSafe("reviewed") & flag),
        "audit-incomplete": audit & ~(final & signed),
        "provenance": outside_if_set("review_provenance", PROVENANCES),
        "provenance-upstream": prov == "upstream",
        "provenance-not-final": prov.isNotNull() & ~final,
        "provenance-reviewer": prov.isNotNull() & ((prov == "rule") != by.isNull()),
        "provenance-unsigned": prov.isin("human", "ai-consensus") & ~signed,
    }
    if publish:
        rules["provenance-missing"] = final & prov.isNull()
    return rules


def reviewer_rules() -> dict[str, Column]:
    """Public reviewer roles: known, of human decisions only, teachers with rubric and reference."""
    role = F.col("reviewer_role")
    return {
        "role": outside_if_set("reviewer_role", ROLES),
        "role-not-human": role.isNotNull() & ~F.col("review_provenance").eqNullSafe("human"),
        "teacher-rubric": (role == "teacher") & blank("review_rubric"),
        "teacher-reference": (role == "teacher") & blank("review_evidence_ref"),
    }


def age_flag_rule() -> dict[str, Column]:
    """Flagged age regressions that the topics do not bear out; rows come from ``with_ends``."""
    held = (
        (review_state("review_status") == "machine")
        & F.col("t_stage").eqNullSafe(F.col("p_stage"))
        & F.coalesce(F.col("p_age") > F.col("t_age"), F.lit(False))
    )
    return {"age-regression": F.coalesce("age_regression", F.lit(False)) & ~held}


def unaligned_clusters(clusters: DataFrame, upstream: DataFrame, key: Sequence[str]) -> DataFrame:
    out = clusters.select(*key).join(upstream.select(*key), list(key), "left_anti")
    return out.select(F.lit("cluster-unknown").alias("rule"), F.concat_ws("|", *key).alias("key"))


def unknown_fields(raw: DataFrame, id_col: str, json_col: str, allowed: Sequence[str]) -> DataFrame:
    """Fields of raw JSON rows outside the closed list, one row each."""
    extra = F.array_except(F.json_object_keys(json_col), F.array(*map(F.lit, allowed)))
    found = raw.select(F.col(id_col).alias("_id"), F.explode(extra).alias("_field"))
    return found.select(F.lit("unknown-field").alias("rule"), F.concat_ws(".", "_id", "_field").alias("key"))


def version_mismatch(headers: DataFrame, upstream: DataFrame) -> DataFrame:
    """Overlay documents (key, version) made for another upstream version."""
    now = upstream.select(F.col("version").alias("_v"))
    return headers.join(now, F.col("version") == F.col("_v"), "left_anti").select(F.lit("version").alias("rule"), "key")


def metric_drift(documented: DataFrame, measured: DataFrame) -> DataFrame:
    """Documented numbers (metric, value) that differ from the measured ones or have none."""
    now = measured.select("metric", F.col("value").alias("_now"))
    return documented.join(now, "metric", "left").where(~F.col("value").eqNullSafe(F.col("_now"))).select(
        F.lit("metric-drift").alias("rule"), F.col("metric").alias("key")
    )


def publication_problems(edges: DataFrame, bridges: DataFrame, stale: DataFrame) -> DataFrame:
    """Counts that must be zero before publication: flagged edges, flagged bridges, stale centrality."""

    def counted(df: DataFrame, rule: str) -> DataFrame:
        return df.agg(F.count("*").alias("n")).where("n > 0").select(F.lit(rule).alias("rule"), F.col("n").cast("string").alias("key"))

    flag = F.coalesce("rescope_required", F.lit(False))
    return union_all([
        counted(edges.where(flag), "edges-need-rescope"),
        counted(bridges.where(flag), "bridges-need-rescope"),
        counted(stale, "stale-centrality"),
    ])


def package_items() -> dict[str, Column]:
    """Required fields and identifier shape of exported items."""
    return {
        "item-field": F.col("identifier").isNull() | F.col("fullStatement").isNull() | F.col("uri").isNull() | F.col("lastChangeDateTime").isNull(),
        "item-uuid": ~F.col("identifier").rlike(UUID_PATTERN),
    }


def package_associations() -> dict[str, Column]:
    kind = F.col("associationType")
    return {
        "association-field": F.col("identifier").isNull() | kind.isNull() | F.col("uri").isNull() | F.col("originNodeURI").isNull()
        | F.col("destinationNodeURI").isNull() | F.col("lastChangeDateTime").isNull(),
        "association-uuid": ~F.col("identifier").rlike(UUID_PATTERN),
        "association-type": ~(kind.isin(*ASSOCIATION_TYPES) | kind.startswith("ext:")),
        "origin-uuid": ~F.col("originNodeURI.identifier").rlike(UUID_PATTERN),
        "destination-uuid": ~F.col("destinationNodeURI.identifier").rlike(UUID_PATTERN),
    }
