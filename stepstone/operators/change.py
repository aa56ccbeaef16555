"""Set-based changes of topic and edge tables: splits, rescopes, migrations, decisions and diffs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepstone.functions.columns import all_of, conjunction_split, normalised_name
from stepstone.operators.cycles import age_regression, with_ends
from stepstone.operators.dedupe import allocate_ids
from stepstone.operators.merge import EDGE_KEY, require_none
from stepstone.operators.stats import degrees

MAX_MINUTES, MIN_CHILDREN, MAX_CHILDREN = 45, 2, 5
SPLIT_GRANULARITY = "split-45min"
RELATIONS = "struct<relations:array<struct<topicId:string,prerequisiteId:string,type:string,strength:string,confidence:double,reason:string>>>"


def map_column(column: str, mapping: Mapping[str, str]) -> Column:
    flat = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*flat), F.col(column)), F.col(column))


def normalise_domains(topics: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Domains through a mapping; ``from_value`` keeps the old one where it changed."""
    new = map_column("domain", mapping)
    return topics.withColumns({"domain": new, "from_value": F.when(new != F.col("domain"), F.col("domain"))})


def migrate_labels(labels: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Labels (subject, domain, label) moved to the mapped domain; an existing target label wins."""
    moved = F.col("domain") != map_column("domain", mapping)
    ranked = labels.select("subject", map_column("domain", mapping).alias("domain"), F.struct(moved.alias("moved"), F.col("domain").alias("was"), "label").alias("v"))
    return ranked.groupBy("subject", "domain").agg(F.min("v").alias("v")).select("subject", "domain", "v.label")


def drop_fragments(topics: DataFrame, names: Sequence[str]) -> DataFrame:
    return topics.where(~F.col("name").isin(*names))


def split_by_mapping(topics: DataFrame, mapping: DataFrame, auto_subject: str | None = None, order: str = "num") -> DataFrame:
    """Split rows in two: part a keeps the id, part b gets a new one and points back.

    ``mapping`` is (id, part_a, part_b); names of ``auto_subject`` without an entry split at their first
    conjunction.
    """
    m = mapping.select("id", "part_a", "part_b")
    wide = topics.join(m, "id", "left")
    if auto_subject is not None:
        own = F.col("subject") == auto_subject
        for part, col in ((1, "part_a"), (2, "part_b")):
            cut_name = conjunction_split("name", part)
            wide = wide.withColumn(col, F.coalesce(col, F.when(own & (cut_name != ""), cut_name)))
    first = wide.withColumns(
        {"name": F.coalesce("part_a", "name"), "split_part": F.when(F.col("part_a").isNotNull(), "a")}
    ).drop("part_a", "part_b")
    second = wide.where("part_b IS NOT NULL").withColumns(
        {"name": F.col("part_b"), "split_from": F.col("id"), "split_part": F.lit("b")}
    ).drop("part_a", "part_b")
    numbered = allocate_ids(second, topics, [order]).withColumn("id", F.col("new_id")).drop("new_id")
    return first.unionByName(numbered)


def _filled(col: Column) -> Column:
    return F.coalesce(F.trim(col) != "", F.lit(False))


def split_problem() -> Column:
    """Why an audit result may not be split, or null: minutes, number of children, then their content."""
    complete = F.forall(
        "children",
        lambda c: _filled(c["name"]) & _filled(c["description"])
        & F.coalesce((c["minutes"] > 0) & (c["minutes"] <= MAX_MINUTES), F.lit(False))
        & (F.size(c["evidence"]) > 0) & F.forall(c["evidence"], _filled),
    )
    many = F.size("children")
    return (
        F.when(~F.coalesce(F.col("minutes") > MAX_MINUTES, F.lit(False)), "parent-too-short")
        .when(F.col("children").isNull() | ~many.between(MIN_CHILDREN, MAX_CHILDREN), "children-count")
        .when(~complete, "children-incomplete")
    )


def audit_actions(results: DataFrame, topics: DataFrame) -> DataFrame:
    """Results with ``action``: covered, split or null.

    Covered needs two other existing topics; a split needs a valid result, a topic not split before,
    distinct child names and no other topic with one of them.
    """
    require_none(results.groupBy("id").count().where("count > 1").select("id"), "duplicate audit result")
    known = topics.select("id", F.coalesce("granularity", F.lit("")).alias("_g"))
    cover = (
        results.where("verdict = 'covered'").select("id", F.explode("covered_by").alias("by")).where("id <> by")
        .join(topics.select(F.col("id").alias("by")), "by", "left_semi")
        .groupBy("id").agg(F.array_sort(F.collect_set("by")).alias("valid_cover"))
    )
    names = topics.groupBy(normalised_name(F.col("name")).alias("child")).agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    children = results.where("verdict = 'split'").select("id", F.explode("children.name").alias("n")).select("id", normalised_name(F.col("n")).alias("child"))
    clash = (
        children.join(names, "child").where((F.col("lo") != F.col("id")) | (F.col("hi") != F.col("id")))
        .select("id").union(children.groupBy("id", "child").count().where("count > 1").select("id"))
        .distinct().withColumn("_clash", F.lit(True))
    )
    wide = results.join(known, "id").join(cover, "id", "left").join(clash, "id", "left")
    action = F.when((F.col("verdict") == "covered") & (F.size("valid_cover") >= 2), "covered").when(
        (F.col("verdict") == "split") & (F.col("_g") != SPLIT_GRANULARITY) & split_problem().isNull() & F.col("_clash").isNull(), "split"
    )
    return wide.withColumn("action", action).drop("_g", "_clash")


#: Fixed value: how an assessment prompt begins; the first evidence follows.
PROMPT_START = "让 {{name}} 展示："


def _of_child(child: Column) -> dict[str, Column]:
    """Fields that a topic takes from a child of its split, and those that the split clears."""
    return {
        "name": F.trim(child["name"]),
        "description": F.trim(child["description"]),
        "evidence": F.transform(child["evidence"], lambda x: F.trim(x)),
        "assessment_prompt": F.concat(F.lit(PROMPT_START), F.trim(child["evidence"][0])),
        "centrality": F.lit(None),
        "granularity": F.lit(SPLIT_GRANULARITY),
        "status": F.lit(None),
        "covered_by": F.lit(None),
    }


def apply_audit(topics: DataFrame, actions: DataFrame) -> DataFrame:
    """Topics after the audit, with the columns they have.

    Covered topics get their status and the topics that cover them.  A split topic becomes its first child: text, evidence
    and prompt are the child's, status, cover and centrality are cleared.  The other children are added with new ids; what a
    child does not have is taken from its parent.  All other topics stay as they are.
    """
    act = actions.where("action IS NOT NULL").select(F.col("id").alias("_id"), F.struct("action", "valid_cover", "children").alias("_audit"))
    wide = topics.join(act, F.col("id") == F.col("_id"), "left")
    split, covered = (F.col("_audit.action") == a for a in ("split", "covered"))
    marked = {"status": F.lit("covered"), "covered_by": F.col("_audit.valid_cover")}

    def field(name: str, child: Column) -> Column:
        own, kind = F.col(name), topics.schema[name].dataType
        taken = _of_child(child).get(name)
        if name in marked:
            own = F.when(covered, marked[name]).otherwise(own)
        return own.alias(name) if taken is None else F.when(split, taken.cast(kind)).otherwise(own).alias(name)

    kept = wide.select(*[field(c, F.col("_audit.children")[0]) for c in topics.columns])
    more = wide.where(split).select("*", F.posexplode("_audit.children").alias("_place", "_child")).where("_place > 0")
    children = more.select(*[field(c, F.col("_child")) for c in topics.columns if c != "split_from"], F.col("id").alias("split_from"), "_place")
    numbered = allocate_ids(children.drop("id"), topics, ["split_from", "_place"])
    return kept.unionByName(numbered.withColumnRenamed("new_id", "id").select(*kept.columns, *[c for c in ("split_from",) if c not in kept.columns]), allowMissingColumns=True)


def rescope(edges: DataFrame, ids: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Edges touching one of ``ids`` go back to machine state, flagged, keeping a reviewed state in mind."""
    hit = ids.select("id").distinct()
    marked = (
        edges.join(hit.select(F.col("id").alias("topic_id"), F.lit(True).alias("_t")), "topic_id", "left")
        .join(hit.select(F.col("id").alias("prerequisite_id"), F.lit(True).alias("_p")), "prerequisite_id", "left")
    )
    touched = F.coalesce("_t", "_p").isNotNull()
    before = F.col("previous_review_status") if "previous_review_status" in edges.columns else F.lit(None).cast("string")
    batch = F.col("rescope_batch_id") if "rescope_batch_id" in edges.columns else F.lit(None).cast("string")
    return marked.withColumns(
        {
            "previous_review_status": F.when(touched & (F.col("review_status") == "reviewed"), "reviewed").otherwise(before),
            "review_status": F.when(touched, "machine").otherwise(F.col("review_status")),
            "rescope_required": F.when(touched, True).otherwise(F.col("rescope_required")),
            "rescope_batch_id": F.when(touched, F.coalesce(F.lit(batch_id), batch)).otherwise(batch),
        }
    ).drop("_t", "_p")


def reused_parents(topics: DataFrame) -> DataFrame:
    """Parents that kept their id as the first part of a finished split."""
    parents = topics.where(F.col("granularity") == SPLIT_GRANULARITY).select("id")
    return topics.where("split_from IS NOT NULL").select(F.col("split_from").alias("id")).distinct().join(parents, "id", "left_semi")


def safety_migration(
    topics: DataFrame, edges: DataFrame, rescope_batch: str, suffix_batch: str | None = None, suffix_from: int | None = None
) -> DataFrame:
    """Rescope edges of reused parents, flag age regressions of machine edges, and name the batch of
    machine edges at or after ``suffix_from`` in the explicit ``position`` column."""
    moved = rescope(edges, reused_parents(topics), rescope_batch)
    flagged = with_ends(moved, topics).withColumn("age_regression", (F.col("review_status") == "machine") & age_regression())
    out = flagged.drop("t_stage", "t_age", "t_known", "p_stage", "p_age", "p_known")
    if suffix_from is None:
        return out
    batch = F.col("generation_batch_id") if "generation_batch_id" in edges.columns else F.lit(None).cast("string")
    late = (F.col("position") >= suffix_from) & (F.col("review_status") == "machine") & batch.isNull()
    return out.withColumn("generation_batch_id", F.when(late, suffix_batch).otherwise(batch))


def provenance_migration(edges: DataFrame, consensus_reviewer: str, curation_reviewer: str, curated_at: str) -> DataFrame:
    """Provenance from (status, reviewer, is_bridge) with the bucket, or the error the row raises.

    Rows that already carry a valid provenance stay as they are, so the step can be repeated.
    """
    status = F.coalesce("review_status", F.lit("machine"))
    prov, by, bridge = F.col("review_provenance"), F.col("reviewed_by"), F.col("is_bridge")
    open_row = status.isin("reviewed", "rejected") & prov.isNull()
    error = (
        F.when((status == "machine") & prov.isNotNull(), "machine-with-provenance")
        .when(~status.isin("machine", "reviewed", "rejected"), "unknown-status")
        .when(prov.isNotNull() & ~prov.isin("rule", "ai-consensus", "human"), "unknown-provenance")
        .when(open_row & by.isNotNull() & (by != consensus_reviewer), "unknown-reviewer")
        .when(open_row & by.isNull() & (status == "rejected"), "rejected-without-reviewer")
    )
    bucket = (
        F.when(error.isNotNull(), None)
        .when(status == "machine", "machine")
        .when(prov.isNotNull() & bridge & (prov == "human") & (by == curation_reviewer) & F.col("reviewer_role").isNull(), "human")
        .when(prov.isNotNull(), "already-stamped")
        .when(by == consensus_reviewer, "ai-consensus")
        .when(bridge, "human")
        .otherwise("rule")
    )
    new_bridge = (F.col("bucket") == "human") & prov.isNull()
    return edges.withColumns({"error": error, "bucket": bucket}).withColumns(
        {
            "reviewer_role": F.when(F.col("bucket") == "human", "curator").otherwise(F.col("reviewer_role")),
            "reviewed_by": F.when(new_bridge, curation_reviewer).otherwise(by),
            "reviewed_at": F.when(new_bridge, curated_at).otherwise(F.col("reviewed_at")),
            "review_provenance": F.when(prov.isNull() & F.col("bucket").isin("rule", "human", "ai-consensus"), F.col("bucket")).otherwise(prov),
        }
    )


def decision_problem(evidence_prefix: str) -> Column:
    ref = F.coalesce("evidence_ref", F.lit(""))
    return (
        F.when(~F.coalesce(F.col("status").isin("reviewed", "rejected"), F.lit(False)), "bad-status")
        .when(~_filled(F.col("reviewer")), "no-reviewer")
        .when(F.coalesce("provenance", F.lit("human")) != "human", "bad-provenance")
        .when(ref.startswith(evidence_prefix), "consensus-evidence")
    )


def review_edges(edges: DataFrame, decisions: DataFrame, evidence_prefix: str = "consensus/") -> DataFrame:
    """Edges with the latest acceptable human decision per key applied and quarantine columns cleared.

    ``decisions`` has (topic_id, prerequisite_id, status, reviewer, provenance, role, note, evidence_ref, at).
    """
    good = decisions.where(decision_problem(evidence_prefix).isNull())
    last = good.groupBy(*EDGE_KEY).agg(F.max_by(F.struct("status", "reviewer", "role", "note", "at"), "at").alias("d"))
    hit = F.col("d").isNotNull()

    def keep(name: str, kind: str = "string") -> Column:
        return F.col(name) if name in edges.columns else F.lit(None).cast(kind)

    return edges.join(last, EDGE_KEY, "left").withColumns(
        {
            "review_status": F.when(hit, F.col("d.status")).otherwise(F.col("review_status")),
            "reviewed_by": F.when(hit, F.trim("d.reviewer")).otherwise(keep("reviewed_by")),
            "review_note": F.when(hit & _filled(F.col("d.note")), F.trim("d.note")).otherwise(keep("review_note")),
            "review_provenance": F.when(hit, "human").otherwise(keep("review_provenance")),
            "reviewer_role": F.when(hit, F.coalesce("d.role", F.lit("curator"))).otherwise(keep("reviewer_role")),
            "rescope_required": F.when(hit, None).otherwise(keep("rescope_required", "boolean")),
            "previous_review_status": F.when(hit, None).otherwise(keep("previous_review_status")),
            "age_regression": F.when(hit, None).otherwise(keep("age_regression", "boolean")),
        }
    ).drop("d")


def relation_targets(topics: DataFrame, edges: DataFrame, subject: str | None = None, stage: str | None = None) -> DataFrame:
    """Topics that need relations: unlinked split children and reused parents under rescope."""
    flagged = edges.where(F.coalesce("rescope_required", F.lit(False))).select(
        F.explode(F.array("topic_id", "prerequisite_id")).alias("id")
    )
    again = flagged.distinct().join(reused_parents(topics), "id", "left_semi").withColumn("_again", F.lit(True))
    wide = topics.where(~F.col("status").eqNullSafe("covered")).join(degrees(topics, edges).select("id", "degree"), "id").join(again, "id", "left")
    out = wide.where((F.col("split_from").isNotNull() & (F.col("degree") == 0)) | F.col("_again")).drop("_again", "degree")
    for name, value in (("subject", subject), ("stage", stage)):
        if value is not None:
            out = out.where(F.col(name) == value)
    return out


def missing_targets(expected: DataFrame, work: DataFrame) -> DataFrame:
    """Expected ids no work row covers."""
    return expected.select("id").join(work.select("id"), "id", "left_anti")


def own_proposals(work: DataFrame) -> DataFrame:
    """Proposals (id, topic_id, prerequisite_id) that contain the target they were made for."""
    return work.where((F.col("topic_id") == F.col("id")) | (F.col("prerequisite_id") == F.col("id")))


def clean_json(text: str | Column) -> Column:
    """Model answer without code fences; when it does not parse, cut after its last complete object."""
    text = F.col(text) if isinstance(text, str) else text
    bare = F.trim(F.regexp_replace(F.regexp_replace(text, r"(?i)^```json?\s*", ""), r"```\s*$", ""))
    whole = F.regexp_extract(bare, r"(?s)^(.*\}),", 1)
    repaired = F.when(whole != "", F.concat(whole, F.lit("\n  ]\n}")))
    return F.when(F.try_parse_json(bare).isNotNull(), bare).when(F.try_parse_json(repaired).isNotNull(), repaired)


def parse_relations(responses: DataFrame, allowed: DataFrame, topics: DataFrame, min_confidence: float = 0.8) -> DataFrame:
    """Relation rows of JSON answers (task, content) as prerequisite, related or rejected with a reason.

    ``allowed`` lists the (task, topic_id, prerequisite_id) pairs each task was asked about.
    """
    parsed = responses.select("task", F.from_json(clean_json("content"), RELATIONS).alias("r"))
    broken = parsed.where("r IS NULL").select(
        "task", *[F.lit(None).cast("string").alias(c) for c in EDGE_KEY], F.lit("rejected").alias("class"), F.lit("invalid-json").alias("why")
    )
    rows = parsed.select("task", F.explode("r.relations").alias("x")).select(
        "task", F.col("x.topicId").alias("topic_id"), F.col("x.prerequisiteId").alias("prerequisite_id"), "x.type", "x.confidence", "x.reason"
    )
    ids = topics.select("id")
    pairs = (
        allowed.select("task", *EDGE_KEY).distinct()
        .join(ids, F.col("topic_id") == F.col("id"), "left_semi")
        .join(ids, F.col("prerequisite_id") == F.col("id"), "left_semi")
        .where("topic_id <> prerequisite_id").withColumn("_ok", F.lit(True))
    )
    wide = rows.join(pairs, ["task", *EDGE_KEY], "left")
    sure = F.coalesce((F.col("type") == "prerequisite") & (F.col("confidence") >= min_confidence) & (F.col("reason") != ""), F.lit(False))
    why = F.when(F.col("_ok").isNull(), "outside-candidates").when(
        ~sure & ~F.coalesce(F.col("type").isin("related", "none"), F.lit(False)), "low-confidence-or-invalid"
    )
    kind = F.when(why.isNotNull(), "rejected").when(F.col("type") == "related", "related").when(sure, "prerequisite")
    return wide.select("task", *EDGE_KEY, kind.alias("class"), why.alias("why")).where("class IS NOT NULL").union(broken)


def sync_diff(upstream: DataFrame, overlay: DataFrame, items: str = "evidence") -> DataFrame:
    """Rows pending in the overlay, orphaned there, or with another number of list items."""
    up = upstream.select("id", F.size(items).alias("_u"), F.lit(True).alias("_in"))
    zh = overlay.select("id", F.size(items).alias("_z"), F.lit(True).alias("_at"))
    state = F.when(F.col("_at").isNull(), "pending").when(F.col("_in").isNull(), "orphaned").when(F.col("_u") != F.col("_z"), "item-drift")
    return up.join(zh, "id", "full_outer").select("id", state.alias("state")).where("state IS NOT NULL")


def merge_translations(upstream: DataFrame, existing: DataFrame, progress: DataFrame) -> DataFrame:
    """Reviewed existing text, else new progress, else existing text; orphans are kept."""
    up = upstream.select("id", F.lit(True).alias("_up"))
    old = existing.select("id", F.struct("name", "translation_status").alias("o"))
    new = progress.select("id", F.struct("name", "translation_status").alias("n"))
    reviewed = F.coalesce(F.col("o.translation_status") == "reviewed", F.lit(False))
    pick = F.when(reviewed | F.col("_up").isNull(), F.col("o")).otherwise(F.coalesce("n", "o"))
    wide = up.join(old, "id", "full_outer").join(new, "id", "left").withColumn("v", pick).where("v IS NOT NULL")
    return wide.select("id", "v.name", "v.translation_status", F.col("_up").isNull().alias("orphaned"))


def merge_edge_translations(upstream: DataFrame, existing: DataFrame, progress: DataFrame) -> DataFrame:
    """Reason per upstream edge: new progress, else existing, else the original."""
    new = progress.select(*EDGE_KEY, F.col("reason").alias("_n"), F.lit(True).alias("_hn"))
    old = existing.select(*EDGE_KEY, F.col("reason").alias("_o"), F.lit(True).alias("_ho"))
    text = F.when(F.col("_hn"), F.col("_n")).when(F.col("_ho"), F.col("_o")).otherwise(F.col("reason"))
    return upstream.join(new, EDGE_KEY, "left").join(old, EDGE_KEY, "left").select(*EDGE_KEY, "strength", text.alias("reason"))


def pending_rows(
    topics: DataFrame, done: DataFrame, first_stage: str = "primary", subject: str | None = None,
    stage: str | None = None, force: bool = False,
) -> DataFrame:
    """Rows still to be processed: not reviewed, not done, not split yet; the first stage only on request."""
    keep = [F.coalesce(F.col("translation_status") != "reviewed", F.lit(True)), ~F.col("granularity").eqNullSafe(SPLIT_GRANULARITY)]
    keep.append(F.col("stage") == stage if stage is not None else F.col("stage") != first_stage)
    if subject is not None:
        keep.append(F.col("subject") == subject)
    out = topics.where(all_of(keep))
    if not force:
        out = out.join(done.select("id"), "id", "left_anti")
    return out
