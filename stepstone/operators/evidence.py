"""Stored consensus evidence: one document for each packet, sealed by a hash and derived anew from the votes that it holds.

A document has ``packet_id``, ``format``, ``status``, ``error``, ``completed_at``, ``evidence_ref``, ``evidence_hash`` and lists of
``edges`` (the packet's), ``roles`` (with their ``votes``), ``decisions`` and ``proposals``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepstone.functions.columns import all_of, any_of, nested_canonical_json
from stepstone.operators.consensus import EDGE_KEY, PACKET_KEY, ROLES, decisions_of, proposals_of

STATUSES = ("complete", "failed")
ROLE_STATUSES = ("valid", "invalid", "timeout")
DECIDED = ("strength", "content_fingerprint", "consensus", "resolved_strength")
#: Rules that a packet must keep, or none of its votes count.
UNSOUND = ("roles", "role-status", "votes", "actual-models", "valid-roles")
PROPOSED = ("content_fingerprint", "resolved_strength")


def _seal_of(documents: DataFrame) -> Column:
    """Hash over all fields but ``evidence_hash``, keys sorted at every depth."""
    return F.sha2(nested_canonical_json(documents.schema, *[c for c in documents.columns if c != "evidence_hash"]), 256)


def seal(documents: DataFrame) -> DataFrame:
    """Documents with their ``evidence_hash``."""
    return documents.withColumn("evidence_hash", _seal_of(documents))


def _keys(rows: Column) -> Column:
    return F.array_sort(F.transform(rows, lambda r: F.struct(*[r[k] for k in EDGE_KEY])))


def _normal(text: Column) -> Column:
    return F.coalesce((text != "") & (text == F.trim(text)), F.lit(False))


def _document_rules(documents: DataFrame, evidence_format: str) -> dict[str, Column]:
    roles, status = F.col("roles"), F.col("status")
    complete, failed = status.eqNullSafe("complete"), status.eqNullSafe("failed")
    valid = F.filter(roles, lambda r: r["status"].eqNullSafe("valid"))
    models = F.size(F.array_distinct(F.transform(valid, lambda r: r["actual_model"])))
    all_valid = F.size(valid) == len(ROLES)
    told = F.coalesce(F.trim("error") != "", F.lit(False))
    return {
        "format": ~F.col("format").eqNullSafe(evidence_format),
        "status": ~(complete | failed),
        "error": (complete & F.col("error").isNotNull()) | (failed & ~told),
        "roles": ~F.array_sort(F.transform(roles, lambda r: r["role"])).eqNullSafe(F.array(*map(F.lit, sorted(ROLES)))),
        "role-status": F.exists(roles, lambda r: ~F.coalesce(r["status"].isin(*ROLE_STATUSES), F.lit(False))),
        "partial-votes": F.exists(roles, lambda r: ~r["status"].eqNullSafe("valid") & (F.coalesce(F.size(r["votes"]), F.lit(0)) > 0)),
        "votes": F.exists(valid, lambda r: ~_keys(r["votes"]).eqNullSafe(_keys(F.col("edges")))),
        "configured-models": (F.size(F.array_distinct(F.transform(roles, lambda r: r["configured_model"]))) < len(ROLES))
        | F.exists(roles, lambda r: ~_normal(r["configured_model"])),
        "actual-models": F.exists(valid, lambda r: ~_normal(r["actual_model"])) | (complete & all_valid & (models < len(ROLES))),
        "valid-roles": complete & ~all_valid,
        "failed-without-cause": failed & all_valid & (models == len(ROLES)),
        "seal": ~F.col("evidence_hash").eqNullSafe(_seal_of(documents)),
    }


def document_problems(documents: DataFrame, evidence_format: str) -> DataFrame:
    """(packet_id, rule): what is wrong with a document by itself; ``seal`` is the hash over it."""
    rules = {name: F.coalesce(broken, F.lit(True)) for name, broken in _document_rules(documents, evidence_format).items()}
    checks = F.array(*[F.struct(F.lit(name).alias("rule"), broken.alias("broken")) for name, broken in rules.items()])
    return documents.select("packet_id", F.inline(checks)).where("broken").select("packet_id", "rule")


#: What a document says of an edge, by kind of list; fields are in the order by which the first of several is chosen.
KINDS = {
    "edge": ("strength", "content_fingerprint"),
    "vote": ("role", "verdict", "resolved_strength", "model"),
    "decision": DECIDED,
    "proposal": (*PROPOSED, "reviewed_by", "reviewed_at", "evidence_ref"),
}


def _by_edge(documents: DataFrame, evidence_format: str) -> DataFrame:
    """One row for each key of an edge with all that its document says of it: edges (different ones), votes, decisions, proposals.

    A document's lists leave it in one step, so rows of a key are put together before they are shuffled.
    """
    rules = _document_rules(documents, evidence_format)
    sound = F.coalesce((F.col("status") == "complete") & ~any_of([rules[r] for r in UNSOUND]), F.lit(False))
    types = {kind: f"struct<{', '.join(f'{f}: string' for f in fields)}>" for kind, fields in KINDS.items()}
    element = f"array<struct<{', '.join([*[f'{k}: string' for k in EDGE_KEY], *[f'{k}: {t}' for k, t in types.items()]])}>>"

    def listed(rows: Column, kind: str, **also: Column) -> Column:
        def said(r: Column) -> Column:
            fields = F.struct(*[also.get(f, r[f]).alias(f) for f in KINDS[kind]])
            given = [(fields if k == kind else F.lit(None)).cast(t).alias(k) for k, t in types.items()]
            return F.struct(*[r[k].cast("string").alias(k) for k in EDGE_KEY], *given)

        return F.coalesce(F.transform(rows, said), F.array().cast(element))

    valid = F.filter("roles", lambda r: r["status"] == "valid")
    votes = F.flatten(F.transform(valid, lambda r: listed(r["votes"], "vote", role=r["role"], model=r["actual_model"])))
    parts = [
        listed(F.col("edges"), "edge"), F.coalesce(votes, F.array().cast(element)), listed(F.col("decisions"), "decision"),
        listed(F.col("proposals"), "proposal"),
    ]
    rows = documents.select("packet_id", sound.alias("sound"), F.struct(F.col("completed_at").alias("reviewed_at"), "evidence_ref").alias("bound"), F.inline(F.concat(*parts)))
    return rows.groupBy(*PACKET_KEY).agg(
        F.max("sound").alias("sound"), F.max("bound").alias("bound"), F.array_distinct(F.collect_list("edge")).alias("edges"),
        *[F.collect_list(k).alias(f"{k}s") for k in ("vote", "decision", "proposal")],
    )


def _met(stored: Column, wanted: Column, kind: str, rules: dict[str, list[str]]) -> Column:
    """Rules broken by the stored rows of a key: missing, extra or given twice, or other in the fields of a rule."""
    given, first, twice = F.size(stored) > 0, F.array_min(stored), F.size(stored) > 1

    def told(w: Column) -> Column:
        other = {rule: ~F.struct(*[first[f] for f in names]).eqNullSafe(F.struct(*[w[f] for f in names])) for rule, names in rules.items()}
        broken = {f"{kind}-missing": ~given, f"{kind}-twice": twice, **{rule: given & differs for rule, differs in other.items()}}
        return F.array_compact(F.array(*[F.when(b, rule) for rule, b in broken.items()]))

    unasked = F.array_compact(F.array(F.lit(f"{kind}-extra"), F.when(twice, f"{kind}-twice")))
    return F.when(F.size(wanted) > 0, F.flatten(F.transform(wanted, told))).when(given, unasked).otherwise(F.array().cast("array<string>"))


def evidence_problems(documents: DataFrame, evidence_format: str) -> DataFrame:
    """(packet_id, rule, key): all that is wrong with stored evidence; ``key`` names an edge, or is null for a whole document.

    Decisions and proposals are derived anew from the document's own edges and votes and met with the stored ones edge by
    edge; packet ids must be unique.  Where status, roles, models or votes are not in order, the whole packet is taken as failed, so
    all its decisions must say so and it has no proposals.  A document is a row, so it must fit a task; its edges are spread.
    """
    whole = document_problems(documents, evidence_format).select("packet_id", "rule", F.lit(None).cast("string").alias("key"))
    known = F.when(all_of([F.col(c).isNotNull() for c in PACKET_KEY]), F.col("edges")).otherwise(F.slice("edges", 1, 0))
    derived = _by_edge(documents, evidence_format).withColumnsRenamed({"decisions": "given_decisions", "proposals": "given_proposals"}).withColumn(
        "edges", known
    ).withColumn("decisions", decisions_of(F.col("sound")))
    decided = F.flatten(F.transform("decisions", lambda d: F.transform("edges", lambda e: F.struct(
        d["strength"].alias("strength"), e["content_fingerprint"].alias("content_fingerprint"), d["consensus"].alias("consensus"),
        d["resolved_strength"].alias("resolved_strength"),
    ))))
    proposed = F.transform(proposals_of(), lambda p: F.struct(
        *[p[f].alias(f) for f in (*PROPOSED, "reviewed_by")], *[F.col("bound")[f].alias(f) for f in ("reviewed_at", "evidence_ref")]
    ))
    broken = [
        _met(F.col("given_decisions"), F.col("decided"), "decision", {"decision": [*DECIDED]}),
        _met(
            F.col("given_proposals"), F.col("proposed"), "proposal",
            {"proposal": [*PROPOSED], "proposal-reviewer": ["reviewed_by"], "proposal-binding": ["reviewed_at", "evidence_ref"]},
        ),
    ]
    met = derived.withColumns({"decided": decided, "proposed": proposed})
    return whole.union(met.select("packet_id", F.explode(F.concat(*broken)).alias("rule"), F.concat_ws("<-", *EDGE_KEY).alias("key")))
