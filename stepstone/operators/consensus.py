"""Multi-reviewer consensus: fail-closed validation, decisions, evidence checks, guarded apply and gate."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepstone.functions.columns import all_of, any_of, fingerprint
from stepstone.operators.merge import EDGE_KEY, require_none
from stepstone.operators.ordering import with_position

# Roles, verdicts and limits of a review.
ROLES = ("necessity", "direction", "adversary")
VERDICTS = ("reviewed", "rejected")
STRENGTHS = ("hard", "soft", "unchanged")
MAX_REASON = 2000
MAX_REFERENCES, MAX_REFERENCE = 8, 500
# The fields that an edge of a packet and a topic in it may have.
PACKET_EDGE_FIELDS = (
    "topicId", "prerequisiteId", "strength", "reason", "contentFingerprint", "generationBatchId", "generationBatch", "topic",
    "prerequisite",
)
PACKET_TOPIC_FIELDS = (
    "id", "name", "description", "subject", "domain", "ageRangeStart", "ageRangeEnd", "evidence", "cnStandards",
)
SHA256 = "^[a-f0-9]{64}$"
REVIEWER_PREFIX = "ai-consensus-v1:"
REVIEWER_PATTERN = "^ai-consensus-v1:[a-f0-9]{64}$"
QUARANTINE = (
    "rescope_required", "previous_review_status", "age_regression", "review_note", "reviewer_role",
    "review_rubric", "review_provenance", "reviewed_by", "reviewed_at", "review_evidence_ref",
)
PACKET_KEY = ["packet_id", *EDGE_KEY]
PROPOSAL = "array<struct<resolved_strength: string, content_fingerprint: string, reviewed_by: string>>"


def packet_problems(packets: DataFrame, edges: DataFrame, packet_format: str) -> DataFrame:
    """(packet_id, rule, key) for every broken packet rule.

    ``packets`` (packet_id, format, checksum); ``edges`` (packet_id, topic_id, prerequisite_id, strength,
    fingerprint, topic_context, prerequisite_context).
    """
    head = packets.select(
        "packet_id",
        F.inline(F.array(
            F.struct(F.lit("format").alias("rule"), (~F.col("format").eqNullSafe(packet_format)).alias("broken")),
            F.struct(F.lit("checksum").alias("rule"), (~F.coalesce(F.col("checksum").rlike(SHA256), F.lit(False))).alias("broken")),
        )),
    ).where("broken").select("packet_id", "rule", F.lit("").alias("key"))
    key = F.concat_ws("<-", *EDGE_KEY).alias("key")
    rows = edges.select(
        "packet_id", key,
        F.inline(F.array(
            F.struct(F.lit("strength").alias("rule"), (~F.coalesce(F.col("strength").isin("hard", "soft"), F.lit(False))).alias("broken")),
            F.struct(F.lit("fingerprint").alias("rule"), (~F.coalesce(F.col("fingerprint").rlike(SHA256), F.lit(False))).alias("broken")),
            F.struct(F.lit("topic-context").alias("rule"), (~F.col("topic_context").eqNullSafe(F.col("topic_id"))).alias("broken")),
            F.struct(F.lit("prerequisite-context").alias("rule"), (~F.col("prerequisite_context").eqNullSafe(F.col("prerequisite_id"))).alias("broken")),
        )),
    ).where("broken").select("packet_id", "rule", "key")
    doubled = edges.groupBy(*PACKET_KEY).count().where("count > 1").select("packet_id", F.lit("duplicate-edge").alias("rule"), key)
    empty = packets.select("packet_id").join(edges.select("packet_id"), "packet_id", "left_anti").select(
        "packet_id", F.lit("no-edges").alias("rule"), F.lit("").alias("key")
    )
    return head.union(rows).union(doubled).union(empty)


def field_problems(rows: DataFrame, documents: Mapping[str, tuple[Column, Sequence[str]]]) -> DataFrame:
    """(packet_id, rule, key) for JSON documents with a field outside their closed list, or that are no object.

    ``rows`` (packet_id, key, …); ``documents`` gives for each name the JSON text and the fields that it may have.
    """
    checks = []
    for name, (text, allowed) in documents.items():
        fields = F.json_object_keys(text)
        checks += [
            F.struct(F.lit(f"{name}-object").alias("rule"), fields.isNull().alias("broken")),
            F.struct(
                F.lit(f"{name}-field").alias("rule"),
                F.coalesce(F.size(F.array_except(fields, F.array(*map(F.lit, allowed)))) > 0, F.lit(False)).alias("broken"),
            ),
        ]
    return rows.select("packet_id", "key", F.inline(F.array(*checks))).where("broken").select("packet_id", "rule", "key")


def packet_identity(packets: DataFrame, edges: DataFrame, order: Sequence[str] = EDGE_KEY, fan: int = 256) -> DataFrame:
    """(packet_id, identity): hash of a packet's head, the number of its edges and the root of a tree over their hashes.

    Every edge is hashed whole, with all its columns.  ``order`` sets the edges' places (equal ones follow their hash); ``fan``
    neighbours are hashed into one on the next level, one alone goes up as it is.  A packet of any size is spread over tasks: no more
    than ``fan`` hashes meet in one.  Packets without edges have no identity.
    """
    columns = [c for c in edges.columns if c != "packet_id"]
    hashed = edges.select("packet_id", *order, fingerprint(*columns).alias("_hash"))
    placed = with_position(hashed, ["packet_id"], [*order, "_hash"], "_place")
    level = placed.select("packet_id", (F.col("_place") - 1).alias("place"), F.col("_hash").alias("hash"), F.lit(1).cast("bigint").alias("n"))
    largest = level.agg(F.max("place")).first()[0] or 0
    levels = 0 if largest == 0 else math.floor(math.log2(largest) / math.log2(fan)) + 2  # one level more changes nothing
    for _ in range(levels):
        hashes = F.transform("x", lambda e: e["hash"])
        level = level.groupBy("packet_id", F.floor(F.col("place") / fan).alias("place")).agg(
            F.array_sort(F.collect_list(F.struct("place", "hash"))).alias("x"), F.sum("n").alias("n")
        ).select(
            "packet_id", "place", F.when(F.size("x") == 1, hashes[0]).otherwise(F.sha2(F.array_join(hashes, ""), 256)).alias("hash"), "n"
        )
    return packets.join(level, "packet_id").select(
        "packet_id", F.concat(F.lit("packet-v1:"), F.sha2(F.concat_ws("|", "format", "checksum", "n", "hash"), 256)).alias("identity")
    )


def echo_problems(requests: DataFrame, responses: DataFrame, response_format: str, fields: Sequence[str]) -> DataFrame:
    """(packet_id, role, rule): answers that do not repeat their request, or are missing, unasked or given twice.

    ``requests`` and ``responses`` have (packet_id, role) and ``fields``, the answers also ``format``.  Nulls are equal to nulls only.
    """
    key = ["packet_id", "role"]
    asked = requests.groupBy(*key).agg(*[F.min(c).alias(f"_{c}") for c in fields])  # asked once each
    same = responses.withColumn("_times", F.lit(1)).join(asked.withColumn("_asked", F.lit(True)), key, "full_outer")
    given, wanted = F.col("_times").isNotNull(), F.col("_asked").isNotNull()
    rules = {
        "unanswered": ~given,
        "unasked": ~wanted,
        "format": given & ~F.col("format").eqNullSafe(response_format),
        **{c.replace("_", "-"): given & wanted & ~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in fields},
    }
    checks = F.array(*[F.struct(F.lit(name).alias("rule"), broken.alias("broken")) for name, broken in rules.items()])
    rows = same.select(*key, F.inline(checks)).where("broken").select(*key, "rule").distinct()
    twice = responses.groupBy(*key).count().where("count > 1").select(*key, F.lit("answered-twice").alias("rule"))
    return rows.union(twice)


def echoed(responses: DataFrame, problems: DataFrame) -> DataFrame:
    """Verdicts of :func:`response_verdicts` with ``echo``, the number of rules broken by :func:`echo_problems`; both must hold."""
    broken = problems.groupBy("packet_id", "role").agg(F.count("*").alias("echo"))
    both = responses.join(broken, ["packet_id", "role"], "left").withColumn("echo", F.coalesce("echo", F.lit(0)))
    return both.withColumn("valid", F.col("valid") & (F.col("echo") == 0))


def well_cited(references: Column) -> Column:
    """A list of few references, none of them missing, empty or long."""
    short = F.forall(references, lambda r: F.coalesce(F.length(r).between(1, MAX_REFERENCE), F.lit(False)))
    return (F.size(references) <= MAX_REFERENCES) & short


def ballots(edges: DataFrame, votes: DataFrame) -> DataFrame:
    """One row for each key of a packet edge, with the lists ``edges`` and ``votes`` of all rows that have it.

    ``edges`` has the packet key and further columns, all of which are kept; of ``votes`` role, verdict, resolved_strength and model are
    kept, and ``bad`` tells malformed ones.  Where votes have ``references`` (array of text), they must be a list of few and short ones.
    Everything that is asked of a packet edge follows from its row, so edges and votes are shuffled once.
    """
    rest = [c for c in edges.columns if c not in PACKET_KEY]
    tests = {
        "verdict": ~F.coalesce(F.col("verdict").isin(*VERDICTS), F.lit(False)),
        "resolved_strength": ~F.coalesce(F.col("resolved_strength").isin(*STRENGTHS), F.lit(False)),
        "reason": ~F.coalesce(F.length("reason").between(1, MAX_REASON), F.lit(False)),
        "references": ~F.coalesce(well_cited(F.col("references")), F.lit(False)) if "references" in votes.columns else F.lit(False),
    }
    bad = any_of([test for name, test in tests.items() if name in votes.columns])
    kept = [F.col(c) if c in votes.columns else F.lit(None).cast("string").alias(c) for c in ("role", "verdict", "resolved_strength", "model")]
    vote = votes.select(*PACKET_KEY, F.struct(*kept, bad.alias("bad")).alias("vote"))
    edge = edges.select(*PACKET_KEY, F.struct(*rest).alias("edge"))
    # a number in front of the keys: rows are sorted for the lists, and texts that begin alike are slow to compare
    both = edge.unionByName(vote, allowMissingColumns=True).withColumn("_hash", F.xxhash64(*PACKET_KEY))
    # rows of a key come from different tasks, so lists made before the shuffle would hold one row each and cost a sort of all rows
    both = both.repartition("_hash", *PACKET_KEY)
    return both.groupBy("_hash", *PACKET_KEY).agg(F.collect_list("edge").alias("edges"), F.collect_list("vote").alias("votes")).drop("_hash")


def _whole_key() -> Column:
    """Keys with a null are equal to none, so edges and votes that have one do not meet."""
    return all_of([F.col(c).isNotNull() for c in PACKET_KEY])


def response_verdicts(votes: DataFrame, edges: DataFrame, roles: Sequence[str] = ROLES) -> DataFrame:
    """Per (packet, role): missing, doubled, extra and malformed votes, and whether the answer is valid."""
    return judged(ballots(edges.select(*PACKET_KEY), votes), roles)


def judged(cast: DataFrame, roles: Sequence[str] = ROLES) -> DataFrame:
    """:func:`response_verdicts` of :func:`ballots`."""
    asked = F.array(*map(F.lit, roles))
    none = F.array().cast("array<string>")
    meet, listed = _whole_key(), F.size("edges") > 0
    named = F.col("votes")["role"]
    # the usual row has one vote of each role: its votes are counted as they are, without functions over lists
    usual = listed & meet & F.sort_array(named).eqNullSafe(F.array(*map(F.lit, sorted(roles))))

    def cell(role: Column) -> Column:
        mine = F.filter("votes", lambda v: v["role"].eqNullSafe(role))
        return F.struct(
            role.alias("role"), (listed & F.coalesce(F.array_contains(asked, role), F.lit(False))).alias("wanted"), F.size(mine).alias("n"),
            F.size(F.filter(mine, lambda v: v["bad"])).alias("bad"), F.array_min(mine["model"]).alias("model"),
        )

    cells = cast.where(~usual).select(
        "packet_id", meet.alias("meet"), F.inline(F.transform(F.array_union(F.when(listed, asked).otherwise(none), named), cell))
    )
    given, wanted = F.col("n") > 0, F.col("wanted")
    odd = cells.select(
        "packet_id", "role", "model",
        (wanted & ~(given & F.col("meet"))).alias("missing"), (given & ~(wanted & F.col("meet"))).alias("extra"),
        (wanted & F.col("meet") & (F.col("n") > 1)).alias("doubled"), "bad",
    )
    no = F.lit(False)
    plain = cast.where(usual).select("packet_id", F.inline("votes")).select(
        "packet_id", "role", "model", no.alias("missing"), no.alias("extra"), no.alias("doubled"), F.col("bad").cast("int").alias("bad")
    )
    # models are few: as a key they leave sums only, which need no sorting
    sums = plain.union(odd).groupBy("packet_id", "role", "model").agg(
        *[F.count_if(c).alias(c) for c in ("missing", "extra", "doubled")], F.sum("bad").alias("malformed")
    )
    counts = ("missing", "extra", "doubled", "malformed")
    # by packet, so that what follows for packets needs no further shuffle
    return sums.repartition("packet_id").groupBy("packet_id", "role").agg(*[F.sum(c).alias(c) for c in counts], F.min("model").alias("model")).withColumn(
        "valid", (F.col("missing") + F.col("extra") + F.col("doubled") + F.col("malformed")) == 0
    )


def packet_verdicts(responses: DataFrame, roles: Sequence[str] = ROLES) -> DataFrame:
    """A packet passes only when every role answered validly and each reports its own model."""
    known = responses.where(F.col("role").isin(*roles))
    return known.groupBy("packet_id").agg(
        F.count_if("valid").alias("valid_roles"),
        F.size(F.collect_set(F.when(F.col("valid"), F.col("model")))).cast("bigint").alias("models"),  # at most one for each role
    ).select(
        "packet_id", "valid_roles", "models",
        F.when(F.col("valid_roles") < len(roles), "invalid-role").when(F.col("models") < len(roles), "shared-model").alias("failure"),
    )


def each(rows: Column, f: Callable[[Column], Column]) -> Column:
    """``transform``; for the usual list of one element without a lambda function, for which no code is generated."""
    return F.when(F.size(rows) == 1, F.array(f(rows[0]))).otherwise(F.transform(rows, f))


def _said(vote: Column, strength: Column) -> Column:
    return F.when(vote["resolved_strength"] == "unchanged", strength).otherwise(vote["resolved_strength"])


def decisions_of(passed: Column) -> Column:
    """Decisions on the edges of a row of :func:`ballots`: (strength, consensus, resolved_strength) for each distinct strength."""
    heard = F.when(_whole_key(), F.col("votes")).otherwise(F.slice("votes", 1, 0))
    lo, hi = F.array_min(heard["verdict"]), F.array_max(heard["verdict"])
    named = heard["resolved_strength"]
    kept, others = F.array_contains(named, "unchanged"), F.array_remove(named, "unchanged")

    def decide(strength: Column) -> Column:
        own = F.when(kept, strength)
        slo, shi = F.least(F.array_min(others), own), F.greatest(F.array_max(others), own)
        agreed = (lo == hi) & (slo == shi)
        label = (
            F.when(~F.coalesce(passed, F.lit(False)), "packet-failed")
            .when(~agreed, "disagreement")
            .when(lo == "rejected", "unanimous-rejected")
            .otherwise("unanimous-reviewed")
        )
        return F.struct(strength.alias("strength"), label.alias("consensus"), F.when(label == "unanimous-reviewed", slo).alias("resolved_strength"))

    return each(F.array_distinct(F.col("edges")["strength"]), decide)


def decided(cast: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The rows of :func:`ballots` that have edges, with ``decisions`` on them (see :func:`decisions_of`)."""
    passed = verdicts.select("packet_id", F.col("failure").isNull().alias("_passed"))
    return cast.where(F.size("edges") > 0).join(passed, "packet_id", "left").select(
        *cast.columns, decisions_of(F.col("_passed")).alias("decisions")
    )


def edge_decisions(edges: DataFrame, votes: DataFrame, verdicts: DataFrame) -> DataFrame:
    """packet-failed, disagreement, unanimous-rejected or unanimous-reviewed per packet edge."""
    return decided(ballots(edges, votes), verdicts).select(*PACKET_KEY, F.inline("decisions"))


def proposals_of() -> Column:
    """Proposals of a row with ``edges`` (strength, content_fingerprint), ``votes`` and ``decisions``: the reviewer is derived from them."""
    good = F.filter("decisions", lambda d: d["consensus"] == "unanimous-reviewed")
    pairs = F.flatten(F.transform(good, lambda d: F.transform("edges", lambda e: F.struct(
        d["resolved_strength"].alias("resolved_strength"), e["content_fingerprint"].alias("content_fingerprint"), d["strength"].alias("strength")
    ))))

    def proposal(p: Column, cast: Column) -> Column:
        body = F.to_json(F.struct(
            p["content_fingerprint"].alias("content_fingerprint"), F.col("packet_id"), F.col("prerequisite_id"),
            cast["vote"].alias("roles"), F.col("topic_id"),
        ))
        return F.struct(
            p["resolved_strength"].alias("resolved_strength"), p["content_fingerprint"].alias("content_fingerprint"),
            F.concat(F.lit(REVIEWER_PREFIX), F.sha2(body, 256)).alias("reviewed_by"),
        )

    def votes_on(strength: Column) -> Column:
        return F.transform("votes", lambda v: F.struct(v["role"].alias("role"), F.struct(
            v["model"].alias("model"), _said(v, strength).alias("resolved_strength"), v["role"].alias("role"), v["verdict"].alias("verdict"),
        ).alias("vote")))

    def shared(p: Column) -> Column:
        same = F.filter(pairs, lambda o: o["resolved_strength"].eqNullSafe(p["resolved_strength"]) & o["content_fingerprint"].eqNullSafe(p["content_fingerprint"]))
        return proposal(p, F.sort_array(F.flatten(F.transform(same, lambda o: votes_on(o["strength"])))))

    different = F.array_distinct(F.transform(pairs, lambda p: F.struct(
        p["resolved_strength"].alias("resolved_strength"), p["content_fingerprint"].alias("content_fingerprint")
    )))
    first, only = F.col("decisions")[0], F.col("edges")[0]
    one = F.struct(first["resolved_strength"].alias("resolved_strength"), only["content_fingerprint"].alias("content_fingerprint"))
    lone = F.array(proposal(one, F.sort_array(votes_on(first["strength"]))))
    agreed = F.coalesce(F.array_contains(F.col("decisions")["consensus"], "unanimous-reviewed"), F.lit(False))
    found = F.when(F.size("edges") == 1, lone).otherwise(F.transform(different, shared))
    return F.when(agreed & _whole_key() & (F.size("votes") > 0), found).otherwise(F.array().cast(PROPOSAL))


def proposals(decided: DataFrame) -> DataFrame:
    """Unanimously reviewed edges with the reviewer identity derived from packet, edge and votes.

    ``decided`` is a result of :func:`decided` whose edges have a ``content_fingerprint``.
    """
    good = decided.where(F.array_contains(F.col("decisions")["consensus"], "unanimous-reviewed"))
    return good.select(*PACKET_KEY, F.inline(proposals_of()))


def evidence_drift(stored: DataFrame, derived: DataFrame) -> DataFrame:
    """Rows only stored or only derived; an intact record has none."""
    cols = sorted(stored.columns)
    sides = stored.select(*cols, F.lit(1).alias("_n")).union(derived.select(*cols, F.lit(-1).alias("_n")))
    left = sides.groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    side = F.when(F.col("_n") > 0, "stored").otherwise("derived")
    return left.select(*cols, F.explode(F.array_repeat(side, F.abs("_n").cast("int"))).alias("side"))


def context_drift(found: DataFrame, packet_context: DataFrame, topics: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Ends of proposed edges whose topic no longer looks as it did in the packet.

    ``packet_context`` and ``topics`` are compared by a fingerprint over ``cols``.
    """
    ends = found.select("packet_id", F.inline(F.array(
        F.struct(F.col("topic_id").alias("id"), F.lit("topic").alias("end")),
        F.struct(F.col("prerequisite_id").alias("id"), F.lit("prerequisite").alias("end")),
    ))).distinct()
    then = packet_context.select("packet_id", "id", fingerprint(*cols).alias("_then"))
    now = topics.select("id", fingerprint(*cols).alias("_now"))
    return ends.join(then, ["packet_id", "id"], "left").join(now, "id", "left").where(
        F.col("_now").isNull() | ~F.col("_now").eqNullSafe(F.col("_then"))
    ).select("packet_id", "id", "end")


def apply_proposals(
    live: DataFrame, found: DataFrame, fingerprint_cols: Sequence[str], drift: DataFrame | None = None
) -> DataFrame:
    """Compare and set: verdict per proposal against the live edge, nothing at all when contexts drifted.

    The result has the proposal's key, ``conflict`` (null when applied) and the resulting edge state.
    """
    if drift is not None:
        require_none(drift, "topic context drifted from the packet; no proposal applied")
    require_none(live.groupBy(*EDGE_KEY).count().where("count > 1").select(*EDGE_KEY), "duplicate live edge")
    held = any_of([F.col(c).isNotNull() for c in QUARANTINE if c in live.columns] or [F.lit(False)])
    now = live.select(
        *EDGE_KEY, F.col("review_status").alias("_status"), held.alias("_held"), fingerprint(*fingerprint_cols).alias("_print"), F.lit(True).alias("_live")
    )
    conflict = (
        F.when(F.col("_live").isNull(), "missing-edge")
        .when(F.col("_status") != "machine", "not-machine")
        .when(F.col("_held"), "quarantined")
        .when(F.col("_print") != F.col("content_fingerprint"), "stale-fingerprint")
    )
    free = F.col("conflict").isNull()
    return found.join(now, EDGE_KEY, "left").withColumn("conflict", conflict).select(
        *EDGE_KEY, "conflict",
        F.when(free, "reviewed").alias("review_status"),
        F.when(free, F.col("resolved_strength")).alias("strength"),
        F.when(free, "ai-consensus").alias("review_provenance"),
        F.when(free, F.col("reviewed_by")).alias("reviewed_by"),
    )


def publish_problems(edges: DataFrame, evidence: DataFrame, legacy_reviewer: str, evidence_prefix: str, preimage: Column) -> DataFrame:
    """Why an edge may not be published, in order of the checks; one row per offending edge.

    ``evidence`` holds one row per (evidence_ref, edge): complete, consensus, resolved strength, reviewer,
    time and fingerprint.  ``preimage`` is the fingerprint of the edge as it was before consensus.
    """
    proof = evidence.select(
        F.col("evidence_ref").alias("review_evidence_ref"), *EDGE_KEY, F.col("consensus").alias("e_consensus"),
        F.col("resolved_strength").alias("e_strength"), F.col("reviewed_by").alias("e_by"), F.col("reviewed_at").alias("e_at"),
        F.col("content_fingerprint").alias("e_print"),
    )
    complete = evidence.groupBy(F.col("evidence_ref").alias("review_evidence_ref")).agg(F.min("complete").alias("e_complete"))
    wide = edges.withColumn("_pre", preimage).join(proof, ["review_evidence_ref", *EDGE_KEY], "left").join(complete, "review_evidence_ref", "left")
    ref, by = F.col("review_evidence_ref"), F.coalesce("reviewed_by", F.lit(""))
    ours = F.coalesce(F.col("review_provenance") == "ai-consensus", F.lit(False))
    same = (
        F.col("review_status").eqNullSafe("reviewed") & F.col("strength").eqNullSafe(F.col("e_strength"))
        & F.col("reviewed_by").eqNullSafe(F.col("e_by")) & F.col("reviewed_at").eqNullSafe(F.col("e_at"))
    )
    problem = (
        F.when(~ours, F.when(F.coalesce(ref.startswith(evidence_prefix), F.lit(False)), "foreign-evidence"))
        .when(by == legacy_reviewer, F.when(ref.isNotNull(), "legacy-with-evidence"))
        .when(~by.rlike(REVIEWER_PATTERN), "unknown-reviewer")
        .when(~F.coalesce("e_complete", F.lit(False)), "no-complete-evidence")
        .when(~F.col("e_consensus").eqNullSafe("unanimous-reviewed"), "no-unanimous-proposal")
        .when(~same, "field-mismatch")
        .when(~F.col("_pre").eqNullSafe(F.col("e_print")), "preimage-mismatch")
    )
    return wide.select(*EDGE_KEY, problem.alias("problem")).where("problem IS NOT NULL")
