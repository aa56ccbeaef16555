"""Nested canonical JSON against Python's, and stored evidence of which any field was changed."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from stepstone.functions.columns import nested_canonical_json
from stepstone.operators import evidence

FORMAT = "consensus-evidence/v1"
ROLE = "role string, status string, configured_model string, actual_model string, votes array<struct<topic_id string, prerequisite_id string, verdict string, resolved_strength string>>"
EDGE = "topic_id string, prerequisite_id string, strength string, content_fingerprint string"
SCHEMA = (
    "packet_id string, format string, status string, error string, completed_at string, evidence_ref string, "
    f"edges array<struct<{EDGE}>>, roles array<struct<{ROLE}>>, decisions array<struct<{EDGE}, consensus string, resolved_strength string>>, "
    "proposals array<struct<topic_id string, prerequisite_id string, content_fingerprint string, resolved_strength string, reviewed_by string, "
    "reviewed_at string, evidence_ref string>>"
)


def canonical(value):
    """Python's JSON with sorted keys, nulls left out of objects."""

    def bare(v):
        if isinstance(v, dict):
            return {k: bare(x) for k, x in v.items() if x is not None}
        return [bare(x) for x in v] if isinstance(v, list) else v

    return json.dumps(bare(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def reviewer(packet, edge, strength, models):
    """Derived identity by a plain loop over the roles in order of their names."""
    roles = [{"model": models[r], "resolved_strength": strength, "role": r, "verdict": "reviewed"} for r in sorted(models)]
    body = {"content_fingerprint": edge["content_fingerprint"], "packet_id": packet, "prerequisite_id": edge["prerequisite_id"], "roles": roles, "topic_id": edge["topic_id"]}
    return "ai-consensus-v1:" + hashlib.sha256(canonical(body).encode()).hexdigest()


def document():
    """Edges a<-b: reviewed by all; a<-c: one rejects; a<-d: all reject."""
    models = {"necessity": "m1", "direction": "m2", "adversary": "m3"}
    edges = [{"topic_id": "a", "prerequisite_id": p, "strength": "soft", "content_fingerprint": f"f{p}"} for p in "bcd"]
    verdicts = {"b": ["reviewed"] * 3, "c": ["reviewed", "rejected", "reviewed"], "d": ["rejected"] * 3}
    roles = [
        {"role": r, "status": "valid", "configured_model": f"c-{r}", "actual_model": models[r], "votes": [
            {"topic_id": "a", "prerequisite_id": p, "verdict": verdicts[p][k], "resolved_strength": "unchanged"} for p in "bcd"]}
        for k, r in enumerate(models)
    ]
    said = ["unanimous-reviewed", "disagreement", "unanimous-rejected"]
    decisions = [{**e, "consensus": s, "resolved_strength": "soft" if s == said[0] else None} for e, s in zip(edges, said, strict=True)]
    return {
        "packet_id": "p", "format": FORMAT, "status": "complete", "error": None, "completed_at": "t", "evidence_ref": "r", "edges": edges,
        "roles": roles, "decisions": decisions, "proposals": [{
            "topic_id": "a", "prerequisite_id": "b", "content_fingerprint": "fb", "resolved_strength": "soft",
            "reviewed_by": reviewer("p", edges[0], "soft", models), "reviewed_at": "t", "evidence_ref": "r"}],
    }


def changed(path, value):
    doc = document()
    place = doc
    for step in path[:-1]:
        place = place[step]
    place[path[-1]] = value
    return doc


CHANGES = {
    "none": ([], None, set()),
    "format": (["format"], "other", {"format"}),
    "status": (["status"], "done", {"status", "decision", "proposal-extra"}),
    "error": (["error"], "late", {"error"}),
    "role": (["roles", 1, "role"], "umpire", {"roles", "decision", "proposal-extra"}),
    "role status": (["roles", 1, "status"], "odd", {"role-status", "partial-votes", "valid-roles", "decision", "proposal-extra"}),
    "configured": (["roles", 1, "configured_model"], "c-necessity", {"configured-models"}),
    "blank model": (["roles", 1, "configured_model"], " x", {"configured-models"}),
    "no models": (["roles", 1, "actual_model"], None, {"actual-models", "decision", "proposal-extra"}),
    "same models": (["roles", 1, "actual_model"], "m1", {"actual-models", "decision", "proposal-extra"}),
    "votes": (["roles", 0, "votes", 0, "prerequisite_id"], "z", {"votes", "decision", "proposal-extra"}),
    "vote": (["roles", 0, "votes", 0, "verdict"], "rejected", {"decision", "proposal-extra"}),
    "consensus": (["decisions", 1, "consensus"], "unanimous-rejected", {"decision"}),
    "decision": (["decisions", 0, "content_fingerprint"], "other", {"decision"}),
    "extra": (["decisions", 0, "prerequisite_id"], "z", {"decision-extra", "decision-missing"}),
    "twice": (["decisions", 1], document()["decisions"][0], {"decision-twice", "decision-missing"}),
    "fingerprint": (["proposals", 0, "content_fingerprint"], "other", {"proposal"}),
    "strength": (["proposals", 0, "resolved_strength"], "hard", {"proposal"}),
    "reviewer": (["proposals", 0, "reviewed_by"], "me", {"proposal-reviewer"}),
    "time": (["proposals", 0, "reviewed_at"], "later", {"proposal-binding"}),
    "no proposals": (["proposals"], [], {"proposal-missing"}),
    "no votes": (["roles"], [], {"roles", "valid-roles", "configured-models", "decision", "proposal-extra"}),
}


def test_each_changed_field_is_reported(spark):
    docs = [{**(changed(path, value) if path else document()), "packet_id": "p"} for path, value, _ in CHANGES.values()]
    for n, doc in enumerate(docs):  # the identity holds the packet's id
        doc["packet_id"] = f"p{n}"
        for p in doc["proposals"]:
            if p["reviewed_by"] != "me":
                p["reviewed_by"] = reviewer(f"p{n}", document()["edges"][0], "soft", {"necessity": "m1", "direction": "m2", "adversary": "m3"})
    sealed = evidence.seal(spark.createDataFrame(docs, SCHEMA))
    got = {}
    for r in evidence.evidence_problems(sealed, FORMAT).collect():
        got.setdefault(r.packet_id, set()).add(r.rule)
    assert {name: got.get(f"p{n}", set()) for n, name in enumerate(CHANGES)} == {name: rules for name, (_, _, rules) in CHANGES.items()}


def test_the_seal_holds_every_field_at_every_depth(spark):
    """The hash is that of Python's sorted JSON, and a field changed after sealing breaks it."""
    doc = document()
    whole = spark.createDataFrame([doc], SCHEMA)
    assert evidence.seal(whole).first().evidence_hash == hashlib.sha256(canonical(doc).encode()).hexdigest()
    sealed = evidence.seal(whole).withColumn("roles", F.transform("roles", lambda r: r.withField("actual_model", F.concat(r["actual_model"], F.lit("x")))))
    assert "seal" in {r.rule for r in evidence.document_problems(sealed, FORMAT).collect()}


@pytest.mark.parametrize("value", [
    {"z": 1, "a": {"y": [{"d": "é\"\\", "c": None}, {"c": 2, "d": None}], "b": True}, "m": {"k2": 1, "k1": 2}},
    {"z": None, "a": None, "m": {}},
])
def test_keys_are_sorted_at_every_depth(spark, value):
    df = spark.createDataFrame([value], "z int, a struct<y array<struct<d string, c int>>, b boolean>, m map<string, int>")
    assert df.select(nested_canonical_json(df.schema, "z", "a", "m").alias("j")).first().j == canonical(value)


def test_no_documents(spark):
    sealed = evidence.seal(spark.createDataFrame([], SCHEMA))
    assert evidence.evidence_problems(sealed, FORMAT).count() == 0
