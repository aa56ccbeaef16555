"""Packet edges and their votes by key, shuffled once, against plain loops on rows that repeat or have nulls."""

import random
from collections import Counter

from pyspark.sql import functions as F

from stepstone.operators import consensus as ops
from stepstone.operators import dedupe
from stepstone.session import cut_counted

EDGES = "packet_id string, topic_id string, prerequisite_id string, strength string, content_fingerprint string"
VOTES = "packet_id string, topic_id string, prerequisite_id string, role string, verdict string, resolved_strength string, reason string, model string"


def tables(rng):
    """Edges and votes; some edges come twice or have no key, some votes are missing, doubled, malformed or unasked."""
    edges, votes = [], []
    for p in range(60):
        packet = None if p == 7 else f"p{p}"
        for n in range(rng.randint(1, 3)):
            key = (packet, f"t{n}", None if rng.random() < 0.03 else f"r{n}")
            row = (*key, rng.choice(["hard", "soft", None]), f"f{n}")
            edges += [row] * (2 if rng.random() < 0.05 else 1)
            for role in ops.ROLES:
                vote = (*key, role, rng.choice(["reviewed"] * 9 + ["rejected"]), rng.choice(["unchanged"] * 9 + ["soft"]), "ok", f"m-{role}")
                votes += [vote] * rng.choice([1] * 60 + [0, 2])
        if rng.random() < 0.1:
            votes.append((packet, "t9", "r9", rng.choice(["referee", None, "direction"]), "maybe", "soft", "", "m"))
    return edges, votes


def verdicts_by_hand(edges, votes):
    keys, out = {e[:3] for e in edges}, {}
    n = Counter(v[:4] for v in votes)
    asked = {(*k, r) for k in keys for r in ops.ROLES}
    for packet, role in {(a[0], a[3]) for a in asked | set(n)}:
        mine = [k for k in asked if (k[0], k[3]) == (packet, role)]
        given = [k for k in n if (k[0], k[3]) == (packet, role)]
        met = [k for k in mine if k in n and None not in k]
        cast = [v for v in votes if (v[0], v[3]) == (packet, role)]
        bad = sum(v[4] not in ops.VERDICTS or not v[6] for v in cast)
        out[packet, role] = (len(mine) - len(met), len(given) - len(met), sum(n[k] > 1 for k in met), bad)
    return out


def test_verdicts_and_decisions_of_odd_rows(spark):
    edges, votes = tables(random.Random(3))
    e, v = spark.createDataFrame(edges, EDGES), spark.createDataFrame(votes, VOTES)
    judged = ops.response_verdicts(v, e)
    found = {(r.packet_id, r.role): (r.missing, r.extra, r.doubled, r.malformed) for r in judged.collect()}
    assert found == verdicts_by_hand(edges, votes)
    passed = {r.packet_id for r in ops.packet_verdicts(judged).collect() if r.failure is None}
    wanted = Counter()
    for key in {r[:4] for r in edges}:
        cast = [x for x in votes if x[:3] == key[:3] and None not in key[:3]]
        said = {key[3] if x[5] == "unchanged" else x[5] for x in cast} - {None}
        if key[0] is None or key[0] not in passed:
            label = "packet-failed"
        elif len({x[4] for x in cast}) > 1 or len(said) > 1:
            label = "disagreement"
        else:
            label = "unanimous-rejected" if {x[4] for x in cast} == {"rejected"} else "unanimous-reviewed"
        wanted[(*key, label, min(said) if label == "unanimous-reviewed" and said else None)] += 1
    got = ops.edge_decisions(e, v, ops.packet_verdicts(judged)).collect()
    assert Counter(tuple(r) for r in got) == wanted
    assert {"packet-failed", "disagreement", "unanimous-reviewed"} <= {k[4] for k in wanted}


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_edges_and_votes_are_shuffled_once(spark):
    """Proposals of written ballots shuffle sums of packets and, where they are large, rows of edges once more by packet."""
    edges, votes = (spark.createDataFrame(rows, schema) for rows, schema in zip(tables(random.Random(4)), (EDGES, VOTES), strict=True))
    cast = ops.ballots(edges, votes)
    assert exchanges(cast) == 1
    found = ops.proposals(ops.decided(cast, ops.packet_verdicts(ops.judged(cast))))
    assert exchanges(found) <= 6  # three times the ballots' own, as they are not written here
    assert found.count()


def test_rows_of_a_key_are_listed_after_the_shuffle_only(spark):
    edges, votes = tables(random.Random(8))
    cast = ops.ballots(spark.createDataFrame(edges, EDGES), spark.createDataFrame(votes, VOTES))
    before = cast._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning")
    assert len(before) == 2 and "collect_list" in before[0] and "collect_list" not in before[1]


def test_drift_is_found_by_one_shuffle(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "y")], "n int, s string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "n int, s string")
    drift = ops.evidence_drift(a, b)
    assert exchanges(drift) == 1
    assert sorted(tuple(r) for r in drift.collect()) == [(1, "x", "stored"), (3, "y", "stored"), (3, "z", "derived")]
    assert ops.evidence_drift(a.withColumn("n", F.col("n") + 0), a).count() == 0


def test_only_contested_names_are_decided_in_rounds(spark, monkeypatch):
    seen = []

    def counted(df, tag="cut", where=None):
        out, n = cut_counted(df, tag, where)
        seen.append(n)
        return out, n

    monkeypatch.setattr(dedupe, "cut_counted", counted)
    proposals = spark.createDataFrame([("x", n, f"p{n}") for n in range(30)], "bucket string, ord int, id string")
    own = [("x", f"p{n}", f"n{n}") for n in range(28)]
    names = spark.createDataFrame([*own, ("x", "p3", "n2"), ("x", "p3", "n2"), ("x", "p28", None)], "bucket string, id string, name string")
    got = {r.id: r.verdict for r in dedupe.resolve_name_conflicts(proposals, names).collect()}
    assert got == {f"p{n}": "review" if n == 3 else "split" for n in range(30)}
    assert seen == [2, 0]  # both claims on n2 alone
