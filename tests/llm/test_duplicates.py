"""Fingerprints and SimHash groups against comparisons of all pairs."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from stepstone.llm import fingerprint, simhash
from stepstone.operators.components import smallest_members


def naive_simhash(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, distance=3):
    """Sets of values that are linked by chains of at most ``distance`` differing bits."""
    values, parent = list(values), {}
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for k, a in enumerate(values):
        for b in values[k + 1 :]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= distance:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(5)
    rows = set()
    for c in range(12):
        value = int(rng.integers(0, 2**63)) * 2 + 1
        for _ in range(25 if c else 250):
            near = value
            for b in rng.choice(64 if c else 10, rng.integers(0, 6), replace=False):
                near ^= 1 << int(b)
            rows.add(near - (1 << 64) if near >> 63 else near)
    return sorted(rows), spark.createDataFrame([(r,) for r in sorted(rows)], "fp bigint")


PLANS = [None, [(list(range(21)), 1), (list(range(21, 42)), 0), (list(range(42, 64)), 0)], [(list(range(32)), 1), (list(range(32, 64)), 1)]]


@pytest.mark.parametrize("part_rows", [512, 30])
@pytest.mark.parametrize("plan", PLANS)
def test_links_connect_what_all_pairs_connect(clustered, monkeypatch, plan, part_rows):
    values, distinct = clustered
    if plan:
        monkeypatch.setattr(simhash, "plan_probes", lambda *a: plan)
    roots = {r.node: r.root for r in smallest_members(simhash.near_links(distinct, 3, part_rows)).collect()}
    assert {v: roots.get(v, v) for v in values} == groups(values)


def test_thresholds_are_the_cheapest_that_leave_no_pair_out():
    costs = [[0.0, 5.0, 50.0, 500.0, 900.0], [0.0, 9.0, 20.0, 90.0, 900.0], [0.0, 100.0, 200.0, 300.0, 900.0]]
    price, chosen = simhash.choose_thresholds(costs, 4)
    assert sum(t + 1 for t in chosen) == 4
    every = [(a, b, c) for a in range(-1, 4) for b in range(-1, 4) for c in range(-1, 4) if a + b + c + 3 == 4]
    assert price == min(sum(costs[k][t + 1] for k, t in enumerate(x)) for x in every)


def test_correlated_bits_share_a_partition():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (4000, 64))
    bits[:, 40] = bits[:, 3]
    bits[:, 50] = bits[:, 3]
    parts = simhash.group_bits(len(bits), (bits.T @ bits).astype(float), 4)
    assert sorted(b for p in parts for b in p) == list(range(64))
    assert any({3, 40, 50} <= set(p) for p in parts)


def test_groups_of_odd_rows(odd):
    got = simhash.near_duplicates(odd).collect()
    rows = [(r.doc_id, naive_simhash(r.text)) for r in odd.select("doc_id", "text").collect()]
    root = groups({fp for _, fp in rows})
    least = {}
    for doc_id, fp in rows:
        if doc_id is not None:
            least[root[fp]] = min(doc_id, least.get(root[fp], doc_id))
    want = Counter((d, fp, least.get(root[fp])) for d, fp in rows)
    assert Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == want


def test_one_row_of_each_group_stays(odd, nothing):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    root = groups({naive_simhash(r.text) for r in odd.collect()})
    assert sorted(root[naive_simhash(r.text)] for r in rows) == sorted(set(root.values()))
    assert simhash.one_of_each(nothing).collect() == []
    assert simhash.near_duplicates(nothing).collect() == []


def test_edited_pairs(spark, odd, nothing):
    rows = odd.where("doc_id IS NOT NULL AND doc_id <> 6").select("doc_id", "text").collect()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    order = sorted(rows, key=lambda r: -r.doc_id)
    for blocks in (1, 3, 8):
        got = {r.doc_id: r for r in fingerprint.edited_pairs(docs, blocks).collect()}
        assert len(got) == len(rows)
        for k, row in enumerate(order):
            text, after = row.text or "", order[(k + 1) % len(order)].text or ""
            half = len(text) // 2
            edited = text[: len(text) - half] + after[:half]
            own, other, following = (fingerprint.digests([t]) for t in (text, edited, after))
            r = got[row.doc_id]
            assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
            assert (r.fingerprint, r.edited_fingerprint) == (bytes(own[0]).hex(), bytes(other[0]).hex())
            assert r.near_edited == pytest.approx(fingerprint.likeness(own, other)[0])
            assert r.near_next == pytest.approx(fingerprint.likeness(own, following)[0])
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert fingerprint.edited_pairs(nothing).collect() == []
    single = fingerprint.edited_pairs(docs.where("doc_id = 9")).collect()
    assert [r.near_next for r in single] == [1.0]
    assert fingerprint.edited_pairs(odd, 4).count() == odd.count()
    assert fingerprint.edited_pairs(docs.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text")).count() == len(rows)


def test_digests_of_equal_texts_are_equal(odd):
    by_text = {}
    for r in fingerprint.fingerprints(odd.withColumn("doc_id", odd["text"])).collect():
        by_text.setdefault(r.doc_id or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
