"""Ranked search, conversation repair and nearest neighbours against plain loops over all rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stepstone.llm import ball_tree, conversations, neighbours

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


# op11
def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, k=10):
    texts = [(d, Counter(terms(t))) for d, t in docs]
    n = sum(1 for _, c in texts if c)
    total = sum(sum(c.values()) for _, c in texts)
    df = Counter(t for _, c in texts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for t, f in df.items()}
    out = Counter()
    for item, text in items:
        scores = []
        for d, c in texts:
            m = 100 - 75 + (75 * sum(c.values()) * n) // total if total else 0
            score = sum(weight[t] * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0))
        for rank, (score, none, d) in enumerate(sorted(scores)[:k], 1):
            out[item, rank, None if none else d, -score] += 1
    return out


def test_terms():
    texts = [None, "", "A-b c", "É ÀB9", "--", "x\x00y", "日本, ok", "last"]
    found, counts = ball_tree.terms_of(pa.array(texts))
    assert counts.tolist() == [len(terms(t)) for t in texts]
    assert [t.decode() for t in found.to_pylist()] == [t for text in texts for t in terms(text)]
    assert ball_tree.terms_of(pa.array([None, ""]))[1].tolist() == [0, 0]


@pytest.mark.parametrize("block_bytes", [1 << 17, 40])
def test_ranks_of_odd_rows(spark, odd, nothing, block_bytes):
    items = [(1, "the cat sat on the mat the"), (2, "WORD one"), (3, None), (4, "!!"), (5, "中文字 ñandú"), (6, "unknownterm"), (7, "word one"), (None, "dog w5"), (8, "the cat sat on the mat the")]
    asked = spark.createDataFrame([(*x, "extra") for x in items], "item_id bigint, text string, asked string").repartition(2)
    got = Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in ball_tree.search(odd, asked, block_bytes=block_bytes).collect())
    assert got == ranked([(r.doc_id, r.text) for r in odd.collect()], items)
    assert ball_tree.search(nothing, asked).collect() == []
    assert ball_tree.search(odd, asked.limit(0)).collect() == []
    repeated = asked.unionAll(asked)
    assert ball_tree.search(odd, repeated).count() == sum(got.values())


def test_ranks_with_many_shards_and_ties(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    docs = [(k, " ".join(words[min(int(rng.expovariate(0.02)), 299)] for _ in range(rng.randint(1, 80)))) for k in range(1500)]
    docs += [(2000 + k, docs[k % 7][1]) for k in range(200)]  # ties beyond the k-th rank
    items = [(k, docs[rng.randrange(1500)][1] if k % 2 else " ".join(rng.choices(words, k=6))) for k in range(25)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = ball_tree.search(frame, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == ranked(docs, items)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    width, rows = 60, 900
    centres = rng.random((6, width)) * (rng.random((6, width)) < 0.2)
    dense = (centres[rng.integers(0, 6, rows)] * 1e6).astype(np.int64) + rng.integers(0, 1000, (rows, width)) * (rng.random((rows, width)) < 0.1)
    dense[:, 0] += 1
    row, term = np.nonzero(dense)
    weight = rng.integers(1, 9000, width)
    shard = ball_tree.Shard(list(range(rows)), np.concatenate([[0], np.cumsum(np.bincount(row))]), term, dense[row, term], weight, 16)
    asked = (rng.random((20, width)) < 0.1).astype(np.int64)
    true = asked * weight @ dense.T
    bounds = shard.bounds(asked.astype(float))
    opened = 0

    class Leaves(dict):
        def __getitem__(self, k):
            nonlocal opened
            opened += 1
            return super().__getitem__(k)

    for leaf, (ids, *_) in shard.leaves.items():
        assert (bounds[leaf] >= true[:, ids].max(axis=1)).all()
    for node, children in shard.children.items():
        assert len(children) == 2
    leaves, shard.leaves = len(shard.leaves), Leaves(shard.leaves)
    for q in range(20):
        held = []
        shard.best(asked[q], bounds[:, q], held, 10)
        want = sorted(((-s, d) for d, s in enumerate(true[q].tolist()) if s > 0))[:10]
        assert sorted((-s, d) for s, _, d in held) == want
    assert opened < 0.8 * 20 * leaves


# op12
def plain_repair(rows):
    """Counts, and the least (cost, edits) with its lines by trying all edits."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        core = text.strip(" \t\n\x0b\f\r")
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    best = [None]

    def go(k, roles, cost, edits, lines, inserted):
        if not re.fullmatch("s?(ua)*u?", roles) or best[0] and (cost, edits) >= best[0][:2] and cost > best[0][0]:
            return
        if k == len(rows) and re.fullmatch("(s?(ua)+)?", roles) and (best[0] is None or (cost, edits) < best[0][:2]):
            best[0] = cost, edits, lines
        if not inserted:
            for role in ("user", "assistant"):
                go(k, roles + role[0], cost + 5, edits + "I", [*lines, role + ":"], True)
        if k == len(rows):
            return
        _, role, text = rows[k]
        go(k + 1, roles, cost + 2, edits + "D", lines, False)
        if faults[k] not in ("blank", "duplicate"):
            more = 5 * (faults[k] == "truncated")
            if role:
                go(k + 1, roles + role[0], cost + more, edits + "K", [*lines, role + ":" + text], False)
            for new in ("user", "assistant"):
                go(k + 1, roles + new[0], cost + 1 + more, edits + "R", [*lines, new + ":" + text], False)

    go(0, "", 0, "", [], False)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), *best[0][:2],
        hashlib.sha256("\n".join(best[0][2]).encode()).hexdigest(),
    )


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        k = zlib.crc32(key.encode()) % 20
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            out += [(conv, turn, "user" if k == 4 else role, text)] * (1 + (k == 3))
    return out


NAMES = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
COLUMNS = "conv_id bigint, turn bigint, role string, text string, place bigint, edits string, n int"


def made_conversations():
    rng = random.Random(12)
    texts = ["Yes.", "no", "Well then! ", "\t\n", "", None, "é ok?", "Sure.\n\n", "a.b"]
    roles = ["user", "assistant", "system", None, "", "tool", "user", "assistant"]
    rows = []
    for conv in range(160):
        for turn in range(rng.randint(1, 5)):
            late = rng.choice([turn, turn, turn, None, 0, turn + 7])
            role = rng.choice(roles) if rng.random() < 0.5 else ("user", "assistant")[turn % 2]
            rows.append((conv, late, role, rng.choice(texts) if rng.random() < 0.6 else f"Text {conv} {turn}."))
    rows += [(None, 0, "user", "hi."), (None, None, None, None), (500, 3, "user", "x" * 40000 + ".")]
    rows += [rows[7]] * 3 + [rows[11]] * 2 + [(900, k, "user", "Same.") for k in range(4)]
    return rows


@pytest.mark.parametrize("bits", [9, 1, 0])
def test_repairs_of_odd_conversations(spark, bits):
    rows = made_conversations()
    frame = spark.createDataFrame([(*r, 1, "e", 2) for r in rows], COLUMNS).repartition(3)
    got = {r.conv_id: tuple(r[c] for c in NAMES[1:]) for r in conversations.repair(frame, bits).collect()}
    left = {}
    for conv, *row in plain_damage(rows):
        left.setdefault(conv, []).append(tuple(row))
    assert set(got) == {r[0] for r in rows}
    for conv, found in got.items():
        assert found == (plain_repair(left[conv]) if conv in left else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())), conv


def test_copies_of_one_row_and_no_rows(spark):
    conv = next(k for k in range(1000) if zlib.crc32(f"{k}:1".encode()) % 20 > 4)
    rows = [(conv, 1, "user", "Copy.", 0, "", 0)] * 700
    got = conversations.repair(spark.createDataFrame(rows, COLUMNS)).first()
    assert (got.duplicate, got.illegal, got.cost, got.audit) == (699, 699, 1400, "D" * 700)  # cheaper than an inserted answer
    assert conversations.repair(spark.createDataFrame([], COLUMNS)).collect() == []


def test_spans_joined_are_derivations_of_the_whole():
    rng = random.Random(1)
    for _ in range(200):
        units = [rng.choice([(rng.choice("usat "), rng.random() < 0.3), rng.randint(1, 3)]) for _ in range(rng.randint(0, 9))]
        at = rng.randint(0, len(units))
        whole = conversations.derive(units, 0)
        spans = {q: conversations.derive(units[at:], q) for q in conversations.STATES}
        joined = conversations.join_spans(conversations.derive(units[:at], 0), spans)
        assert {q: x[:2] for q, x in joined.items()} == whole


# op13
def nearest(rows, query, k=5):
    def cosine(a, b):
        a, b = np.array(a, float), np.array(b, float)
        return float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b))

    own, v = query
    found = [(-cosine(v, w), i is None, i or 0) for i, w in rows if (i != own or i is None) and len(w) == len(v)]
    return [(None if none else i, -s) for s, none, i in sorted(found)[:k]]


VECTORS = "vec_id bigint, embedding array<float>, label int, shard int, v string, id string"


def test_neighbours_of_odd_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(k, [float(x) for x in np.float32(rng.normal(size=8))]) for k in range(120)]
    rows += [(200 + k, rows[3][1]) for k in range(20)]  # a vector of many rows
    rows += [(250, rows[3][1]), (None, rows[50][1]), (300, [1.0, 2.0]), (301, [2.0, 1.0]), (302, [-0.0, 1.0]), (303, [0.0, 1.0])]
    rows += [rows[0]] * 2 + [(350, [float(np.float32(1e30)), float(np.float32(1e-30))] + [0.0] * 6)]
    out = [(400, None), (450, [0.0] * 8), (500, [1.0, None] * 4), (550, [float("nan")] * 8), (600, [float("inf")] + [0.0] * 7), (650, [])]
    frame = spark.createDataFrame([(*r, 0, 1, "v", "i") for r in rows + out], VECTORS).repartition(4)
    good = sorted(set((i, tuple(v)) for i, v in rows), key=repr)
    vectors = neighbours.usable(frame)
    assert vectors.distinct().count() == len(set((i, tuple(x + 0.0 for x in v)) for i, v in rows))
    for numbers in (1 << 19, 300):
        index = neighbours.build_index(vectors, shard_numbers=numbers)
        assert index.count() >= 2 if numbers == 1 << 19 else index.count() > 3
        for block in (1 << 20, 16):
            got = {}
            for r in neighbours.search(index, vectors.where("id % 50 = 0"), block_numbers=block).collect():
                got.setdefault(r.query_id, []).append((r["rank"], r.id, r.score))
            assert set(got) == {0, 50, 100, 200, 250, 300, 350}
            for own, found in got.items():
                want = nearest(good, (own, next(v for i, v in good if i == own)))
                found.sort()
                assert [f[0] for f in found] == list(range(1, len(want) + 1))
                assert [f[2] for f in found] == pytest.approx([s for _, s in want], abs=1e-12)
                assert [f[1] for f in found] == [i for i, _ in want], own
    none = neighbours.usable(frame.limit(0))
    assert neighbours.search(neighbours.build_index(none), none).collect() == []
    assert neighbours.search(neighbours.build_index(none), vectors).collect() == []


def test_pruning_keeps_diverse_neighbours():
    rng = np.random.default_rng(0)
    points = neighbours.unit(rng.normal(size=(300, 6))).astype(np.float32)
    proposed = np.array([rng.permutation(300)[:40] for _ in range(5)], np.int32)
    own = np.arange(5)
    got = neighbours.robust_prune(points, own, proposed, 8, 1.2)
    for k in range(5):
        left = sorted((float(((points[k] - points[j]) ** 2).sum()), j) for j in set(proposed[k].tolist()) if j != k)
        kept = []
        while left and len(kept) < 8:
            _, best = left[0]
            kept.append(best)
            left = [(d, j) for d, j in left[1:] if 1.44 * float(((points[best] - points[j]) ** 2).sum()) > d]
        assert [x for x in got[k].tolist() if x >= 0] == kept


def test_recall_on_clusters():
    """Beam search on one shard of clustered vectors against all distances."""
    rng = np.random.default_rng(4)
    points = rng.normal(size=(40, 32))[rng.integers(0, 40, 3000)] + 0.5 * rng.normal(size=(3000, 32))
    points = neighbours.unit(points).astype(np.float32)
    graph, start = neighbours.build_graph(points)
    assert (graph[graph >= 0] < 3000).all() and (graph != np.arange(3000)[:, None]).all()
    found, _ = neighbours.beam_search(points, graph, start, points[::30], neighbours.BEAM)
    true = np.argsort(-(points[::30] @ points.T), axis=1)[:, :6]
    assert np.mean([len(set(a[:6]) & set(b)) / 6 for a, b in zip(found.tolist(), true.tolist(), strict=True)]) > 0.95


def test_registered_query_finds_the_nearest(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    got = {}
    for r in neighbours.pruned_graph(spark, small).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    asked = [r for r in rows if r[0] % 50 == 0]
    hits = sum(len(got[own] & {i for i, _ in nearest(rows, (own, v))}) for own, v in asked)
    assert hits >= 0.9 * 5 * len(asked)
