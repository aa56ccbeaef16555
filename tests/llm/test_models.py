"""Scores, votes, lists and the pipeline: brute force, held-out accuracy, and odd rows."""

import math
import random
import re
import zlib
from collections import Counter
from datetime import datetime

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from stepstone.llm import lattice, quality, rules, simhash, toxicity, url_lists

PATH = public_tokenizers.path("byte_bpe_50k.json")


# op3
def test_lattice_sums_over_all_segmentations(monkeypatch):
    rng = random.Random(1)
    pieces = [bytes([b]) for b in b" abc"] + [b"ab", b" a", b"bc", b"abc", b"ca", b" ab"]
    scores = np.log(np.array([rng.random() for _ in pieces]))
    score = dict(zip(pieces, scores, strict=True))
    words = [bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 7))) for _ in range(40)]

    def paths(text):
        if not text:
            return [[]]
        return [[p, *rest] for p in pieces if text.startswith(p) for rest in paths(text[len(p):])]

    data, offsets = np.frombuffer(b"".join(words), np.uint8), np.concatenate([[0], np.cumsum([len(w) for w in words])])
    counts = np.array([rng.randint(1, 5) for _ in words], float)
    got, expected = lattice.Lattice(pieces).marginals(data, offsets, scores, counts)
    monkeypatch.setattr(lattice, "LONG_WORD", 1)
    again = lattice.Lattice(pieces).marginals(data, offsets, scores, counts)
    assert again[0] == pytest.approx(got) and again[1] == pytest.approx(expected)
    want = Counter()
    for word, value, n in zip(words, got, counts, strict=True):
        ways = paths(b" " + word)
        chances = [math.exp(sum(score[p] for p in way)) for way in ways]
        assert value == pytest.approx(math.log(sum(chances)))
        for way, chance in zip(ways, chances, strict=True):
            for p in way:
                want[p] += n * chance / sum(chances)
    assert expected == pytest.approx([want[p] for p in pieces])


def test_base_scores_and_counts_of_odd_rows(odd, nothing):
    rows = odd.select("doc_id", "text").collect()
    tokens = [((r.text or "").encode().lower().split() + [None]) for r in rows]
    held = [zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 10 == 0 for r in rows]
    counts = Counter(t for ts, h in zip(tokens, held, strict=True) if not h for t in ts)
    n, v = sum(counts.values()), len(counts)
    got = lattice.score(odd, PATH).collect()
    assert {r.train_tokens for r in got} == {n}
    want = Counter(
        (r.doc_id, h, len(ts), sum(counts[t] > 0 for t in ts), round(sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts), 4))
        for r, ts, h in zip(rows, tokens, held, strict=True)
    )
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got) == want
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert lattice.score(nothing, PATH).collect() == []


def test_model_probabilities_sum_to_one():
    """Over all words of up to three letters of a small alphabet and the end, pieces' mass being spent within them."""
    t = lattice.Tokens(total=20, distinct=4, once=2, twice=1, ends=5)
    c = np.array([9, 4, 2, 0, 0])
    share = np.array([0.2, 0.1, 0.1, 0.4, 0.2])
    assert (10 ** t.model(c, np.log10(share))).sum() + 10 ** t.end() == pytest.approx(1)


# op8, op9
def made_up(rng, n):
    plain = ["".join(rng.choice("bdfgklmnprstv") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(120)]
    bad = ["zworx", "quixty", "jhexa"]
    texts, labels = [], []
    for k in range(n):
        words = rng.choices(plain, k=rng.randint(20, 300))
        if k % 3 == 0:
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(bad)
        texts.append(" ".join(words))
        labels.append(float(k % 3 == 0))
    return texts, np.array(labels), plain


def toxic_scores(model, texts):
    lists = [toxicity.tokens(t) for t in texts]
    number = {}
    places = np.array([number.setdefault(w, len(number)) for words in lists for w in words], np.int64)
    return model.texts(places, model.words(list(number)), np.array([len(x) for x in lists]))


def test_unseen_misspellings_score_as_toxic():
    rng = random.Random(7)
    texts, labels, plain = made_up(rng, 1800)
    model = toxicity.fit(texts[:1500], labels[:1500])
    assert ((toxic_scores(model, texts[1500:]) >= 0.7) == (labels[1500:] == 1)).mean() > 0.95
    long_text = " ".join(rng.choices(plain, k=5000))
    clean, misspelt = toxic_scores(model, [long_text, long_text + " quixtyy zworxx"])
    assert clean < 0.5 < misspelt


def test_windows_cover_each_word_once():
    counts = np.array([0, 1, 31, 32, 33, 65, 0, 1000])
    text, begin, size = toxicity.windows(counts)
    assert size.max() <= toxicity.WINDOW and (np.bincount(text, size, minlength=len(counts)) == counts).all()
    assert (begin == np.cumsum(size) - size).all()


@pytest.mark.parametrize("module", [toxicity, quality])
def test_scores_of_odd_rows(spark, odd, nothing, labels, module):
    model = module.fit_on(odd, labels)
    got = module.with_score(odd, model, odd.columns, name="_s").collect()
    assert len(got) == odd.count() and all(0 <= r["_s"] <= 1 for r in got)
    by_text = {}
    for r in got:
        by_text.setdefault(r.text or "", set()).add(r["_s"])
    assert all(len(v) == 1 for v in by_text.values())
    assert module.with_score(nothing, module.fit_on(nothing, labels.limit(0)), ["doc_id"]).collect() == []
    even = module.with_score(odd, module.fit_on(odd, labels.limit(0)), ["doc_id"]).collect()
    assert {r.score for r in even} == {0.5}


def test_tables_learn_a_pair_that_no_feature_shows_alone():
    rng = np.random.default_rng(3)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def test_features_see_junk():
    rows = quality.features(pa.array([None, "", "of of of of of of", "The cat sat. It was fine.", "LOUD!! LOUD!! WORDS!!"]))
    at = {n: k for k, n in enumerate(quality.FEATURES)}
    assert not rows[:2].any() and np.isfinite(rows).all()
    assert rows[2, at["repeats_next"]] > 0.8 and rows[4, at["exclamations"]] > rows[3, at["exclamations"]]


# op10
def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {k + d for k, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_rule_counts_of_odd_rows(spark, odd, nothing):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["a", "b", "c|", "#"], k=rng.randint(0, 40))) + rng.choice(["", "\nx\nx", "\n \n"]) for _ in range(200)]
    docs = odd.unionByName(spark.createDataFrame([(1000 + k, t) for k, t in enumerate(texts)], "doc_id bigint, text string"), True)
    got = rules.judge(docs).collect()
    want = Counter((r.doc_id, *base_counts(r.text)) for r in docs.collect())
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    assert Counter(tuple(r[n] for n in names) for r in got) == want
    assert all(not (r.kept and r.base_failed) and 0 <= r.quality <= 1 for r in got)
    assert rules.judge(nothing).collect() == []


def test_expectation_maximisation_finds_accuracies(spark):
    """Votes drawn from known accuracies; the verdicts must follow the hidden truth."""
    rng = np.random.default_rng(4)
    truth = rng.random(4000) < 0.8
    rows = []
    for good in truth:
        right = rng.random(5) < (0.97 if good else 0.6)
        rows.append(tuple(int(v) if rng.random() < 0.9 else -1 for v in np.where(right, good, not good)))
    votes = spark.createDataFrame(rows, ", ".join(f"vote_{k} int" for k in range(5)))
    accuracies, prior = rules.fit_accuracies(votes, 5)
    assert prior == pytest.approx(0.8, abs=0.1)  # the weight of the first accuracies pulls a little
    assert all(a.good == pytest.approx(0.97, abs=0.03) and a.bad == pytest.approx(0.5, abs=0.25) for a in accuracies)
    kept = np.array([r.p >= 0.5 for r in votes.select(rules.posterior(accuracies, prior).alias("p")).collect()])
    assert (kept == np.array([r.p >= 0.5 for r in votes.select(rules.posterior([rules.Accuracy(0.97, 0.6)] * 5, 0.8).alias("p")).collect()])).mean() > 0.93


# op2
def test_entries_decide_by_time_and_kind(spark):
    day = lambda d: datetime(2024, 1, d)
    changes = [
        ("block", "d:example.com", day(2), 1, True), ("block", "d:example.com", day(5), 2, False),
        ("block", "d:example.com", day(6), 3, True), ("block", "d:example.com", day(6), 4, False),  # never active
        ("allow", "h:good.example.com", day(1), 5, True), ("allow", "h:good.example.com", day(1), 6, True),
        ("block", "p:good.example.com/x", day(3), 7, True), ("block", "h:gone.org", day(3), 8, False),
        (None, "h:a.org", day(1), 9, True), ("block", None, day(1), 10, True), ("block", "h:a.org", None, 11, True), ("block", "h:a.org", day(1), 12, None),
    ]
    entries = url_lists.validity(spark.createDataFrame(changes, "list string, key string, at timestamp_ntz, seq int, added boolean"))
    assert entries.count() == 3
    urls = [
        ("https://bad.example.com/a", 1, "none"), ("https://bad.example.com/a", 2, "block"), ("https://bad.example.com/a", 4, "block"),
        ("https://bad.example.com/a", 5, "none"), ("https://BAD.example.com:80/a?q=1", 3, "block"), ("https://good.example.com/y", 3, "allow"),
        ("https://good.example.com/x/z", 2, "allow"), ("https://good.example.com/x/z", 4, "block"), ("https://a.org/", 9, "none"),
        ("no url", 3, "none"), (None, 3, "none"), ("", 3, "none"), ("https://good.example.com/y", None, "none"),
    ]
    rows = [(k, u, d and day(d), "extra") for k, (u, d, _) in enumerate(urls)]
    rows.append(rows[0])
    found = url_lists.judge(spark.createDataFrame(rows, "page_id bigint, url string, fetched_at timestamp_ntz, span string"), entries)
    got = {r.page_id: r for r in found.collect()}
    assert [got[k].verdict for k in range(len(urls))] == [v for *_, v in urls]
    assert got[0].n_captures == 2 and got[1].active_to == day(5)
    empty = url_lists.judge(spark.createDataFrame([], "page_id bigint, url string, fetched_at timestamp_ntz"), entries)
    assert empty.collect() == []


def test_pipeline_stages(spark, odd, nothing, small, tmp_path_factory):
    """Each stage equals its rule applied row by row to its own input."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    toxic = {r.doc_id: r.score for r in toxicity.with_score(docs, toxicity.fit_on(docs, toxicity.labels_of(spark, small)), ["doc_id"]).collect()}
    clean = corpus_pipeline.cut(corpus_pipeline.drop_toxic(spark, docs, small))
    assert {r.doc_id for r in clean.collect()} == {k for k, s in toxic.items() if s < 0.7} and clean.columns == docs.columns
    good = corpus_pipeline.cut(corpus_pipeline.drop_poor(spark, clean, small))
    assert good.columns == docs.columns and 0 < good.count() <= clean.count()
    single = corpus_pipeline.cut(corpus_pipeline.drop_near_duplicates(spark, good, small))
    groups = simhash.near_duplicates(good).collect()
    assert sorted(r.doc_id for r in single.collect()) == sorted({r.component_id for r in groups})
    assert {r.doc_id for r in corpus_pipeline.pack(spark, single, small).collect()} == {r.doc_id for r in single.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "packing"]
