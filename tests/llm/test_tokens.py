"""BPE, packing and word pieces against the tokenizers library and plain loops."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stepstone.llm import bpe, lattice, packing, wordblocks, wordpiece
from stepstone.llm.vocabulary import byte_pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def random_texts(n):
    rng = random.Random(1)
    parts = ["a", "B", " ", "  ", "\n", "\t", "'s", "'re", "'", "é", "1", "٣", "中", "　", "\x85", "​", "!", "<|endoftext|>",
             "<|endo", "\U0001f600", "ࡰ", "\U00010570", "\U0001ccf0", "x́", "\x00", "\x1c", "'S", "_", "\xa0"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(600)]


def test_encode_and_decode_equal_the_library(spark, odd, library):
    texts = random_texts(600) + [" " * 4000 + "x", "ab" * 20000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    rows = {r.doc_id: r for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    assert len(rows) == len(texts)
    for k, t in enumerate(texts):
        assert rows[k].ids == ids_of(library, t)
        assert rows[k].decoded == library.decode(rows[k].ids, skip_special_tokens=False)
    whole = odd.select("doc_id", "text").collect()
    got = bpe.encode(odd, PATH).collect()
    key = lambda pairs: sorted(pairs, key=repr)
    assert key((r.doc_id, r.ids) for r in got) == key((r.doc_id, ids_of(library, r.text)) for r in whole)


def test_blocks_may_end_anywhere(spark, odd, library, monkeypatch):
    """Small blocks and chunks give the same ids, and all keys come along."""
    monkeypatch.setattr(wordblocks, "BLOCK_PLACES", 50)
    monkeypatch.setattr(wordblocks, "CHUNK_PLACES", 20)
    got = bpe.encode(odd.coalesce(1), PATH, keys=["doc_id", "lang"]).collect()
    assert Counter((r.doc_id, r.lang, tuple(r.ids)) for r in got) == Counter(
        (r.doc_id, r.lang, tuple(ids_of(library, r.text))) for r in odd.collect()
    )


def test_rows_in_another_order_stop_the_job(spark, monkeypatch):
    """As many words in the same places, but the second walk meets the rows in the other order."""
    rows = [(1, "one two"), (2, "six ten")]
    schema = "doc_id bigint, text string"
    again = spark.createDataFrame(rows[::-1], schema).coalesce(1)
    second = wordblocks.numbered_rows
    monkeypatch.setattr(wordblocks, "numbered_rows", lambda docs, keys, words: second(again, keys, words))
    docs = spark.createDataFrame(rows, schema).coalesce(1)
    for run in (lambda: bpe.encode(docs, PATH).collect(), lambda: lattice.score(docs, PATH).collect()):
        with pytest.raises(Exception, match="another order"):
            run()


def test_no_rows(spark, nothing):
    assert bpe.decode(bpe.encode(nothing, PATH), PATH).collect() == []
    assert packing.packed(nothing).collect() == []
    assert wordpiece.count_pieces(nothing, PATH).collect() == []


def test_broken_ids_decode(spark):
    ids = spark.createDataFrame([(1, [0, 255, 50256]), (2, None), (3, [])], "doc_id int, ids array<int>")
    data = byte_pieces(PATH)
    back = {v: k for k, v in data.items()}
    want = (back[0] + back[255]).decode("utf-8", "replace") + "<|endoftext|>"
    assert {r.doc_id: r.decoded for r in bpe.decode(ids, PATH).collect()} == {1: want, 2: "", 3: ""}


def test_pieces_hold_the_texts(odd, library):
    rows = packing.packed(odd).collect()
    texts = odd.select("doc_id", "text").collect()
    want = Counter()
    for r in texts:
        ids, before = [*ids_of(library, r.text), 2], 0
        for n, size in enumerate(packing.piece_lengths(len(ids), 1024)):
            want[r.doc_id, n, before, size, zlib.crc32(np.array(ids[before : before + size], "<u4").tobytes())] += 1
            before += size
        assert before == len(ids)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


def one_bin_at_a_time(lengths, capacity):
    left, bins = sorted(lengths), 0
    while left:
        filled, gap = [], capacity
        for k in range(len(left) - 1, -1, -1):
            if left[k] <= gap:
                gap -= left[k]
                filled.append(left.pop(k))
        if gap and left:
            least, best = min(filled), None
            for i in range(len(left)):
                for j in range(i + 1, len(left)):
                    total = left[i] + left[j]
                    if least < total <= gap + least and (best is None or total > best[0]):
                        best = (total, i, j)
            if best:
                left.pop(best[2])
                left.pop(best[1])
                left = sorted([*left, least])
        bins += 1
    return bins


def test_best_two_fit_equals_one_bin_at_a_time():
    rng = random.Random(3)
    for _ in range(150):
        capacity = rng.randint(5, 60)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 80))]
        bins = packing.best_two_fit(Counter(lengths), capacity)
        assert sum(b.times for b in bins) == one_bin_at_a_time(lengths, capacity)
        used = Counter()
        for b in bins:
            assert sum(k * n for k, n in b.uses.items()) <= capacity
            for k, n in b.uses.items():
                used[k] += n * b.times
        assert used == Counter(lengths)


def test_packing_is_tight():
    rng = random.Random(4)
    lengths = [min(1024, int(rng.lognormvariate(5.5, 1)) + 1) for _ in range(20000)]
    bins = packing.best_two_fit(Counter(lengths), 1024)
    assert sum(b.times for b in bins) <= -(-sum(lengths) // 1024) * 1.01


def greedy(word, pieces, most):
    at = count = 0
    while at < len(word):
        size = next((n for n in range(min(most, len(word) - at), 0, -1) if word[at : at + n] in pieces), 0)
        if not size:
            return 1
        at, count = at + size, count + 1
    return count


def test_automaton_equals_greedy_search():
    rng = random.Random(2)
    for _ in range(150):
        pieces = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))})
        words = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 9))) for _ in range(30)]
        ends = np.cumsum([len(w) for w in words])
        starts = ends - [len(w) for w in words]
        got = wordpiece.Automaton(pieces).lengths(np.frombuffer(b"".join(words), np.uint8), starts, ends, None)
        assert list(got) == [greedy(w, set(pieces), 5) for w in words]


def test_piece_counts_of_odd_rows(odd):
    pieces = byte_pieces(PATH)
    most = max(map(len, pieces))
    want = Counter()
    for r in odd.select("doc_id", "text").collect():
        words = (r.text or "").encode().split()
        want[r.doc_id, len((r.text or "").encode()), len(words), sum(greedy(b" " + w, pieces, most) for w in words)] += 1
    assert Counter(tuple(r) for r in wordpiece.count_pieces(odd, PATH).collect()) == want
