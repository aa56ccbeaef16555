"""Subword lattice likelihood: the probability of a text over all its segmentations into pieces.

Pieces are those of an existing vocabulary, and their order gives the first scores; expectation-maximisation over all
distinct training words then gives each piece its probability.  A word seen in training is an arc of its own besides: it
weighs its count less a discount, and what the discounts leave goes to the segmentations into pieces.  No piece holds a blank
but as its first byte, so a text's lattice falls apart at word starts: a text's log probability is the sum of its words' and
of the end's, and each distinct word goes through the forward recursion once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepstone.llm import wordblocks
from stepstone.llm.registry import documents, query
from stepstone.llm.texts import flat_utf8
from stepstone.llm.vocabulary import Trie, byte_pieces
from stepstone.session import cut

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HELD_OUT_ONE_IN = 10
ITERATIONS = 6
#: Added to every piece's expected count, so that no piece is impossible.
SMOOTHING = 0.01
#: Bytes of words whose lattices are walked together.
CELLS = 1 << 20
#: Words of more bytes are walked one by one.
LONG_WORD = 400


class Lattice:
    """Forward and backward recursions over the pieces of many words at once; each word is read after one blank."""

    def __init__(self, pieces: list[bytes]):
        self.trie = Trie(pieces)

    def _arcs(self, grid: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, words, pieces) of all pieces in the words of a grid, longest word first, by start."""
        for start in range(grid.shape[1]):
            lanes = np.arange(np.searchsorted(-sizes, -start, "left"))
            node, end = np.zeros(len(lanes), np.int32), start
            while len(lanes):
                node = self.trie.go(node, grid[lanes, end].astype(np.int64))
                lanes, node, end = lanes[node >= 0], node[node >= 0], end + 1
                piece = self.trie.piece[node]
                found = piece >= 0
                if found.any():
                    yield start, end, lanes[found], piece[found]
                on = sizes[lanes] > end
                lanes, node = lanes[on], node[on]

    def _grids(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(words, bytes, sizes) in groups of like size; sizes count the blank before each word."""
        sizes = np.diff(offsets) + 1
        order, at = np.argsort(-sizes, kind="stable"), 0
        while at < len(order):
            width = int(sizes[order[at]])
            rows = order[at : at + max(1, CELLS // width)]
            size = sizes[rows]
            grid = np.zeros((len(rows), width), np.uint8)
            grid[:, 0] = 0x20
            inside = np.arange(width - 1) < (size - 1)[:, None]
            where = offsets[rows][:, None] + np.arange(width - 1)
            grid[:, 1:][inside] = data[where[inside]]
            yield rows, grid, size
            at += len(rows)

    def _one_word(self, word: np.ndarray, scores: np.ndarray, count: float | None, expected: np.ndarray) -> float:
        """The same recursions along one long word: arcs of all starts are found together, then walked one by one."""
        begin, node, length, found = np.arange(len(word)), np.zeros(len(word), np.int32), 0, []
        while len(begin):
            node = self.trie.go(node, word[begin + length].astype(np.int64))
            begin, node, length = begin[node >= 0], node[node >= 0], length + 1
            piece = self.trie.piece[node]
            found.append(np.stack([begin, begin + length, piece])[:, piece >= 0])
            on = begin + length < len(word)
            begin, node = begin[on], node[on]
        start, end, piece = (np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64))
        order = np.argsort(start, kind="stable")
        start, end, piece = start[order], end[order], piece[order]
        arcs = list(zip(start.tolist(), end.tolist(), scores[piece].tolist(), strict=True))

        def add(a: float, b: float) -> float:
            if a < b:
                a, b = b, a
            return a + math.log1p(math.exp(b - a)) if b > -math.inf else a

        forward = [0.0] + [-math.inf] * len(word)
        for a, b, weight in arcs:
            forward[b] = add(forward[b], forward[a] + weight)
        whole = forward[-1]
        if count is None or whole == -math.inf:
            return whole
        backward = [-math.inf] * len(word) + [0.0]
        for a, b, weight in reversed(arcs):
            backward[a] = add(backward[a], weight + backward[b])
        share = np.exp(np.array(forward)[start] + scores[piece] + np.array(backward)[end] - whole)
        expected += np.bincount(piece, share * count, minlength=len(scores))
        return whole

    def marginals(self, data: np.ndarray, offsets: np.ndarray, scores: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Natural log probability of each word, and the expected number of each piece in ``counts`` of the words."""
        out, expected = np.full(len(offsets) - 1, -np.inf), np.zeros(len(scores))
        for rows, grid, sizes in self._grids(data, offsets):
            if grid.shape[1] > LONG_WORD:  # too few words for a step to be worth an array
                for row, word, size in zip(rows, grid, sizes, strict=True):
                    out[row] = self._one_word(word[:size], scores, None if counts is None else counts[row], expected)
                continue
            forward = np.full((grid.shape[1] + 1, len(rows)), -np.inf)
            forward[0] = 0.0
            arcs = []
            for start, end, lanes, piece in self._arcs(grid, sizes):
                weight = scores[piece]
                forward[end, lanes] = np.logaddexp(forward[end, lanes], forward[start, lanes] + weight)
                if counts is not None:
                    arcs.append((start, end, lanes, piece))
            whole = forward[sizes, np.arange(len(rows))]
            out[rows] = whole
            if counts is None:
                continue
            backward = np.full(forward.shape, -np.inf)
            backward[sizes, np.arange(len(rows))] = 0.0
            times, known = counts[rows], np.isfinite(whole)
            for start, end, lanes, piece in reversed(arcs):
                after = scores[piece] + backward[end, lanes]
                backward[start, lanes] = np.logaddexp(backward[start, lanes], after)
                share = np.exp(forward[start, lanes] + after - np.where(known, whole, 0.0)[lanes])
                expected += np.bincount(piece, share * times[lanes] * known[lanes], minlength=len(scores))
        return out, expected


@lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    """Built once in each Python worker."""
    return Lattice(list(byte_pieces(path)))


def first_scores(n: int) -> np.ndarray:
    """Log probabilities by a piece's rank in the vocabulary; byte-level vocabularies list frequent merges first."""
    weight = 1.0 / np.arange(1, n + 1)
    return np.log(weight / weight.sum())


def fit_pieces(words: DataFrame, path: str, iterations: int = ITERATIONS) -> np.ndarray:
    """Natural log probabilities of pieces, from column ``word``; each distinct word counts once, as unseen words are rare.

    A task walks its words and sends a number for each piece; the vocabulary bounds what reaches the driver.
    """
    n = len(byte_pieces(path))
    scores = first_scores(n)

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n)
        for batch in batches:
            data, offsets = flat_utf8(batch.column(0))
            total += lattice(path).marginals(data, offsets, scores, np.ones(batch.num_rows))[1]
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["piece", "n"])

    for _ in range(iterations):
        found = words.select("word").mapInArrow(expect, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
        expected = np.full(n, SMOOTHING)
        expected[found.column("piece").to_numpy()] += found.column("n").to_numpy()
        scores = np.log(expected / expected.sum())
    return scores


@dataclass(frozen=True)
class Tokens:
    """Counts over training tokens: all, distinct, seen once and twice, and ends of texts."""

    total: int
    distinct: int
    once: int
    twice: int
    ends: int

    @property
    def discount(self) -> float:
        """What a seen word's count gives up for unseen words, by how many words were seen once and twice."""
        return min(max(self.once / (self.once + 2 * self.twice), 0.1), 0.9) if self.once and self.twice else 0.5

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.total + 0.1 * (self.distinct + 1)))

    def model(self, c: np.ndarray, pieces: np.ndarray) -> np.ndarray:
        """log10 probability of tokens from counts and log10 probabilities over pieces; all of it sums to one.

        Without training tokens words and the end share the chances evenly.
        """
        seen = np.maximum(c - self.discount, 0) / max(self.total, 1)
        rest = self.discount * self.distinct / self.total if self.total else 0.5
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log(seen), np.log(rest) + np.log(10) * pieces) / np.log(10)

    def end(self) -> float:
        return float(self.model(np.array([self.ends]), np.array([-np.inf if self.total else 0.0]))[0])


def held_out(id_col: str, one_in: int) -> Column:
    """A row without an id counts as one with an empty id."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % one_in == 0


def lower_words(text_col: str) -> Column:
    small = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), CAPITALS, SMALL)
    return F.array_remove(F.split(small, r"[\x20\x09-\x0D]+"), "")


def score(docs: DataFrame, path: str, one_in: int = HELD_OUT_ONE_IN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, piece_score) of every row, in log10.

    Rows whose crc32 of the id leaves no remainder by ``one_in`` are held out; words are counted over all others.  A null or
    empty text is its end alone.  ``piece_score`` is that of the words over pieces alone, without word arcs.
    """
    words = lower_words(text_col)
    table = cut(wordblocks.block_words(docs, [id_col], words, ~held_out(id_col, one_in)), "block-words")
    counts = cut(table.groupBy("word").agg(F.sum("n").alias("c")), "counts")
    ends = docs.agg(F.count_if(~held_out(id_col, one_in)).alias("n")).first()["n"]
    c = F.col("c")
    sums = counts.agg(F.sum("c").alias("n"), *(F.count_if(x).alias(k) for k, x in {"v": c > 0, "once": c == 1, "twice": c == 2}.items())).first()
    seen_tokens = Tokens((sums["n"] or 0) + ends, sums["v"] + (1 if ends else 0), sums["once"], sums["twice"], ends)
    scores = fit_pieces(counts.where("c > 0"), path)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_utf8(batch.column(0))
            found = lattice(path).marginals(data, offsets, scores)[0] / np.log(10)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=["word", "c", "p"])

    measured = cut(counts.mapInArrow(measure, "word string, c bigint, p double"), "word-scores")
    values = table.select("word", "block", "no").join(measured, "word").select("block", "no", "c", "p", F.xxhash64("word").alias("hash"))

    def assemble(block: pa.Table):
        no = block.column("no").to_numpy()
        if not (np.bincount(no, minlength=len(no)) == 1).all():
            raise RuntimeError("the words of a block are not whole; its rows were read in another order")
        seen, base, model, pieces = np.zeros(len(no), bool), np.zeros(len(no)), np.zeros(len(no)), np.zeros(len(no))
        c, p = block.column("c").to_numpy(), block.column("p").to_numpy()
        seen[no], base[no], model[no], pieces[no] = c > 0, seen_tokens.base(c), seen_tokens.model(c, p), p

        def read(sizes: np.ndarray, codes: np.ndarray) -> list[pa.Array]:
            if len(codes) and codes.max() >= len(no):
                raise RuntimeError("a block has rows with words that it doesn't know")
            owner = np.repeat(np.arange(len(sizes)), sizes)

            def by_row(x: np.ndarray) -> np.ndarray:
                return np.bincount(owner, x[codes], minlength=len(sizes))

            return [
                pa.array(sizes + 1), pa.array(by_row(seen).astype(np.int64) + (ends > 0)),
                pa.array(by_row(base) + seen_tokens.base(np.array([ends]))[0]), pa.array(by_row(model) + seen_tokens.end()),
                pa.array(by_row(pieces)),
            ]

        return wordblocks.mark(block.column("hash").to_numpy(), no), read

    found = wordblocks.join_back(
        values, wordblocks.numbered_rows(docs, [id_col], words), [id_col], assemble,
        "n_tokens bigint, n_known bigint, base_score double, score double, piece_score double",
    )
    return found.select(
        id_col, held_out(id_col, one_in).alias("held_out"), "n_tokens", "n_known",
        F.lit(seen_tokens.total).cast("bigint").alias("train_tokens"), "base_score", "score", "piece_score",
    )


@query("op3_lattice_likelihood")
def lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
