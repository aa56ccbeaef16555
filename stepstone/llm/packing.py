"""Best-two-fit packing of documents into sequences of at most ``capacity`` tokens.

A bin is filled with the longest unpacked documents that fit; then its shortest one gives way to the two unpacked ones
that fill the widened gap best.  Only lengths matter to these choices, and a length is at most ``capacity``: the decisions
are taken once over the counts of each length, a repeated bin is decided once, and every document finds its place by its
rank among those of its length.  So the packing is that of all documents, whatever their number.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepstone.llm.bpe import encoder, split_pattern, split_words
from stepstone.llm.registry import documents, query
from stepstone.llm.texts import spread_ranges
from stepstone.operators.ordering import with_position
from stepstone.session import cut

CAPACITY, END_ID = 1024, 2
#: Words whose ids a task keeps before it starts its table anew, and words worked on at once.
TABLE_WORDS, PLACES = 1 << 20, 1 << 20
PIECE_SCHEMA = "piece int, start bigint, length bigint, ids_crc32 bigint"


class _WordIds:
    """Ids of the words seen so far in a task; each is encoded once until the table is full."""

    def __init__(self, path: str):
        self.path, self.known = path, {}
        self.ids, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words on end, and how many each has."""
        if len(self.known) > TABLE_WORDS:
            self.__init__(self.path)
        local = words.dictionary_encode()
        names, known = local.dictionary.to_pylist(), self.known
        new = [w for w in names if w not in known]
        if new:
            ids, sizes = encoder(self.path).encode(new)
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.begins = np.cumsum(self.sizes) - self.sizes
        if not names:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        number = np.array([known[w] for w in names], np.int64)[local.indices.to_numpy(zero_copy_only=False)]
        each = self.sizes[number]
        return self.ids[spread_ranges(self.begins[number], each)], each


def piece_lengths(total: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces; all but the first are full."""
    first = total % capacity or capacity
    return [min(first, total), *[capacity] * ((total - first) // capacity)]


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, keys: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """(``keys``, piece, start, length, ids_crc32): every row's ids and ``end_id``, cut if there are more than ``capacity``.

    A null or empty text is ``end_id`` alone.  Rows that repeat are packed each for itself.
    """
    keys = keys or ["doc_id"]
    words = split_words(F.col(text_col), split_pattern(docs.sparkSession, path))
    picked = docs.select(*keys, words.alias("_words"))
    names = [*keys, "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _WordIds(path)
        for batch in batches:
            sizes = pc.list_value_length(batch.column(len(keys))).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, at = np.cumsum(sizes), 0
            while at < batch.num_rows:
                begun = ends[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(ends, begun + PLACES, "right")))
                part = batch.slice(at, stop - at)
                ids, each = table.of(part.column(len(keys)).flatten())
                until = np.concatenate([[0], np.cumsum(each)])[np.cumsum(sizes[at:stop])]
                owner, piece, start, length, crc = [], [], [], [], []
                last = np.array([end_id], "<u4").tobytes()
                for k, (a, b) in enumerate(zip(np.concatenate([[0], until[:-1]]).tolist(), until.tolist(), strict=True)):
                    data, before = memoryview(ids[a:b].astype("<u4").tobytes() + last), 0
                    for n, size in enumerate(piece_lengths(b - a + 1, capacity)):
                        owner.append(k)
                        piece.append(n)
                        start.append(before)
                        length.append(size)
                        crc.append(zlib.crc32(data[4 * before : 4 * (before + size)]))
                        before += size
                rows = part.select(list(range(len(keys)))).take(pa.array(owner, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], names=names
                )
                at = stop

    schema = ", ".join([*(f"`{n}` {t}" for n, t in picked.dtypes[:-1]), PIECE_SCHEMA])
    return picked.mapInArrow(run, schema)


@dataclass(frozen=True)
class Bins:
    """``times`` bins alike, each with ``uses[length]`` documents of a length, longest first."""

    times: int
    uses: dict[int, int]


def _two_that_fit(open_lengths: list[int], left: Counter, room: int) -> tuple[int, int] | None:
    """Two unpacked documents of the largest summed length within ``room``."""
    low, high, best, found = 0, bisect_right(open_lengths, room) - 1, 0, None
    while low <= high:
        a, b = open_lengths[low], open_lengths[high]
        if a + b > room or left[b] < 1 or (low == high and left[b] < 2):
            high -= 1
        elif left[a] < 1:
            low += 1
        else:
            if a + b > best:
                best, found = a + b, (a, b)
            low += 1
    return found


def best_two_fit(histogram: dict[int, int], capacity: int) -> list[Bins]:
    """Bins for ``histogram[length]`` documents of each length; bins that repeat are decided once.

    A bin repeats as long as enough documents of each of its lengths are left: every choice is then the same again.
    """
    left = Counter({k: n for k, n in histogram.items() if n > 0})
    lengths, out = sorted(left), []
    while lengths:
        gap, fill = capacity, Counter()
        at = len(lengths)
        while True:
            at = bisect_right(lengths, gap, 0, at) - 1
            if at < 0:
                break
            size = lengths[at]
            fill[size] = min(left[size], gap // size)
            gap -= fill[size] * size
        uses = Counter(fill)
        if gap and fill:
            least, rest = min(fill), Counter(left)
            rest.subtract(fill)
            two = _two_that_fit(lengths, rest, gap + least)
            if two and sum(two) > least:
                uses[least] -= 1
                uses.update(two)
        uses = {k: uses[k] for k in sorted(uses, reverse=True) if uses[k]}
        times = min((left[k] - max(n, fill[k])) // n + 1 for k, n in uses.items())
        out.append(Bins(times, uses))
        for k, n in uses.items():
            left[k] -= times * n
        lengths = [k for k in lengths if left[k]]
    return out


def _places(bins: list[Bins]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first ranks of its runs, with each run's documents a bin, first bin and place in the bin."""
    rank, sequence, runs = Counter(), 0, {}
    for b in bins:
        offset = 0
        for size, n in b.uses.items():
            runs.setdefault(size, []).append((rank[size], n, sequence, offset))
            rank[size] += b.times * n
            offset += n * size
        sequence += b.times
    return {size: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for size, rows in runs.items()}


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset``; column ``length`` says how long a piece is, ``order`` ranks pieces of a length.

    The counts by length, at most ``capacity`` numbers, go to the driver; the runs that come of them, a few thousand by
    the number of lengths, go to the tasks.
    """
    pieces = cut(pieces, "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    places = _places(best_two_fit(histogram, capacity))
    ranked = with_position(pieces, ["length"], order, "_rank")
    at = pieces.columns.index("length")
    names = [*pieces.columns, "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(at).to_numpy(zero_copy_only=False)
            rank = batch.column(len(names) - 2).to_numpy(zero_copy_only=False) - 1
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(length):
                rows = np.flatnonzero(length == size)
                firsts, each, bins, begins = places[int(size)]
                which = np.searchsorted(firsts, rank[rows], "right") - 1
                along = rank[rows] - firsts[which]
                sequence[rows] = bins[which] + along // each[which]
                offset[rows] = begins[which] + along % each[which] * size
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=names)

    schema = ", ".join([*(f"`{n}` {t}" for n, t in pieces.dtypes), "sequence_id bigint, `offset` bigint"])
    return ranked.mapInArrow(run, schema)


def packed(docs: DataFrame) -> DataFrame:
    """Pieces of every row of ``docs`` with their places, under the production settings."""
    pieces = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pack(pieces, ["doc_id", "piece", "start", "ids_crc32"])


@query("op4_best_two_fit")
def best_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))
