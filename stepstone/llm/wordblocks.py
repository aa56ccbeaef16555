"""Join a value of each distinct word back to the word's places, without a row for each place.

A task numbers the distinct words of a block of rows and keeps its rows as lists of these numbers.  Two tables come of it:
the words of each block, to be joined by word, and the numbered rows, which wait for their block's words.  What crosses
the cluster is a row for each distinct word of a block and a compressed number for each place.

Both tables come of a walk over the input each.  Were the rows read in another order the second time, as they may be behind a
shuffle, numbers would mean other words; so both walks mark a block by its words in number order, and blocks whose marks differ
stop the job.  Callers whose rows come out of a shuffle write them to a table first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Places of a block after which the next one begins; bounds the memory of a task.
BLOCK_PLACES = 1 << 23
#: Places in one row of the numbered table.
CHUNK_PLACES = 1 << 18


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(numbers.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def mark(hashes: np.ndarray, numbers: np.ndarray) -> int:
    """Signed 64-bit sum over words, each weighed by its number, so marks of parts add up to that of the whole."""
    return int((hashes.astype(np.int64).view(np.uint64) * (2 * numbers.astype(np.uint64) + 1)).sum(dtype=np.uint64).view(np.int64))


def check_marks(found: int, numbered: pa.Table) -> None:
    """Stop unless the block's words, with the mark ``found``, are those that its numbered rows were numbered by."""
    known = numbered.column("known").to_numpy()
    if len(known) and numbered.column("mark").to_numpy()[known.argmax()] != found:
        raise RuntimeError("the rows of a block were read in another order the second time; write them to a table first")


class _Block:
    def __init__(self, number: int):
        self.number, self.words, self.places, self.counts = number, {}, 0, np.zeros(0)
        self.mark, self.marked = np.zeros(1, np.int64), 0

    def code(self, words: pa.Array) -> np.ndarray:
        """Numbers of the words, in place order; new words get the next number."""
        local = words.dictionary_encode()
        known = self.words
        numbers = np.array([known.setdefault(w, len(known)) for w in local.dictionary.to_pylist()], np.int64)
        self.places += len(words)
        return numbers[local.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)

    def marks(self) -> tuple[int, int]:
        """Number and mark of the words so far."""
        fresh = list(islice(reversed(self.words), len(self.words) - self.marked))[::-1]
        hashes = np.array([xxhash.xxh64_intdigest(w.encode(), 42) for w in fresh], np.uint64).view(np.int64)
        self.mark += mark(hashes, np.arange(self.marked, len(self.words)))
        self.marked = len(self.words)
        return self.marked, int(self.mark[0])

    def count(self, codes: np.ndarray, weights: np.ndarray) -> None:
        if len(self.words) > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros(len(self.words) - len(self.counts))])
        self.counts += np.bincount(codes, weights, minlength=len(self.counts))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Block, pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(block, keys, words of each row, numbers of all places, counted) by and by; keys are None where a block ends.

    Both tables number their words by this walk over the same rows in the same order.
    """
    first = TaskContext.get().partitionId() << 20
    block = _Block(first)
    for batch in batches:
        rows = 0
        lists = batch.column(1)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        while rows < batch.num_rows:
            begun = ends[rows - 1] if rows else 0
            stop = max(rows + 1, int(np.searchsorted(ends, begun + CHUNK_PLACES, "right")))
            part = batch.slice(rows, stop - rows)
            codes = block.code(part.column(1).flatten())
            yield block, part.column(0), sizes[rows:stop], codes, part.column(2).to_numpy(zero_copy_only=False)
            rows = stop
            if block.places >= BLOCK_PLACES:
                yield block, None, None, None, None
                block = _Block(block.number + 1)
    if block.places:
        yield block, None, None, None, None


def block_words(rows: DataFrame, keys: list[str], words: Column, counted: Column) -> DataFrame:
    """(word, block, no, n): the distinct words of each block; n counts a word's places in rows where ``counted`` holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, keys_, sizes, codes, counts in _blocks(batches):
            if keys_ is not None:
                block.count(codes, np.repeat(counts.astype(np.float64), sizes))
                continue
            n = len(block.words)
            yield pa.RecordBatch.from_arrays([
                pa.array(list(block.words), pa.string()), pa.array(np.full(n, block.number, np.int64)),
                pa.array(np.arange(n, dtype=np.int32)), pa.array(block.counts.astype(np.int64)),
            ], names=["word", "block", "no", "n"])

    return _picked(rows, keys, words, counted).mapInArrow(run, "word string, block bigint, no int, n bigint")


def numbered_rows(rows: DataFrame, keys: list[str], words: Column) -> DataFrame:
    """(block, keys, sizes, codes, known, mark): rows of a block as packed numbers, several rows of the input in one.

    ``known`` and ``mark`` are the number and the mark of the block's words up to there.
    """
    picked = _picked(rows, keys, words, F.lit(True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = TaskContext.get().partitionId() << 20
        for block, keys_, sizes, codes, _ in _blocks(batches):
            if keys_ is None:
                continue
            known, words_mark = block.marks()
            yield pa.RecordBatch.from_arrays([
                pa.array([block.number if block.places else empty]), pa.ListArray.from_arrays(pa.array([0, len(keys_)], pa.int32()), keys_),
                pa.array([pack(sizes)]), pa.array([pack(codes)]), pa.array([known], pa.int64()), pa.array([words_mark], pa.int64()),
            ], names=["block", "keys", "sizes", "codes", "known", "mark"])

    kind = picked.dtypes[0][1]
    return picked.mapInArrow(run, f"block bigint, keys array<{kind}>, sizes binary, codes binary, known bigint, mark bigint")


def _picked(rows: DataFrame, keys: list[str], words: Column, counted: Column) -> DataFrame:
    return rows.select(F.struct(*keys).alias("keys"), words.alias("words"), counted.alias("counted"))


def join_back(values: DataFrame, numbered: DataFrame, keys: list[str], assemble: Callable, result: str) -> DataFrame:
    """Meet the numbered rows with their block's values.

    ``values`` has ``block`` and whatever ``assemble`` reads.  ``assemble(values of the block as a table)`` returns the mark of
    the block's words and a function of (sizes, codes) that gives the result columns, in the order of the schema text ``result``.
    """
    kinds = dict(numbered.select(F.explode("keys").alias("k")).select("k.*").dtypes)
    names = [*keys, *(f.strip().split(" ")[0] for f in result.split(", "))]

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found, read = assemble(left)
        check_marks(found, right)
        parts = []
        for k in range(right.num_rows):
            owners = right.column("keys")[k].values
            columns = read(unpack(right.column("sizes")[k].as_py()).astype(np.int64), unpack(right.column("codes")[k].as_py()).astype(np.int64))
            parts.append(pa.Table.from_arrays([*owners.flatten(), *columns], names=names))
        return pa.concat_tables(parts)

    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), result])
    return values.groupBy("block").cogroup(numbered.groupBy("block")).applyInArrow(meet, schema)
