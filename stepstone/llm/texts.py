"""Texts as flat byte arrays: the numpy side of operators that run inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The bytes between words.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[list(SPACES)] = False


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, behind as many underscores as it takes to be none of ``columns`` in any case of letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_text(df: DataFrame, keep: Iterable[str], text_col: str) -> DataFrame:
    """Columns ``keep`` under names of their place, c0, c1, ..., then the text as ``text``: what Python tasks can take of any names."""
    kept = [named(c).alias(f"c{k}") for k, c in enumerate(keep)]
    return df.select(*kept, named(text_col).cast("string").alias("text"))


def named(column: str) -> Column:
    """The column of exactly this name, whatever it holds of dots and backticks."""
    return F.col("`" + column.replace("`", "``") + "`")


def flat_utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts on end, and the n + 1 offsets of the texts; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Cut batches between rows so that a piece holds about ``most_bytes`` of text, or one longer row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            begun = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, begun + most_bytes, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every run of non-space bytes; a text's border ends a word."""
    inside = IS_WORD[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    border = offsets[1:-1]
    border = border[(border > 0) & (border < len(data))]
    starts[border] = inside[border]
    ends[border - 1] = inside[border - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def spread_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[i] .. starts[i] + lengths[i] - 1 of all ranges on end."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return shift + np.arange(total)
