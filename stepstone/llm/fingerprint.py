"""Quartile bucket digest: counts of hashed byte triplets, coded by the quartiles of a text's own buckets.

A digest is hexadecimal text: two digits of length class, two of quartile ratios, then two bits a bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepstone.llm.registry import documents, query

BUCKETS = 256
#: Bytes looked at, relative to the first of a window, with one multiplier for each kind of triplet.
TRIPLETS = (((0, 1, 2), 0x9E3779B1), ((0, 1, 3), 0x85EBCA6B), ((0, 2, 3), 0xC2B2AE35))
#: Worst difference that a score tells apart; the score is 0 from there on.
WORST = BUCKETS * 3 * 2 // 3
LENGTH_BASE = 1.1
MOST_BYTES = 1 << 22


def bucket_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed triplets by text and bucket; a triplet never crosses from one text into the next."""
    n = len(offsets) - 1
    counts = np.zeros(n * BUCKETS, np.int64)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    wide = data.astype(np.uint32)
    for at, factor in TRIPLETS:
        reach = at[-1]
        if len(data) <= reach:
            continue
        last = len(data) - reach
        packed = wide[at[0] : last + at[0]] << 16 | wide[at[1] : last + at[1]] << 8 | wide[at[2] : last + at[2]]
        hashed = ((packed * np.uint32(factor)) >> np.uint32(24)).astype(np.int64)
        fits = room[:last] > reach
        counts += np.bincount((owner[:last] * BUCKETS + hashed)[fits], minlength=n * BUCKETS)
    return counts.reshape(n, BUCKETS)


def digests(texts: list[str]) -> np.ndarray:
    """Digest bytes, a row for each text: length class, ratios, then four buckets a byte."""
    out = np.zeros((len(texts), 2 + BUCKETS // 4), np.uint8)
    raw = [t.encode() for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    at = 0
    while at < len(raw):
        ends = np.cumsum(sizes[at:])
        stop = at + max(1, int(np.searchsorted(ends, MOST_BYTES, "right")))
        data = np.frombuffer(b"".join(raw[at:stop]), np.uint8)
        offsets = np.concatenate([[0], np.cumsum(sizes[at:stop])])
        counts = bucket_counts(data, offsets)
        ordered = np.sort(counts, axis=1)
        q1, q2, q3 = (ordered[:, BUCKETS * k // 4 - 1][:, None] for k in (1, 2, 3))
        codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
        four = codes.reshape(len(codes), -1, 4)
        out[at:stop, 2:] = four[:, :, 0] << 6 | four[:, :, 1] << 4 | four[:, :, 2] << 2 | four[:, :, 3]
        size = sizes[at:stop]
        out[at:stop, 0] = np.where(size > 0, np.minimum(1 + np.log(np.maximum(size, 1)) / np.log(LENGTH_BASE), 255), 0)
        top = np.maximum(q3[:, 0], 1)
        out[at:stop, 1] = (q1[:, 0] * 15 // top) << 4 | (q2[:, 0] * 15 // top)
        at = stop
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal digests, down to 0: one less the summed differences over ``WORST``, never below 0.

    Buckets differ by 0 to 3 quartiles, 3 counting double; length classes and ratios beyond one step add to it.
    """
    shifts = (6, 4, 2, 0)
    steps = np.zeros(len(a), np.int64)
    for shift in shifts:
        step = np.abs((a[:, 2:] >> shift & 3).astype(np.int16) - (b[:, 2:] >> shift & 3))
        steps += (step + 3 * (step == 3)).sum(axis=1)
    length = np.abs(a[:, 0].astype(np.int64) - b[:, 0])
    steps += np.where(length <= 1, length, np.minimum(length, 24))
    for shift in (4, 0):
        ratio = np.abs((a[:, 1] >> shift & 15).astype(np.int64) - (b[:, 1] >> shift & 15))
        steps += np.where(ratio <= 1, ratio, 2 * ratio)
    return 1.0 - np.minimum(steps, WORST) / WORST


def _hex(rows: np.ndarray) -> list[str]:
    return [bytes(r).hex() for r in rows]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row; a null text is empty, the empty text has its own digest of zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_hex(digests(texts)), pa.string())], names=[id_col, "fingerprint"])

    picked = docs.select(F.col(id_col), F.col(text_col))
    return picked.mapInArrow(run, f"`{id_col}` {picked.dtypes[0][1]}, fingerprint string")


EDITED_SCHEMA = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_pairs(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """Compare every document with its edited text and with the next document by descending ``doc_id``.

    The edited text has its last half replaced by the start of the next document; after the last comes the first.
    Rows of one id follow each other by text, rows without an id come last, a single row is its own next.

    Ids are cut at quantiles of the id column, so a block's first document is known beforehand; a copy of it goes to the
    block above.  Texts are shuffled once.
    """
    spark = docs.sparkSession
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = [F.lit((k + 1) / blocks) for k in range(blocks)]
    bounds = picked.agg(F.percentile_approx("doc_id", F.array(*parts), F.lit(20 * blocks)).alias("b")).first()["b"] or []
    bounds = np.unique(np.array(bounds, np.int64))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "head", "doc_id", "text"]
        for batch in batches:
            ids = batch.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            plain = ids.fill_null(0).to_numpy(zero_copy_only=False)
            block = np.where(known, np.minimum(np.searchsorted(bounds, plain), max(len(bounds) - 1, 0)), 0)
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(np.zeros(len(block), bool)), *batch.columns], names=names)
            heads = np.flatnonzero(known & np.isin(plain, bounds))
            if len(heads):
                above = (block[heads] + 1) % len(bounds)
                moved = batch.take(pa.array(heads))
                yield pa.RecordBatch.from_arrays([pa.array(above, pa.int32()), pa.array(np.ones(len(heads), bool)), *moved.columns], names=names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (block, head, id, text), the last one still waits for its next
        first: tuple | None = None

        def told(rows: list[tuple], following: list[str]) -> pa.RecordBatch:
            texts = [r[3] for r in rows]
            edited = [t[: len(t) - len(t) // 2] + f[: len(t) // 2] for t, f in zip(texts, following, strict=True)]
            own, other = digests([*texts, following[-1]]), digests(edited)
            after = own[1:]
            for k in range(len(rows) - 1):  # blocks may meet inside one list
                if texts[k + 1] is not following[k]:
                    after[k] = digests([following[k]])[0]
            return pa.RecordBatch.from_arrays([
                pa.array([r[2] for r in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]), pa.array(_hex(own[:-1])), pa.array(_hex(other)),
                pa.array(likeness(own[:-1], other)), pa.array(likeness(own[:-1], after)),
            ], names=[f.split(" ")[0] for f in EDITED_SCHEMA.split(", ")])

        def flush(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, first
            rows, following, begin = [], [], first
            for k, row in enumerate(held):
                if begin is None or begin[0] != row[0]:
                    begin = row
                after = held[k + 1] if k + 1 < len(held) else None
                if after is None and not final:
                    break
                if row[1]:
                    continue
                rows.append(row)
                following.append(after[3] if after is not None and after[0] == row[0] else begin[3])
            if rows:
                yield told(rows, following)
            held, first = ([] if final else held[-1:]), begin

        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append((row[0], row[1], row[2], row[3] or ""))
                size += len(held[-1][3])
                if size >= MOST_BYTES:
                    yield from flush(False)
                    size = 0
        if held:
            yield from flush(True)

    dealt = picked.mapInArrow(deal, "block int, head boolean, doc_id bigint, text string")
    ordered = dealt.repartitionById(max(len(bounds), 1), F.col("block")).sortWithinPartitions(
        "block", "head", F.col("doc_id").desc_nulls_last(), "text"
    )
    return ordered.mapInArrow(compare, EDITED_SCHEMA)


@query("op1_quartile_digest")
def quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_pairs(documents(spark, sf_dir))
