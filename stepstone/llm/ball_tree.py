"""Ranked lexical search by an exact inner-product search over ball trees of sparse document vectors.

A score is the inner product of an item's term weights and a document's term impacts.  Only terms of the items asked can
add to it, so documents are vectors over those.  A task takes its documents shard by shard, splits a shard into a tree of balls,
and walks the tree best first: a ball's centroid and radius bound the score of all its documents, and a ball whose
bound is below the k-th best score so far is left out.  A ball has a radius over all terms and one along each term; the
smaller bound counts, as a document is far from the centroid mostly in terms that the item does not ask for.  Bounds are
rounded up; scores are exact 64-bit integers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stepstone.llm.registry import documents, query
from stepstone.llm.texts import flat_utf8, slices, spread_ranges
from stepstone.session import cut, scratch_path

K = 10
#: Documents of a shard, and entries of all its vectors, after which the next shard begins.
SHARD_ROWS, SHARD_ENTRIES = 8192, 1 << 21
LEAF_ROWS = 32
#: Bytes of all item texts that are sent to the tasks at once.
BLOCK_BYTES = 1 << 17
#: Share by which a bound is rounded up; double precision errs by far less on vectors of up to a million terms.
ROUND_UP = 1e-9

#: Bytes that belong to a term (ASCII digits and letters, and all of other characters).
IS_TERM = np.ones(256, dtype=bool)
IS_TERM[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all terms on end as binary values, number of terms of each text); a null text has none."""
    data, offsets = flat_utf8(texts)
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(len(offsets) - 1, np.int64)
    # a space after each text, so that no term crosses into the next
    spaced = np.full(len(data) + len(offsets) - 1, 0x20, np.uint8)
    spaced[np.arange(len(data)) + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))] = LOWER[data]
    inside = np.concatenate([[False], IS_TERM[spaced]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])  # begin and end by turns, as the last byte is a space
    buffers = [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(spaced)]
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), max(len(edges) - 1, 0), buffers)  # a term, what is between, a term, ...
    owner = np.searchsorted(offsets + np.arange(len(offsets)), edges[::2], "right") - 1
    return pieces.take(pa.array(np.arange(0, len(pieces), 2))), np.bincount(owner, minlength=len(offsets) - 1)


def project(docs: DataFrame, vocabulary: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, terms, tf) of every row: its number of terms, and which of the vocabulary it holds and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.large_binary())
        for batch in slices(batches, "doc_text"):
            found, counts = terms_of(batch.column(1))
            number = pc.fill_null(pc.index_in(found, known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(counts)), counts)[number >= 0]
            pairs, tf = np.unique(owner * len(vocabulary) + number[number >= 0], return_counts=True)
            ends = np.concatenate([[0], np.cumsum(np.bincount(pairs // max(len(vocabulary), 1), minlength=len(counts)))]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for v in (pairs % max(len(vocabulary), 1), tf)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), *lists], names=["id", "n", "terms", "tf"])

    picked = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("doc_text"))
    return picked.mapInArrow(run, "id bigint, n bigint, terms array<int>, tf array<int>")


def frequencies(projected: DataFrame, terms: int) -> np.ndarray:
    """Number of documents that hold each term of the vocabulary; a task sends one row for each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(terms, np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=terms)
        there = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(df[there])], names=["term", "df"])

    df = np.zeros(terms, np.int64)
    for row in projected.select("terms").mapInArrow(run, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[row["term"]] = row["df"]
    return df


@dataclass
class Statistics:
    """What scoring takes from all documents: those with a term, all their terms, and the weight of each term."""

    docs: int
    terms: int
    weight: np.ndarray

    @staticmethod
    def of(docs: int, terms: int, df: np.ndarray) -> Statistics:
        return Statistics(docs, terms, np.floor(1000 * np.log((2 * docs + 2) / (2 * df + 1))).astype(np.int64))

    def impact(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """A document's part of the score, without the term's weight; ``n`` is the length of the document of each entry."""
        m = 100 - 75 + 75 * n * self.docs // self.terms
        return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Shard:
    """Sparse vectors of some documents, none of them empty, row by row, and a tree of balls over them.

    The tree works on vectors scaled by the root of each term's weight, so that both sides of the product are scaled alike.
    """

    def __init__(self, ids: list, begin: np.ndarray, terms: np.ndarray, impact: np.ndarray, weight: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.weight = weight
        self.root = np.sqrt(weight.astype(np.float64))
        value = impact * self.root[terms]
        length = np.diff(begin)
        row = np.repeat(np.arange(len(ids)), length)
        square = np.bincount(row, value * value, minlength=len(ids))
        nodes: list[tuple[np.ndarray, float, np.ndarray]] = []  # centroid, radius, how far members go beyond it along each term
        self.children: dict[int, list[int]] = {}
        members: dict[int, np.ndarray] = {}
        work: list[tuple[np.ndarray, int]] = [(np.arange(len(ids)), -1)]
        while work:
            rows, parent = work.pop()
            places = spread_ranges(begin[rows], length[rows])
            own = np.repeat(np.arange(len(rows)), length[rows])

            def dot(v: np.ndarray) -> np.ndarray:
                return np.bincount(own, value[places] * v[terms[places]], minlength=len(rows))

            def member(k: int) -> np.ndarray:
                out = np.zeros(len(weight))
                at = slice(begin[rows[k]], begin[rows[k] + 1])
                out[terms[at]] = value[at]
                return out

            centre = np.bincount(terms[places], value[places], minlength=len(weight)) / len(rows)
            along, middle = dot(centre), centre @ centre
            # a difference of large squares is uncertain by their rounding, which the radius takes on
            away = np.maximum(square[rows] - 2 * along + middle, 0) + ROUND_UP * (square[rows] + 2 * along + middle)
            number = len(nodes)
            beyond = np.zeros(len(weight))
            np.maximum.at(beyond, terms[places], value[places])
            nodes.append((centre, float(np.sqrt(away.max())), np.maximum(beyond - centre, 0)))
            if parent >= 0:
                self.children[parent].append(number)
            if len(rows) <= leaf_rows:
                members[number] = rows
                continue
            first = dot(member(int(away.argmax())))  # the member farthest from the centre, and that farthest from it
            second = dot(member(int((square[rows] - 2 * first).argmax())))
            order = np.argsort(first - second, kind="stable")  # halves: outliers can't make the tree deep
            self.children[number] = []
            work += [(rows[order[len(rows) // 2 :]], number), (rows[order[: len(rows) // 2]], number)]
        self.centres, self.radii, self.beyond = (np.array(x) for x in zip(*nodes, strict=True))
        self.leaves = {}
        for k, rows in members.items():
            places = spread_ranges(begin[rows], length[rows])
            starts = np.cumsum(length[rows]) - length[rows]
            self.leaves[k] = [ids[r] for r in rows], terms[places], impact[places], starts

    def bounds(self, counts: np.ndarray) -> np.ndarray:
        """Upper bounds of the score of any document by node (rows) and query (columns); ``counts`` has queries as rows."""
        asked = counts * self.root
        norm = np.sqrt((asked * asked).sum(axis=1))
        inner = self.centres @ asked.T
        size = np.sqrt((self.centres**2).sum(axis=1))
        reach = np.minimum(np.outer(self.radii, norm), self.beyond @ asked.T)
        return inner + reach + ROUND_UP * np.outer(self.radii + size, norm) + 1

    def best(self, counts: np.ndarray, bound: np.ndarray, held: list[tuple], k: int) -> None:
        """Push the documents that belong to the ``k`` best of one query on the heap ``held`` of (score, -id, id)."""
        weights = counts * self.weight
        open_ = [(-bound[0], 0)]
        while open_:
            most, node = heapq.heappop(open_)
            if len(held) == k and -most < held[0][0]:
                return  # no ball that is left can reach the k-th score
            if node in self.children:
                for child in self.children[node]:
                    heapq.heappush(open_, (-bound[child], child))
                continue
            ids, terms, impact, starts = self.leaves[node]
            scores = np.add.reduceat(weights[terms] * impact, starts)
            least = max(held[0][0], 1) if len(held) == k else 1
            for row in np.flatnonzero(scores >= least).tolist():
                entry = (int(scores[row]), -np.inf if ids[row] is None else -ids[row], ids[row])
                if len(held) < k:
                    heapq.heappush(held, entry)
                elif entry[:2] > held[0][:2]:
                    heapq.heapreplace(held, entry)


def shards_of(batches: Iterator[pa.RecordBatch], stats: Statistics) -> Iterator[Shard]:
    """Trees over the projected rows of a task, one after the other."""
    held: list[pa.RecordBatch] = []
    rows = entries = 0

    def build() -> Shard:
        table = pa.Table.from_batches(held).combine_chunks()
        terms, tf = (table.column(c).combine_chunks() for c in ("terms", "tf"))
        sizes = pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64)
        n = np.repeat(table.column("n").to_numpy(), sizes)
        impact = stats.impact(tf.flatten().to_numpy().astype(np.int64), n)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        return Shard(table.column("id").to_pylist(), begin, terms.flatten().to_numpy().astype(np.int64), impact, stats.weight)

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, min(SHARD_ROWS - rows, 1024))
            held.append(part)
            rows, entries, at = rows + part.num_rows, entries + len(part.column("terms").flatten()), at + part.num_rows
            if rows >= SHARD_ROWS or entries >= SHARD_ENTRIES:
                yield build()
                held, rows, entries = [], 0, 0
    if rows:
        yield build()


def search(docs: DataFrame, items: DataFrame, k: int = K, item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` documents with the highest score above 0 for every row of ``items``.

    Equal scores rank by ascending ``doc_id``, nulls last; repeated documents rank as rows of their own.  Null, empty and
    termless texts have no terms and are in no answer; an item without known terms has none.  Items with equal texts are searched
    once, and repeated rows of an item are answered once.  Items are asked in blocks of about ``block_bytes`` of text.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).alias("item_id"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("asked")).distinct()
    asked = cut(asked, "items")
    texts = asked.select("asked").distinct()
    blocks = -(-(texts.agg(F.sum(F.octet_length("asked")).alias("n")).first()["n"] or 0) // block_bytes)
    out = scratch_path(spark, "ranked")
    first = Window.partitionBy("asked").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    for b in range(blocks):
        block = [r["asked"] for r in texts.where(F.pmod(F.xxhash64("asked"), F.lit(blocks)) == b).collect()]
        found, sizes = terms_of(pa.array(block, pa.string()))
        words = found.dictionary_encode()
        vocabulary, number = words.dictionary.to_pylist(), words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        asking = np.bincount(np.repeat(np.arange(len(block)), sizes) * len(vocabulary) + number, minlength=len(block) * len(vocabulary))
        asking = asking.reshape(len(block), len(vocabulary)).astype(np.int32)
        rows = cut(project(docs, vocabulary), "projected")
        total = rows.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
        stats = Statistics.of(total["docs"] or 0, total["terms"] or 0, frequencies(rows, len(vocabulary)))

        def run(batches: Iterator[pa.RecordBatch], asking=asking, stats=stats, block=block) -> Iterator[pa.RecordBatch]:
            held: list[list[tuple]] = [[] for _ in block]
            wide = asking.astype(np.int64)
            for shard in shards_of(batches, stats):
                bounds = shard.bounds(wide.astype(np.float64))
                for q in range(len(block)):
                    shard.best(wide[q], bounds[:, q], held[q], k)
            best = [(text, doc_id, score) for text, heap in zip(block, held, strict=True) for score, _, doc_id in heap]
            columns = [pa.array(list(c), t) for c, t in zip(zip(*best, strict=True) if best else ([], [], []), (pa.string(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["asked", "doc_id", "score"])

        near = rows.where(F.size("terms") > 0).mapInArrow(run, "asked string, doc_id bigint, score bigint")
        ranked = near.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
        ranked.write.mode("append").parquet(out)
    schema = "asked string, doc_id bigint, score bigint, rank int"
    ranked = spark.read.schema(schema).parquet(out) if blocks else spark.createDataFrame([], schema)
    return ranked.join(asked, "asked").select("item_id", "rank", "doc_id", "score")


_SQL = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), lengths AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
held AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, total GROUP BY term, docs),
parts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))) AS part
  FROM held JOIN weights USING (term) JOIN lengths USING (doc_id), total
), scores AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM i JOIN parts USING (term) GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 10
"""


@query("op11_ball_tree", _SQL)
def ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
