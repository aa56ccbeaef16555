"""SimHash near-duplicates by a generalised pigeonhole search.

Bits that vary together go into one partition.  A pair within ``distance`` bits differs by at most t_i bits in some
partition i if the thresholds satisfy sum(t_i + 1) = distance + 1, so thresholds may be unequal; dynamic programming picks
them by the number of candidates that each would bring, estimated over all fingerprints.  Partitions are probed by keys
with t_i bits blanked, and candidates are verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stepstone.llm.registry import documents, query
from stepstone.llm.texts import named, slices, with_text
from stepstone.operators.components import smallest_members
from stepstone.session import cut

BITS, DISTANCE, SHINGLE = 64, 3, 3
#: Most rows of a key that a task compares at once; keys with more are dealt in pairs of parts.
PART_ROWS = 512
#: Cost of shuffling one key, in verified pairs.
KEY_COST = 200.0
HASHES_AT_ONCE = 1 << 15


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits; a bit is set if over half of the shingle hashes have it.  Repeats count, no words give 0."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, and the breaks are the ASCII ones
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), HASHES_AT_ONCE):
        spans = zip(starts[at : at + HASHES_AT_ONCE].tolist(), ends[at : at + HASHES_AT_ONCE].tolist(), strict=True)
        hashes = np.array([digest(joined[s:e], 42) for s, e in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_ = ones * 2 > len(starts)
    return int.from_bytes(np.packbits(set_, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep``, none of them ``fp``, and ``fp``, the fingerprint as a signed 64-bit integer; a null text has no words."""
    names = [*(f"c{k}" for k in range(len(keep))), "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.array([fingerprint_of(t) for t in batch.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
            kept = [batch.column(k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found)], names=names)

    picked = with_text(docs, keep, text_col)
    return picked.mapInArrow(run, StructType([*picked.schema.fields[:-1], StructField("fp", LongType())])).toDF(*keep, "fp")


def as_hex(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have both of two bits set, over all rows; tasks send 64 x 64 sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, rows = np.zeros((BITS, BITS)), 0
        for batch in batches:
            x = _bits(batch.column(0).to_numpy(zero_copy_only=False)).astype(np.float32)
            both, rows = both + x.T @ x, rows + len(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(BITS * BITS + 1), pa.int32()), pa.array([float(rows), *both.ravel()])], names=["k", "v"])

    sums = distinct.select("fp").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    values = np.zeros(BITS * BITS + 1)
    for row in sums:
        values[row["k"]] = row["v"]
    return int(values[0]), values[1:].reshape(BITS, BITS)


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fp, "<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of nearly equal width; each takes the bit most correlated with those it has, from a free bit on."""
    mean = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.outer(np.diag(cov), np.diag(cov)), 1e-12))
    corr = np.abs(cov / scale)
    np.fill_diagonal(corr, 0.0)
    free, out = set(range(BITS)), []
    for k in range(parts):
        width = (BITS - sum(map(len, out))) // (parts - k)
        order = sorted(free)
        group = [max(order, key=lambda b: (corr[b, order].sum(), -b))]
        free.remove(group[0])
        while len(group) < width:
            order = sorted(free)
            best = max(order, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        out.append(sorted(group))
    return out


def differing(n: int, both: np.ndarray, group: list[int]) -> np.ndarray:
    """Chance that two fingerprints differ by 0, 1, ... bits of a group, bits taken one by one from their shares of ones."""
    p = np.diag(both)[group] / max(n, 1)
    chance = np.array([1.0])
    for q in 2 * p * (1 - p):
        chance = np.convolve(chance, [1 - q, q])
    return chance


def choose_thresholds(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = total and the least summed cost; costs[i][t + 1] is that of t in i."""
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(np.inf, [])] * total
    for cost in costs:
        best = [
            min((best[used - t - 1][0] + cost[t + 1], [*best[used - t - 1][1], t]) for t in range(-1, used))
            for used in range(total + 1)
        ]
    return best[total]


def plan_probes(distinct: DataFrame, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the partitions to probe: the cheapest plan among 1 to distance + 1 partitions.

    A threshold's cost is its keys, times ``KEY_COST``, plus its candidate pairs, from bit statistics of all fingerprints.
    """
    n, both = bit_statistics(distinct)
    n, plans = max(n, 1), []  # without rows the cheapest plan is that of one row
    for parts in range(1, distance + 2):
        groups, costs = group_bits(n, both, parts), []
        for group in groups:
            near = np.cumsum(differing(n, both, group)) * n * (n - 1) / 2
            cost, keys = [0.0], 1.0
            for t in range(distance + 1):
                keys = keys * (len(group) - t + 1) / t if t else 1.0  # ways to blank t bits
                cost.append(KEY_COST * n * keys + near[t])
            costs.append(cost)
        price, chosen = choose_thresholds(costs, distance + 1)
        plans.append((price, [(g, t) for g, t in zip(groups, chosen, strict=True) if t >= 0]))
    return min(plans, key=lambda x: x[0])[1]


def _masks(probes: list[tuple[list[int], int]]) -> list[tuple[int, int]]:
    """(number, mask) of every kind of key: the partition's bits without the blanked ones."""
    out = []
    for group, t in probes:
        for blank in combinations(group, t):
            out.append((len(out), sum(1 << b for b in group if b not in blank)))
    return out


def _components(fp: np.ndarray, left: np.ndarray, distance: int) -> np.ndarray:
    """Smallest reachable fingerprint of each row, along links of which one end is in ``left`` and one is not, or all."""
    plain = fp.view(np.uint64)  # a signed count would be that of the absolute value
    differing = np.bitwise_count(plain[:, None] ^ plain[None, :]) <= distance
    if left.any() and not left.all():
        differing &= left[:, None] != left[None, :]
    label = np.arange(len(fp))
    while True:
        nearest = np.where(differing, label[None, :], len(fp)).min(axis=1)
        nearest = np.minimum(nearest, label)
        nearest = nearest[nearest]
        if (nearest == label).all():
            return label
        label = nearest


def near_links(distinct: DataFrame, distance: int = DISTANCE, part_rows: int = PART_ROWS) -> DataFrame:
    """(src, dst) links that connect all fingerprints within ``distance`` bits of each other, through chains of links.

    Rows of a key are compared in pairs of parts of about ``part_rows``, so no task holds a hot key; a pair of parts gives
    one link a row at most instead of all pairs.
    """
    masks = _masks(plan_probes(distinct, distance))
    signed = [m - (1 << 64) if m >> 63 else m for _, m in masks]
    keys = F.array(*[F.struct(F.lit(k).alias("kind"), F.col("fp").bitwiseAND(F.lit(m).cast("bigint")).alias("value")) for (k, _), m in zip(masks, signed, strict=True)])
    rows = distinct.select("fp", F.explode(keys).alias("k")).select("fp", "k.kind", "k.value")
    hot = rows.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > part_rows)
    parts = F.ceil(F.coalesce("n", F.lit(1)) / part_rows).cast("int")
    placed = rows.join(cut(hot, "hot-keys"), ["kind", "value"], "left").withColumn("parts", parts)
    placed = placed.withColumn("own", F.pmod(F.xxhash64("fp"), "parts").cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "fp", "kind", "value", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own"
    )
    group = ["kind", "value", "a", "b"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def links(run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            order = np.argsort(run[0].view(np.uint64), kind="stable")
            fp, left = run[0][order], run[1][order] == run[2][order]
            root = fp[_components(fp, left, distance)]
            return fp[root != fp], root[root != fp]

        def finish(whole: np.ndarray, last: bool) -> tuple[list, np.ndarray]:
            """Compare every run of rows with one key but, unless it is the last, the one that may go on."""
            same = (whole[3:, 1:] == whole[3:, :-1]).all(axis=0)
            edges = np.concatenate([[0], np.flatnonzero(~same) + 1, [whole.shape[1]]])
            stop = len(edges) - 1 if last else len(edges) - 2
            sizes = np.diff(edges)
            found = [links(whole[:3, edges[k] : edges[k + 1]]) for k in range(stop) if sizes[k] > 1]
            return found, whole[:, edges[stop] :]

        rest = np.zeros((7, 0), np.int64)
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("fp", "own", "a", "kind", "value", "a", "b")]
            found, rest = finish(np.concatenate([rest, np.array(columns)], axis=1), False)
            if found:
                held = [np.concatenate(x) for x in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["src", "dst"])
        if rest.shape[1]:
            found, _ = finish(rest, True)
            for src, dst in found:
                yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], names=["src", "dst"])

    return dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(compare, "src bigint, dst bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, distance: int = DISTANCE) -> DataFrame:
    """(``keep`` columns, fp, root, component_id) of every row.

    Rows link if their fingerprints differ by ``distance`` bits or fewer; ``root`` stands for the component and
    ``component_id`` is its smallest id, null if none of its rows has one.  Null and empty texts have fingerprint zero.
    Equal fingerprints are one node of the search, however many rows have them.
    """
    keep = keep or [id_col]
    rows = cut(fingerprints(docs, keep, text_col), "simhash")
    distinct = cut(rows.groupBy("fp").agg(F.min(id_col).alias("least_id")), "distinct-fp")
    roots = smallest_members(cut(near_links(distinct, distance), "near-links"))
    linked = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "least_id")
    linked = cut(linked, "linked")
    least = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = cut(linked.select("fp", "root").join(least, "root"), "components")
    return rows.join(named, "fp").select(*keep, "fp", "root", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stay when one row of each group of near-duplicates stays.

    That is the row with the smallest ``doc_id``; of rows that share it, one with the smallest hash of its text.  A group
    whose rows all lack an id keeps one of them.
    """
    mark = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("mark")
    groups = near_duplicates(docs.select("doc_id", "text", mark), keep=["doc_id", "mark"])
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    stay = groups.groupBy("root").agg(F.min(rank).alias("r")).select(F.col("r.doc_id").alias("id"), F.col("r.mark").alias("of"))
    # a row is one column here, so that none of its names can clash; rows alike in id and text stand for one of them
    rows = docs.select(F.struct(*map(named, docs.columns)).alias("row"), F.col("doc_id").alias("doc_id"), mark)
    kept = rows.join(cut(stay, "stay"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("of")), "left_semi")
    first = Window.partitionBy("doc_id", "mark").orderBy("doc_id")
    return kept.withColumn("n", F.row_number().over(first)).where("n = 1").select("row.*")


@query("op5_simhash_groups")
def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", as_hex("fp").alias("fingerprint"), "component_id")
