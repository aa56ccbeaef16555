"""Approximate nearest neighbours by robust-pruned directed graphs, one for each shard of the vectors.

Rows are dealt over shards of a bounded size.  A task builds the graph of its shard: greedy searches propose neighbours, and
relaxed distance pruning keeps an edge to a proposal unless a kept neighbour is nearer to the proposal by the factor
``SLACK``, so edges point in many directions.  Queries come in blocks of a bounded size; beam search asks every shard and
the nearest of all shards are kept, with the cosine of the original vectors in double precision.

Equal vectors are one node with the smallest ids of its rows: no more of them than ``k`` + 1 can be among ``k`` answers, and
a graph of copies would not lead anywhere else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stepstone.llm.registry import query
from stepstone.llm.texts import spread_ranges
from stepstone.session import cut, scratch_path

K = 5
#: Components of all vectors of a shard, which one task holds together with the graph.
SHARD_NUMBERS = 1 << 19
#: Components of the queries that are sent to all shards at once.
BLOCK_NUMBERS = 1 << 20
DEGREE, BUILD_BEAM, BEAM, SLACK = 24, 32, 96, 1.2
#: Places of a list of neighbours beyond ``DEGREE`` before it is pruned again.
ROOM = 12
#: Points that search and are pruned together while a graph is built, and queries that search together.
TOGETHER = 256
#: Stands for a null id; sorts last.
NO_ID = np.iinfo(np.int64).max
INDEX_COLUMNS = "shard int, width int, ids array<array<bigint>>, vectors array<double>, neighbours array<int>, start int"
INDEX_SCHEMA = pa.schema([
    ("shard", pa.int32()), ("width", pa.int32()), ("ids", pa.list_(pa.list_(pa.int64()))),
    ("vectors", pa.list_(pa.float64())), ("neighbours", pa.list_(pa.int32())), ("start", pa.int32()),
])
SHARD_SCHEMA = pa.schema([("shard", pa.int32()), ("ids", pa.list_(pa.int64())), ("v", pa.list_(pa.float64()))])


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times powers of two, so that no square overflows or vanishes; cosines stay the same to the last bit."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponent)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def beam_search(points: np.ndarray, graph: np.ndarray, start: int, asked: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, squared distances) of the ``beam`` nearest nodes met from ``start`` on, nearest first, for each query.

    All vectors have length 1.  All queries step together: each expands the nearest node of its beam that it has not expanded,
    until none is left.  Places of a beam that stay empty hold node -1.
    """
    beam = min(beam, len(points))
    last_nodes, last_far = np.full((len(asked), beam), -1, np.int32), np.full((len(asked), beam), np.inf, np.float32)
    nodes, far = last_nodes.copy(), last_far.copy()
    nodes[:, 0], far[:, 0] = start, 2 - 2 * asked @ points[start]
    todo = far.copy()  # distance of the nodes that are still to be expanded
    query = np.arange(len(asked))
    while True:
        spot = todo.argmin(axis=1)
        going = todo[np.arange(len(query)), spot] < np.inf
        if not going.all():
            last_nodes[query[~going]], last_far[query[~going]] = nodes[~going], far[~going]
            query, nodes, far, todo, spot = query[going], nodes[going], far[going], todo[going], spot[going]
            if not len(query):
                break
        rows = np.arange(len(query))
        todo[rows, spot] = np.inf
        new = graph[nodes[rows, spot]]
        row, place = np.nonzero(~(new[:, :, None] == nodes[:, None, :]).any(axis=2) & (new >= 0))
        distance = np.full(new.shape, np.inf, np.float32)
        distance[row, place] = 2 - 2 * np.einsum("nd,nd->n", points[new[row, place]], asked[query[row]])
        both = np.concatenate([far, distance], axis=1)
        best = np.argpartition(both, beam - 1, axis=1)[:, :beam]
        nodes = np.take_along_axis(np.concatenate([nodes, new], axis=1), best, 1)
        todo = np.take_along_axis(np.concatenate([todo, distance], axis=1), best, 1)
        far = np.take_along_axis(both, best, 1)
        nodes[far == np.inf] = -1
    best = np.argsort(last_far, axis=1, kind="stable")
    return np.take_along_axis(last_nodes, best, 1), np.take_along_axis(last_far, best, 1)


def robust_prune(points: np.ndarray, own: np.ndarray, proposed: np.ndarray, degree: int, slack: float) -> np.ndarray:
    """Neighbours of the nodes ``own`` out of ``proposed`` (-1: none), at most ``degree``, nearest first, padded by -1.

    The nearest proposal left is kept, and every proposal to which it is nearer than the node itself, by the factor
    ``slack``, is dropped.
    """
    rows = np.arange(len(own))
    proposed = np.sort(proposed, axis=1)
    out = (proposed < 0) | (proposed == own[:, None])
    out[:, 1:] |= proposed[:, 1:] == proposed[:, :-1]
    there = points[proposed]
    to_own = 2 - 2 * np.matmul(there, points[own][:, :, None])[:, :, 0]
    between = 2 - 2 * there @ there.transpose(0, 2, 1)
    left = np.where(out, np.inf, to_own)
    kept = np.full((len(own), degree), -1, np.int32)
    for k in range(degree):
        spot = left.argmin(axis=1)
        some = left[rows, spot] < np.inf
        if not some.any():
            break
        kept[some, k] = proposed[rows, spot][some]
        left[slack * slack * between[rows, spot] <= to_own] = np.inf
        left[rows, spot] = np.inf
    return kept


def add_back(points: np.ndarray, graph: np.ndarray, own: np.ndarray, degree: int, slack: float) -> None:
    """Propose the nodes ``own`` to their neighbours; a list of neighbours that has no room is pruned to ``degree``."""
    goal, back = graph[own].ravel(), np.repeat(own, graph.shape[1])
    goal, back = goal[goal >= 0], back[goal >= 0]
    there = (graph[goal] == back[:, None]).any(axis=1)
    goal, back = goal[~there], back[~there]
    order = np.argsort(goal, kind="stable")
    goal, back = goal[order], back[order]
    while len(goal):  # a hub takes as many proposals as it has room for in each round
        first = np.flatnonzero(np.diff(goal, prepend=-1))
        sizes = np.diff(np.append(first, len(goal)))
        used = (graph[goal[first]] >= 0).sum(axis=1)
        full = goal[first][used + sizes > graph.shape[1]]
        full = full[(graph[full] >= 0).sum(axis=1) > degree]
        for at in range(0, len(full), TOGETHER):
            some = full[at : at + TOGETHER]
            kept = robust_prune(points, some, graph[some], degree, slack)
            graph[some] = -1
            graph[some, :degree] = kept
        used = (graph[goal[first]] >= 0).sum(axis=1)
        place = np.arange(len(goal)) - np.repeat(first, sizes) + np.repeat(used, sizes)
        fits = place < graph.shape[1]
        graph[goal[fits], place[fits]] = back[fits]
        goal, back = goal[~fits], back[~fits]


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, slack: float = SLACK, seed: int = 11) -> tuple[np.ndarray, int]:
    """(neighbours of each node, padded by -1; the node where searches start: that nearest to the mean).

    From a random graph on, every node searches for itself, takes the pruned nodes it met and is proposed to each of them;
    once without slack and once with it.
    """
    n = len(points)
    rng = np.random.default_rng(seed)
    start = int((points @ points.mean(axis=0)).argmax())
    graph = np.full((n, degree + ROOM), -1, np.int32)
    graph[:, : degree // 2] = rng.integers(0, n, (n, degree // 2))
    for wide in (1.0, slack):
        order = rng.permutation(n)
        for at in range(0, n, TOGETHER):
            own = order[at : at + TOGETHER]
            met, _ = beam_search(points, graph, start, points[own], beam)
            kept = robust_prune(points, own, np.concatenate([met, graph[own]], axis=1), degree, wide)
            graph[own] = -1
            graph[own, :degree] = kept
            add_back(points, graph, own, degree, wide)
    return graph, start


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v) of the rows that take part: the vector is no null, has no null or non-finite component and is not zero."""
    v = F.col(vector_col).cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    # -0.0 becomes 0.0: the cosine is the same, the group of equal vectors would not be
    return vectors.select(F.col(id_col).cast("bigint").alias("id"), F.transform(v, lambda x: x + 0.0).alias("v")).where(sound)


def build_index(vectors: DataFrame, k: int = K, shard_numbers: int = SHARD_NUMBERS) -> DataFrame:
    """The written index of rows (id, v): a row for each shard with its vectors, the ids of each vector, and its graph.

    Columns: shard, width (components of a vector), ids (k + 1 smallest ids of each node's rows, nulls last), vectors
    (all nodes on end), neighbours (``DEGREE`` a node on end, -1: none), start.  Only vectors of one width share a shard.
    Every row is indexed; rows alike in id and vector count once.
    """
    smallest = Window.partitionBy("v").orderBy(F.col("id").asc_nulls_last())
    few = vectors.distinct().withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= k + 1)
    ids = F.array_sort(F.collect_list(F.struct("n", "id"))).getField("id")
    nodes = cut(few.groupBy("v").agg(ids.alias("ids")), "vector-nodes")
    before = Window.orderBy("width").rowsBetween(Window.unboundedPreceding, -1)  # a row for each width
    widths = nodes.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    widths = widths.withColumn("shards", F.ceil(F.col("n") * F.col("width") / shard_numbers))
    widths = cut(widths.withColumn("first", F.coalesce(F.sum("shards").over(before), F.lit(0))), "vector-widths")
    total = widths.agg(F.sum("shards").alias("n")).first()["n"] or 0
    number = F.col("first") + F.pmod(F.xxhash64("v"), "shards")
    dealt = nodes.join(widths, F.size("v") == F.col("width")).select(number.cast("int").alias("shard"), "ids", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(list(batches), SHARD_SCHEMA).combine_chunks()  # one shard
        if not held.num_rows:
            return
        flat = held.column("v").combine_chunks().flatten()
        points = unit(scaled(flat.to_numpy().reshape(held.num_rows, -1))).astype(np.float32)
        graph, start = build_graph(points)
        row = {
            "shard": held.column("shard")[0].as_py(), "width": points.shape[1], "ids": held.column("ids").to_pylist(),
            "vectors": flat, "neighbours": graph.ravel(), "start": start,
        }
        yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in INDEX_SCHEMA], schema=INDEX_SCHEMA)

    built = dealt.repartitionById(max(int(total), 1), F.col("shard")).mapInArrow(run, INDEX_COLUMNS)
    return cut(built, "vector-index")


def ask_shard(shard: dict, asked: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], k: int, beam: int) -> tuple[np.ndarray, ...]:
    """(query number, id, score) of the ``k`` nearest rows of a shard for each query; ``asked`` has numbers, ids and vectors by width."""
    numbers, own, vectors = asked[shard["width"]]
    stored = scaled(shard["vectors"].reshape(-1, shard["width"]))
    points = unit(stored).astype(np.float32)
    graph = shard["neighbours"].reshape(len(points), -1)
    counts = np.array([len(x) for x in shard["ids"]])
    ids = np.array([NO_ID if x is None else x for xs in shard["ids"] for x in xs], np.int64)
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(numbers), TOGETHER):
        some = slice(at, at + TOGETHER)
        nodes, _ = beam_search(points, graph, shard["start"], unit(vectors[some]).astype(np.float32), max(beam, 2 * k + 2))
        nodes = nodes[:, : 2 * k + 2]  # more than k + 1: single precision may have ranked the last ones wrongly
        query, spot = np.nonzero(nodes >= 0)
        node = nodes[query, spot]
        score = cosine(vectors[some][query], stored[node])
        row = np.repeat(np.arange(len(node)), counts[node])
        each = ids[spread_ranges((np.cumsum(counts) - counts)[node], counts[node])]
        query, score = query[row], score[row]
        other = (each != own[some][query]) | (each == NO_ID)
        query, each, score = query[other], each[other], score[other]
        order = np.lexsort((each, -score, query))
        first = np.searchsorted(query[order], np.arange(query.max(initial=-1) + 1))
        order = order[np.arange(len(order)) - first[query[order]] < k] if len(order) else order
        found.append((numbers[some][query[order]], each[order], score[order]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def search(index: DataFrame, queries: DataFrame, k: int = K, beam: int = BEAM, block_numbers: int = BLOCK_NUMBERS) -> DataFrame:
    """(query_id, rank, id, score) of the ``k`` nearest rows found for each distinct row (id, v) of ``queries``.

    Rows with the query's own id are left out.  Nearest is the largest cosine, ties to the smaller id, nulls last.  Rows that
    share an id with different vectors are answered one by one.  Vectors of another width than the query's are not compared.
    Blocks of about ``block_numbers`` components, never the whole set, are sent to the tasks that hold the shards.
    """
    spark = index.sparkSession
    asked = cut(queries.distinct(), "asked")
    seen = asked.agg(F.sum(F.size("v")).alias("n")).first()["n"] or 0
    blocks = -(-seen // block_numbers)
    spread = index.repartitionById(max(index.count(), 1), F.col("shard"))  # small files would share a task
    out = scratch_path(spark, "neighbours")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("id", "v"), F.lit(blocks)) == b).collect()
        by_width = {}
        for width in {len(r.v) for r in block}:
            mine = [n for n, r in enumerate(block) if len(r.v) == width]
            own = np.array([NO_ID if block[n].id is None else block[n].id for n in mine], np.int64)
            by_width[width] = np.array(mine), own, scaled(np.array([block[n].v for n in mine]))

        def run(batches: Iterator[pa.RecordBatch], asked=by_width, ids=[r.id for r in block]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for n in range(batch.num_rows):
                    shard = {f: batch.column(f)[n].as_py() for f in ("width", "ids", "start")}
                    if shard["width"] not in asked:
                        continue
                    shard |= {f: batch.column(f)[n].values.to_numpy() for f in ("vectors", "neighbours")}
                    query, found, score = ask_shard(shard, asked, k, beam)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(query, pa.int32()), pa.array([ids[q] for q in query.tolist()], pa.int64()),
                        pa.array(found, mask=found == NO_ID), pa.array(score),
                    ], names=["query", "query_id", "id", "score"])

        near = spread.mapInArrow(run, "query int, query_id bigint, id bigint, score double")
        ranked = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        ranked.select("query_id", "rank", "id", "score").write.mode("append").parquet(out)
    schema = "query_id bigint, rank int, id bigint, score double"
    return spark.read.schema(schema).parquet(out) if blocks else spark.createDataFrame([], schema)


@query("op13_pruned_graph")
def pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    found = search(build_index(vectors), vectors.where("id % 50 = 0"))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
