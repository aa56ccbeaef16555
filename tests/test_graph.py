"""Graph operators against brute force on small and random graphs."""

import heapq
import random

import pytest
from pyspark.sql import functions as F

from stepstone.operators import cycles, graph, reachability
from stepstone.session import cut


def frame(spark, rows, strength="soft"):
    full = [(t, p, s if s else strength, r) for t, p, s, r in (row if len(row) == 4 else (*row, None, None) for row in rows)]
    return spark.createDataFrame(full, "topic_id string, prerequisite_id string, strength string, reason string")


def pairs(spark, rows):
    return spark.createDataFrame(rows, "src string, dst string")


def closure(rows):
    out = {}
    for s, d in rows:
        out.setdefault(s, set()).add(d)
    seen = {}
    for start in {x for r in rows for x in r}:
        todo, met = list(out.get(start, ())), set()
        while todo:
            n = todo.pop()
            if n not in met:
                met.add(n)
                todo.extend(out.get(n, ()))
        seen[start] = met
    return seen


def scc_of(rows):
    reach = closure(rows)
    return {n: min(m for m in reach if m == n or (m in reach[n] and n in reach[m]))
            for n in reach if any(m != n and m in reach[n] and n in reach[m] for m in reach)}


def random_rows(seed, nodes=14, edges=24):
    rng = random.Random(seed)
    return sorted({(f"n{rng.randrange(nodes):02d}", f"n{rng.randrange(nodes):02d}") for _ in range(edges)})


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("piece", [2000, 0])
def test_components(spark, seed, piece):
    rows = [r for r in random_rows(seed) if r[0] != r[1]]
    found = {r.id: r.scc for r in graph.components(pairs(spark, rows), piece).collect()}
    assert found == scc_of(rows)


def test_components_of_shared_node_and_empty(spark):
    eight = [("a", "b"), ("b", "a"), ("b", "c"), ("c", "b"), ("c", "d")]
    assert {r.id: r.scc for r in graph.components(pairs(spark, eight)).collect()} == {"a": "a", "b": "a", "c": "a"}
    assert graph.components(pairs(spark, [("a", "b")])).count() == 0


def test_reach_counts_itself_on_a_cycle_and_passes_text(spark):
    topics = spark.createDataFrame(
        [("a", "concept"), ("t", "text"), ("b", "skill"), ("c", None), ("x", "concept")], "id string, node_kind string"
    )
    edges = pairs(spark, [("a", "t"), ("t", "b"), ("b", "c"), ("c", "c")])
    got = {r.id: r.reach for r in reachability.reach_counts(topics, edges).collect()}
    assert got == {"a": 2, "b": 1, "c": 1, "x": 0}
    cent = {r.id: r.centrality for r in reachability.centrality(topics, edges).collect()}
    assert cent == {"a": 1.0, "t": None, "b": 0.5, "c": 0.5, "x": 0.0}


def test_unsortable_holds_cycle_and_descendants(spark):
    rows = [("a", "b"), ("b", "c"), ("c", "b"), ("c", "d"), ("e", "a"), ("s", "s"), ("s", "u")]
    assert {r.id for r in graph.unsortable(pairs(spark, rows)).collect()} == {"b", "c", "d", "s", "u"}


def kahn(ids, keys, rows):
    into = {i: 0 for i in ids}
    out = {i: [] for i in ids}
    for s, d in set(rows):
        into[d] += 1
        out[s].append(d)
    ready = [(keys[i], i) for i in ids if not into[i]]
    heapq.heapify(ready)
    order = []
    while ready:
        _, i = heapq.heappop(ready)
        order.append(i)
        for d in out[i]:
            into[d] -= 1
            if not into[d]:
                heapq.heappush(ready, (keys[d], d))
    return order + sorted((i for i in ids if i not in order), key=lambda i: keys[i])


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_sequence_is_the_smallest_ready_order(spark, seed):
    rng = random.Random(seed)
    rows = random_rows(seed, 16, 18)
    ids = [f"n{i:02d}" for i in range(16)]
    keys = {i: (rng.randrange(5), i) for i in ids}
    nodes = spark.createDataFrame([("s", i, keys[i][0]) for i in ids], "scope string, id string, age int")
    got = graph.sequence(nodes, pairs(spark, rows), "scope", ["age", "id"])
    order = [r.id for r in got.orderBy(F.desc("sortable"), "path").collect()]
    assert order == kahn(ids, keys, rows)


def break_by_hand(rows):
    """Sequential rule: best-scored edge of a cyclic component, again and again."""
    left, removed = dict(rows), set()
    while True:
        scc = scc_of([(p, t) for t, p in left])
        inner = [k for k in left if k[0] in scc and scc.get(k[0]) == scc.get(k[1])]
        if not inner:
            return removed
        root = min(scc[k[0]] for k in inner)

        def rank(k):
            into = sum(1 for e in left if e[0] == k[0])
            out = sum(1 for e in left if e[1] == k[1])
            return (-((left[k] == "soft") * 1.0 + (1.0 / (into + out)) * 0.3), f"{k[1]}->{k[0]}")

        best = min((k for k in inner if scc[k[0]] == root), key=rank)
        removed.add(best)
        del left[best]


@pytest.mark.parametrize("cap", [2000, 3])
@pytest.mark.parametrize("seed", [7, 8])
def test_break_cycles_matches_the_sequential_rule(spark, seed, cap):
    rng = random.Random(seed)
    rows = {(a, b): rng.choice(["soft", "hard"]) for a, b in random_rows(seed, 8, 18) if a != b}
    edges = frame(spark, [(t, p, s, "r") for (t, p), s in rows.items()])
    kept, removed = cycles.break_cycles(edges, group_edges=cap)
    assert {(r.topic_id, r.prerequisite_id) for r in removed.collect()} == break_by_hand(rows)
    assert graph.components(graph.links(kept)).count() == 0


def append_by_hand(old, new, stages):
    current, out = set(old), {}
    for t, p in sorted(new, key=lambda k: f"{k[0]}|{k[1]}"):
        if t not in stages or p not in stages or t == p:
            out[(t, p)] = "invalid-endpoint"
        elif stages[p] > stages[t]:
            out[(t, p)] = "stage-regression"
        elif (t, p) in current:
            out[(t, p)] = "duplicate"
        elif (p, t) in current:
            out[(t, p)] = "reverse-conflict"
        elif p in closure([(b, a) for a, b in current] or [("", "")]).get(t, ()):
            out[(t, p)] = "cycle"
        else:
            out[(t, p)] = None
            current.add((t, p))
    return out


@pytest.mark.parametrize("cap", [2000, 0])
@pytest.mark.parametrize("seed", [11, 12, 13])
def test_safe_append_matches_the_sequential_rule(spark, seed, cap):
    names = [f"n{i:02d}" for i in range(9)]
    old = [(b, a) for a, b in random_rows(seed, 9, 7) if a < b]
    new = sorted(set(random_rows(seed + 100, 9, 22)) | {("n01", "gone")})
    topics = spark.createDataFrame([(n, "primary" if i < 8 else "senior", i) for i, n in enumerate(names)], "id string, stage string, age_start int")
    stages = {n: 0 if i < 8 else 2 for i, n in enumerate(names)}
    got = cycles.safe_append(frame(spark, old), frame(spark, new), topics, "b", cap)
    assert {(r.topic_id, r.prerequisite_id): r.rejected_reason for r in got.collect()} == append_by_hand(old, new, stages)


def test_nearest_unmastered_goes_back_first(spark):
    edges = pairs(spark, [("c", "b"), ("b", "a"), ("a", "d"), ("d", "e"), ("a", "b")])
    nodes = spark.createDataFrame([(n, i, n) for i, n in enumerate("abcde")], "id string, age int, name string")
    starts = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a")], "learner int, id string")
    mastered = spark.createDataFrame(
        [(1, "b"), (2, "b"), (2, "c")] + [(3, n) for n in "bcde"], "learner int, id string"
    )
    got = {r.learner: (r.next_id, r.direction) for r in graph.nearest_unmastered(starts, mastered, edges, nodes).collect()}
    assert got == {1: ("c", "prerequisite"), 2: ("d", "dependent")}


def test_self_edges_stay_and_repeated_keys_are_one_edge(spark):
    edges = frame(spark, [("a", "a", "hard", "r"), ("b", "a", "soft", "q"), ("b", "a", "hard", "r")])
    kept, removed = cycles.break_cycles(edges)
    assert sorted((r.topic_id, r.prerequisite_id, r.strength) for r in kept.collect()) == [("a", "a", "hard"), ("b", "a", "hard")]
    assert removed.count() == 0


def test_one_large_component_takes_no_rounds(spark, monkeypatch):
    """A component of 2,600 edges, more than a task once took, is broken, appended to and found without rounds over the cluster."""
    rng, n = random.Random(8), 600
    ring = {(f"n{i:03d}", f"n{(i + 1) % n:03d}") for i in range(n)}
    while len(ring) < 2600:
        a, b = rng.sample(range(n), 2)
        ring.add((f"n{a:03d}", f"n{b:03d}"))
    rounds = []
    monkeypatch.setattr(graph, "color_components", lambda e: rounds.append("color"))
    monkeypatch.setattr(cycles, "_bottlenecks", lambda a, w: rounds.append("cost"))
    found = {(r.id, r.scc) for r in graph.components(pairs(spark, sorted(ring))).collect()}
    assert found == {(f"n{i:03d}", "n000") for i in range(n)}
    kept, removed = cycles.break_cycles(frame(spark, sorted(ring)))
    left = [(r.prerequisite_id, r.topic_id) for r in kept.collect()]
    assert len(left) + removed.count() == len(ring) and not scc_of(left)
    topics = spark.createDataFrame([(f"n{i:03d}", "primary", 1) for i in range(n)], "id string, stage string, age_start int")
    verdicts = cycles.safe_append(frame(spark, left[:1]).limit(0), frame(spark, sorted(ring)), topics).collect()
    taken = [(r.prerequisite_id, r.topic_id) for r in verdicts if r.verdict == "accepted"]
    assert len(verdicts) == len(ring) and not scc_of(taken) and not rounds


def test_shortcuts_broadcast_no_table_of_all_edges(spark, monkeypatch):
    """Tables of all edges are merged, so none of them passes through the driver."""
    plans = []

    def seen(df, tag="cut", where=None):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, tag)

    monkeypatch.setattr(graph, "cut", seen)
    pairs = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(30)], "src string, dst string")
    assert graph.shortcuts(pairs).count() == 30 + 29 + 28 + 27
    assert len(plans) == 2 and not any("BroadcastExchange" in p for p in plans)
