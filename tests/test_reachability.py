"""Sets united along edges and searches from both ends, against closures by plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from stepstone.operators import graph, reachability
from test_graph import closure, pairs, random_rows


def chain_of(n):
    return [(f"c{k:04d}", f"c{k + 1:04d}") for k in range(n)]


@pytest.mark.parametrize("doublings", [0, 4])
def test_counts_of_random_graphs(spark, monkeypatch, doublings):
    monkeypatch.setattr(reachability, "DOUBLINGS", doublings)
    rows = random_rows(3) + random_rows(4, 60, 60) + [("s", "s"), ("s", "n01")]
    nodes = {x for r in rows for x in r}
    counted = sorted(n for n in nodes if hash(n) % 3 or n == "s") + ["alone"]
    want = {n: len(met & set(counted)) for n, met in closure(rows).items()}
    frame = spark.createDataFrame([(c,) for c in counted] * 2, "id string").repartition(3)
    got = {r.id: r.reach for r in reachability.reached(frame, pairs(spark, rows)).collect()}
    assert got == {n: k for n, k in want.items() if k}
    assert reachability.reached(frame, pairs(spark, [])).collect() == []


def test_sets_of_a_chain_are_words_not_pairs(spark):
    """Each node of a chain leads to all later ones: the sets must take far fewer rows than the pairs."""
    rows = chain_of(70)
    edges = pairs(spark, rows)
    ends = graph.endpoints(edges)
    got = {r.id: r.reach for r in reachability.reached(ends, edges).collect()}
    assert got == {f"c{k:04d}": 70 - k for k in range(70)}
    hops = graph.shortcuts(edges, reachability.DOUBLINGS)
    direct = hops.join(reachability.numbered(ends), F.col("dst") == F.col("id")).groupBy(F.col("src").alias("node"), "part").agg(F.bit_or("bit").alias("members"))
    sets = reachability._united(direct, hops, F.bit_or, lambda c: F.bit_count(c).cast("bigint"))
    assert sets.count() < 70 * 71 / 2 / 8


def test_sketches_are_near_the_counts(spark):
    rng = random.Random(6)
    rows = [(f"m{rng.randrange(2500):04d}", f"m{rng.randrange(2500):04d}") for _ in range(3200)]
    edges = pairs(spark, rows)
    ends = graph.endpoints(edges)
    exact = {r.id: r.reach for r in reachability.reached(ends, edges).collect()}
    assert exact == {n: len(met) for n, met in closure(rows).items() if met}
    near = {r.id: r.reach for r in reachability.reached_sketch(ends, edges).collect()}
    assert set(near) == set(exact)
    errors = sorted(abs(near[n] - k) / k for n, k in exact.items())
    assert max(exact.values()) > 300 and errors[len(errors) // 2] < 0.03 and errors[-1] < 0.1


@pytest.mark.parametrize("seed", [1, 2])
def test_asked_pairs_of_random_graphs(spark, seed):
    rows = random_rows(seed, 24, 34) + chain_of(6)
    reach = closure(rows)
    names = sorted(reach) + ["gone"]
    rng = random.Random(seed)
    asked = [(rng.choice(names), rng.choice(names)) for _ in range(150)] + [("c0000", "c0006"), ("c0006", "c0000"), ("gone", "gone"), ("n01", "n01")]
    frame = spark.createDataFrame(asked, "src string, dst string")
    got = {(r.src, r.dst): r.reachable for r in reachability.reachable_pairs(frame, pairs(spark, rows)).collect()}
    assert got == {(s, d): s == d or d in reach.get(s, ()) for s, d in asked}
    assert reachability.reachable_pairs(frame.limit(0), pairs(spark, rows)).collect() == []
    assert not any(r.reachable for r in reachability.reachable_pairs(frame.where("src <> dst"), pairs(spark, [])).collect())


def test_intervals_hold_those_of_descendants(spark):
    rows = random_rows(9, 16, 18)
    labels = {r.id: (r.low, r.high) for r in reachability.descent_labels(pairs(spark, rows)).collect()}
    for node, met in closure(rows).items():
        inside = [labels[m] for m in met]
        assert all(labels[node][0] <= low and high <= labels[node][1] for low, high in inside)
