"""Packet identities, field lists and echoes, snapshots by trees, and cycles broken again after an insert, by hand."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from stepstone.operators import consensus as ops
from stepstone.operators import cycles, quality
from stepstone.sources import hashtree
from stepstone.sources.export import diff_snapshots

EDGE = "packet_id string, topic_id string, prerequisite_id string, reason string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def identity_by_hand(head, edges, fan):
    rows = [{k: v for k, v in zip(("topic_id", "prerequisite_id", "reason"), e) if v is not None} for e in edges]
    hashed = [(e[0], e[1], sha(json.dumps(r, sort_keys=True, separators=(",", ":"), ensure_ascii=False))) for e, r in zip(edges, rows)]
    level = [h for *_, h in sorted(hashed)]
    while len(level) > 1:
        groups = [level[i : i + fan] for i in range(0, len(level), fan)]
        level = [g[0] if len(g) == 1 else sha("".join(g)) for g in groups]
    return "packet-v1:" + sha("|".join([*head, str(len(edges)), level[0]]))


@pytest.mark.parametrize("fan", [2, 3, 256])
def test_packet_identity_is_the_tree_over_ordered_hashes(spark, fan):
    rng = random.Random(fan)
    sizes = {"a": 1, "b": 2, "c": fan, "d": fan + 1, "e": 40}
    rows = [(p, f"t{rng.randrange(9)}", f"p{n}", rng.choice(["é中", "", None, "x"])) for p, size in sizes.items() for n in range(size)]
    rows.append(rows[-1])  # a repeated row
    rng.shuffle(rows)
    packets = spark.createDataFrame([(p, "f", f"s{p}") for p in [*sizes, "none"]], "packet_id string, format string, checksum string")
    found = {r.packet_id: r.identity for r in ops.packet_identity(packets, spark.createDataFrame(rows, EDGE), fan=fan).collect()}
    assert found == {p: identity_by_hand(("f", f"s{p}"), [r[1:] for r in rows if r[0] == p], fan) for p in sizes}


def test_packet_identity_shows_every_change(spark):
    packets = spark.createDataFrame([("a", "f", "s")], "packet_id string, format string, checksum string")
    base = [("a", f"t{n}", f"p{n}", f"r{n}", n) for n in range(9)]

    def identity(rows, order=ops.EDGE_KEY):
        return ops.packet_identity(packets, spark.createDataFrame(rows, EDGE + ", place int"), order, 4).first().identity

    swapped = [*base[:2], (*base[2][:3], "r3", 2), (*base[3][:3], "r2", 3), *base[4:]]
    moved = [(*r[:4], {2: 3, 3: 2}.get(r[4], r[4])) for r in base]
    byte = [(*base[0][:3], "r0 ", 0), *base[1:]]
    assert identity(base) == identity(base[::-1])
    assert len({identity(x) for x in (base, swapped, moved, byte, base[:-1], [*base, base[0]])}) == 6
    assert identity(base, ["place"]) != identity(moved, ["place"])


def test_packet_identity_of_no_rows(spark):
    packets = spark.createDataFrame([("a", "f", "s")], "packet_id string, format string, checksum string")
    assert ops.packet_identity(packets, spark.createDataFrame([], EDGE)).count() == 0


def test_field_problems(spark):
    rows = spark.createDataFrame(
        [("a", "1", '{"id":"x","name":null}'), ("a", "2", '{"id":"x","rank":1}'), ("a", "3", None), ("a", "4", "[1]"), ("a", "5", "{}"), ("a", "6", "{"), ("a", "7", '"id"')],
        "packet_id string, key string, doc string",
    )
    found = {(r.rule, r.key) for r in ops.field_problems(rows, {"topic": (F.col("doc"), ops.PACKET_TOPIC_FIELDS)}).collect()}
    assert found == {("topic-field", "2"), *[("topic-object", k) for k in "3467"]}


def test_echo_problems(spark):
    asked = spark.createDataFrame([("a", r, f"q{r}", "m") for r in ("x", "y", "z", "w")], "packet_id string, role string, request_id string, model string")
    given = spark.createDataFrame(
        [("a", "x", "qx", "m", "v1"), ("a", "y", "qx", None, "v2"), ("a", "z", "qz", "m", "v1"), ("a", "z", "qz", "m", "v1"), ("b", "x", "q", "m", "v1")],
        "packet_id string, role string, request_id string, model string, format string",
    )
    found = sorted(tuple(r) for r in ops.echo_problems(asked, given, "v1", ["request_id", "model"]).collect())
    assert found == [
        ("a", "w", "unanswered"), ("a", "y", "format"), ("a", "y", "model"), ("a", "y", "request-id"), ("a", "z", "answered-twice"), ("b", "x", "unasked"),
    ]


def test_references_have_bounds(spark):
    lists = [[], ["r" * 500] * 8, ["r"] * 9, ["r" * 501], [""], [None], None]
    rows = spark.createDataFrame([(n, x) for n, x in enumerate(lists)], "n int, references array<string>")
    assert [r.ok for r in rows.select("n", F.coalesce(ops.well_cited(F.col("references")), F.lit(False)).alias("ok")).orderBy("n").collect()] == [True, True, *[False] * 5]


def states(spark, seed, rows=400):
    rng = random.Random(seed)
    before = [(k, rng.choice(["a", "b", None]), rng.random(), ["x, y"]) for k in range(rows)]
    after = [(k, "changed" if rng.random() < 0.05 else v, x, z) for k, v, x, z in before if rng.random() > 0.05]
    after += [(rows + n, "new", 0.0, None) for n in range(7)]
    schema = "digest int, row string, top double, leaf array<string>"  # the names that the snapshot uses itself
    return spark.createDataFrame(before, schema), spark.createDataFrame(after, schema)


@pytest.mark.parametrize("size", [(1, 1), (4, 4), (64, 64)])
def test_tree_diff_is_the_whole_diff(spark, tmp_path, size):
    before, after = states(spark, size[0])
    a, b = (hashtree.create_tree_snapshot(df, f"{tmp_path}/{n}", ["digest"], *size) for n, df in enumerate((before, after)))
    found = {r.change: r.n for r in hashtree.diff_trees(spark, a, b, ["digest"]).collect()}
    assert found == {r.change: r.n for r in diff_snapshots(before, after, ["digest"]).collect()}
    assert {r.change: r.n for r in hashtree.diff_trees(spark, a, a, ["digest"]).collect()} == {"unchanged": 400}


def test_tree_diff_of_null_and_repeated_keys_and_no_rows(spark, tmp_path):
    schema = "k string, v string"

    def put(name, rows):
        return hashtree.create_tree_snapshot(spark.createDataFrame(rows, schema), f"{tmp_path}/{name}", ["k"], 4, 4)

    def diff(a, b):
        return {r.change: r.n for r in hashtree.diff_trees(spark, a, b, ["k"]).collect()}

    base = put("a", [(None, "x"), ("t", "1"), ("t", "1"), ("u", None), ("v", '","')])
    assert diff(base, put("b", [(None, "y"), ("t", "1"), ("t", "2"), ("u", ""), ("v", '","')])) == {"changed": 4, "unchanged": 1}
    assert diff(base, put("c", [])) == {"removed": 5} and diff(put("d", []), base) == {"added": 5} and diff(put("e", []), put("f", [])) == {}


def test_one_changed_row_reads_little(spark, small, tmp_path):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    changed = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") == 77, 0.0).otherwise(F.col("o_totalprice")))
    a, b = (hashtree.create_tree_snapshot(df, f"{tmp_path}/{n}", ["o_orderkey"]) for n, df in enumerate((orders, changed)))
    places = hashtree.differing_leaves(spark, a, b).collect()
    assert len(places) == 1
    read = hashtree.rows_of_leaves(spark, a, [(places[0].top, places[0].leaf)])
    folder = spark.read.parquet(f"{a}/rows").where(F.col("top") == places[0].top)
    assert folder.count() < 0.05 * orders.count() and 1 <= read.count() == places[0].n_before
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "top#" in plan.split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize(("seed", "piece"), [(1, 2000), (2, 3)])
def test_cycles_after_an_insert_are_those_of_the_whole(spark, seed, piece):
    rng = random.Random(seed)
    old = {(f"n{b:02d}", f"n{a:02d}") for a, b in (sorted(rng.sample(range(30), 2)) for _ in range(60))}  # no cycle: ids grow
    new = {(f"n{a:02d}", f"n{b:02d}", rng.random() < 0.2) for a, b in (sorted(rng.sample(range(30), 2)) for _ in range(6))}
    schema = "topic_id string, prerequisite_id string, strength string, reason string"
    existing = spark.createDataFrame([(t, p, rng.choice(["soft", "hard"]), "r") for t, p in sorted(old)], schema)
    decided = spark.createDataFrame([(t, p, "soft", "n", "self" if s else None) for t, p, s in sorted(new)], schema + ", skipped string")
    kept, removed = cycles.insert_and_break(existing, decided, (), piece)
    whole = existing.union(decided.where("skipped IS NULL").drop("skipped"))
    want_kept, want = cycles.break_cycles(whole, (), piece)
    assert sorted(map(tuple, removed.collect())) == sorted(map(tuple, want.collect()))
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, want_kept.collect()))


def test_insert_into_a_large_component(spark):
    """Eight layers with more edges than a task takes at once, closed by one edge from the last to the first."""
    rng = random.Random(6)
    rows = {(f"n{layer + 1}_{rng.randrange(40):02d}", f"n{layer}_{rng.randrange(40):02d}") for layer in range(7) for _ in range(600)}
    assert len(rows) > 2000
    schema = "topic_id string, prerequisite_id string, strength string, reason string"
    existing = spark.createDataFrame([(t, p, "hard", "r") for t, p in sorted(rows)], schema)
    decided = spark.createDataFrame([("n0_03", "n7_05", "soft", "n", None)], schema + ", skipped string")
    removed = cycles.insert_and_break(existing, decided, ())[1].collect()
    assert [(r.topic_id, r.prerequisite_id) for r in removed] == [("n0_03", "n7_05")]


def test_insert_of_nothing(spark):
    schema = "topic_id string, prerequisite_id string, strength string, reason string"
    existing = spark.createDataFrame([("b", "a", "soft", "r")], schema)
    kept, removed = cycles.insert_and_break(existing, spark.createDataFrame([], schema + ", skipped string"))
    assert kept.count() == 1 and removed.count() == 0


def test_reference_problems(spark):
    topics = spark.createDataFrame(
        [("a", "covered", ["k1", "k9", "k9", None], ["b", "z"]), ("b", None, None, ["z"]), ("c", "covered", [], None), ("a", "covered", ["k9"], [])],
        "id string, status string, standards array<string>, covered_by array<string>",
    )
    edges = spark.createDataFrame([("a", "b", "g1"), ("b", "a", "g2"), ("c", "a", None)], "topic_id string, prerequisite_id string, generation_batch_id string")
    entries, batches = spark.createDataFrame([("k1",), (None,)], "key string"), spark.createDataFrame([("g1",), ("g1",)], "id string")
    found = sorted(tuple(r) for r in quality.reference_problems(topics, edges, entries, batches).collect())
    assert found == [("unknown-batch", "b->a"), ("unknown-cover", "a:z"), ("unknown-standard", "a:k9")]
    nothing = quality.reference_problems(topics.limit(0), edges.limit(0), entries, batches.limit(0))
    assert nothing.count() == 0


def test_cluster_problems_and_end_patterns(spark):
    schema = "subject string, domain string, age_start int"
    structure = spark.createDataFrame([("s", "d", 6), ("s", "e", 7), (None, "d", 6)], schema)
    overlay = spark.createDataFrame(
        [("s", "d", 6, None), ("s", "d", 6, "machine"), ("s", "e", 8, "reviewed"), ("s", "e", 7, ""), (None, "d", 6, None)], schema + ", translation_status string"
    )
    found = sorted(tuple(r) for r in quality.cluster_problems(overlay, structure).collect())
    assert found == [("duplicate-cluster", "s|d|6"), ("translation-status", "s|e|7"), ("unknown-cluster", "s|e|8"), ("unknown-cluster", "|d|6")]
    assert quality.cluster_problems(overlay.limit(0), structure).count() == 0
    edges = spark.createDataFrame([("a1", "b1"), ("a", "b1"), (None, "b"), ("a1", None)], "topic_id string, prerequisite_id string")
    odd = sorted(tuple(r) for r in quality.end_patterns(edges, r"^a\d$", r"^b\d$").collect())
    assert odd == [("prerequisite-end", "->b"), ("prerequisite-end", "a1->"), ("topic-end", "->b"), ("topic-end", "a->b1")]
