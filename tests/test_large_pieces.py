"""Components of more than 100,000 edges are decided in one task, and decided edges are found once."""

from stepstone.operators import cycles

EDGES = "topic_id string, prerequisite_id string, strength string, reason string"


def test_a_large_component_lists_no_pairs(spark, monkeypatch):
    def listed(*_):
        raise AssertionError("ways between all starts and nodes are listed")

    monkeypatch.setattr(cycles, "_bottlenecks", listed)
    middle = [f"x{i}" for i in range(50_100)]
    old = spark.createDataFrame([(x, "a") for x in middle] + [("z", x) for x in middle], "topic_id string, prerequisite_id string")
    proposed = spark.createDataFrame([("a", "z", "soft", "r"), ("b", "z", "soft", "r"), ("x1", "b", "soft", "r")], EDGES)
    topics = spark.createDataFrame([(x, "primary", 1) for x in ["a", "b", "z", *middle]], "id string, stage string, age_start int")
    got = {(r.topic_id, r.prerequisite_id): r.rejected_reason for r in cycles.safe_append(old, proposed, topics).collect()}
    assert got == {("a", "z"): "cycle", ("b", "z"): None, ("x1", "b"): "cycle"}


def test_a_curated_edge_is_decided_once(spark, monkeypatch):
    tags, plain = [], cycles.cut
    monkeypatch.setattr(cycles, "cut", lambda df, tag="cut": tags.append(tag) or plain(df, tag))
    existing = spark.createDataFrame([("b", "a", "hard", "r"), ("c", "b", "soft", "r")], EDGES)
    decided = spark.createDataFrame([("a", "c", "soft", "bridge", None), ("d", "c", "soft", "bridge", None), ("a", "b", "soft", "bridge", "self")], EDGES + ", skipped string")
    kept, removed = cycles.insert_and_break(existing, decided)
    assert {(r.topic_id, r.prerequisite_id) for r in removed.collect()} == {("c", "b")}
    assert kept.count() == 3 and tags.count("added") == 1
