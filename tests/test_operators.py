"""Ordering, de-duplication, similarity, merge and consensus rules on hand-made rows."""

import math
import random

import pytest
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from stepstone import session
from stepstone.functions import columns as fn
from stepstone.operators import change, consensus, dedupe, edges, merge, ordering, recommend, text


@pytest.fixture(scope="module")
def hot(spark):
    """One group holds most rows."""
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.8 else f"g{rng.randrange(4)}", rng.randrange(50), i) for i in range(400)]
    return spark.createDataFrame(rows, "g string, a int, id int").repartition(3)


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("group", [["g"], []])
def test_positions_equal_window_positions(hot, group, parts):
    plain = hot.withColumn("pos", F.row_number().over(Window.partitionBy(*group).orderBy("a", "id")))
    split = ordering.with_position(hot, group, ["a", "id"], parts=parts)
    assert sorted(plain.collect()) == sorted(split.select(*plain.columns).collect())


@pytest.mark.parametrize("parts", [1, 7])
def test_neighbours_equal_window_neighbours(hot, parts):
    plain = hot.withColumn("prev", F.lag(F.struct("id", "a")).over(Window.partitionBy("g").orderBy("a", "id")))
    split = ordering.with_previous(hot, ["g"], ["a", "id"], ["id", "a"], parts=parts)
    key = lambda rows: sorted(tuple(r)[:3] + ((r.prev.id, r.prev.a) if r.prev else ()) for r in rows)
    assert key(plain.collect()) == key(split.collect())


@pytest.mark.parametrize("parts", [1, 6])
def test_neighbours_of_null_groups_and_pieces(spark, parts):
    rows = [(g, i // 2, i, None if i % 5 == 0 else float("nan") if i % 5 == 1 else -0.0) for i in range(60) for g in (None, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "g double, a int, id int, v double").repartition(3)
    plain = df.withColumn("prev", F.lag(F.struct("id", "g", "v")).over(Window.partitionBy("g").orderBy("a", "id")))
    split = ordering.with_previous(df, ["g"], ["a", "id"], ["id", "g", "v"], parts=parts)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, split.collect()))
    assert ordering.with_previous(df.limit(0), ["g"], ["a"], ["v"], parts=parts).count() == 0
    whole = ordering.with_previous(df.where("g = 1"), [], ["a", "id"], ["id"], parts=parts)
    assert {(r.id, r.prev.id if r.prev else None) for r in whole.collect()} == {(i, i - 1 if i else None) for i in range(60)}


@pytest.mark.parametrize("parts", [1, 7])
def test_neighbours_that_no_one_asks_for_are_not_written(hot, monkeypatch, parts):
    written = []

    def kept(df, tag="cut"):
        out = session.cut(df, tag)
        written.append((tag, out.count()))
        return out

    monkeypatch.setattr(ordering, "cut", kept)
    asked = F.col("prev.id") > F.col("id") + 300
    split = ordering.with_previous(hot, ["g"], ["a", "id"], ["id", "a"], parts=parts, where=asked)
    plain = hot.withColumn("prev", F.lag(F.struct("id", "a")).over(Window.partitionBy("g").orderBy("a", "id"))).where(asked)
    assert sorted(map(repr, split.collect())) == sorted(map(repr, plain.collect())) != []
    assert dict(written)["ranged"] <= plain.count() + 2 * parts


def test_neighbours_shuffle_rows_once(spark):
    df = spark.range(0, 2000, 1, 4).selectExpr("cast(id % 300 as string) g", "id a")
    split = ordering.with_previous(df, ["g"], ["a"], ["a"], parts=4)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan


def test_positions_of_null_groups_and_no_rows(spark):
    rows = spark.createDataFrame([(None, 2), (None, 1), ("x", 1)], "g string, a int")
    assert {(r.g, r.a, r.pos) for r in ordering.with_position(rows, ["g"], ["a"]).collect()} == {(None, 1, 1), (None, 2, 2), ("x", 1, 1)}
    assert ordering.with_position(rows.limit(0), ["g"], ["a"]).count() == 0


@pytest.mark.parametrize("n", [1, 2, 30, 31, 40, 46, 61])
def test_row_windows(spark, n):
    rows = spark.range(n).select(F.lit("b").alias("bucket"), F.col("id"))
    got = edges.row_windows(rows, ["bucket"], ["id"]).collect()
    wins = {}
    for r in got:
        wins.setdefault(r.window, []).append(r.id)
    if n <= 30:
        want = {0: list(range(n))} if n > 1 else {}
    else:
        want = {k: list(range(s, min(s + 25, n))) for k, s in enumerate(range(0, n, 15)) if min(s + 25, n) - s >= 2}
    assert {k: sorted(v) for k, v in wins.items()} == want


def by_hand_conflicts(rows):
    taken, out = {}, {}
    for bucket, ord_, id_, names in sorted(rows, key=lambda r: (r[0], r[1])):
        used = taken.setdefault(bucket, set())
        out[id_] = "review" if used & set(names) else "split"
        if out[id_] == "split":
            used |= set(names)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_name_conflicts_follow_the_order(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("xy"), i, f"p{i}", rng.sample("abcdefghij", rng.randrange(0, 4))) for i in range(40)]
    proposals = spark.createDataFrame([r[:3] for r in rows], "bucket string, ord int, id string")
    names = spark.createDataFrame([(r[0], r[2], n) for r in rows for n in r[3]], "bucket string, id string, name string")
    got = {r.id: r.verdict for r in dedupe.resolve_name_conflicts(proposals, names).collect()}
    assert got == by_hand_conflicts(rows)


def grams(s):
    return {s[i : i + 2] for i in range(len(s) - 1)}


@pytest.mark.parametrize("k", [1, 3])
def test_top_similar_is_exact(spark, k):
    rng = random.Random(9)
    rows = [(f"t{i:02d}", rng.choice("xy"), "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    df = spark.createDataFrame(rows, "id string, block string, text string")
    got = {}
    for r in text.top_similar(df, df, ["block"], k).collect():
        got.setdefault(r.id, []).append((-round(r.score, 9), r.candidate))
    want = {}
    for i, b, s in rows:
        scored = []
        for j, c, u in rows:
            a, d = grams(s), grams(u)
            if j != i and b == c and a & d:
                scored.append((-round(len(a & d) / math.sqrt(len(a) * len(d)), 9), j))
        if scored:
            want[i] = sorted(scored)[:k]
    assert {i: sorted(v) for i, v in got.items()} == want


@pytest.mark.parametrize("k", [1, 3])
def test_most_similar_sharing_is_exact(spark, k):
    rng = random.Random(4)
    rows = [(f"t{i:02d}", "".join(rng.choice("abcde") for _ in range(rng.randrange(0, 6))), rng.sample("uvwxyz", 2)) for i in range(50)]
    df = spark.createDataFrame([(i, b, s) for i, s, both in rows for b in both] * 2, "id string, block string, text string")
    got = {}
    for r in text.most_similar_sharing(df, df, ["block"], k).collect():
        got.setdefault(r.id, []).append(r.candidate)
    want = {}
    for i, s, own in rows:
        a, scored = grams(s), []
        for j, u, other in rows:
            d = grams(u)
            if j != i and set(own) & set(other):
                scored.append((-round(len(a & d) / math.sqrt(len(a) * len(d)), 9) if a and d else 0, j))
        want[i] = sorted(j for _, j in sorted(scored)[:k])
    assert {i: sorted(v) for i, v in got.items()} == want


def test_shared_standards_list_no_pairs(spark, monkeypatch):
    n, sizes = 240, []
    rows = [(f"t{i:03d}", "s", "d", "primary", None, f"t{i - 1:03d}" if i else None, f"text {i % 7}", ["a", "b"]) for i in range(n)]
    topics = spark.createDataFrame(rows, "id string, subject string, domain string, stage string, status string, split_from string, text string, standards array<string>")
    edges = spark.createDataFrame([], "topic_id string, prerequisite_id string")
    plain = text.pair_similarity
    monkeypatch.setattr(text, "pair_similarity", lambda pairs, texts: sizes.append(pairs.count()) or plain(pairs, texts))
    assert text.build_candidates(topics.where("split_from IS NOT NULL"), topics, edges).where("sources LIKE '%curriculum%'").count() == 4 * (n - 1)
    assert sizes[-1] == 4 * (n - 1)


def test_bigrams_of_short_and_marked_text(spark):
    rows = spark.createDataFrame([("",), ("a",), ("·，（",), ("ab",), ("a b·c",), ("😀a",), (None,)], "t string")
    got = [r.g for r in rows.select(fn.bigrams("t").alias("g")).collect()]
    assert got == [[], [], [], ["ab"], ["ab", "bc"], ["😀a"], []]


def test_overlay_reason_by_presence(spark):
    up = spark.createDataFrame([("a", "b", "up"), ("a", "c", "up"), ("a", "d", "up")], "topic_id string, prerequisite_id string, reason string")
    zh = spark.createDataFrame([("a", "b", None), ("a", "c", "")], up.schema)
    got = {r.prerequisite_id: r.reason for r in merge.merge_edges(up, zh).collect()}
    assert got == {"b": None, "c": "", "d": "up"}


def test_local_id_collision_stops(spark):
    rows = spark.createDataFrame([("a", "n")], "id string, name string")
    zh = spark.createDataFrame([("b", "n", "d", None)], "id string, name string, description string, translation_status string")
    with pytest.raises(ValueError):
        merge.merge_topics(rows, zh, rows)


def test_public_rows_leak_nothing(spark):
    row = spark.createDataFrame([Row(topic_id="a", prerequisite_id="b", strength="hard", reason="r", review_note="secret", reviewed_by="me")])
    assert merge.public_edge(row).columns == ["topic_id", "prerequisite_id", "strength", "reason"]


def test_toggle_parity_after_last_decision(spark):
    log = spark.createDataFrame(
        [(1, "a", "toggle", 1, 1), (1, "a", "toggle", 2, 2), (1, "a", "toggle", 3, 3), (1, "b", "mastered", 1, 4), (1, "b", "toggle", 2, 5)],
        "learner int, topic_id string, decision string, ts int, event_id int",
    )
    assert {r.topic_id: r.mastered for r in recommend.fold_toggles(log).collect()} == {"a": True, "b": False}


def test_broken_answers_are_repaired_or_rejected(spark):
    ok = '{"relations":[{"topicId":"a","prerequisiteId":"b","type":"prerequisite","confidence":0.9,"reason":"r"}]}'
    cut_off = ok[:-2] + ',{"topicId":"a","prere'
    rows = spark.createDataFrame([("1", ok), ("2", f"```json\n{ok}\n```"), ("3", cut_off), ("4", ok[:30]), ("5", '{"relations":[]}')], "task string, content string")
    allowed = spark.createDataFrame([(str(i), "a", "b") for i in range(1, 6)], "task string, topic_id string, prerequisite_id string")
    topics = spark.createDataFrame([("a",), ("b",)], "id string")
    got = {(r.task, r["class"], r.why) for r in change.parse_relations(rows, allowed, topics).collect()}
    assert got == {("1", "prerequisite", None), ("2", "prerequisite", None), ("3", "prerequisite", None), ("4", "rejected", "invalid-json")}


def test_provenance_step_can_be_repeated(spark):
    rows = spark.createDataFrame(
        [("a", "b", "reviewed", None, None, None, None, True), ("a", "c", "reviewed", None, None, None, None, False), ("a", "d", "rejected", None, "model", None, None, False),
         ("a", "e", "rejected", None, None, None, None, False), ("a", "f", None, None, None, None, None, False)],
        "topic_id string, prerequisite_id string, review_status string, review_provenance string, reviewed_by string, reviewed_at string, reviewer_role string, is_bridge boolean",
    )
    once = change.provenance_migration(rows, "model", "curation", "t0")
    got = {r.prerequisite_id: (r.bucket, r.review_provenance, r.error) for r in once.collect()}
    assert got == {
        "b": ("human", "human", None), "c": ("rule", "rule", None), "d": ("ai-consensus", "ai-consensus", None),
        "e": (None, None, "rejected-without-reviewer"), "f": ("machine", None, None),
    }
    good = once.where("error IS NULL").drop("error", "bucket")
    again = change.provenance_migration(good, "model", "curation", "t1").drop("error", "bucket")
    assert sorted(again.collect(), key=str) == sorted(good.collect(), key=str)


def test_one_bad_role_fails_the_packet(spark):
    edges_ = spark.createDataFrame([("p", "a", "b", "hard", "r")], "packet_id string, topic_id string, prerequisite_id string, strength string, reason string")
    votes = [("p", "a", "b", role, "reviewed", "unchanged", "r", f"m{role}") for role in consensus.ROLES]
    schema = "packet_id string, topic_id string, prerequisite_id string, role string, verdict string, resolved_strength string, reason string, model string"

    def outcome(rows):
        df = spark.createDataFrame(rows, schema)
        verdicts = consensus.packet_verdicts(consensus.response_verdicts(df, edges_))
        return consensus.edge_decisions(edges_, df, verdicts).first()

    assert (outcome(votes).consensus, outcome(votes).resolved_strength) == ("unanimous-reviewed", "hard")
    assert outcome(votes[:2]).consensus == "packet-failed"
    assert outcome([votes[0], votes[1], (*votes[2][:5], "soft", "r", "x")]).consensus == "disagreement"
    assert outcome([votes[0], votes[1], (*votes[2][:7], votes[0][7])]).consensus == "packet-failed"


def test_drifted_context_applies_nothing(spark):
    live = spark.createDataFrame([("a", "b", "hard", "r", "machine")], "topic_id string, prerequisite_id string, strength string, reason string, review_status string")
    drift = spark.createDataFrame([("a",)], "id string")
    with pytest.raises(ValueError):
        consensus.apply_proposals(live, live, ["topic_id"], drift)


def test_neighbouring_terms_are_both_found(spark):
    rows = spark.createDataFrame([(1, "Ohm's law Newton's law, lawful")], "num int, body string")
    got = {r.term for r in text.discover_terms(rows, "body", ["some law"]).collect()}
    assert got == {"ohm's law", "newton's law"}


def test_digests_tell_where_values_end(spark):
    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "~"), ("~", None)], "x string, y string")
    assert rows.select(fn.row_digest("x", "y").alias("d")).distinct().count() == 4


@pytest.mark.parametrize("length", [1, 2, 50])
def test_components_of_a_chain_and_a_star(spark, length):
    from stepstone.operators.components import smallest_members

    chain = [(f"n{k:03}", f"n{k + 1:03}") for k in range(length)]
    star = [("hub", f"leaf{k}") for k in range(20)]
    got = {r.node: r.root for r in smallest_members(spark.createDataFrame([*chain, *star, ("x", "x")], "src string, dst string")).collect()}
    want = {f"n{k:03}": "n000" for k in range(1, length + 1)} | {f"leaf{k}": "hub" for k in range(20)}
    assert {k: v for k, v in got.items() if k != v} == want


def test_audit_leaves_other_topics_alone_and_takes_the_childrens_fields(spark):
    columns = "id string, name string, subject string, description string, evidence array<string>, assessment_prompt string, centrality double, status string, granularity string, covered_by array<string>, split_from string"
    rows = [
        ("mtc_1", "One", "a", "d1", ["e1"], "p1", 0.5, "covered", None, ["mtc_2", "mtc_3"], None),
        ("mtc_2", "Two", "b", "d2", ["e2"], "p2", 0.4, "covered", None, ["mtc_1", "mtc_3"], "mtc_9"),
        ("mtc_3", "Three", None, None, None, None, None, None, None, None, None),
        ("mtc_4", "Four", "c", "d4", ["e4"], "p4", 0.3, None, None, ["mtc_1", "mtc_2"], None),
    ]
    topics = spark.createDataFrame(rows, columns)
    kids = [(" A ", " about a ", 20, [" shows a ", "more "]), ("B", "about b", 30, ["shows b"]), ("C", "about c", 40, [" shows c"])]
    results = spark.createDataFrame(
        [("mtc_2", "split", 90, kids, None), ("mtc_4", "covered", 50, None, ["mtc_3", "mtc_1", "mtc_4", "mtc_8"])],
        "id string, verdict string, minutes int, children array<struct<name:string,description:string,minutes:int,evidence:array<string>>>, covered_by array<string>",
    )
    done = change.apply_audit(topics, change.audit_actions(results, topics))
    assert done.columns == topics.columns
    got = {r.id: tuple(r) for r in done.collect()}
    prompt = change.PROMPT_START
    assert got == {
        "mtc_1": rows[0], "mtc_3": rows[2],
        "mtc_2": ("mtc_2", "A", "b", "about a", ["shows a", "more"], prompt + "shows a", None, None, "split-45min", None, "mtc_9"),
        "mtc_4": (*rows[3][:7], "covered", None, ["mtc_1", "mtc_3"], None),
        "mtc_5": ("mtc_5", "B", "b", "about b", ["shows b"], prompt + "shows b", None, None, "split-45min", None, "mtc_2"),
        "mtc_6": ("mtc_6", "C", "b", "about c", ["shows c"], prompt + "shows c", None, None, "split-45min", None, "mtc_2"),
    }
