"""Children's names are compared by what they mean, not by how they are spelled."""

import pytest

from stepstone.plans import edge_plans

LINES = [(1, 7, "A"), (2, 7, "R"), (2, 8, "N"), (3, 8, "A"), (4, 9, None), (5, 9, "R"), (6, 5, "N"), (101, 7, "N"), (102, 6, "A"), (6, 5, "N")]


def verdicts(spark, folder):
    spark.createDataFrame(LINES, "l_orderkey long, l_partkey long, l_returnflag string").write.parquet(f"{folder}/lineitem.parquet")
    return {r.id: r.verdict for r in edge_plans.name_conflicts(spark, str(folder)).collect()}


def test_other_spellings_of_a_name_are_conflicts(spark, tmp_path):
    # order 2 loses part 7 to order 1 and frees part 8 for order 3
    review = {"order_2", "order_5"}
    assert verdicts(spark, tmp_path) == {f"order_{n}": "review" if f"order_{n}" in review else "split" for n in (1, 2, 3, 4, 5, 6, 101, 102)}


def test_without_normalising_spellings_are_no_conflicts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(edge_plans, "normalised_name", lambda name: name)
    assert set(verdicts(spark, tmp_path).values()) == {"split"}


@pytest.mark.parametrize("flag", ["A", "R", "N", None])
def test_every_spelling_normalises_to_one_name(spark, flag):
    row = spark.createDataFrame([(12, flag)], "l_partkey long, l_returnflag string")
    assert row.select(edge_plans.normalised_name(edge_plans.child_name())).first()[0] == "Part12"
