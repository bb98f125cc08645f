from __future__ import annotations

from claimflow.operators import dedup
from claimflow.operators.dedup import dedup_claims, dedup_first, dedup_wide
from claimflow.operators.scd import scd1_upsert
from tests.conftest import plan_of


def test_null_key_is_one_key(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3), ("a", None)], "k string, v int")
    assert sorted(map(tuple, dedup_first(df, ["k"], ["v"]).collect()), key=str) == [("a", None), (None, 1)]


def test_amounts_compare_as_numbers(claim):
    rows = [{"TRANSACTION_ID": "t", "CLAIM_AMOUNT": a} for a in ("100.0", "9.5")]
    assert dedup_claims(claim(*rows)).first().CLAIM_AMOUNT == "9.5"


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS k", "id AS v").repartition(4)
    once = dedup_first(df, ["k"], ["v"])
    plan = plan_of(once)
    below_shuffle = plan[plan.index("WindowGroupLimit"):]
    assert below_shuffle.index("Exchange") < below_shuffle.rindex("WindowGroupLimit")
    assert once.count() == 1 + 666
    assert once.where("k = 'hot'").first().v == 0


def test_scd1_newest_wins_and_ties_go_to_the_greater_id(spark):
    schema = "k string, city string, at int, id string"
    old = spark.createDataFrame([("a", "Rome", 1, "1"), ("b", "Oslo", 5, "2"), ("d", "Bern", None, "9")], schema)
    new = spark.createDataFrame([("a", "Paris", 2, "3"), ("b", "Bonn", 5, "4"), ("c", "Lima", 1, "5"), ("d", "Kiel", 0, "1")], schema)
    got = {r.k: r.city for r in scd1_upsert(old, new, "k", ["at", "id"]).collect()}
    assert got == {"a": "Paris", "b": "Bonn", "c": "Lima", "d": "Kiel"}


def _wide_rows(spark):
    rows = [(None if i % 500 == 7 else f"k{i % 900}", str(i % 3), i % 11) for i in range(1000)]
    return spark.createDataFrame(rows, "k string, a string, b int").repartition(4)


def test_wide_rows_keep_the_least_of_each_key(spark, monkeypatch):
    df = _wide_rows(spark)
    wanted = sorted(map(tuple, dedup_first(df, ["k"], ["a", "b"]).collect()), key=str)
    for bits in (dedup.MOST_BITS, 1 << 15, 8):  # with 8 bits most keys are marked by chance
        monkeypatch.setattr(dedup, "MOST_BITS", bits)
        assert sorted(map(tuple, dedup_wide(df, ["k"], ["a", "b"]).collect()), key=str) == wanted


def test_claims_of_their_own_id_are_not_sent(spark, claim):
    """Before, every claim was sorted and shuffled with all its columns."""
    rows = [{"TRANSACTION_ID": f"t{i}", "CLAIM_AMOUNT": str(i)} for i in range(20)]
    assert "Exchange" not in plan_of(dedup_claims(claim(*rows)))
    once = dedup_claims(claim(*rows, {"TRANSACTION_ID": "t3", "CLAIM_AMOUNT": "1"}, {}, {}))
    assert once.count() == 21
    assert once.where("TRANSACTION_ID = 't3'").first().CLAIM_AMOUNT == "1"
    plan = plan_of(once)
    assert "WindowGroupLimit" in plan and "Union" in plan
