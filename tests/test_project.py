from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimflow.functions.dates import calendar_key, date_key, date_spine, date_spine_covering, is_weekend
from claimflow.operators import project
from claimflow.plans.gold import dim_date


@pytest.mark.parametrize(
    "code,name",
    [("A", "Approved"), ("D", "Denied"), ("P", "Pending"), ("a", "Unknown"), ("F", "Unknown"), ("", "Unknown"),
     (None, "Unknown")],
)
def test_status(spark, code, name):
    df = spark.createDataFrame([(code,)], "s string")
    assert df.select(project.decode_claim_status(F.col("s"))).first()[0] == name


def test_typing_keeps_rows_and_nulls_what_does_not_parse(claim):
    good = {
        "TRANSACTION_ID": "1", "TXN_DATE_TIME": "2020-02-29 23:59:59", "LOSS_DT": "2020-02-10", "REPORT_DT": "2020-02-01",
        "POLICY_EFF_DT": "2020-01-31", "CLAIM_AMOUNT": "10.005", "AGE": "41", "ROUTING_NUMBER": "9000000000",
        "ANY_INJURY": "1", "POLICE_REPORT_AVAILABLE": "N",
    }
    bad = {
        "TRANSACTION_ID": "2", "TXN_DATE_TIME": "soon", "LOSS_DT": "2020-13-01", "REPORT_DT": "not-a-date",
        "CLAIM_AMOUNT": "99999999999999999999", "AGE": "9000000000", "ROUTING_NUMBER": "x", "ANY_INJURY": "maybe",
    }
    first, second = project.type_claims(claim(good, bad)).orderBy("transaction_id").collect()
    assert first.txn_date_time == dt.datetime(2020, 2, 29, 23, 59, 59)
    assert first.claim_amount == Decimal("10.01")
    assert (first.reporting_lag_days, first.policy_to_loss_days) == (-9, 10)
    assert (first.age, first.routing_number, first.any_injury, first.police_report_available) == (41, 9_000_000_000, True, False)
    nulls = ("txn_date_time", "loss_dt", "report_dt", "claim_amount", "age", "routing_number", "any_injury",
             "reporting_lag_days", "policy_to_loss_days")
    assert all(second[c] is None for c in nulls)


def test_snake_case_and_rename(spark):
    df = spark.createDataFrame([(1, 2)], "`First Name` int, AGE int")
    assert project.snake_case_columns(df).columns == ["first_name", "age"]
    assert project.rename_select(df, {"AGE": "age", "First Name": "name"}).first().asDict() == {"age": 2, "name": 1}


def test_calendar(spark):
    days = date_spine(spark, "2015-01-01", "2027-12-31")
    assert days.count() == 4748
    d = spark.sql("SELECT DATE '2024-03-02' AS d UNION ALL SELECT DATE '2014-12-31' UNION ALL SELECT NULL")
    rows = d.select(
        "d", date_key(F.col("d")).alias("k"), is_weekend(F.col("d")).alias("w"),
        calendar_key(F.col("d"), "2015-01-01", "2027-12-31").alias("c"),
    ).collect()
    assert [(r.k, r.w, r.c) for r in rows] == [(20240302, True, 20240302), (20141231, False, None), (None, None, None)]


def test_calendar_columns_follow_the_calendar(spark):
    rows = dim_date(spark, "1999-12-25", "2032-03-05").collect()
    days = [dt.date(1999, 12, 25) + dt.timedelta(n) for n in range((dt.date(2032, 3, 5) - dt.date(1999, 12, 25)).days + 1)]
    assert sorted(map(tuple, rows)) == [
        (d, d.year * 10000 + d.month * 100 + d.day, d.year, d.month, d.day, d.isoweekday() % 7 + 1,
         (d.month + 2) // 3, d.isoweekday() >= 6)
        for d in days
    ]


def test_spine_over_no_dates_is_empty(spark):
    assert date_spine_covering(spark.sql("SELECT CAST(NULL AS DATE) AS a"), ["a", "a"]).count() == 0
