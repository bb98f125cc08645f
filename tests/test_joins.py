from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from claimflow.operators import profiling
from claimflow.operators.joins import join_date_role, join_dimension, orphans
from claimflow.plans import gold
from tests.conftest import plan_of


def test_left_join_keeps_rows_and_null_matches_nothing(spark):
    fact = spark.createDataFrame([("t1", "a"), ("t2", "z"), ("t3", None)], "id string, agent_id string")
    dim = spark.createDataFrame([("a", 7), (None, -1)], "agent_id string, agent_sk bigint")
    rows = join_dimension(fact, dim, F.col("agent_id"), "agent_id", "agent_sk").orderBy("id").collect()
    assert [r.agent_sk for r in rows] == [7, None, None]
    assert rows[0].agent_id == "a"


def test_hot_key_of_a_lookup_is_split(spark):
    """A third of the rows under one key: adaptive execution divides that partition among tasks."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    session = spark.newSession()
    for key, value in small.items():
        session.conf.set(key, value)
    ids = "IF(id % 3 = 0, 'hot', CONCAT('k', id)) AS k"
    fact = session.range(0, 60_000, numPartitions=8).selectExpr("id", ids)
    dim = session.range(60_000).selectExpr("CONCAT('k', id) AS k", "id AS sk").unionAll(session.sql("SELECT 'hot', -5L"))
    joined = join_dimension(fact, dim, F.col("k"), "k", "sk")
    joined.collect()
    assert "skew=true" in plan_of(joined)
    assert joined.where("sk = -5").count() == 20_000 and joined.count() == 60_000


def test_date_role_outside_the_calendar(spark):
    fact = spark.createDataFrame([(dt.date(2014, 12, 31),), (dt.date(2015, 1, 1),), (None,)], "loss_dt date")
    rows = join_date_role(fact, gold.dim_date(spark), F.col("loss_dt"), "loss").collect()
    assert {r.loss_dt: r.loss_date_sk for r in rows} == {
        dt.date(2014, 12, 31): None, dt.date(2015, 1, 1): 20150101, None: None
    }


def test_orphans_count_null_keys(spark):
    fact = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    assert orphans(fact, spark.createDataFrame([("a",), ("a",)], "k string"), "k").first()[0] == 3
    assert orphans(fact.limit(0), fact, "k").first()[0] == 0


def test_agent_with_differing_rows_gets_one_row(spark):
    columns = "agent_id string, agent_name string, " + ", ".join(
        f"{c} string" for c in ("date_of_joining", "address_line1", "address_line2", "city", "state", "postal_code",
                                "emp_routing_number", "emp_acct_number")
    )
    rows = [("A1", "Zoe") + (None,) * 8, ("A1", "Ann") + (None,) * 8, ("A2", "Bob") + (None,) * 8]
    got = gold.dim_agent(spark.createDataFrame(rows, columns)).collect()
    assert sorted((r.agent_id, r.agent_name) for r in got) == [("A1", "Ann"), ("A2", "Bob")]


def test_profile_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "k string, v string")
    assert {r.column_name: r.null_count for r in profiling.null_counts(empty).collect()} == {"k": 0, "v": 0}
    assert profiling.row_counts(e=empty).first().row_count == 0


def test_inconsistent_ignores_nulls(spark):
    df = spark.createDataFrame([("a", "x", None), ("a", "y", "1"), ("b", "x", "1"), ("b", "x", None)], "k string, c string, d string")
    assert [tuple(r) for r in profiling.inconsistent_keys(df, "k", ["c", "d"]).collect()] == [("a", "c")]


def test_star_integrity_finds_faults(spark):
    fact = spark.createDataFrame([("t1", 1), ("t2", 9), ("t3", None)], "transaction_id string, agent_sk bigint")
    dim = spark.createDataFrame([(1,), (1,)], "agent_sk bigint")
    got = {r.check_name: r.row_count for r in gold.star_integrity(fact, fact.limit(2), {"agent_sk": dim}).collect()}
    assert got == {"fact_rows": 3, "silver_rows": 2, "duplicate_agent_sk": 1, "unmatched_agent_sk": 2}
