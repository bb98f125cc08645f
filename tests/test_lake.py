"""Stored tables, the whole run, and the shape of plans."""

from __future__ import annotations

import os
import tempfile

import pytest

from claimflow import fixtures as fx
from claimflow import session
from claimflow.plans import end_to_end
from claimflow.registry import QUERIES
from claimflow.session import SHUFFLE_TARGET_BYTES, shuffle_partitions_for
from claimflow.sources.files import list_names
from claimflow.sources.tables import publish, read_table, read_table_stream, run_sql
from tests.conftest import plan_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="lake-")


def test_publish_overwrites_and_comments(spark, root):
    publish(spark.range(5), root, "gold", "t", "first")
    df = publish(spark.range(2), root, "gold", "t", "the owner's table")
    assert df.count() == 2 and spark.table("gold.t").count() == 2
    info = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED gold.t").collect()}
    assert info["Comment"] == "the owner's table"


def test_read_table_with_a_wider_schema(spark, root):
    publish(spark.range(1), root, "bronze", "t", "")
    wide = read_table(spark, root, "bronze", "t").selectExpr("id", "CAST(NULL AS STRING) AS extra").schema
    assert tuple(read_table(spark, root, "bronze", "t", wide).first()) == (0, None)
    assert read_table_stream(spark, root, "bronze", "t").isStreaming


def test_run_sql(spark):
    assert run_sql(spark, "SELECT sum(id) FROM numbers", numbers=spark.range(4)).first()[0] == 6


@pytest.mark.parametrize("incremental", [False, True])
def test_whole_run_twice_and_with_a_new_file(spark, root, incremental):
    claims, employee = fx.raw_claims(spark, SF_DIR), fx.raw_employee(spark, SF_DIR)
    early, late = claims.where("INCIDENT_SEVERITY <> 'Total Loss'"), claims.where("INCIDENT_SEVERITY = 'Total Loss'")
    raw, lake = f"{root}/raw", f"{root}/lake"
    early.write.option("header", True).csv(f"{raw}/claims")
    employee.write.option("header", True).csv(f"{raw}/employee")
    run = lambda: end_to_end.run_pipeline(spark, raw, lake, incremental=incremental)
    want = early.select("TRANSACTION_ID").distinct().count()
    assert run().count() == want
    assert run().count() == want
    late.write.mode("append").option("header", True).csv(f"{raw}/claims")
    fact = run()
    assert fact.count() == claims.select("TRANSACTION_ID").distinct().count()
    assert fact.where("policy_sk IS NOT NULL").join(spark.read.parquet(f"{lake}/gold/dim_policy"), "policy_sk", "left_anti").isEmpty()


def test_gated_run(spark, root):
    raw = f"{root}/raw"
    fx.raw_claims(spark, SF_DIR).write.option("header", True).csv(f"{raw}/claims")
    fx.raw_employee(spark, SF_DIR).write.option("header", True).csv(f"{raw}/employee")
    assert end_to_end.run_pipeline(spark, raw, f"{root}/lake", gated=True).count() == 2048
    held = read_table(spark, f"{root}/lake", "silver", "quarantine_claims")
    assert held.count() == 345 and held.where("size(reasons) = 0").isEmpty()


def test_expected_counts(spark):
    silver = fx.silver_claims(spark, SF_DIR)
    assert (fx.raw_claims(spark, SF_DIR).count(), silver.count()) == (6000, 4599)
    assert (fx.dim_customer(spark, SF_DIR).count(), fx.dim_policy(spark, SF_DIR).count()) == (149, 1472)
    assert fx.dim_date(spark, SF_DIR).count() == 4748
    assert QUERIES["quarantine_claims"](spark, SF_DIR).count() == 345
    assert QUERIES["demographic_inconsistencies"](spark, SF_DIR).where("column_name = 'MARITAL_STATUS'").count() == 144


BATCH = [n for n in QUERIES if not n.startswith(("stream_", "bronze_", "lakehouse_"))]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not any(node in plan for node in ("EvalPython", "MapInArrow", "MapInPandas", "FlatMapGroups"))


def test_scans_read_only_what_is_needed(spark):
    plan = plan_of(QUERIES["claim_status_distribution"](spark, SF_DIR))
    assert "ReadSchema: struct<CLAIM_STATUS:string>" in plan
    plan = plan_of(fx.silver_claims(spark, SF_DIR).where("claim_amount > 100").select("transaction_id"))
    assert "GreaterThan(claim_amount,100.00)" in plan and "ReadSchema: struct<transaction_id:string,claim_amount:decimal(18,2)>" in plan


def test_fact_moves_no_claims(spark):
    """Without stored statistics the only shuffle allowed is none: agents are broadcast, keys derived."""
    plan = plan_of(QUERIES["fact_claims"](spark, SF_DIR))
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_integrity_scans_the_fact_once(spark):
    plan = plan_of(QUERIES["star_integrity"](spark, SF_DIR))
    assert plan.count("/fact_claims-") == 1 and "Join" not in plan


def test_shuffle_sizing():
    assert shuffle_partitions_for(0, at_least=8) == 8
    assert shuffle_partitions_for(100 << 40) == (100 << 40) // SHUFFLE_TARGET_BYTES
    assert shuffle_partitions_for(1 << 40) == 2048


def test_repository_holds_no_data():
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert not [f for _, _, files in os.walk(here) for f in files if f.endswith((".parquet", ".csv"))]


def test_sizes_follow_the_rows_not_the_stored_bytes(spark, monkeypatch):
    """Before, 1 GB of stored line items, some 35 GB of claims in a sort, asked for 2 partitions and splits of 128 MB."""
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(session.MAX_SPLIT)
    monkeypatch.setattr(session, "stored_bytes", lambda *_: 1 << 30)
    try:
        spark.conf.set(session.MAX_SPLIT, "128m")
        assert session.fit_shuffle(spark, "x") == 64
        assert spark.conf.get(first) == "64"
        assert session.split_bytes(spark) == session.SPLIT_BYTES
        with session.whole_splits(spark):
            assert session.split_bytes(spark) == 2 * session.SPLIT_BYTES
        assert session.split_bytes(spark) == session.SPLIT_BYTES
        spark.conf.set(session.MAX_SPLIT, "16m")  # a finer choice stays
        session.fit_shuffle(spark, "x")
        assert session.split_bytes(spark) == 16 << 20
    finally:
        spark.conf.unset(first)
        spark.conf.set(session.MAX_SPLIT, before)


def test_a_stream_over_claims_has_state_partitions_for_their_rows(monkeypatch):
    monkeypatch.setattr(fx, "stored_bytes", lambda *_: 4 << 30)
    assert fx.state_size(None, "x") == 256  # 8 before


def test_landed_files_are_compressed(spark, tmp_path):
    rows = spark.createDataFrame([(str(i % 7), None if i % 3 else "a,b") for i in range(100)], "a string, b string")
    fx.land(rows, f"{tmp_path}/in")
    fx.land(rows, f"{tmp_path}/in")
    names = [n for n in list_names(spark, f"{tmp_path}/in") if not n.startswith("_")]
    assert names and all(n.endswith(".csv.gz") for n in names)
    back = spark.read.schema(rows.schema).option("header", True).csv(f"{tmp_path}/in")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.unionAll(rows).collect()), key=str)


def test_a_file_written_as_it_comes_can_be_shared(spark):
    """A micro-batch of one file is read by several tasks, as Spark cuts files at row groups."""
    import pyarrow.parquet as pq

    rows = spark.range(60_000, numPartitions=1).selectExpr("sha2(cast(id AS string), 512) AS a", "sha2(cast(-id AS string), 512) AS b")
    kept = spark.conf.get(session.MAX_SPLIT)
    try:
        layer = fx._layer(spark, SF_DIR, "test_row_groups", lambda: rows, as_it_comes=True)
    finally:
        spark.conf.set(session.MAX_SPLIT, kept)
    (path,) = layer.inputFiles()
    file = pq.ParquetFile(path.removeprefix("file://"))
    assert file.metadata.num_rows == 60_000 and file.num_row_groups > 1
