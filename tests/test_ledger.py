"""The reconciliation ledger and the drift report."""

from __future__ import annotations

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from claimflow.sources import drift, ledger
from claimflow.sources.csv_files import load_schema
from claimflow.streaming.ingest import ingest


class Feed:
    def __init__(self, spark):
        self.spark, self.root = spark, tempfile.mkdtemp(prefix="ledger-")
        self.src, self.dst, self.ckpt, self.store = (f"{self.root}/{p}" for p in ("in put", "out", "ckpt", "schema"))
        os.makedirs(self.src)

    def land(self, name, text):
        with open(f"{self.src}/{name}", "w") as f:
            f.write(text)

    def load(self):
        ingest(self.spark, self.src, self.dst, self.ckpt, self.store)

    def settle(self):
        return self.rows(ledger.settle(self.spark, self.src, self.dst, self.root, "t"))

    def all(self):
        return self.rows(ledger.read_ledger(self.spark, self.root, "t"))

    @staticmethod
    def rows(df):
        return sorted((os.path.basename(r.file), r.landed, r.loaded, r.difference) for r in df.collect())


@pytest.fixture
def feed(spark):
    return Feed(spark)


def test_each_file_is_counted_once(feed):
    feed.land("a.csv", "ID,N\nx,1\ny,2\n")
    feed.land("empty.csv", "ID,N\n")
    feed.load()
    assert feed.settle() == [("a.csv", 2, 2, 0), ("empty.csv", 0, 0, 0)]
    # The settled file now holds other rows under the same length and time: a run that read it would count them.
    kept = os.stat(f"{feed.src}/a.csv")
    feed.land("a.csv", "ID,N\n\n\n\n\n\n\n\n\n")
    os.utime(f"{feed.src}/a.csv", ns=(kept.st_atime_ns, kept.st_mtime_ns))
    assert os.path.getsize(f"{feed.src}/a.csv") == kept.st_size
    assert feed.settle() == []
    feed.land("b.csv", "ID,N\nz,3\n")
    feed.load()
    assert feed.settle() == [("b.csv", 1, 1, 0)]
    assert feed.all() == [("a.csv", 2, 2, 0), ("b.csv", 1, 1, 0), ("empty.csv", 0, 0, 0)]


def test_bronze_files_are_counted_once(feed):
    feed.land("a.csv", "ID,N\nx,1\n")
    feed.load()
    feed.settle()
    for name in os.listdir(feed.dst):
        if name.endswith(".parquet"):
            os.truncate(f"{feed.dst}/{name}", 0)  # cannot be read any more
    feed.land("b.csv", "ID,N\ny,1\nz,2\n")
    feed.load()
    assert feed.settle() == [("b.csv", 2, 2, 0)]


def test_a_file_that_is_not_loaded_stays_open(feed):
    feed.land("a.csv", "ID,N\nx,1\n")
    feed.load()
    feed.land("late.csv", "ID,N\ny,1\nz,2\n")
    assert feed.settle() == [("a.csv", 1, 1, 0), ("late.csv", 2, 0, 2)]
    assert feed.settle() == [("late.csv", 2, 0, 2)]
    feed.load()
    assert feed.settle() == [("late.csv", 2, 2, 0)] and feed.settle() == []
    assert feed.all() == [("a.csv", 1, 1, 0), ("late.csv", 2, 2, 0)]


def test_a_file_changed_after_its_load_comes_up(feed):
    feed.land("a.csv", "ID,N\nx,1\n")
    feed.load()
    feed.settle()
    time.sleep(1.1)
    feed.land("a.csv", "ID,N\nx,1\ny,2\nz,3\n")
    feed.load()
    assert feed.settle() == [("a.csv", 3, 0, 3)]
    assert feed.all() == [("a.csv", 1, 1, 0), ("a.csv", 3, 0, 3)]


def test_rows_loaded_twice_open_their_file_again(feed):
    feed.land("a.csv", "ID,N\nx,1\ny,2\n")
    feed.load()
    feed.settle()
    feed.ckpt, old = f"{feed.root}/lost", feed.dst
    feed.dst = f"{feed.root}/out2"
    feed.load()
    for name in os.listdir(feed.dst):
        if name.endswith(".parquet"):
            os.rename(f"{feed.dst}/{name}", f"{old}/again-{name}")
    plain = f"{feed.root}/plain"  # a table without a stream's log, so that all its files count
    os.makedirs(plain)
    for name in os.listdir(old):
        if name.endswith(".parquet"):
            os.rename(f"{old}/{name}", f"{plain}/{name}")
    feed.dst = plain
    assert feed.settle() == [("a.csv", 2, 6, -4)]


# Drift


def test_types_and_their_least_common_type(spark):
    texts = {
        "1": "int", " -7 ": "int", "3000000000": "bigint", "1e3": "double", "1.5": "double", ".5": "double", "5d": "string",
        "12345678901234567890": "double", "2020-02-29": "date", "2020-02-30": "string", "2020-02-29 10:00:00": "timestamp",
        "2020-02-29T10:00:00Z": "timestamp", "True": "boolean", "": "string", "NaN": "string", "x": "string",
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", drift.kind_of(F.col("t")).alias("kind"))
    for kind in ("int", "bigint", "double", "decimal(20,0)", "date", "timestamp", "boolean"):
        fits = df.select("t", (F.col("kind").bitwiseAND(F.lit(drift._fitting(kind))) != 0).alias("want"), drift._fits(F.col("t"), kind).alias("fits"))
        assert fits.where("want <> fits").collect() == []
    named = {v: k for k, v in drift.KINDS.items()}
    assert {r.t: named[r.kind] for r in df.collect()} == texts
    joins = {
        ("int",): "int", ("int", "double"): "double", ("int", "bigint"): "bigint", ("date", "timestamp"): "timestamp",
        ("int", "date"): "string", ("boolean",): "boolean", ("boolean", "int"): "string", ("bigint", "string"): "string",
    }
    for kinds, want in joins.items():
        assert spark.range(1).select(drift.common_type(F.lit(sum(drift.KINDS[k] for k in kinds)))).first()[0] == want


def test_report_names_file_column_and_first_value(feed, spark):
    feed.land("a.csv", "ID,N,D,T,F,B\nx,1,2020-01-01,2020-01-01 10:00:00,1.5,true\n")
    feed.load()
    schema = load_schema(spark, feed.store)
    assert drift.type_drift(spark, feed.src, schema).isEmpty()
    rows = ["y,2,2020-01-02,2020-01-01 11:00:00,2,false"] * 3 + ["z,,,,,"]
    rows += ["q,9000000000,2020-01-02 05:00:00,soon,n/a,1", "q,2.5,,later,3,0", "q,4,,,,"]
    feed.land("b.csv", "ID,N,D,T,F,B\n" + "\n".join(rows) + "\n")
    got = drift.type_drift(spark, feed.src, schema)
    assert sorted((os.path.basename(r[0]), *r[1:]) for r in got.collect()) == [
        ("b.csv", "B", "boolean", "string", 2, "1"),
        ("b.csv", "D", "date", "timestamp", 1, "2020-01-02 05:00:00"),
        ("b.csv", "F", "double", "string", 1, "n/a"),
        ("b.csv", "N", "int", "double", 2, "9000000000"),
        ("b.csv", "T", "timestamp", "string", 2, "soon"),
    ]


def test_text_columns_do_not_drift(spark, feed):
    feed.land("a.csv", "ID\nx\n")
    feed.load()
    assert drift.type_drift(spark, feed.src, load_schema(spark, feed.store)).isEmpty()
