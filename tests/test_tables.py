"""Versions of stored tables."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from claimflow.sources import tables
from claimflow.sources.files import AlreadyWritten, list_names, write_once
from claimflow.sources.tables import catalog_name, manifest, publish, read_table, replace_parts


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="tables-")


def ids(df):
    return sorted(r.id for r in df.collect())


def folders(root):
    path = f"{root}/kept/t"
    return sorted(f"{d}/{p}" for d in os.listdir(path) if d.startswith("_version") for p in os.listdir(f"{path}/{d}") if "=" in p)


def test_a_table_can_be_published_over_itself(spark, root):
    publish(spark.range(10), root, "kept", "t", "")
    for left in (9, 8, 7, 6):
        table = publish(read_table(spark, root, "kept", "t").where(f"id < {left}"), root, "kept", "t", "")
        assert ids(table) == list(range(left)) and spark.table(catalog_name(spark, root, "kept", "t")).count() == left
    assert len([d for d in os.listdir(f"{root}/kept/t") if d.startswith("_version")]) == tables.KEPT_VERSIONS
    assert ids(read_table(spark, root, "kept", "t", version=4)) == list(range(7))


def test_a_job_that_dies_leaves_the_old_version(spark, root):
    publish(spark.range(3), root, "kept", "t", "")
    dying = spark.range(1000, numPartitions=4).select(F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("x")).cast("long")).alias("id"))
    with pytest.raises(PySparkException):
        publish(dying, root, "kept", "t", "")
    assert ids(read_table(spark, root, "kept", "t")) == [0, 1, 2]
    assert ids(publish(spark.range(4), root, "kept", "t", "")) == list(range(4))
    assert len([d for d in os.listdir(f"{root}/kept/t") if d.startswith("_version")]) == 2


def test_a_driver_that_dies_before_the_manifest_leaves_the_old_version(spark, root, monkeypatch):
    publish(spark.range(3), root, "kept", "t", "")

    def die(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(tables, "write_once", die)
        publish(spark.range(7), root, "kept", "t", "")
    assert ids(read_table(spark, root, "kept", "t")) == [0, 1, 2]
    assert len(os.listdir(f"{root}/kept/t")) == 3
    publish(spark.range(4), root, "kept", "t", "")
    assert ids(read_table(spark, root, "kept", "t")) == [0, 1, 2, 3]
    assert len([d for d in os.listdir(f"{root}/kept/t") if d.startswith("_version")]) == 2


def test_of_two_publishers_one_fails(spark, root, monkeypatch):
    publish(spark.range(1), root, "kept", "t", "")
    late, seen = spark.range(2), tables._versions(spark, f"{root}/kept/t")
    publish(spark.range(3), root, "kept", "t", "")
    monkeypatch.setattr(tables, "_versions", lambda *a: seen)
    with pytest.raises(AlreadyWritten):
        publish(late, root, "kept", "t", "")
    monkeypatch.undo()
    assert ids(read_table(spark, root, "kept", "t")) == [0, 1, 2]
    with pytest.raises(AlreadyWritten):
        write_once(spark, f"{root}/kept/t/_manifests/{1:020d}.json", "")
    assert not [n for n in list_names(spark, f"{root}/kept/t/_manifests") if n.endswith(".tmp")]


def test_two_roots_have_entries_of_their_own(spark, root):
    other = tempfile.mkdtemp(prefix="tables-")
    publish(spark.range(1), root, "mart", "t", "one")
    publish(spark.range(2), other, "mart", "t", "two")
    publish(spark.range(3), root, "mart", "t", "one")
    assert spark.table("mart.t").count() == 3 and catalog_name(spark, root, "mart", "t") == "mart.t"
    assert spark.table(catalog_name(spark, other, "mart", "t")).count() == 2 and ids(read_table(spark, other, "mart", "t")) == [0, 1]


def test_parts_are_replaced_and_others_keep_their_files(spark, root):
    by_three = lambda n, step=1: spark.range(0, n, step).withColumn("_part", F.col("id") % 3)
    publish(by_three(9), root, "kept", "t", "", "_part")
    before = manifest(spark, root, "kept", "t").folders
    table = replace_parts(by_three(30, 3), root, "kept", "t", "", "_part", {"seen": "1"})
    after = manifest(spark, root, "kept", "t")
    assert ids(table) == sorted([*range(0, 30, 3), 1, 4, 7, 2, 5, 8]) and after.properties == {"seen": "1"}
    assert {p: after.folders[p] == before[p] for p in before} == {"0": False, "1": True, "2": True}
    assert ids(read_table(spark, root, "kept", "t", parts=["1", "5"])) == [1, 4, 7]
    assert spark.table(catalog_name(spark, root, "kept", "t")).count() == 16
    replace_parts(by_three(9).where("id > 90"), root, "kept", "t", "", "_part", emptied=["2"])
    assert ids(read_table(spark, root, "kept", "t")) == sorted([*range(0, 30, 3), 1, 4, 7])
    assert set(folders(root)) == set(after.folders.values())  # what only the first version had is gone
    replace_parts(by_three(1), root, "kept", "t", "", "_part", emptied=["0", "1"])
    assert ids(read_table(spark, root, "kept", "t")) == [0]
    with pytest.raises(ValueError):
        replace_parts(spark.range(1), root, "kept", "t", "", "id")


def test_parts_with_new_columns_and_odd_values(spark, root):
    rows = [(1, "a/b=c"), (2, "")]
    replace_parts(spark.createDataFrame(rows, "id long, p string"), root, "kept", "t", "", "p")
    wide = spark.createDataFrame([(3, "x", "new")], "id long, p string, extra string")
    table = replace_parts(wide, root, "kept", "t", "", "p")
    assert sorted(map(tuple, table.collect()))[2] == (3, "x", "new") and table.columns == ["id", "p", "extra"]
    assert ids(table.where("extra is null")) == [1, 2] and ids(table.where("p = 'a/b=c'")) == [1]
    with pytest.raises(ValueError):
        replace_parts(wide.withColumn("extra", F.lit(1)), root, "kept", "t", "", "p")


def test_an_empty_table(spark, root):
    assert publish(spark.range(0), root, "kept", "t", "").count() == 0
    empty = replace_parts(spark.range(0).withColumn("_part", F.lit(1)), root, "kept", "u", "", "_part")
    assert empty.count() == 0 and empty.columns == ["id", "_part"]
