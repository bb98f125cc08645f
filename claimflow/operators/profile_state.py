"""Profiles kept up to date by the new files of a table.

The state is a stored table with a row per key and profiled column: rows, values, least and greatest value. States of
different files add up, so a run reads the files that came since the last one and the states before. The files a state
covers are noted in the same table and in the same step, so no file counts twice.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.operators.project import having
from claimflow.session import freeze
from claimflow.sources.files import list_names
from claimflow.sources.tables import manifest, read_table, replace_parts

STATE = "file string, key string, column_name string, rows long, present long, least string, greatest string, _run string"
MOST_PARTS = 16  # states of more runs are merged into one


def _merged(states: DataFrame) -> DataFrame:
    return states.groupBy("key", "column_name").agg(
        F.sum("rows").alias("rows"), F.sum("present").alias("present"), F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
    )


def _state_of(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The state of some rows: one aggregate per key, then one row per column."""
    ends = [
        (F.count(F.col(c)).alias(f"_n{i}"), F.min(F.col(c)).alias(f"_a{i}"), F.max(F.col(c)).alias(f"_b{i}"))
        for i, c in enumerate(columns)
    ]
    per_key = rows.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"), *[e for three in ends for e in three])
    return per_key.select(F.col("_key").alias("key"), F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.col("_rows").alias("rows"), F.col(f"_n{i}").alias("present"),
            F.col(f"_a{i}").alias("least"), F.col(f"_b{i}").alias("greatest"),
        )
        for i, c in enumerate(columns)
    ])))


def read_state(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(key, column_name, rows, present, least, greatest) over all files seen."""
    found = manifest(spark, root, "profile", name)
    stored = read_table(spark, root, "profile", name) if found else spark.createDataFrame([], STATE)
    return _merged(stored.where("file IS NULL"))


def advance_profile(
    spark: SparkSession, table: str, schema: T.StructType, root: str, name: str, key: str, columns: list[str]
) -> DataFrame:
    """Add the parquet files of a folder that are new to the state, and return the state as `read_state` does.

    Of the new files only `key` and `columns` are read. Texts compare as they do in a full pass over the table.
    """
    found = manifest(spark, root, "profile", name)
    stored = read_table(spark, root, "profile", name) if found else spark.createDataFrame([], STATE)
    if not list_names(spark, table):
        return _merged(stored.where("file IS NULL"))
    files = spark.read.format("binaryFile").load(table).select(F.col("_metadata.file_path").alias("file"))
    new = freeze(files.join(stored.where("file IS NOT NULL"), "file", "left_anti"), "new-files")
    paths = [unquote(r["file"]) for r in new.collect()]  # a read is planned from a list of files, here of the new ones
    if paths:
        run = str(found.version + 1 if found else 1)
        wanted = T.StructType([f for f in schema if f.name in {key, *columns}])
        state = _state_of(spark.read.schema(wanted).parquet(*paths), key, columns)
        covered, merged_parts = new, []
        if found and len(found.folders) >= MOST_PARTS:
            state = _merged(state.unionByName(stored.where("file IS NULL").drop("file", "_run")))
            covered, merged_parts = new.unionByName(stored.where("file IS NOT NULL").select("file")), list(found.folders)
        rows = state.withColumn("file", F.lit(None).cast("string")).unionByName(covered, allowMissingColumns=True)
        comment = f"States of {key} for profiles of new files"
        replace_parts(rows.withColumn("_run", F.lit(run)), root, "profile", name, comment, "_run", emptied=merged_parts)
    return read_state(spark, root, name)


def null_counts_of(state: DataFrame) -> DataFrame:
    """(column_name, null_count) of the profiled columns."""
    return state.groupBy("column_name").agg(F.sum(F.col("rows") - F.col("present")).alias("null_count"))


def null_profile_of(state: DataFrame, key: str) -> DataFrame:
    """Per key and column how many values are present and absent, where several or any absent."""
    counts = state.select(
        F.col("key").alias(key), "column_name", F.col("present").alias("non_null_count"),
        (F.col("rows") - F.col("present")).alias("null_count"),
    )
    return having(counts, "non_null_count > 1 or null_count > 0")


def inconsistent_keys_of(state: DataFrame, key: str) -> DataFrame:
    """(key, column_name) where a key carries more than one distinct value of the column."""
    return state.where("least <> greatest").select(F.col("key").alias(key), "column_name")
