"""Reconciliation of landed and loaded rows that reads each file once.

The ledger is a stored table with a row per landed file, known by its path, length and time of change, and a row per
bronze file whose rows have been counted. A run counts the landed files that are not settled and the bronze files that
are new. What is settled, as many rows loaded as landed, is not read again. A file that changes after it was loaded
comes up as a landed file without loaded rows, and rows that are loaded twice open their file again.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimflow.operators.dedup import dedup_first
from claimflow.schemas import all_strings
from claimflow.session import freeze
from claimflow.sources.csv_files import SOURCE_FILE
from claimflow.sources.files import list_names
from claimflow.sources.tables import manifest, read_table, replace_parts

ROWS = "kind string, file string, length long, changed timestamp, landed long, loaded long, _run string"
KEY = ["kind", "file", "length", "changed"]
OPEN = "open"  # the part of files whose counts differ; files settled by a run are in a part of its number


def _listing(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """The files of a folder, without their content; of a stream's table the files it has finished."""
    if not list_names(spark, folder):
        return spark.createDataFrame([], "kind string, file string, length long, changed timestamp")
    meta = {"file": "file_path", "length": "file_size", "changed": "file_modification_time"}
    files = spark.read.format("binaryFile").load(folder)
    return files.select(F.lit(kind).alias("kind"), *[F.col(f"_metadata.{m}").alias(c) for c, m in meta.items()])


def _paths(files: DataFrame) -> list[str]:
    """Paths as the readers take them. The driver plans a read from a list of files, here of the new ones only."""
    return [unquote(r["file"]) for r in files.select("file").distinct().collect()]


def _counted(rows: DataFrame, file, name: str) -> DataFrame:
    return rows.groupBy(file.alias("file")).agg(F.count(F.lit(1)).alias(name))


def read_ledger(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """(file, length, changed, landed, loaded, difference) of every version of a landed file that was counted."""
    files = _current(_stored(spark, root, feed)).where("kind = 'landed'")
    return files.select("file", "length", "changed", "landed", "loaded", (F.col("landed") - F.col("loaded")).alias("difference"))


def _stored(spark: SparkSession, root: str, feed: str) -> DataFrame:
    if manifest(spark, root, "ledger", feed) is None:
        return spark.createDataFrame([], ROWS)
    return read_table(spark, root, "ledger", feed)


def _current(rows: DataFrame) -> DataFrame:
    """One row per file version: the open one, else the one of the last run."""
    run = F.col("_run").try_cast("long")
    return dedup_first(rows, KEY, [(F.col("_run") != OPEN).asc(), run.desc_nulls_last()])


def settle(spark: SparkSession, src: str, bronze: str, root: str, feed: str) -> DataFrame:
    """Count what is new in a landing folder and its bronze table, note it in the ledger, and return this run's files.

    Columns as of `read_ledger`. The counts and the list of counted bronze files are noted in one step.
    """
    found = manifest(spark, root, "ledger", feed)
    run = str(found.version + 1 if found else 1)
    known = freeze(_current(_stored(spark, root, feed)), "ledger")
    settled = known.where("kind = 'landed' AND landed = loaded")
    landing = freeze(_listing(spark, src, "landed").join(settled, KEY, "left_anti"), "landing")
    counted_before = known.where("kind = 'landed' AND landed IS NOT NULL").select(*KEY)
    fresh = _paths(landing.join(counted_before, KEY, "left_anti"))
    new_bronze = freeze(_listing(spark, bronze, "bronze").join(known.where("kind = 'bronze'"), "file", "left_anti"), "bronze")
    bronze_paths = _paths(new_bronze)
    nothing = spark.createDataFrame([], "file string, n long")
    landed, loaded = nothing.withColumnRenamed("n", "landed_now"), nothing.withColumnRenamed("n", "loaded_now")
    if fresh:
        names = spark.read.option("header", True).csv(fresh[0]).columns
        rows = spark.read.option("header", True).schema(all_strings(names)).csv(fresh)
        landed = _counted(rows, F.col("_metadata.file_path"), "landed_now")
    if bronze_paths:
        schema = all_strings([SOURCE_FILE])
        loaded = _counted(spark.read.schema(schema).parquet(*bronze_paths), F.col(SOURCE_FILE), "loaded_now")
    loaded = freeze(loaded, "loaded")
    # Files that are here and not settled, those open before, and settled ones that rows were loaded from once more.
    again = settled.join(loaded, "file", "left_semi").select(*KEY)
    candidates = landing.select(*KEY).unionByName(known.where(F.col("_run") == OPEN).select(*KEY)).unionByName(again).distinct()
    # Rows are loaded from the version of a file that is there now.
    newest = F.max("changed").over(Window.partitionBy("file"))
    before = known.select(*KEY, "landed", "loaded")
    counted = candidates.withColumn("_newest", newest == F.col("changed")).join(before, KEY, "left")
    counted = counted.join(landed, "file", "left").join(loaded, "file", "left").select(
        *KEY,
        F.coalesce("landed", "landed_now", F.lit(0)).alias("landed"),
        (F.coalesce("loaded", F.lit(0)) + F.when(F.col("_newest"), F.coalesce("loaded_now", F.lit(0))).otherwise(0)).alias("loaded"),
    )
    counted = freeze(counted.withColumn("_run", F.when(F.col("landed") == F.col("loaded"), run).otherwise(OPEN)), "counted")
    seen = new_bronze.select(*KEY, F.lit(0).cast("long").alias("landed"), F.lit(0).cast("long").alias("loaded"), F.lit(run).alias("_run"))
    replace_parts(
        counted.unionByName(seen), root, "ledger", feed, "Rows landed and loaded per file", "_run", emptied=[OPEN]
    )
    return counted.select(*KEY[1:], "landed", "loaded", (F.col("landed") - F.col("loaded")).alias("difference"))
