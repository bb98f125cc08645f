"""CSV landing folders: batch reads, the stored schema, header checks, reconciliation."""

from __future__ import annotations

import csv
import datetime as dt
import json
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.schemas import all_strings
from claimflow.session import freeze

SOURCE_FILE = "_source_file"
PATTERN_CHARACTERS = r"[\[\]{}*?]"
WHOLE_FILE = str(1 << 40)


class HeaderMismatch(ValueError):
    """A file's header is not the stored columns, or those followed by new ones."""


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Header CSV files. Without a schema the types are inferred, which costs a further pass."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def require_files(spark: SparkSession, src: str) -> None:
    """Raise unless the folder holds at least one file with content, and names Spark can stream.

    Spark's file stream takes a file name for a pattern if it can, and then reads the other files of
    the micro-batch twice; such names are refused.
    """
    try:
        files = spark.read.format("binaryFile").load(src).select("path", "length")
        found = files.agg(
            F.count_if(F.col("length") > 0).alias("filled"),
            F.min(F.when(F.col("path").rlike(PATTERN_CHARACTERS), F.col("path"))).alias("pattern"),
        ).first()
    except AnalysisException as e:
        raise FileNotFoundError(f"no such landing folder: {src}") from e
    if not found["filled"]:
        raise FileNotFoundError(f"landing folder is empty: {src}")
    if found["pattern"]:
        raise ValueError(f"rename this file, its name reads as a pattern: {found['pattern']}")


def _first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            line, path = (batch.column(i)[0].as_py() for i in (0, 1))
            names = next(csv.reader([line.lstrip("﻿")]), [])
            yield pa.RecordBatch.from_arrays(
                [pa.array([names], pa.list_(pa.string())), pa.array([path], pa.string())], names=["names", "file"]
            )
            return


def file_headers(spark: SparkSession, src: str, since: dt.datetime | None = None) -> DataFrame:
    """(names, file, files): each distinct header of the folder, one example file, how many have it.

    `since` (in UTC) leaves out files last changed before it.

    One task per file, which stops after its first line, so the files are not read through. The
    settings for that live in a session of their own.
    """
    one_by_one = spark.newSession()
    one_by_one.conf.set("spark.sql.files.maxPartitionBytes", WHOLE_FILE)
    one_by_one.conf.set("spark.sql.files.openCostInBytes", WHOLE_FILE)
    one_by_one.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    reader = one_by_one.read
    if since is not None:
        reader = reader.option("modifiedAfter", since.strftime("%Y-%m-%dT%H:%M:%S")).option("timeZone", "UTC")
    lines = reader.text(src).select("value", F.col("_metadata.file_path").alias("file"))
    headers = lines.mapInArrow(_first_line, "names array<string>, file string")
    return headers.groupBy("names").agg(F.min("file").alias("file"), F.count(F.lit(1)).alias("files"))


def _lower(names: list[str]) -> list[str]:
    return [n.lower() for n in names]


def _is_start_of(names: Column, whole: list[str]) -> Column:
    """Whether a header is the first of the given columns. Case does not matter, as for Spark's own check."""
    return F.transform(names, F.lower) == F.slice(F.array(*[F.lit(c) for c in _lower(whole)]), 1, F.size(names))


def widen_schema(stored: T.StructType, incoming: T.StructType) -> T.StructType:
    """The stored columns followed by those of the incoming schema that come after them."""
    old, new = _lower(stored.fieldNames()), _lower(incoming.fieldNames())
    if new[: len(old)] != old:
        raise HeaderMismatch(f"columns {incoming.fieldNames()} do not continue the stored {stored.fieldNames()}")
    return T.StructType(stored.fields + incoming.fields[len(old):])


def save_schema(spark: SparkSession, schema: T.StructType, schema_dir: str) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(schema_dir)


def load_schema(spark: SparkSession, schema_dir: str) -> T.StructType | None:
    try:
        row = spark.read.text(schema_dir, wholetext=True).first()
    except AnalysisException:
        return None
    return T.StructType.fromJson(json.loads(row["value"])) if row else None


def load_or_infer_schema(spark: SparkSession, src: str, schema_dir: str, sampling: float = 1.0) -> T.StructType:
    """The stored schema; on the first run inferred from the folder and stored."""
    schema = load_schema(spark, schema_dir)
    if schema is None:
        reader = spark.read.option("header", True).option("inferSchema", True).option("samplingRatio", sampling)
        schema = reader.csv(src).schema
        save_schema(spark, schema, schema_dir)
    return schema


def check_headers(headers: DataFrame, schema: T.StructType) -> None:
    """Raise for a header that is not the schema's columns or the first of them."""
    wrong = headers.where(~_is_start_of(F.col("names"), schema.fieldNames())).first()
    if wrong is not None:
        raise HeaderMismatch(f"{wrong['file']}: {wrong['names']} does not match {schema.fieldNames()}")


def sync_schema(spark: SparkSession, src: str, schema_dir: str) -> T.StructType:
    """Check every header of the folder against the stored schema and widen that where needed.

    Spark assigns CSV columns by position, so a file with columns in another order would load with
    swapped values; it is refused. New columns are accepted at the end.
    """
    stored = load_or_infer_schema(spark, src, schema_dir)
    headers = freeze(file_headers(spark, src), "headers")
    widest = headers.orderBy(F.desc(F.size("names"))).first()
    schema = stored
    if widest is not None and len(widest["names"]) > len(stored):
        schema = widen_schema(stored, read_csv(spark, unquote(widest["file"])).schema)
    check_headers(headers, schema)
    if schema != stored:
        save_schema(spark, schema, schema_dir)
    return schema


def schema_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """(ordinal, column_name, data_type) of a schema."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(schema.fields, 1)]
    return spark.createDataFrame(rows, "ordinal int, column_name string, data_type string")


def reconcile(spark: SparkSession, src: str, bronze: DataFrame) -> DataFrame:
    """(file, landed, loaded, difference) per file of the landing folder or the bronze table."""
    require_files(spark, src)
    names = spark.read.option("header", True).csv(src).columns
    landed = spark.read.option("header", True).schema(all_strings(names)).csv(src)
    landed = landed.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("landed"))
    loaded = bronze.groupBy(F.col(SOURCE_FILE).alias("file")).agg(F.count(F.lit(1)).alias("loaded"))
    both = landed.join(loaded, "file", "full").na.fill(0, ["landed", "loaded"])
    return both.withColumn("difference", F.col("landed") - F.col("loaded"))
