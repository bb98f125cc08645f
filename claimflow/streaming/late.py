"""Bounded deduplication of a stream that keeps its late rows.

Spark's own bounded deduplication drops rows behind the watermark without a trace. Here the keys seen within the delay
are a stored table, and each micro-batch is split into first rows, repeats and late rows: the first and the late rows
are written, all three are counted. Use it where a feed's lateness must be accounted for; per batch it rewrites the keys
of the last `delay`.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimflow.operators.dedup import dedup_first, source_order
from claimflow.session import freeze
from claimflow.sources.csv_files import load_schema, save_schema
from claimflow.sources.files import list_names
from claimflow.sources.tables import manifest, publish, read_table
from claimflow.streaming.gate import METRICS, SCHEMA, has_rows
from claimflow.streaming.sinks import run_available_now

OUTCOMES = ("first", "late")
COUNTS = "batch_id long, rows_in long, first long, repeated long, late long"


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(f"`{ts}`"))


def dedup_with_late_rows(
    sdf: DataFrame, keys: list[str], ts: str, delay: dt.timedelta, out: str, ckpt: str
) -> StreamingQuery:
    """Write `<out>/batch_id=<n>/outcome=<first|late>`, one first row per key among rows whose times lie within `delay`.

    The watermark of a batch is the greatest time of all batches before less `delay`. Rows before it, and rows without
    a time, are late; they are stored with the batch's watermark in `_watermark`. Of a batch's rows of one key the
    earliest is first (of equal ones the least by all columns); NULL is a key too. A key is forgotten when the watermark
    has passed its first row by `delay`.

    The keys, the watermark and the number of the last batch are replaced in one step after a batch is written. So a
    batch that is tried again overwrites its own folder from the same keys, or was finished and is passed over.
    """
    root, layer, name = out.rstrip("/"), "_keys", "seen"
    step = int(delay / dt.timedelta(microseconds=1))
    spark = sdf.sparkSession
    marked = sdf.withColumn("_watermark", F.lit(None).cast("timestamp"))
    save_schema(spark, marked.withColumn("outcome", F.lit("")).schema, f"{out}/{SCHEMA}")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        found = manifest(spark, root, layer, name)
        state = found.properties if found else {"batch": "-1", "greatest": ""}
        if int(state["batch"]) >= batch_id:
            return
        greatest = int(state["greatest"]) if state["greatest"] else None
        mark = F.lit(None if greatest is None else greatest - step).cast("bigint")
        behind = F.col(f"`{ts}`").isNull() | F.coalesce(_micros(ts) < mark, F.lit(False))
        seen_in, written = Observation(f"in-{batch_id}"), Observation(f"out-{batch_id}")
        rows = batch.withColumn("_watermark", F.timestamp_micros(mark)).withColumn("_late", behind)
        rows = rows.observe(seen_in, F.count(F.lit(1)).alias("rows"), F.count_if("_late").alias("late"), F.max(_micros(ts)).alias("greatest"))
        rows = freeze(rows, "batch")
        on_time = rows.where("NOT _late")
        first = dedup_first(on_time, keys, [F.col(f"`{ts}`"), *source_order(batch, [*keys, ts])])
        known = None
        if found:
            known = read_table(spark, root, layer, name).where(F.col("_until") >= mark)
            same = reduce(Column.__and__, [F.col(f"`{k}`").eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
            first = first.join(known, same, "left_anti")
        first = first.withColumn("outcome", F.lit("first")).observe(written, F.count(F.lit(1)).alias("first"))
        both = first.unionByName(rows.where("_late").withColumn("outcome", F.lit("late"))).drop("_late")
        folder = f"{root}/batch_id={batch_id}"
        both.write.mode("overwrite").partitionBy("outcome").parquet(folder)
        rows_in, late, n_first = seen_in.get["rows"], seen_in.get["late"], written.get["first"]
        counts = spark.createDataFrame([(batch_id, rows_in, n_first, rows_in - late - n_first, late)], COUNTS)
        counts.coalesce(1).write.mode("overwrite").parquet(f"{root}/{METRICS}/batch_id={batch_id}")
        stored = spark.read.schema(batch.schema).parquet(f"{folder}/outcome=first") if n_first else rows.limit(0)
        keys_now = stored.select(*[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)], (_micros(ts) + step).alias("_until"))
        greatest = max((g for g in (greatest, seen_in.get["greatest"]) if g is not None), default=None)
        properties = {"batch": str(batch_id), "greatest": "" if greatest is None else str(greatest)}
        publish(known.unionByName(keys_now) if known is not None else keys_now, root, layer, name, "Keys seen", properties=properties)

    return run_available_now(sdf.writeStream.foreachBatch(write).option("checkpointLocation", ckpt))


def read_outcome(spark: SparkSession, out: str, outcome: str) -> DataFrame:
    """The first or the late rows of all batches, late ones with the watermark they were behind."""
    schema = load_schema(spark, f"{out}/{SCHEMA}")
    if schema is None:
        raise FileNotFoundError(f"no stream has written to {out}")
    if has_rows(spark, out):
        df = spark.read.schema(schema).option("basePath", out).parquet(out).where(f"outcome = '{outcome}'")
    else:
        df = spark.createDataFrame([], schema)
    left_out = {"outcome"} if outcome == "late" else {"outcome", "_watermark"}
    return df.select(*[f"`{f.name}`" for f in schema if f.name not in left_out])


def read_counts(spark: SparkSession, out: str) -> DataFrame:
    """(batch_id, rows_in, first, repeated, late) per batch."""
    if not list_names(spark, f"{out}/{METRICS}"):
        return spark.createDataFrame([], COUNTS)
    stored = spark.read.schema(COUNTS).parquet(f"{out}/{METRICS}")
    return stored.select("batch_id", "rows_in", "first", "repeated", "late")
