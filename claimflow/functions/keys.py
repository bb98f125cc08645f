"""Surrogate keys: hashed from the natural key, or dense in natural-key order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.schemas import UNKNOWN_KEY
from claimflow.session import freeze

HASH_DIGITS = 15  # hex digits of md5 kept: 60 bits, always a positive bigint


def hash_key(*cols: Column | str) -> Column:
    """Bigint that depends on the natural key alone, so a rebuild gives the same key. NULL stays NULL."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    text = parts[0] if len(parts) == 1 else F.concat(*[p for c in parts for p in (c, F.lit("\x1f"))])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_DIGITS), 16, 10).cast("bigint")


def keyed_dimension(dim: DataFrame, key: str, out: str) -> DataFrame:
    """Add a unique hash key to a frame with one row per natural key; the NULL row gets -1.

    60 bits do not rule out that two of several billion keys share a hash. Keys that share one are
    ranked: the least keeps the hash, the others add their rank in the bits above it (room for seven).
    """
    shared = Window.partitionBy("_hash").orderBy(F.col(key).asc_nulls_first())
    hashed = dim.withColumn("_hash", F.coalesce(hash_key(key), F.lit(UNKNOWN_KEY).cast("bigint")))
    rank = (F.row_number().over(shared) - 1).cast("bigint")
    return hashed.select(*dim.columns, (F.col("_hash") + rank * F.lit(16**HASH_DIGITS)).alias(out))


def with_new_keys(dim: DataFrame, key: str, sk: str) -> DataFrame:
    """Fill in the keys that are NULL, next to keys given before, which stay.

    The frame must hold all rows that share a hash. As in `keyed_dimension`, a hash that is taken is passed on with the
    next rank; the rows before have the ranks from 0 on.
    """
    same_hash = Window.partitionBy("_hash")
    order = same_hash.orderBy(F.col(sk).isNull(), F.col(key).asc_nulls_first())
    hashed = dim.withColumn("_hash", F.coalesce(hash_key(key), F.lit(UNKNOWN_KEY).cast("bigint")))
    rank = (F.row_number().over(order) - 1).cast("bigint")
    new = F.col("_hash") + rank * F.lit(16**HASH_DIGITS)
    return hashed.withColumn(sk, F.coalesce(F.col(sk), new)).select(*dim.columns)


def ranked_keys(dim: DataFrame, key: str, sk: str) -> DataFrame:
    """(natural key, key) of the dimension rows whose key is not the plain hash; normally none."""
    return dim.where(F.col(key).isNotNull() & (F.col(sk) != hash_key(key))).select(key, sk)


def with_dense_key(df: DataFrame, order_cols: list[str], out: str) -> DataFrame:
    """Number the rows 1..n in key order without ever sorting them in one task.

    Rows are range-partitioned and sorted, then written once, which fixes the ranges. A row's number
    is its place in its range plus the sizes of the earlier ranges; only those sizes (one per
    partition) reach the driver. `order_cols` must identify a row.
    """
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_place"))
    )
    fixed = freeze(placed, "dense-key")
    sizes = fixed.groupBy("_range").agg(F.min("_place").alias("first"), F.count(F.lit(1)).alias("n")).collect()
    offsets, total = [], 0
    for r in sorted(sizes, key=lambda r: r["_range"]):
        offsets.append((r["_range"], total - r["first"]))
        total += r["n"]
    table = df.sparkSession.createDataFrame(offsets, "_range int, _shift bigint")
    return fixed.join(F.broadcast(table), "_range").select(
        *df.columns, (F.col("_place") + F.col("_shift") + 1).alias(out)
    )
