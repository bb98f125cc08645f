"""Batch deduplication with a defined survivor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.session import freeze

MOST_BITS = 1 << 28
MONEY = ("premium_amount", "claim_amount")


def dedup_first(df: DataFrame, keys: list[str], order_cols: list) -> DataFrame:
    """One row per key (NULL is a key too): the least by `order_cols`, NULLs first.

    Spark turns `row_number = 1` into a group limit that already runs before the shuffle, so each
    map task sends at most one row per key and a key with very many rows costs one row per task.
    """
    order = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_cols]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def source_order(df: DataFrame, keys: list[str]) -> list:
    """Order by all other columns as they come; amounts compare as numbers, also when read as text."""
    return [
        (F.col(f"`{c}`").try_cast("double") if c.lower() in MONEY else F.col(f"`{c}`")).asc_nulls_first()
        for c in df.columns
        if c.lower() not in {k.lower() for k in keys}
    ]


def dedup_wide(df: DataFrame, keys: list[str], order_cols: list) -> DataFrame:
    """`dedup_first` for wide rows of which most have a key of their own: only the others are sorted and sent.

    A first pass counts rows per hash of the key. The hashes that come more than once are marked in bitmaps, at most
    32 MB in all, that every task gets. Rows whose hash is not marked stay as they are; the marked ones, some by chance,
    are compared. The frame is read three times, so let it be a stored one.
    """
    of_key = F.xxhash64(*keys)
    hashes = df.select(of_key.alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    several = freeze(hashes.where("_n > 1").select("_hash"), "several")
    n = several.count()
    if not n:
        return df
    size = min(MOST_BITS, 1 << max(15, (16 * n).bit_length()))

    def place(of: Column) -> Column:
        return F.pmod(of, F.lit(size).cast("bigint")) + 1

    bitmaps = several.select(place(F.col("_hash")).alias("_place")).groupBy(
        F.bitmap_bucket_number("_place").alias("_bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
    at = F.bitmap_bit_position(place(of_key))
    byte = F.conv(F.hex(F.substr(F.col("_bits"), F.lit(1) + F.shiftright(at, 3).cast("int"), F.lit(1))), 16, 10)
    bit = F.getbit(F.coalesce(byte.cast("bigint"), F.lit(0).cast("bigint")), (at % 8).cast("int"))
    marked = df.join(F.broadcast(bitmaps), F.bitmap_bucket_number(place(of_key)) == F.col("_bucket"), "left")
    alone, rest = (marked.where(bit == flag).select(*[df[f"`{c}`"] for c in df.columns]) for flag in (0, 1))
    return alone.unionAll(dedup_first(rest, keys, order_cols))


def dedup_claims(df: DataFrame) -> DataFrame:
    """One row per transaction id: the least row by all source columns in schema order."""
    return dedup_wide(df, ["TRANSACTION_ID"], source_order(df, ["TRANSACTION_ID"]))
