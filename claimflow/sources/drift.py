"""Type drift: values of landed files that do not fit the stored types, and the types they would need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.schemas import all_strings

# The types inference gives, as bits. A set of them has a least common type: numbers and times form chains, and
# whatever is in two chains is text.
KINDS = {"int": 1, "bigint": 2, "double": 4, "date": 8, "timestamp": 16, "boolean": 32, "string": 64}
CHAINS = (("int", "bigint", "double"), ("date", "timestamp"), ("boolean",))
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
DAY = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def kind_of(value: Column) -> Column:
    """The bit of the narrowest type a text fits."""
    number = value.rlike(NUMBER)
    bit = {name: F.lit(b) for name, b in KINDS.items()}
    return (
        F.when(number & value.try_cast("int").isNotNull(), bit["int"])
        .when(number & value.try_cast("bigint").isNotNull(), bit["bigint"])
        .when(number, bit["double"])
        .when(value.rlike(DAY + r"\s*$") & value.try_cast("date").isNotNull(), bit["date"])
        .when(value.rlike(DAY) & value.try_cast("timestamp").isNotNull(), bit["timestamp"])
        .when(F.lower(F.trim(value)).isin("true", "false"), bit["boolean"])
        .otherwise(bit["string"])
    )


def _bit(kind: str) -> int:
    return KINDS["double"] if kind.startswith("decimal") or kind == "float" else KINDS.get(kind, KINDS["string"])


def _fitting(kind: str) -> int:
    """The bits of all types whose texts fit a type."""
    for chain in CHAINS:
        bits = [KINDS[k] for k in chain]
        if _bit(kind) in bits:
            return sum(bits[: bits.index(_bit(kind)) + 1])
    return sum(KINDS.values())


def _fits(value: Column, kind: str) -> Column:
    """Whether `kind_of` a value that is not null is a type whose texts fit `kind`."""
    bit = _bit(kind)
    if bit in (KINDS["int"], KINDS["bigint"]):
        return value.try_cast("int" if bit == KINDS["int"] else "bigint").isNotNull()
    if bit == KINDS["double"]:
        return value.rlike(NUMBER)
    if bit == KINDS["date"]:
        return value.rlike(DAY + r"\s*$") & value.try_cast("date").isNotNull()
    if bit == KINDS["timestamp"]:
        return value.rlike(DAY) & value.try_cast("timestamp").isNotNull()
    return F.lower(F.trim(value)).isin("true", "false")


def common_type(bits: Column) -> Column:
    """The name of the least type that all types of a set of bits fit."""
    out = F.lit("string")
    for chain in CHAINS:
        for kind in reversed(chain):
            out = F.when(bits.bitwiseAND(F.lit(~_fitting(kind))) == 0, F.lit(kind)).otherwise(out)
    return out


def type_drift(spark: SparkSession, src: str, stored: T.StructType) -> DataFrame:
    """(file, column_name, stored_type, seen_type, bad_values, first_bad_value) where a file does not fit the stored types.

    seen_type is the least type for the stored one and the file's values. Empty values fit any type. One pass over the
    files; only values that do not fit leave the scan. Columns that are not stored are not looked at.
    """
    rows = spark.read.option("header", True).schema(all_strings(stored.fieldNames())).csv(src)
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    unfit = []
    for f in stored:
        kind = f.dataType.simpleString()
        if _bit(kind) != KINDS["string"]:
            value = F.col(f"`{f.name}`")
            unfit.append(F.when(value.isNotNull() & ~_fits(value, kind), F.struct(
                F.lit(f.name).alias("column_name"), F.lit(kind).alias("stored_type"), F.lit(_bit(kind)).alias("stored_bit"),
                value.alias("value"),
            )))
    if not unfit:
        return spark.createDataFrame([], "file string, column_name string, stored_type string, seen_type string, bad_values long, first_bad_value string")
    values = rows.select(F.col("_metadata.file_path").alias("file"), place.alias("place"), F.inline(F.array_compact(F.array(*unfit))))
    values = values.withColumn("kind", kind_of(F.col("value")))  # of the few that are left
    found = values.groupBy("file", "column_name", "stored_type", "stored_bit").agg(
        F.bit_or("kind").alias("kinds"), F.count(F.lit(1)).alias("bad_values"),
        F.min(F.struct("place", "value")).alias("first"),
    )
    return found.select(
        "file", "column_name", "stored_type", common_type(F.col("kinds").bitwiseOR(F.col("stored_bit"))).alias("seen_type"),
        "bad_values", F.col("first.value").alias("first_bad_value"),
    )
