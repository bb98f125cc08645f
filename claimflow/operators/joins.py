"""Lookups of dimension keys. All are equi-joins on a unique dimension key.

No side is broadcast by hint: Spark broadcasts a dimension when its size is below
spark.sql.autoBroadcastJoinThreshold and otherwise shuffles, where adaptive execution splits the
partitions of hot or NULL keys (a left join against a unique key can always be split on the left).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_dimension(fact: DataFrame, dim: DataFrame, fact_key: Column, dim_key: str, sk: str) -> DataFrame:
    """Add the dimension's key to every fact row; NULL where no dimension row matches."""
    lookup = dim.select(F.col(dim_key).alias("_dim_key"), F.col(sk).alias(sk))
    return fact.join(lookup, fact_key == F.col("_dim_key"), "left").drop("_dim_key")


def join_date_role(fact: DataFrame, dim_date: DataFrame, date_expr: Column, role: str) -> DataFrame:
    """Add `<role>_date_sk` of the calendar day; NULL for days outside the calendar."""
    calendar = dim_date.select("full_date", F.col("date_sk").alias(f"{role}_date_sk"))
    return join_dimension(fact, calendar, date_expr, "full_date", f"{role}_date_sk")


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Number of fact rows whose key (NULL included) is not in the dimension.

    Fact rows are counted per key first, so the anti join moves keys and counts, not rows.
    """
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    missing = per_key.join(dim.select(key), key, "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_count"))
