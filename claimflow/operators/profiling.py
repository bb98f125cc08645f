"""Profiling of raw tables. Each operator is one pass with partial aggregation before any shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.operators.project import having


def _rows(entries: list) -> "F.Column":
    return F.inline(F.array(*entries))


def row_counts(**tables: DataFrame) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, null_count) for every column, from one pass over the table."""
    missing = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return missing.unpivot([], df.columns, "column_name", "null_count")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def value_distribution(df: DataFrame, col: str, order=None, limit: int | None = None) -> DataFrame:
    """Rows per value; with `order` and `limit` the first values only (a top-k, never a full sort)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("row_count"))
    if order is not None:
        counts = counts.orderBy(order)
    return counts if limit is None else counts.limit(limit)


def distinct_rows_count(df: DataFrame, col: str) -> DataFrame:
    """Number of distinct values, NULL counted as one of them."""
    return distinct_values(df, col).agg(F.count(F.lit(1)).alias("distinct_count"))


def null_profile_by_key(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Per key and column: how many values are present and absent, where several or any absent."""
    counts = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(f"_present_{c}") for c in cols]
    )
    long = counts.select(key, _rows([
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"_present_{c}").alias("non_null_count"),
            (F.col("_rows") - F.col(f"_present_{c}")).alias("null_count"),
        )
        for c in cols
    ]))
    return having(long, "non_null_count > 1 or null_count > 0")


def group_counts(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Number of key groups for each of the columns; grouping does not depend on the column."""
    groups = distinct_rows_count(df, key)
    names = F.explode(F.array(*[F.lit(c) for c in cols])).alias("column_name")
    return groups.select(names, F.col("distinct_count").alias("group_count"))


def inconsistent_keys(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """(key, column_name) where a key carries more than one distinct value of the column; NULL is a key too.

    Least and greatest value differ exactly then, which needs no distinct aggregate per column.
    """
    ends = df.groupBy(key).agg(
        *[f(F.col(c)).alias(f"_{f.__name__}_{c}") for c in cols for f in (F.min, F.max)]
    )
    long = ends.select(key, _rows([
        F.struct(F.lit(c).alias("column_name"), (F.col(f"_min_{c}") != F.col(f"_max_{c}")).alias("_differs"))
        for c in cols
    ]))
    return long.where("_differs").select(key, "column_name")


def distinct_vs_total(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count_distinct(F.col(col)).alias("distinct_policies"), F.count(F.lit(1)).alias("total_claims"))


def preview(df: DataFrame, order_cols: list[str], n: int = 5) -> DataFrame:
    """The first rows in a stated order (a top-k per partition, merged)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order_cols]).limit(n)
