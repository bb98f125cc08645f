"""Row-wise operators on claims: renaming, typing and derived columns. All of them are narrow."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.schemas import CLAIM_TYPES, STATUS_NAMES, UNKNOWN_STATUS


def rename_select(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep the mapping's columns, in its order, under its new names."""
    return df.select([F.col(f"`{old}`").alias(new) for old, new in mapping.items()])


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*["_".join(name.lower().split(" ")) for name in df.columns])


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns in place. A value that does not parse becomes NULL."""
    by_name = {name.lower(): kind for name, kind in types.items()}
    return df.select([
        F.col(f"`{c}`").try_cast(by_name[c.lower()]).alias(c) if c.lower() in by_name else F.col(f"`{c}`")
        for c in df.columns
    ])


def days_between(later: str, earlier: str) -> Column:
    """Whole days from `earlier` to `later`; text that is no date counts as NULL."""
    return F.datediff(F.col(later).try_cast("date"), F.col(earlier).try_cast("date"))


def with_reporting_lag(df: DataFrame) -> DataFrame:
    return df.withColumn("reporting_lag_days", days_between("REPORT_DT", "LOSS_DT"))


def with_policy_to_loss(df: DataFrame) -> DataFrame:
    return df.withColumn("policy_to_loss_days", days_between("LOSS_DT", "POLICY_EFF_DT"))


def decode_claim_status(col: Column) -> Column:
    """Status code to its name; any other code, and NULL, is Unknown."""
    return reduce(
        lambda named, code: F.when(col == code, STATUS_NAMES[code]).otherwise(named),
        reversed(STATUS_NAMES),
        F.lit(UNKNOWN_STATUS),
    )


def cast_claims(df: DataFrame) -> DataFrame:
    """Raw claims (batch or stream) to typed claims with lower-case names."""
    return snake_case_columns(cast_columns(df, CLAIM_TYPES))


def with_derived(typed: DataFrame) -> DataFrame:
    """Typed claims with the derived columns."""
    return typed.withColumns({
        "reporting_lag_days": days_between("report_dt", "loss_dt"),
        "policy_to_loss_days": days_between("loss_dt", "policy_eff_dt"),
        "claim_status_desc": decode_claim_status(F.col("claim_status")),
    })


def type_claims(df: DataFrame) -> DataFrame:
    """Raw claims (batch or stream) to typed claims with lower-case names and the derived columns."""
    return with_derived(cast_claims(df))


def null_indicator(col: Column) -> Column:
    return col.isNull().cast("int")


def having(df: DataFrame, expr: str) -> DataFrame:
    """Keep the aggregated rows for which a SQL predicate holds."""
    return df.where(F.expr(expr))
