"""Silver tables in batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame

from claimflow.operators.dedup import dedup_claims
from claimflow.operators.project import snake_case_columns, type_claims


def silver_employee(employee: DataFrame) -> DataFrame:
    """Distinct employee rows, types left as they come."""
    return snake_case_columns(employee.distinct())


def silver_claims(claims: DataFrame) -> DataFrame:
    """Typed claims with derived columns, one row per transaction, before any quality rule."""
    return type_claims(dedup_claims(claims))
