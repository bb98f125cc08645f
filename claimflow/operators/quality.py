"""Declared quality rules: a violating row is quarantined, dropped or only flagged."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LATE_AFTER_DAYS = 30


@dataclass(frozen=True)
class Rule:
    """`predicate` is true for a violating row; NULL means the row is fine."""

    name: str
    predicate: Column
    action: Literal["quarantine", "drop", "flag"]
    flag_column: str | None = None

    @property
    def violated(self) -> Column:
        return F.coalesce(self.predicate, F.lit(False))


def blank(col: str) -> Column:
    return F.col(col).isNull() | (F.trim(F.col(col)) == "")


def invalid_amount() -> Column:
    return F.col("claim_amount").isNull() | (F.col("claim_amount") <= 0)


def policy_after_loss() -> Column:
    return F.col("policy_eff_dt") > F.col("loss_dt")


def late_report(days: int = LATE_AFTER_DAYS) -> Column:
    return F.col("reporting_lag_days") > days


def claim_rules(late_after: int = LATE_AFTER_DAYS) -> list[Rule]:
    """The rules for typed claims."""
    return [
        Rule("invalid_amount", invalid_amount(), "quarantine"),
        Rule("missing_customer", blank("customer_id"), "quarantine"),
        Rule("missing_agent", blank("agent_id"), "quarantine"),
        Rule("missing_policy", blank("policy_number"), "quarantine"),
        Rule("policy_after_loss", policy_after_loss(), "drop"),
        Rule("late_report", late_report(late_after), "flag", "is_late_reported"),
    ]


def _any(rules: list[Rule], action: str) -> Column:
    return reduce(Column.__or__, [r.violated for r in rules if r.action == action], F.lit(False))


def evaluate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add `outcome` (quarantine before drop before clean), `reasons` and the flag columns."""
    return df.select(
        "*",
        F.when(_any(rules, "quarantine"), "quarantine").when(_any(rules, "drop"), "drop").otherwise("clean")
        .alias("outcome"),
        F.array_compact(F.array(*[F.when(r.violated, F.lit(r.name)) for r in rules])).alias("reasons"),
        *[r.violated.alias(r.flag_column or r.name) for r in rules if r.action == "flag"],
    )


def quarantined(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return evaluate(df, rules).where("outcome = 'quarantine'").select(*df.columns, "reasons")


def clean(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return evaluate(df, rules).where("outcome = 'clean'").drop("outcome", "reasons")


def split(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(clean rows with their flags, quarantined rows with their reasons); dropped rows are in neither."""
    return clean(df, rules), quarantined(df, rules)


def rule_counts(rules: list[Rule]) -> list[Column]:
    """Aggregates for the rows and each rule's hits."""
    return [
        F.count(F.lit(1)).alias("rows_seen"),
        *[F.count_if(r.violated).alias(r.name) for r in rules],
    ]


def rule_metrics(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per rule: rows seen, rows failed, action. One aggregate, whatever the number of rules."""
    totals = df.agg(*rule_counts(rules))
    return totals.select(F.inline(F.array(*[
        F.struct(
            F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
            F.col("rows_seen").alias("rows_seen"), F.col(r.name).alias("rows_failed"),
        )
        for r in rules
    ])))


def observe_rules(df: DataFrame, rules: list[Rule], name: str = "quality") -> DataFrame:
    """The same numbers as a side metric of whatever job or stream consumes the frame."""
    return df.observe(name, *rule_counts(rules))
