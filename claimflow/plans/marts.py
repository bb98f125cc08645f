"""Reports on the star. The fact is reduced per key before it meets a dimension.

That keeps the join to one row per key, whatever the share of a single policy, agent or day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.operators.quality import LATE_AFTER_DAYS

MONEY = "decimal(28,2)"
UNMATCHED = "UNMATCHED"


def _per_key(fact: DataFrame, key: str, dim: DataFrame, dim_key: str, attributes: list[str], **sums: Column) -> DataFrame:
    """Aggregate the fact by a key, then add attributes of the dimension (NULL where none matches)."""
    small = fact.groupBy(key).agg(*[c.alias(n) for n, c in sums.items()])
    lookup = dim.select(F.col(dim_key).alias("_dim_key"), *attributes)
    return small.join(lookup, F.col(key) == F.col("_dim_key"), "left").drop("_dim_key")


def _n() -> Column:
    return F.count(F.lit(1))


def _money(col: Column | str) -> Column:
    return F.sum(col).cast(MONEY)


def _ratio(top: Column | str, bottom: Column | str, digits: int = 6) -> Column:
    top, bottom = (F.col(c) if isinstance(c, str) else c for c in (top, bottom))
    return F.round(F.try_divide(top.cast("double"), bottom.cast("double")), digits)


def claims_by_policy_type(fact: DataFrame, dim_policy: DataFrame) -> DataFrame:
    by_policy = _per_key(
        fact, "policy_sk", dim_policy, "policy_sk", ["insurance_type"], n=_n(), amount=F.sum("claim_amount"),
        priced=F.count("claim_amount"),
    )
    totals = by_policy.groupBy("insurance_type").agg(
        F.sum("n").alias("claim_count"), _money("amount").alias("total_claim_amount"), F.sum("priced").alias("priced")
    )
    return totals.withColumn("avg_claim_amount", _ratio("total_claim_amount", "priced", 4)).drop("priced")


def loss_ratio_by_policy_type(fact: DataFrame, dim_policy: DataFrame) -> DataFrame:
    """Claims over premiums, with the premium of every claim row counted."""
    by_policy = _per_key(
        fact, "policy_sk", dim_policy, "policy_sk", ["insurance_type"],
        amount=F.sum("claim_amount"), premium=F.sum("premium_amount"),
    )
    return _loss_ratio(by_policy)


def loss_ratio_policy_level(fact: DataFrame, dim_policy: DataFrame) -> DataFrame:
    """Claims over premiums, with each policy's premium counted once."""
    by_policy = _per_key(
        fact, "policy_sk", dim_policy, "policy_sk", ["insurance_type"],
        amount=F.sum("claim_amount"), premium=F.max("premium_amount"),
    )
    return _loss_ratio(by_policy)


def _loss_ratio(by_policy: DataFrame) -> DataFrame:
    totals = by_policy.groupBy("insurance_type").agg(
        _money("amount").alias("total_claim_amount"), _money("premium").alias("total_premium_amount")
    )
    return totals.withColumn("loss_ratio", _ratio("total_claim_amount", "total_premium_amount"))


def agent_claim_volume(fact: DataFrame, dim_agent: DataFrame) -> DataFrame:
    """Claims of every agent; claims without a known agent form one group."""
    by_agent = _per_key(
        fact, "agent_sk", dim_agent, "agent_sk", ["agent_id", "agent_name"], n=_n(), amount=F.sum("claim_amount")
    )
    return by_agent.groupBy(F.coalesce("agent_id", F.lit(UNMATCHED)).alias("agent_id"), "agent_name").agg(
        F.sum("n").alias("claim_count"), _money("amount").alias("total_claim_amount")
    )


def claims_by_loss_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Claims per month of loss; losses outside the calendar form the NULL month."""
    by_day = _per_key(
        fact, "loss_date_sk", dim_date, "date_sk", ["year", "quarter", "month"], n=_n(), amount=F.sum("claim_amount")
    )
    return by_day.groupBy("year", "quarter", "month").agg(
        F.sum("n").alias("claim_count"), _money("amount").alias("total_claim_amount")
    )


def reporting_lag_summary(fact: DataFrame, dim_policy: DataFrame, late_after: int = LATE_AFTER_DAYS) -> DataFrame:
    lag = F.col("reporting_lag_days")
    by_policy = _per_key(
        fact, "policy_sk", dim_policy, "policy_sk", ["insurance_type"],
        n=_n(), known=F.count(lag), low=F.min(lag), high=F.max(lag), days=F.sum(lag), late=F.count_if(lag > late_after),
    )
    totals = by_policy.groupBy("insurance_type").agg(
        F.sum("n").alias("claim_count"), F.min("low").alias("min_lag_days"), F.max("high").alias("max_lag_days"),
        F.sum("days").alias("days"), F.sum("known").alias("known"), F.sum("late").alias("late"),
    )
    return totals.select(
        "insurance_type", "claim_count", "min_lag_days", "max_lag_days",
        _ratio("days", "known").alias("mean_lag_days"), _ratio("late", "claim_count").alias("late_share"),
    )


def odd_hour_claims(fact: DataFrame) -> DataFrame:
    return fact.groupBy("incident_hour_of_day", "incident_severity").agg(
        _n().alias("claim_count"), _money("claim_amount").alias("total_claim_amount")
    )


def weekend_vs_weekday_claims(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Claims by whether the transaction day is a weekend; NULL for days outside the calendar."""
    by_day = _per_key(
        fact, "txn_date_sk", dim_date, "date_sk", ["is_weekend"], n=_n(), amount=F.sum("claim_amount")
    )
    return by_day.groupBy("is_weekend").agg(
        F.sum("n").alias("claim_count"), _money("amount").alias("total_claim_amount")
    )
