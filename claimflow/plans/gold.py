"""Gold star schema: four dimensions and a fact with one row per claim."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.functions.dates import calendar_key, date_key, date_parts, date_spine, is_weekend
from claimflow.functions.keys import hash_key, keyed_dimension, ranked_keys
from claimflow.operators.dedup import dedup_first, source_order
from claimflow.operators.joins import join_date_role, join_dimension
from claimflow.operators.project import rename_select
from claimflow.schemas import (
    AGENT_RENAMES, CALENDAR_END, CALENDAR_START, CUSTOMER_ATTRIBUTES, FACT_KEYS, FACT_MEASURES, POLICY_ATTRIBUTES,
)
from claimflow.session import freeze


def calendar(days: DataFrame) -> DataFrame:
    """The eight calendar columns for a frame of days."""
    parts = date_parts(days, "full_date")
    return parts.select(
        "full_date", date_key(F.col("full_date")).alias("date_sk"),
        "year", "month", "day", "day_of_week", "quarter", is_weekend(F.col("full_date")).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    return calendar(date_spine(spark, start, end))


def dim_agent(silver_employee: DataFrame) -> DataFrame:
    """One row per agent id; of differing rows the least by all columns."""
    agents = rename_select(silver_employee, AGENT_RENAMES)
    return keyed_dimension(dedup_first(agents, ["agent_id"], source_order(agents, ["agent_id"])), "agent_id", "agent_sk")


def _claims_dimension(silver: DataFrame, attributes: list[str], sk: str) -> DataFrame:
    key = attributes[0]
    rows = dedup_first(silver.select("transaction_id", *attributes), [key], ["transaction_id"])
    return keyed_dimension(rows.select(*attributes), key, sk)


def dim_customer(silver_claims: DataFrame) -> DataFrame:
    return _claims_dimension(silver_claims, CUSTOMER_ATTRIBUTES, "customer_sk")


def dim_policy(silver_claims: DataFrame) -> DataFrame:
    return _claims_dimension(silver_claims, POLICY_ATTRIBUTES, "policy_sk")


def _fact_columns(joined: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return joined.select(
        "transaction_id", *FACT_KEYS, *[F.col(old).alias(new) for old, new in FACT_MEASURES.items()], *carry
    )


def fact_claims_lookup(
    claims: DataFrame, agents: DataFrame, customers: DataFrame, policies: DataFrame, days: DataFrame
) -> DataFrame:
    """The fact by six lookups in stored dimensions, small ones first so that few joins shuffle.

    The two large dimensions are looked up for the distinct pairs of their ids, which are reduced before they are sent;
    so the claims are shuffled once, with the pairs.
    """
    joined = join_dimension(claims, agents, F.col("agent_id"), "agent_id", "agent_sk")
    joined = join_date_role(joined, days, F.to_date("txn_date_time"), "txn")
    joined = join_date_role(joined, days, F.col("loss_dt"), "loss")
    joined = join_date_role(joined, days, F.col("report_dt"), "report")
    pairs = claims.select(F.col("customer_id").alias("_customer"), F.col("policy_number").alias("_policy")).distinct()
    pairs = join_dimension(pairs, customers, F.col("_customer"), "customer_id", "customer_sk")
    pairs = join_dimension(pairs, policies, F.col("_policy"), "policy_number", "policy_sk")
    same = F.col("customer_id").eqNullSafe(F.col("_customer")) & F.col("policy_number").eqNullSafe(F.col("_policy"))
    return _fact_columns(joined.join(pairs, same, "left").drop("_customer", "_policy"))


def _derived_key(claims: DataFrame, dim: DataFrame, key: str, sk: str) -> DataFrame:
    """The key `keyed_dimension` gave this id: its hash, unless another id has the same one."""
    ranked = ranked_keys(dim, key, sk)
    if ranked.isEmpty():
        return claims.withColumn(sk, hash_key(key))
    few = freeze(ranked, sk).select(F.col(key).alias("_id"), F.col(sk).alias("_ranked"))
    joined = claims.join(few, F.col(key) == F.col("_id"), "left")
    return joined.withColumn(sk, F.coalesce("_ranked", hash_key(key))).drop("_id", "_ranked")


def fact_claims(
    claims: DataFrame, agents: DataFrame, customers: DataFrame, policies: DataFrame,
    start: str = CALENDAR_START, end: str = CALENDAR_END, carry: Sequence[str] = (),
) -> DataFrame:
    """The same fact without shuffling the claims.

    Customers and policies are taken from the claims themselves, so each id has its dimension row and
    its key follows from the id; date keys follow from the date and the calendar's bounds. What is
    joined are the agents, of which some are missing, and the few keys that share a hash, normally none.
    Use `fact_claims_lookup` for dimensions that may lack rows. Columns to `carry` come last.
    """
    keyed = join_dimension(claims, agents, F.col("agent_id"), "agent_id", "agent_sk")
    keyed = _derived_key(keyed, customers, "customer_id", "customer_sk")
    keyed = _derived_key(keyed, policies, "policy_number", "policy_sk")
    roles = {"txn": F.to_date("txn_date_time"), "loss": F.col("loss_dt"), "report": F.col("report_dt")}
    return _fact_columns(
        keyed.withColumns({f"{role}_date_sk": calendar_key(day, start, end) for role, day in roles.items()}), carry
    )


def star_integrity(fact: DataFrame, silver: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """(check_name, row_count): the grain of the fact, duplicate dimension keys, fact rows without a match.

    `dims` maps a dimension's key column to the dimension. The fact is scanned once: its keys are counted per column and
    value before they are sent, and meet the dimensions' keys in the same grouping.
    """
    first = next(iter(dims))
    in_fact = fact.select(F.inline(F.array(*[
        F.struct(F.lit(sk).alias("name"), F.col(sk).cast("bigint").alias("sk")) for sk in dims
    ]))).select("*", F.lit(1).alias("in_fact"), F.lit(0).alias("in_dim"))
    in_dims = [
        dim.select(F.lit(sk).alias("name"), F.col(sk).cast("bigint").alias("sk"), F.lit(0).alias("in_fact"), F.lit(1).alias("in_dim"))
        for sk, dim in dims.items()
    ]
    per_key = reduce(DataFrame.unionAll, in_dims, in_fact).groupBy("name", "sk").agg(
        F.sum("in_fact").alias("in_fact"), F.sum("in_dim").alias("in_dim")
    )
    missing = F.col("sk").isNull() | (F.col("in_dim") == 0)
    per_dim = per_key.groupBy("name").agg(
        F.count_if(F.col("in_dim") > 1).alias("duplicate"), F.sum("in_fact").alias("fact_rows"),
        F.coalesce(F.sum(F.when(missing, F.col("in_fact"))), F.lit(0)).alias("unmatched"),
    )

    def check(name: Column, count: Column) -> Column:
        return F.struct(name.alias("check_name"), count.alias("row_count"))

    of_dim = [check(F.concat_ws("_", F.lit(kind), F.col("name")), F.col(kind)) for kind in ("duplicate", "unmatched")]
    rows = F.when(F.col("name") == first, check(F.lit("fact_rows"), F.col("fact_rows")))
    silver_rows = silver.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit("silver_rows").alias("check_name"), "row_count")
    return per_dim.select(F.inline(F.array_compact(F.array(*of_dim, rows)))).unionAll(silver_rows)
