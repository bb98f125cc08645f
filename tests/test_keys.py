from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from claimflow.functions import keys
from claimflow.functions.keys import hash_key, keyed_dimension, ranked_keys, with_dense_key
from claimflow.plans import gold
from tests.conftest import plan_of


def test_hash_key(spark):
    df = spark.createDataFrame([("C1",), (None,)], "k string")
    got = [r[0] for r in df.select(hash_key("k")).collect()]
    assert got == [int(hashlib.md5(b"C1").hexdigest()[:15], 16), None]


def test_compound_keys_do_not_run_together(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "x string, y string")
    assert df.select(hash_key("x", "y").alias("k")).distinct().count() == 2


@pytest.fixture
def short_hash(monkeypatch):
    """Few enough hash values that some keys share one."""
    monkeypatch.setattr(keys, "HASH_DIGITS", 4)


def test_shared_hashes_are_resolved(spark, short_hash):
    dim = spark.range(2000).select(F.concat(F.lit("C"), "id").alias("customer_id"))
    assert dim.select(hash_key("customer_id").alias("h")).distinct().count() < 2000
    keyed = keyed_dimension(dim, "customer_id", "customer_sk").cache()
    assert keyed.select("customer_sk").distinct().count() == 2000
    assert 0 < ranked_keys(keyed, "customer_id", "customer_sk").count() < 200


def test_fact_finds_ranked_keys(spark, claim, short_hash):
    from claimflow.plans.silver import silver_claims

    silver = silver_claims(claim(*[
        {"TRANSACTION_ID": f"T{i}", "CUSTOMER_ID": f"C{i}", "POLICY_NUMBER": f"P{i % 700}", "LOSS_DT": "2020-01-01"}
        for i in range(1500)
    ])).cache()
    agents = spark.createDataFrame([("A1", 1)], "agent_id string, agent_sk bigint")
    customers, policies = gold.dim_customer(silver).cache(), gold.dim_policy(silver).cache()
    assert ranked_keys(customers, "customer_id", "customer_sk").count() > 0
    derived = gold.fact_claims(silver, agents, customers, policies)
    joined = gold.fact_claims_lookup(silver, agents, customers, policies, gold.dim_date(spark))
    assert derived.exceptAll(joined).count() == 0 and joined.exceptAll(derived).count() == 0
    assert derived.where("customer_sk IS NULL OR policy_sk IS NULL").count() == 0


def test_lookups_shuffle_the_claims_once_for_both_large_dimensions(spark, claim):
    """Before, claims were shuffled for customers and again for policies; ids may be NULL or in no dimension."""
    from claimflow.plans.silver import silver_claims

    silver = silver_claims(claim(*[
        {"TRANSACTION_ID": f"T{i}", "CUSTOMER_ID": f"C{i % 5}" if i % 4 else None, "POLICY_NUMBER": f"P{i % 7}" if i % 3 else None}
        for i in range(60)
    ]))
    silver = spark.createDataFrame(silver.collect(), silver.schema)
    agents = spark.createDataFrame([("A1", 1)], "agent_id string, agent_sk bigint")
    customers = gold.dim_customer(silver).where("customer_id <> 'C2'")
    policies = gold.dim_policy(silver).where("policy_number <> 'P3'")
    customers, policies = (spark.createDataFrame(d.collect(), d.schema) for d in (customers, policies))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        fact = gold.fact_claims_lookup(silver, agents, customers, policies, gold.dim_date(spark))
        sent = re.findall(r"\) Exchange\nInput \[\d+\]: \[transaction_id#", plan_of(fact))
        got = {r.transaction_id: (r.customer_sk, r.policy_sk) for r in fact.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sent) == 5  # agents, three dates, pairs; 6 before
    assert len(got) == 60
    sks = [{r[0]: r[1] for r in d.collect()} for d in (customers.select("customer_id", "customer_sk"), policies.select("policy_number", "policy_sk"))]
    for r in silver.collect():
        assert got[r.transaction_id] == tuple(sk.get(k) if k is not None else None for sk, k in zip(sks, (r.customer_id, r.policy_number)))


def test_null_natural_key_is_the_unknown_member(spark):
    dim = spark.createDataFrame([(None,), ("a",)], "k string")
    got = {r.k: r.sk for r in keyed_dimension(dim, "k", "sk").collect()}
    assert got[None] == -1 and got["a"] > 0


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_dense_key_is_row_number(spark, n):
    df = spark.range(n).select(F.concat(F.lit("k"), F.col("id") * 7919 % 100_003).alias("k")).repartition(5)
    got = [(r.k, r.n) for r in with_dense_key(df, ["k"], "n").collect()]
    assert sorted(got, key=lambda r: r[1]) == [(k, i) for i, k in enumerate(sorted(k for k, _ in got), 1)]
    assert len(got) == n
