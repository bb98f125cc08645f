from __future__ import annotations

from pyspark.sql import functions as F

from claimflow.operators import quality
from claimflow.operators.quality import Rule, claim_rules
from claimflow.plans.silver import silver_claims

GOOD = {
    "CUSTOMER_ID": "C1", "AGENT_ID": "A1", "POLICY_NUMBER": "P1", "CLAIM_AMOUNT": "10", "POLICY_EFF_DT": "2020-01-01",
    "LOSS_DT": "2020-02-01", "REPORT_DT": "2020-02-02",
}


def rows(claim):
    cases = {
        "fine": {},
        "zero": {"CLAIM_AMOUNT": "0"},
        "negative": {"CLAIM_AMOUNT": "-5"},
        "no amount": {"CLAIM_AMOUNT": None},
        "text amount": {"CLAIM_AMOUNT": "ten"},
        "blank customer": {"CUSTOMER_ID": "  "},
        "no agent": {"AGENT_ID": None},
        "no policy": {"POLICY_NUMBER": ""},
        "early loss": {"LOSS_DT": "2019-12-31", "REPORT_DT": "2020-01-01"},
        "early and blank": {"LOSS_DT": "2019-12-31", "CUSTOMER_ID": None},
        "late": {"REPORT_DT": "2020-03-03"},
        "just in time": {"REPORT_DT": "2020-03-02"},
        "no dates": {"LOSS_DT": None, "REPORT_DT": "not-a-date"},
    }
    return silver_claims(claim(*[{**GOOD, "TRANSACTION_ID": n, **c} for n, c in cases.items()]))


def test_outcomes(claim):
    got = {r.transaction_id: (r.outcome, r.reasons, r.is_late_reported) for r in quality.evaluate(rows(claim), claim_rules()).collect()}
    assert got == {
        "fine": ("clean", [], False),
        "zero": ("quarantine", ["invalid_amount"], False),
        "negative": ("quarantine", ["invalid_amount"], False),
        "no amount": ("quarantine", ["invalid_amount"], False),
        "text amount": ("quarantine", ["invalid_amount"], False),
        "blank customer": ("quarantine", ["missing_customer"], False),
        "no agent": ("quarantine", ["missing_agent"], False),
        "no policy": ("quarantine", ["missing_policy"], False),
        "early loss": ("drop", ["policy_after_loss"], False),
        "early and blank": ("quarantine", ["missing_customer", "policy_after_loss", "late_report"], True),
        "late": ("clean", ["late_report"], True),
        "just in time": ("clean", [], False),
        "no dates": ("clean", [], False),
    }


def test_split_loses_only_dropped_rows(claim):
    silver = rows(claim)
    clean, held = quality.split(silver, claim_rules())
    assert (clean.count(), held.count(), silver.count()) == (4, 8, 13)
    assert "is_late_reported" in clean.columns and "reasons" in held.columns


def test_threshold_is_a_parameter(claim):
    assert quality.clean(rows(claim), claim_rules(late_after=0)).where("is_late_reported").count() == 3


def test_rules_without_some_actions(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "v int")
    only_flag = [Rule("big", F.col("v") > 3, "flag")]
    assert [r.big for r in quality.evaluate(df, only_flag).orderBy(F.col("v").asc_nulls_first()).collect()] == [False, False, True]
    assert quality.quarantined(df, only_flag).count() == 0


def test_metrics_and_observation_agree(claim):
    from pyspark.sql import Observation

    silver, rules = rows(claim), claim_rules()
    metrics = {r.rule: r.rows_failed for r in quality.rule_metrics(silver, rules).collect()}
    assert metrics["invalid_amount"] == 4 and metrics["policy_after_loss"] == 2
    seen = Observation("quality")
    silver.observe(seen, *quality.rule_counts(rules)).count()
    assert {k: v for k, v in seen.get.items() if k != "rows_seen"} == metrics
