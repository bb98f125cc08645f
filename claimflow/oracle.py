"""The same results in DuckDB SQL, written apart from the Spark side."""

from __future__ import annotations

from claimflow.fixtures import CLAIM_TABLES, CLAIMS_SQL, EMPLOYEE_SQL, EMPLOYEE_TABLES
from claimflow.schemas import CLAIM_COLUMNS, CUSTOMER_ATTRIBUTES, DEMOGRAPHIC_COLUMNS, EMPLOYEE_COLUMNS

_CLAIMS = CLAIMS_SQL.format(**{t: t for t in CLAIM_TABLES})
_EMPLOYEE = EMPLOYEE_SQL.format(**{t: t for t in EMPLOYEE_TABLES})

RAW = f"WITH claims AS ({_CLAIMS}), employee AS ({_EMPLOYEE})"

_TYPED_COLUMNS = """
  TRANSACTION_ID AS transaction_id, TRY_CAST(TXN_DATE_TIME AS TIMESTAMP) AS txn_date_time,
  CUSTOMER_ID AS customer_id, POLICY_NUMBER AS policy_number,
  TRY_CAST(POLICY_EFF_DT AS DATE) AS policy_eff_dt, TRY_CAST(LOSS_DT AS DATE) AS loss_dt,
  TRY_CAST(REPORT_DT AS DATE) AS report_dt, INSURANCE_TYPE AS insurance_type,
  TRY_CAST(PREMIUM_AMOUNT AS DECIMAL(18,2)) AS premium_amount, TRY_CAST(CLAIM_AMOUNT AS DECIMAL(18,2)) AS claim_amount,
  CUSTOMER_NAME AS customer_name, SSN AS ssn, MARITAL_STATUS AS marital_status, TRY_CAST(AGE AS INTEGER) AS age,
  TRY_CAST(TENURE AS INTEGER) AS tenure, EMPLOYMENT_STATUS AS employment_status,
  TRY_CAST(NO_OF_FAMILY_MEMBERS AS INTEGER) AS no_of_family_members, RISK_SEGMENTATION AS risk_segmentation,
  HOUSE_TYPE AS house_type, SOCIAL_CLASS AS social_class, CUSTOMER_EDUCATION_LEVEL AS customer_education_level,
  TRY_CAST(ROUTING_NUMBER AS BIGINT) AS routing_number, ADDRESS_LINE1 AS address_line1, ADDRESS_LINE2 AS address_line2,
  CITY AS city, STATE AS state, TRY_CAST(POSTAL_CODE AS INTEGER) AS postal_code, AGENT_ID AS agent_id,
  CLAIM_STATUS AS claim_status, INCIDENT_SEVERITY AS incident_severity, AUTHORITY_CONTACTED AS authority_contacted,
  TRY_CAST(ANY_INJURY AS BOOLEAN) AS any_injury, TRY_CAST(POLICE_REPORT_AVAILABLE AS BOOLEAN) AS police_report_available,
  INCIDENT_STATE AS incident_state, INCIDENT_CITY AS incident_city,
  TRY_CAST(INCIDENT_HOUR_OF_THE_DAY AS INTEGER) AS incident_hour_of_the_day,
  CAST(TRY_CAST(REPORT_DT AS DATE) - TRY_CAST(LOSS_DT AS DATE) AS INTEGER) AS reporting_lag_days,
  CAST(TRY_CAST(LOSS_DT AS DATE) - TRY_CAST(POLICY_EFF_DT AS DATE) AS INTEGER) AS policy_to_loss_days,
  CASE CLAIM_STATUS WHEN 'A' THEN 'Approved' WHEN 'D' THEN 'Denied' WHEN 'P' THEN 'Pending' ELSE 'Unknown' END
    AS claim_status_desc"""

_CLAIM_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in CLAIM_COLUMNS)

DEDUPED = f"""{RAW}, deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY TRANSACTION_ID ORDER BY {_CLAIM_ORDER}) AS rn FROM claims)
  WHERE rn = 1)"""

SILVER = f"""{DEDUPED}, silver AS (SELECT {_TYPED_COLUMNS} FROM deduped),
silver_employee AS (SELECT DISTINCT {', '.join(f'{c} AS {c.lower()}' for c in EMPLOYEE_COLUMNS)} FROM employee)"""


def _sk(key: str) -> str:
    return f"CAST('0x' || substr(md5({key}), 1, 15) AS BIGINT)"


_CUSTOMER = ", ".join(CUSTOMER_ATTRIBUTES)
_AGENT_ORDER = ", ".join(f"{c.lower()} ASC NULLS FIRST" for c in EMPLOYEE_COLUMNS)

_CALENDAR_COLUMNS = """full_date, CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_sk,
  CAST(year(full_date) AS INTEGER) AS year, CAST(month(full_date) AS INTEGER) AS month,
  CAST(day(full_date) AS INTEGER) AS day, CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week,
  CAST(quarter(full_date) AS INTEGER) AS quarter, dayofweek(full_date) IN (0, 6) AS is_weekend"""

GOLD = f"""{SILVER},
dim_date AS (SELECT {_CALENDAR_COLUMNS} FROM (
  SELECT CAST(unnest(generate_series(DATE '2015-01-01', DATE '2027-12-31', INTERVAL 1 DAY)) AS DATE) AS full_date)),
dim_agent AS (
  SELECT agent_id, agent_name, date_of_joining, address_line1, address_line2, city, state, postal_code,
    emp_routing_number, emp_acct_number AS account_number, coalesce({_sk('agent_id')}, -1) AS agent_sk
  FROM (SELECT *, row_number() OVER (PARTITION BY agent_id ORDER BY {_AGENT_ORDER}) AS rn FROM silver_employee)
  WHERE rn = 1),
dim_customer AS (
  SELECT {_CUSTOMER}, coalesce({_sk('customer_id')}, -1) AS customer_sk
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY transaction_id) AS rn FROM silver) WHERE rn = 1),
dim_policy AS (
  SELECT policy_number, policy_eff_dt, insurance_type, coalesce({_sk('policy_number')}, -1) AS policy_sk
  FROM (SELECT *, row_number() OVER (PARTITION BY policy_number ORDER BY transaction_id) AS rn FROM silver) WHERE rn = 1)"""

_QUARANTINE = """(claim_amount IS NULL OR claim_amount <= 0 OR coalesce(trim(customer_id), '') = ''
  OR coalesce(trim(agent_id), '') = '' OR coalesce(trim(policy_number), '') = '')"""
_DROP = "coalesce(policy_eff_dt > loss_dt, false)"
_LATE = "coalesce(reporting_lag_days > 30, false)"
_REASONS = f"""concat_ws(',',
  CASE WHEN claim_amount IS NULL OR claim_amount <= 0 THEN 'invalid_amount' END,
  CASE WHEN coalesce(trim(customer_id), '') = '' THEN 'missing_customer' END,
  CASE WHEN coalesce(trim(agent_id), '') = '' THEN 'missing_agent' END,
  CASE WHEN coalesce(trim(policy_number), '') = '' THEN 'missing_policy' END,
  CASE WHEN {_DROP} THEN 'policy_after_loss' END,
  CASE WHEN {_LATE} THEN 'late_report' END)"""

GATED = f"""{GOLD}, gated AS (SELECT *, {_LATE} AS is_late_reported FROM silver WHERE NOT {_QUARANTINE} AND NOT {_DROP})"""


def _fact(rows: str) -> str:
    return f"""SELECT s.transaction_id, a.agent_sk, c.customer_sk, p.policy_sk,
  dt.date_sk AS txn_date_sk, dl.date_sk AS loss_date_sk, dr.date_sk AS report_date_sk,
  s.claim_amount, s.premium_amount, s.claim_status, s.claim_status_desc, s.incident_severity, s.authority_contacted,
  s.any_injury, s.police_report_available, s.incident_state, s.incident_city,
  s.incident_hour_of_the_day AS incident_hour_of_day, s.reporting_lag_days, s.policy_to_loss_days
FROM {rows} s
LEFT JOIN dim_agent a ON s.agent_id = a.agent_id
LEFT JOIN dim_customer c ON s.customer_id = c.customer_id
LEFT JOIN dim_policy p ON s.policy_number = p.policy_number
LEFT JOIN dim_date dt ON CAST(s.txn_date_time AS DATE) = dt.full_date
LEFT JOIN dim_date dl ON s.loss_dt = dl.full_date
LEFT JOIN dim_date dr ON s.report_dt = dr.full_date"""


FACT = f"{GOLD}, fact AS ({_fact('silver')})"
MART = f"{GATED}, fact AS ({_fact('gated')})"

_NUMERIC_WHEN_INFERRED = {
    "TXN_DATE_TIME": "TIMESTAMP", "POLICY_EFF_DT": "DATE", "LOSS_DT": "DATE", "AGE": "INTEGER", "TENURE": "INTEGER",
    "NO_OF_FAMILY_MEMBERS": "INTEGER", "ROUTING_NUMBER": "INTEGER", "POSTAL_CODE": "INTEGER", "ANY_INJURY": "INTEGER",
    "POLICE_REPORT_AVAILABLE": "INTEGER", "INCIDENT_HOUR_OF_THE_DAY": "INTEGER",
}
_SPARK_NAMES = {"TIMESTAMP": "timestamp", "DATE": "date", "INTEGER": "int"}


def _inferred(column: str) -> str:
    if column in ("PREMIUM_AMOUNT", "CLAIM_AMOUNT"):
        return "double"
    return _SPARK_NAMES[_NUMERIC_WHEN_INFERRED[column]] if column in _NUMERIC_WHEN_INFERRED else "string"


def _money(expr: str) -> str:
    return f"CAST(sum({expr}) AS DECIMAL(28,2))"


def _loss_ratio(premium: str) -> str:
    return f"""{_money('claim_amount')} AS total_claim_amount, {_money(premium)} AS total_premium_amount,
  round(CAST(sum(claim_amount) AS DOUBLE) / nullif(CAST(sum({premium}) AS DOUBLE), 0), 6) AS loss_ratio"""


def _keyed(key: str, sk: str, dim: str) -> str:
    return f"{GOLD} SELECT s.transaction_id, s.{key}, d.{sk} FROM silver s LEFT JOIN {dim} d ON s.{key} = d.{key}"


def _dated(day: str, role: str) -> str:
    return f"""{GOLD} SELECT s.transaction_id, CAST(s.{day} AS DATE) AS day, d.date_sk AS {role}_date_sk
FROM silver s LEFT JOIN dim_date d ON CAST(s.{day} AS DATE) = d.full_date"""


def _null_counts(table: str, columns: list[str]) -> str:
    return f"{RAW} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM {table}" for c in columns
    )


def _violated(predicate: str) -> str:
    return f"{SILVER} SELECT transaction_id, {predicate} AS violated FROM silver"


def _typed(types: dict[str, str]) -> str:
    columns = ", ".join(f"TRY_CAST({c} AS {t}) AS {c}" for c, t in types.items())
    return f"{RAW} SELECT TRANSACTION_ID, {columns} FROM claims"


def _days(bounds: str) -> str:
    return f"""SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS full_date FROM ({bounds})"""


def oracle_sql() -> dict[str, str]:
    inferred = ", ".join(
        f"CAST({c} AS {_NUMERIC_WHEN_INFERRED[c]}) AS {c}" if c in _NUMERIC_WHEN_INFERRED else c for c in CLAIM_COLUMNS
    )
    schema_rows = ", ".join(f"({i}, '{c}', '{_inferred(c)}')" for i, c in enumerate(CLAIM_COLUMNS, 1))
    all_claims = f"{RAW} SELECT * FROM claims"
    lower_employee = f"{SILVER} SELECT * FROM silver_employee"
    all_silver = f"{SILVER} SELECT * FROM silver"
    typed_claims = f"{RAW} SELECT {_TYPED_COLUMNS} FROM claims"
    ids = f"{RAW} SELECT DISTINCT TRANSACTION_ID FROM claims"
    fact = f"{FACT} SELECT * FROM fact"
    distribution = "{raw} SELECT {c}, count(*) AS row_count FROM claims GROUP BY {c}"
    demographics = " UNION ALL ".join(
        f"SELECT CUSTOMER_ID, '{c}' AS column_name, count({c}) AS non_null_count, count(*) - count({c}) AS null_count "
        f"FROM claims GROUP BY CUSTOMER_ID HAVING count({c}) > 1 OR count(*) - count({c}) > 0"
        for c in DEMOGRAPHIC_COLUMNS
    )
    group_counts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS group_count FROM (SELECT DISTINCT CUSTOMER_ID FROM claims)"
        for c in DEMOGRAPHIC_COLUMNS
    )
    inconsistent = " UNION ALL ".join(
        f"SELECT CUSTOMER_ID, '{c}' AS column_name FROM claims "
        f"GROUP BY CUSTOMER_ID HAVING count(DISTINCT {c}) > 1"
        for c in DEMOGRAPHIC_COLUMNS
    )
    by_type = f"{MART} SELECT p.insurance_type, {{cols}} FROM fact f LEFT JOIN dim_policy p ON f.policy_sk = p.policy_sk GROUP BY p.insurance_type"
    rule_metrics = f"""{SILVER}, hits AS (
  SELECT 'invalid_amount' AS rule, 'quarantine' AS action, (claim_amount IS NULL OR claim_amount <= 0) AS hit FROM silver
  UNION ALL SELECT 'missing_customer', 'quarantine', coalesce(trim(customer_id), '') = '' FROM silver
  UNION ALL SELECT 'missing_agent', 'quarantine', coalesce(trim(agent_id), '') = '' FROM silver
  UNION ALL SELECT 'missing_policy', 'quarantine', coalesce(trim(policy_number), '') = '' FROM silver
  UNION ALL SELECT 'policy_after_loss', 'drop', {_DROP} FROM silver
  UNION ALL SELECT 'late_report', 'flag', {_LATE} FROM silver)
SELECT rule, action, count(*) AS rows_seen, count(*) FILTER (WHERE hit) AS rows_failed FROM hits GROUP BY rule, action"""
    newest_customer = f"""{SILVER} SELECT {_CUSTOMER}, txn_date_time, transaction_id FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY txn_date_time DESC NULLS LAST, transaction_id DESC) AS rn
  FROM silver) WHERE rn = 1"""
    day_bounds = "SELECT least(min({0}), min({1}), min({2})) AS lo, greatest(max({0}), max({1}), max({2})) AS hi FROM silver"
    return {
        # sources and sinks
        "csv_batch_read": f"{RAW} SELECT {inferred} FROM claims",
        "bronze_stream_ingest": all_claims,
        "bronze_schema_store": f"SELECT * FROM (VALUES {schema_rows}) AS t(ordinal, column_name, data_type)",
        "bronze_rerun_idempotent": f"""{RAW}
SELECT run, count(*) FILTER (WHERE run = 3 OR INCIDENT_SEVERITY <> 'Total Loss') AS row_count
FROM claims, (VALUES (1), (2), (3)) AS r(run) GROUP BY run""",
        "bronze_schema_evolution": f"""{RAW} SELECT TRANSACTION_ID, LOSS_DT, INCIDENT_HOUR_OF_THE_DAY,
  CASE WHEN INCIDENT_SEVERITY = 'Total Loss' THEN substr(INCIDENT_STATE, 1, 2) END AS REGION_CODE FROM claims""",
        "landing_reconciliation": f"""{RAW}
SELECT 'claims' AS feed, count(*) AS landed, count(*) AS loaded, CAST(0 AS BIGINT) AS difference FROM claims
UNION ALL SELECT 'employee', count(*), count(*), CAST(0 AS BIGINT) FROM employee""",
        "reconciliation_ledger": f"""{RAW} SELECT run, n AS landed, n AS loaded, CAST(0 AS BIGINT) AS difference FROM (
  SELECT CAST(1 AS INTEGER) AS run, count(*) AS n FROM claims WHERE INCIDENT_SEVERITY <> 'Total Loss'
  UNION ALL SELECT 2, 0
  UNION ALL SELECT 3, count(*) FROM claims WHERE INCIDENT_SEVERITY = 'Total Loss')""",
        "schema_drift_report": f"""{RAW}, late AS (SELECT * FROM claims WHERE INCIDENT_SEVERITY = 'Total Loss')
SELECT column_name, stored_type, seen_type, bad_values FROM (
  SELECT 'CLAIM_AMOUNT' AS column_name, 'double' AS stored_type, 'string' AS seen_type, count(*) AS bad_values FROM late
  UNION ALL SELECT 'AGE', 'int', 'double', count(AGE) FROM late
  UNION ALL SELECT 'LOSS_DT', 'date', 'timestamp', count(LOSS_DT) FROM late
  UNION ALL SELECT 'ROUTING_NUMBER', 'int', 'bigint', count(ROUTING_NUMBER) FROM late) WHERE bad_values > 0""",
        "table_scan": all_silver,
        "stream_table_scan": all_claims,
        "publish_table": lower_employee,
        "publish_over_itself": lower_employee,
        "sql_query": f"""{RAW} SELECT INSURANCE_TYPE, count(DISTINCT POLICY_NUMBER) AS distinct_policies,
  count(*) AS total_claims FROM claims GROUP BY INSURANCE_TYPE""",
        # projections and scalar functions
        "rename_select": f"""{RAW} SELECT AGENT_ID AS agent_id, AGENT_NAME AS agent_name,
  DATE_OF_JOINING AS date_of_joining, ADDRESS_LINE1 AS address_line1, ADDRESS_LINE2 AS address_line2, CITY AS city,
  STATE AS state, POSTAL_CODE AS postal_code, EMP_ROUTING_NUMBER AS emp_routing_number,
  EMP_ACCT_NUMBER AS account_number FROM employee""",
        "snake_case_columns": f"{RAW} SELECT {', '.join(f'{c} AS {c.lower()}' for c in CLAIM_COLUMNS)} FROM claims",
        "reporting_lag_days": f"""{RAW} SELECT TRANSACTION_ID, LOSS_DT, REPORT_DT,
  CAST(TRY_CAST(REPORT_DT AS DATE) - TRY_CAST(LOSS_DT AS DATE) AS INTEGER) AS reporting_lag_days FROM claims""",
        "policy_to_loss_days": f"""{RAW} SELECT TRANSACTION_ID, POLICY_EFF_DT, LOSS_DT,
  CAST(TRY_CAST(LOSS_DT AS DATE) - TRY_CAST(POLICY_EFF_DT AS DATE) AS INTEGER) AS policy_to_loss_days FROM claims""",
        "claim_status_decode": f"""{RAW} SELECT TRANSACTION_ID, CLAIM_STATUS, CASE CLAIM_STATUS WHEN 'A' THEN 'Approved'
  WHEN 'D' THEN 'Denied' WHEN 'P' THEN 'Pending' ELSE 'Unknown' END AS claim_status_desc FROM claims""",
        "parse_timestamp": _typed({"TXN_DATE_TIME": "TIMESTAMP"}),
        "parse_dates": _typed({"POLICY_EFF_DT": "DATE", "LOSS_DT": "DATE", "REPORT_DT": "DATE"}),
        "cast_decimals": _typed({"PREMIUM_AMOUNT": "DECIMAL(18,2)", "CLAIM_AMOUNT": "DECIMAL(18,2)"}),
        "cast_ints": _typed({c: "INTEGER" for c in (
            "POSTAL_CODE", "AGE", "TENURE", "NO_OF_FAMILY_MEMBERS", "INCIDENT_HOUR_OF_THE_DAY")}),
        "cast_long": _typed({"ROUTING_NUMBER": "BIGINT"}),
        "cast_booleans": _typed({"ANY_INJURY": "BOOLEAN", "POLICE_REPORT_AVAILABLE": "BOOLEAN"}),
        "silver_typed": typed_claims,
        "date_spine": f"{SILVER} {_days(day_bounds.format('policy_eff_dt', 'loss_dt', 'report_dt'))}",
        "date_key": f"""{SILVER} SELECT transaction_id, loss_dt, CAST(strftime(loss_dt, '%Y%m%d') AS INTEGER) AS date_sk
FROM silver""",
        "date_parts": f"""{SILVER} SELECT transaction_id, loss_dt, CAST(year(loss_dt) AS INTEGER) AS year,
  CAST(month(loss_dt) AS INTEGER) AS month, CAST(day(loss_dt) AS INTEGER) AS day,
  CAST(dayofweek(loss_dt) + 1 AS INTEGER) AS day_of_week, CAST(quarter(loss_dt) AS INTEGER) AS quarter FROM silver""",
        "weekend_flag": f"{SILVER} SELECT transaction_id, dayofweek(loss_dt) IN (0, 6) AS is_weekend FROM silver",
        "null_indicators": f"""{RAW} SELECT TRANSACTION_ID, CAST(SOCIAL_CLASS IS NULL AS INTEGER) AS social_class_missing,
  CAST(AUTHORITY_CONTACTED IS NOT NULL AS INTEGER) AS authority_present FROM claims""",
        "post_agg_filter": f"""{RAW} SELECT CUSTOMER_ID, count(SOCIAL_CLASS) AS non_null_count,
  count(*) - count(SOCIAL_CLASS) AS null_count FROM claims GROUP BY CUSTOMER_ID
HAVING count(SOCIAL_CLASS) > 1 OR count(*) - count(SOCIAL_CLASS) > 0""",
        "surrogate_key": f"{SILVER} SELECT transaction_id, customer_id, {_sk('customer_id')} AS customer_sk FROM silver",
        "surrogate_key_dense": f"""{SILVER} SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS customer_sk
FROM (SELECT DISTINCT customer_id FROM silver WHERE customer_id IS NOT NULL)""",
        # deduplication
        "stream_distinct_rows": f"{RAW} SELECT DISTINCT * FROM employee",
        "stream_distinct_wider_rows": f"""{RAW} SELECT *, NULL AS GRADE FROM employee
UNION SELECT *, CASE WHEN AGENT_ID LIKE '%1' THEN CITY END FROM employee""",
        "stream_dedup_by_key": ids,
        "dedup_customer": f"""{SILVER} SELECT transaction_id, {_CUSTOMER} FROM (SELECT *, row_number() OVER (
  PARTITION BY customer_id ORDER BY transaction_id) AS rn FROM silver) WHERE rn = 1""",
        "dedup_policy": f"""{SILVER} SELECT transaction_id, policy_number, policy_eff_dt, insurance_type FROM (
  SELECT *, row_number() OVER (PARTITION BY policy_number ORDER BY transaction_id) AS rn FROM silver) WHERE rn = 1""",
        "dedup_claims_deterministic": f"{DEDUPED} SELECT * FROM deduped",
        "stream_dedup_bounded": "SELECT DISTINCT event_id, ts, user_id, event_type, value FROM events",
        "stream_late_rows": """WITH behind AS (
  SELECT *, ts < (SELECT max(ts) FROM events WHERE event_id % 2 = 0) - INTERVAL 6 HOUR AS is_late FROM events)
SELECT 'first' AS outcome, event_id, ts, user_id, event_type, value FROM behind WHERE event_id % 2 = 0 OR NOT is_late
UNION ALL SELECT 'late', event_id, ts, user_id, event_type, value FROM behind WHERE is_late""",
        # joins
        "join_agent_sk": _keyed("agent_id", "agent_sk", "dim_agent"),
        "join_customer_sk": _keyed("customer_id", "customer_sk", "dim_customer"),
        "join_policy_sk": _keyed("policy_number", "policy_sk", "dim_policy"),
        "join_txn_date_sk": _dated("txn_date_time", "txn"),
        "join_loss_date_sk": _dated("loss_dt", "loss"),
        "join_report_date_sk": _dated("report_dt", "report"),
        "orphan_claims": f"""{RAW} SELECT count(*) AS orphan_count FROM claims c
WHERE NOT EXISTS (SELECT 1 FROM employee e WHERE e.AGENT_ID = c.AGENT_ID)""",
        # aggregations, sort, limit
        "row_counts": f"""{RAW} SELECT 'claims' AS table_name, count(*) AS row_count FROM claims
UNION ALL SELECT 'employee', count(*) FROM employee""",
        "null_counts_claims": _null_counts("claims", CLAIM_COLUMNS),
        "null_counts_employee": _null_counts("employee", EMPLOYEE_COLUMNS),
        "distinct_insurance_types": f"{RAW} SELECT DISTINCT INSURANCE_TYPE FROM claims",
        "claim_status_distribution": distribution.format(raw=RAW, c="CLAIM_STATUS"),
        "incident_severity_distribution": distribution.format(raw=RAW, c="INCIDENT_SEVERITY"),
        "incident_hour_distribution": distribution.format(raw=RAW, c="INCIDENT_HOUR_OF_THE_DAY")
        + " ORDER BY TRY_CAST(INCIDENT_HOUR_OF_THE_DAY AS INTEGER) ASC NULLS FIRST",
        "distinct_agents": f"{RAW} SELECT count(*) AS distinct_count FROM (SELECT DISTINCT AGENT_ID FROM claims)",
        "demographic_null_profile": f"{RAW} {demographics}",
        "demographic_group_counts": f"{RAW} {group_counts}",
        "demographic_inconsistencies": f"{RAW} {inconsistent}",
        "incremental_null_counts": _null_counts("claims", DEMOGRAPHIC_COLUMNS),
        "incremental_null_profile": f"{RAW} {demographics}",
        "incremental_inconsistencies": f"{RAW} {inconsistent}",
        "distinct_policies_vs_claims": f"""{RAW} SELECT count(DISTINCT POLICY_NUMBER) AS distinct_policies,
  count(*) AS total_claims FROM claims""",
        "table_preview": f"{RAW} SELECT * FROM claims ORDER BY {_CLAIM_ORDER} LIMIT 5",
        # data quality
        "rule_invalid_amount": _violated("(claim_amount IS NULL OR claim_amount <= 0)"),
        "rule_missing_customer": _violated("coalesce(trim(customer_id), '') = ''"),
        "rule_missing_agent": _violated("coalesce(trim(agent_id), '') = ''"),
        "rule_missing_policy": _violated("coalesce(trim(policy_number), '') = ''"),
        "rule_policy_after_loss": _violated(_DROP),
        "flag_late_report": f"{SILVER} SELECT transaction_id, reporting_lag_days, {_LATE} AS is_late_reported FROM silver",
        "quarantine_claims": f"{SILVER} SELECT *, {_REASONS} AS reasons FROM silver WHERE {_QUARANTINE}",
        "clean_claims": f"{GATED} SELECT * FROM gated",
        "quality_metrics": rule_metrics,
        "stream_quality_metrics": rule_metrics,
        "stream_quality_gate": f"""{SILVER} SELECT CASE WHEN {_QUARANTINE} THEN 'quarantine' ELSE 'clean' END AS outcome,
  transaction_id, claim_amount, {_LATE} AS is_late_reported,
  CASE WHEN {_QUARANTINE} THEN {_REASONS} ELSE '' END AS reasons FROM silver WHERE {_QUARANTINE} OR NOT {_DROP}""",
        # silver and gold tables
        "silver_employee": lower_employee,
        "silver_claims": all_silver,
        "dim_date": f"""{SILVER} SELECT {_CALENDAR_COLUMNS}
FROM ({_days(day_bounds.format('CAST(txn_date_time AS DATE)', 'loss_dt', 'report_dt'))})""",
        "dim_agent": f"{GOLD} SELECT * FROM dim_agent",
        "dim_customer": f"{GOLD} SELECT * FROM dim_customer",
        "dim_policy": f"{GOLD} SELECT * FROM dim_policy",
        "fact_claims": fact,
        "fact_claims_lookup": fact,
        "fact_claims_gated": f"{MART} SELECT * FROM fact",
        "scd1_upsert": newest_customer,
        "scd1_upsert_stored": newest_customer,
        "star_integrity": f"""{FACT} SELECT 'fact_rows' AS check_name, count(*) AS row_count FROM fact
UNION ALL SELECT 'silver_rows', count(*) FROM silver
UNION ALL SELECT 'duplicate_agent_sk', count(*) - count(DISTINCT agent_sk) FROM dim_agent
UNION ALL SELECT 'duplicate_customer_sk', count(*) - count(DISTINCT customer_sk) FROM dim_customer
UNION ALL SELECT 'duplicate_policy_sk', count(*) - count(DISTINCT policy_sk) FROM dim_policy
UNION ALL SELECT 'unmatched_agent_sk', count(*) FROM fact WHERE agent_sk IS NULL
UNION ALL SELECT 'unmatched_customer_sk', count(*) FROM fact WHERE customer_sk IS NULL
UNION ALL SELECT 'unmatched_policy_sk', count(*) FROM fact WHERE policy_sk IS NULL""",
        "lakehouse_end_to_end": fact,
        "lakehouse_incremental": fact,
        # marts
        "claims_by_policy_type": by_type.format(cols=f"""count(*) AS claim_count, {_money('claim_amount')} AS total_claim_amount,
  round(CAST(sum(claim_amount) AS DOUBLE) / count(claim_amount), 4) AS avg_claim_amount"""),
        "loss_ratio_by_policy_type": by_type.format(cols=_loss_ratio("premium_amount")),
        "loss_ratio_policy_level": f"""{MART}, per_policy AS (
  SELECT policy_sk, sum(claim_amount) AS claim_amount, max(premium_amount) AS premium_amount FROM fact GROUP BY policy_sk)
SELECT p.insurance_type, {_loss_ratio('premium_amount')}
FROM per_policy f LEFT JOIN dim_policy p ON f.policy_sk = p.policy_sk GROUP BY p.insurance_type""",
        "agent_claim_volume": f"""{MART} SELECT coalesce(a.agent_id, 'UNMATCHED') AS agent_id, a.agent_name,
  count(*) AS claim_count, {_money('claim_amount')} AS total_claim_amount
FROM fact f LEFT JOIN dim_agent a ON f.agent_sk = a.agent_sk GROUP BY 1, 2""",
        "claims_by_loss_month": f"""{MART} SELECT d.year, d.quarter, d.month, count(*) AS claim_count,
  {_money('claim_amount')} AS total_claim_amount
FROM fact f LEFT JOIN dim_date d ON f.loss_date_sk = d.date_sk GROUP BY 1, 2, 3""",
        "reporting_lag_summary": by_type.format(cols="""count(*) AS claim_count, min(reporting_lag_days) AS min_lag_days,
  max(reporting_lag_days) AS max_lag_days,
  round(CAST(sum(reporting_lag_days) AS DOUBLE) / nullif(count(reporting_lag_days), 0), 6) AS mean_lag_days,
  round(CAST(count(*) FILTER (WHERE reporting_lag_days > 30) AS DOUBLE) / count(*), 6) AS late_share"""),
        "odd_hour_claims": f"""{MART} SELECT incident_hour_of_day, incident_severity, count(*) AS claim_count,
  {_money('claim_amount')} AS total_claim_amount FROM fact GROUP BY 1, 2""",
        "weekend_vs_weekday_claims": f"""{MART} SELECT d.is_weekend, count(*) AS claim_count,
  {_money('claim_amount')} AS total_claim_amount
FROM fact f LEFT JOIN dim_date d ON f.txn_date_sk = d.date_sk GROUP BY 1""",
        # streaming
        "stream_available_now": f"{RAW} SELECT TRANSACTION_ID, CLAIM_STATUS, LOSS_DT FROM claims",
        "stream_append_sink": all_claims,
        "stream_derive": typed_claims,
        "stream_silver_claims": f"{RAW} SELECT DISTINCT TRANSACTION_ID AS transaction_id FROM claims",
    }
