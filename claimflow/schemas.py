"""Column lists and types of the two feeds (fixed values: names and types of the data model)."""

from __future__ import annotations

from pyspark.sql import types as T

CLAIM_COLUMNS = [
    "TRANSACTION_ID", "TXN_DATE_TIME", "CUSTOMER_ID", "POLICY_NUMBER", "POLICY_EFF_DT", "LOSS_DT", "REPORT_DT",
    "INSURANCE_TYPE", "PREMIUM_AMOUNT", "CLAIM_AMOUNT", "CUSTOMER_NAME", "SSN", "MARITAL_STATUS", "AGE", "TENURE",
    "EMPLOYMENT_STATUS", "NO_OF_FAMILY_MEMBERS", "RISK_SEGMENTATION", "HOUSE_TYPE", "SOCIAL_CLASS",
    "CUSTOMER_EDUCATION_LEVEL", "ROUTING_NUMBER", "ADDRESS_LINE1", "ADDRESS_LINE2", "CITY", "STATE", "POSTAL_CODE",
    "AGENT_ID", "CLAIM_STATUS", "INCIDENT_SEVERITY", "AUTHORITY_CONTACTED", "ANY_INJURY", "POLICE_REPORT_AVAILABLE",
    "INCIDENT_STATE", "INCIDENT_CITY", "INCIDENT_HOUR_OF_THE_DAY",
]

EMPLOYEE_COLUMNS = [
    "AGENT_ID", "AGENT_NAME", "DATE_OF_JOINING", "ADDRESS_LINE1", "ADDRESS_LINE2", "CITY", "STATE", "POSTAL_CODE",
    "EMP_ROUTING_NUMBER", "EMP_ACCT_NUMBER",
]

CLAIM_TYPES = {
    "TXN_DATE_TIME": "timestamp",
    "POLICY_EFF_DT": "date",
    "LOSS_DT": "date",
    "REPORT_DT": "date",
    "PREMIUM_AMOUNT": "decimal(18,2)",
    "CLAIM_AMOUNT": "decimal(18,2)",
    "POSTAL_CODE": "int",
    "AGE": "int",
    "TENURE": "int",
    "NO_OF_FAMILY_MEMBERS": "int",
    "INCIDENT_HOUR_OF_THE_DAY": "int",
    "ROUTING_NUMBER": "bigint",
    "ANY_INJURY": "boolean",
    "POLICE_REPORT_AVAILABLE": "boolean",
}

STATUS_NAMES = {"A": "Approved", "D": "Denied", "P": "Pending"}
UNKNOWN_STATUS = "Unknown"

DEMOGRAPHIC_COLUMNS = ["CUSTOMER_NAME", "SSN", "AGE", "MARITAL_STATUS", "SOCIAL_CLASS", "RISK_SEGMENTATION"]

AGENT_RENAMES = {c: c.lower() for c in EMPLOYEE_COLUMNS} | {"EMP_ACCT_NUMBER": "account_number"}

CUSTOMER_ATTRIBUTES = [
    "customer_id", "customer_name", "ssn", "marital_status", "age", "employment_status", "no_of_family_members",
    "risk_segmentation", "house_type", "social_class", "customer_education_level", "routing_number",
    "address_line1", "address_line2", "city", "state", "postal_code",
]

POLICY_ATTRIBUTES = ["policy_number", "policy_eff_dt", "insurance_type"]

FACT_KEYS = ["agent_sk", "customer_sk", "policy_sk", "txn_date_sk", "loss_date_sk", "report_date_sk"]

FACT_MEASURES = {
    "claim_amount": "claim_amount",
    "premium_amount": "premium_amount",
    "claim_status": "claim_status",
    "claim_status_desc": "claim_status_desc",
    "incident_severity": "incident_severity",
    "authority_contacted": "authority_contacted",
    "any_injury": "any_injury",
    "police_report_available": "police_report_available",
    "incident_state": "incident_state",
    "incident_city": "incident_city",
    "incident_hour_of_the_day": "incident_hour_of_day",
    "reporting_lag_days": "reporting_lag_days",
    "policy_to_loss_days": "policy_to_loss_days",
}

CALENDAR_START = "2015-01-01"
CALENDAR_END = "2027-12-31"

UNKNOWN_KEY = -1


def all_strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])
