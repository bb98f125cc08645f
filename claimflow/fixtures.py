"""The two feeds, rebuilt from the test tables, and the stored layers queries start from."""

from __future__ import annotations

import os
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.operators.quality import claim_rules, clean
from claimflow.plans import gold, silver
from claimflow.schemas import CALENDAR_END, CALENDAR_START
from claimflow.session import EXPANSION, STORED, fit_shuffle, scratch_path, shuffle_partitions_for, stored_bytes, whole_splits
from claimflow.sources.files import list_names
from claimflow.streaming.ingest import ingest, read_bronze

# One text for Spark and DuckDB; the braces take the table names. The small tables come first, so
# that the line items, by far the largest, are shuffled once; the hint (a comment to DuckDB) keeps
# Spark from broadcasting them when their columns happen to look small.
CLAIMS_SQL = """
SELECT /*+ MERGE(l) */
  concat('TXN', CAST(l.l_orderkey AS VARCHAR(20)), '-', CAST(l.l_linenumber AS VARCHAR(20))) AS TRANSACTION_ID,
  concat(CAST(CAST(l.l_shipdate AS DATE) + 6940 AS VARCHAR(10)), ' ', lpad(CAST(CAST(l.l_quantity AS INT) % 24 AS VARCHAR(2)), 2, '0'), ':00:00') AS TXN_DATE_TIME,
  CASE WHEN o.o_custkey % 97 = 0 THEN NULL ELSE concat('C', CAST(o.o_custkey AS VARCHAR(20))) END AS CUSTOMER_ID,
  CASE WHEN l.l_partkey % 103 = 0 THEN NULL ELSE concat('PLC', CAST(o.o_orderkey AS VARCHAR(20))) END AS POLICY_NUMBER,
  CAST(CAST(o.o_orderdate AS DATE) + 6940 AS VARCHAR(10)) AS POLICY_EFF_DT,
  CAST(CAST(l.l_shipdate AS DATE) + 6940 AS VARCHAR(10)) AS LOSS_DT,
  CASE WHEN l.l_partkey % 107 = 0 THEN 'not-a-date' ELSE CAST(CAST(l.l_shipdate AS DATE) + 6940 + CAST(l.l_quantity AS INT) AS VARCHAR(10)) END AS REPORT_DT,
  o.o_orderpriority AS INSURANCE_TYPE,
  o.o_totalprice AS PREMIUM_AMOUNT,
  CASE WHEN l.l_quantity = 1 THEN -l.l_extendedprice WHEN l.l_quantity = 2 THEN NULL ELSE l.l_extendedprice END AS CLAIM_AMOUNT,
  c.c_name AS CUSTOMER_NAME,
  concat('SSN-', CAST(c.c_custkey AS VARCHAR(20))) AS SSN,
  CASE WHEN o.o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS MARITAL_STATUS,
  CAST(18 + c.c_custkey % 60 AS VARCHAR(3)) AS AGE,
  CAST(o.o_orderkey % 120 AS VARCHAR(3)) AS TENURE,
  CASE WHEN c.c_acctbal < 0 THEN 'N' ELSE 'Y' END AS EMPLOYMENT_STATUS,
  CAST(1 + c.c_custkey % 7 AS VARCHAR(2)) AS NO_OF_FAMILY_MEMBERS,
  substr(c.c_mktsegment, 1, 1) AS RISK_SEGMENTATION,
  CASE WHEN c.c_custkey % 3 = 0 THEN 'Rent' WHEN c.c_custkey % 3 = 1 THEN 'Own' ELSE 'Mortgage' END AS HOUSE_TYPE,
  CASE WHEN c.c_acctbal < 0 THEN NULL WHEN c.c_acctbal < 5000 THEN 'LI' ELSE 'HI' END AS SOCIAL_CLASS,
  c.c_mktsegment AS CUSTOMER_EDUCATION_LEVEL,
  CAST(100000000 + c.c_custkey AS VARCHAR(12)) AS ROUTING_NUMBER,
  concat(CAST(c.c_custkey AS VARCHAR(20)), ' Main St') AS ADDRESS_LINE1,
  CAST(NULL AS VARCHAR(20)) AS ADDRESS_LINE2,
  n.n_name AS CITY, r.r_name AS STATE,
  CAST(10000 + c.c_custkey % 90000 AS VARCHAR(6)) AS POSTAL_CODE,
  CASE WHEN l.l_partkey % 101 = 0 THEN NULL ELSE concat('AGENT', CAST(l.l_suppkey AS VARCHAR(20))) END AS AGENT_ID,
  CASE WHEN l.l_returnflag = 'A' THEN 'A' WHEN l.l_returnflag = 'R' THEN 'D' ELSE o.o_orderstatus END AS CLAIM_STATUS,
  CASE WHEN l.l_linenumber <= 2 THEN 'Minor Loss' WHEN l.l_linenumber <= 5 THEN 'Major Loss' ELSE 'Total Loss' END AS INCIDENT_SEVERITY,
  CASE WHEN l.l_suppkey % 4 = 0 THEN NULL WHEN l.l_suppkey % 4 = 1 THEN 'Police' WHEN l.l_suppkey % 4 = 2 THEN 'Ambulance' ELSE 'Other' END AS AUTHORITY_CONTACTED,
  CAST(l.l_partkey % 2 AS VARCHAR(1)) AS ANY_INJURY,
  CAST(l.l_suppkey % 2 AS VARCHAR(1)) AS POLICE_REPORT_AVAILABLE,
  r.r_name AS INCIDENT_STATE, n.n_name AS INCIDENT_CITY,
  CAST(CAST(l.l_quantity AS INT) % 24 AS VARCHAR(2)) AS INCIDENT_HOUR_OF_THE_DAY
FROM {region} r
JOIN {nation} n ON n.n_regionkey = r.r_regionkey
JOIN {customer} c ON c.c_nationkey = n.n_nationkey
JOIN {orders} o ON o.o_custkey = c.c_custkey
JOIN {lineitem} l ON l.l_orderkey = o.o_orderkey
"""

EMPLOYEE_SQL = """
SELECT concat('AGENT', CAST(s.s_suppkey AS VARCHAR(20))) AS AGENT_ID, s.s_name AS AGENT_NAME,
  CAST(DATE '2001-01-01' + CAST(s.s_suppkey % 3000 AS INT) AS VARCHAR(10)) AS DATE_OF_JOINING,
  concat(CAST(s.s_suppkey AS VARCHAR(20)), ' Agency Rd') AS ADDRESS_LINE1, CAST(NULL AS VARCHAR(20)) AS ADDRESS_LINE2,
  n.n_name AS CITY, r.r_name AS STATE, CAST(20000 + s.s_suppkey AS VARCHAR(6)) AS POSTAL_CODE,
  CAST(200000000 + s.s_suppkey AS VARCHAR(12)) AS EMP_ROUTING_NUMBER, concat('ACCT', CAST(s.s_suppkey AS VARCHAR(20))) AS EMP_ACCT_NUMBER
FROM (SELECT * FROM {supplier} UNION ALL SELECT * FROM {supplier} WHERE s_suppkey % 5 = 0) s
JOIN {nation} n ON s.s_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
WHERE s.s_suppkey % 10 <> 3
"""

CLAIM_TABLES = ["region", "nation", "customer", "orders", "lineitem"]
EMPLOYEE_TABLES = ["supplier", "nation", "region"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CLAIMS_SQL, **{t: table(spark, sf_dir, t) for t in CLAIM_TABLES})


def employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(EMPLOYEE_SQL, **{t: table(spark, sf_dir, t) for t in EMPLOYEE_TABLES})


# Before compression; Spark reads a file in splits, each of whole row groups.
ROW_GROUP_BYTES = 8 << 20

_done: dict[tuple, object] = {}


def _state_of(spark: SparkSession, sf_dir: str) -> tuple:
    """Size and age of the test tables, so that changed tables are not answered from old layers."""
    if os.path.isdir(sf_dir):
        found = [os.stat(os.path.join(d, f)) for d, _, files in os.walk(sf_dir) for f in files]
        return len(found), sum(s.st_size for s in found), max((s.st_mtime for s in found), default=0)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(sf_dir)
    return tuple(files.agg(F.count("path"), F.sum("length"), F.max("modificationTime")).first())


def _once(spark: SparkSession, sf_dir: str, name: str, build):
    key = (spark.sparkContext.applicationId, sf_dir, _state_of(spark, sf_dir), name)
    if key not in _done:
        _done[key] = build()
    return _done[key]


def _layer(spark: SparkSession, sf_dir: str, name: str, build, as_it_comes: bool = False) -> DataFrame:
    """A table of the lakehouse, written to the shared folder when first needed and read from there.

    One whose rows are written `as_it_comes` from the scan, not sorted, takes larger splits. As a file is then a large
    part of the table and may be a micro-batch of its own, it has row groups that several tasks can share.
    """

    def write() -> tuple:
        fit_shuffle(spark, *[f"{sf_dir}/{t}.parquet" for t in CLAIM_TABLES])
        df = build()
        path = scratch_path(spark, name)
        with whole_splits(spark) if as_it_comes else nullcontext():
            writer = df.write.option("compression", STORED)
            (writer.option("parquet.block.size", ROW_GROUP_BYTES) if as_it_comes else writer).parquet(path)
        return path, df.schema

    path, schema = _once(spark, sf_dir, name, write)
    return spark.read.schema(schema).parquet(path)


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "raw_claims", lambda: claims(spark, sf_dir))


def raw_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "raw_employee", lambda: employee(spark, sf_dir))


def silver_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "silver_claims", lambda: silver.silver_claims(raw_claims(spark, sf_dir)), as_it_comes=True)


def silver_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "silver_employee", lambda: silver.silver_employee(raw_employee(spark, sf_dir)))


def dim_agent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "dim_agent", lambda: gold.dim_agent(silver_employee(spark, sf_dir)))


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "dim_customer", lambda: gold.dim_customer(silver_claims(spark, sf_dir)))


def dim_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "dim_policy", lambda: gold.dim_policy(silver_claims(spark, sf_dir)))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "dim_date", lambda: gold.dim_date(spark, CALENDAR_START, CALENDAR_END))


def fact(spark: SparkSession, sf_dir: str, gated: bool) -> DataFrame:
    def build() -> DataFrame:
        rows = silver_claims(spark, sf_dir)
        rows = clean(rows, claim_rules()) if gated else rows
        dims = (d(spark, sf_dir) for d in (dim_agent, dim_customer, dim_policy))
        return gold.fact_claims(rows, *dims)

    return _layer(spark, sf_dir, "fact_claims_gated" if gated else "fact_claims", build)


def stream_of(layer, spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """One of the layers above as a stream over its files."""
    layer(spark, sf_dir)
    path, schema = _once(spark, sf_dir, layer.__name__, None)
    return spark.readStream.schema(schema).option("maxFileAge", "36500d").options(**options).parquet(path)


def stored_files(layer, spark: SparkSession, sf_dir: str) -> int:
    """Number of files of one of the layers above."""
    layer(spark, sf_dir)
    path, _ = _once(spark, sf_dir, layer.__name__, None)
    return max(1, sum(name.endswith(".parquet") for name in list_names(spark, path)))


def land(rows: DataFrame, folder: str) -> None:
    """Add rows to a landing folder as header CSV files; compressed ones, as text repeats the same values over and over.

    A compressed file is read by one task. A task writes at most a split's rows to one.
    """
    rows.write.mode("append").option("header", True).option("compression", "gzip").csv(folder)


def landing(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Both feeds as folders of header CSV files."""

    def write() -> dict[str, str]:
        root = scratch_path(spark, "landing")
        feeds = {"claims": raw_claims(spark, sf_dir), "employee": raw_employee(spark, sf_dir)}
        for name, df in feeds.items():
            land(df, f"{root}/{name}")
        return {name: f"{root}/{name}" for name in feeds}

    return _once(spark, sf_dir, "landing", write)


def load_bronze(spark: SparkSession, src: str, root: str, name: str) -> DataFrame:
    """Ingest a landing folder below `root` and read the table."""
    dst, ckpt, schema_dir = (f"{root}/{part}/{name}" for part in ("bronze", "checkpoints", "schemas"))
    ingest(spark, src, dst, ckpt, schema_dir)
    return read_bronze(spark, dst, schema_dir)


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    src = landing(spark, sf_dir)[name]
    return _once(
        spark, sf_dir, f"bronze_{name}", lambda: load_bronze(spark, src, scratch_path(spark, "lake"), name)
    )


def state_size(spark: SparkSession, sf_dir: str) -> int:
    """Number of state partitions for a stream over the claims."""
    return shuffle_partitions_for(EXPANSION * stored_bytes(spark, f"{sf_dir}/lineitem.parquet"), at_least=8)
