"""Every operator as a query `(spark, sf_dir) -> DataFrame` over the test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow import fixtures as fx
from claimflow.functions import dates
from claimflow.functions.keys import hash_key, with_dense_key
from claimflow.operators import joins, profile_state, profiling, project, quality, scd
from claimflow.operators.dedup import dedup_claims, dedup_first
from claimflow.plans import end_to_end, gold, marts, silver
from claimflow.schemas import (
    AGENT_RENAMES, CLAIM_TYPES, CUSTOMER_ATTRIBUTES, DEMOGRAPHIC_COLUMNS, POLICY_ATTRIBUTES,
)
from claimflow.session import scratch_path
from claimflow.sources import csv_files, drift, ledger, tables
from claimflow.sources.csv_files import SOURCE_FILE
from claimflow.streaming import dedup as stream_dedup
from claimflow.streaming import late
from claimflow.streaming.gate import quality_gate_stream, read_gate, read_gate_metrics
from claimflow.streaming.ingest import ingest, read_bronze
from claimflow.streaming.silver import silver_claims_stream
from claimflow.streaming.sinks import append_sink, run_available_now, stream_state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def local_times(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock times, the type the test tables use."""
    return df.select([
        F.col(c).cast("timestamp_ntz").alias(c) if kind == "timestamp" else F.col(c) for c, kind in df.dtypes
    ])


def amounts_as_numbers(bronze: DataFrame) -> DataFrame:
    """Bronze text rows with the two amounts as doubles and without the source file."""
    return project.cast_columns(bronze, {"PREMIUM_AMOUNT": "double", "CLAIM_AMOUNT": "double"}).drop(SOURCE_FILE)


def through_sink(sdf: DataFrame, label: str, partitions: int | None = None) -> DataFrame:
    """Run a stream to its end into a new table and read that; `partitions` is for streams with state."""
    spark = sdf.sparkSession
    root = scratch_path(spark, label)
    with stream_state(spark, partitions):
        run_available_now(append_sink(sdf, f"{root}/table", f"{root}/checkpoint"))
    return spark.read.schema(sdf.schema).parquet(f"{root}/table")


# Sources and sinks


@query
def csv_batch_read(spark, sf):
    return local_times(csv_files.read_csv(spark, fx.landing(spark, sf)["claims"]))


@query
def bronze_stream_ingest(spark, sf):
    src = fx.landing(spark, sf)["claims"]
    return amounts_as_numbers(fx.load_bronze(spark, src, scratch_path(spark, "lake"), "claims"))


@query
def bronze_schema_store(spark, sf):
    src, store = fx.landing(spark, sf)["claims"], scratch_path(spark, "schema")
    csv_files.load_or_infer_schema(spark, src, store)
    return csv_files.schema_rows(spark, csv_files.load_or_infer_schema(spark, src, store))


def _land_in_two(spark, first: DataFrame, second: DataFrame):
    """Yield the bronze table after the first drop, after no drop, and after the second drop."""
    root = scratch_path(spark, "lake")
    src, dst, ckpt, store = (f"{root}/{part}" for part in ("landing", "bronze", "checkpoint", "schema"))
    for drop in (first, None, second):
        if drop is not None:
            fx.land(drop, src)
        ingest(spark, src, dst, ckpt, store)
        yield read_bronze(spark, dst, store)


@query
def bronze_rerun_idempotent(spark, sf):
    claims = fx.raw_claims(spark, sf)
    early, late = (claims.where(f"INCIDENT_SEVERITY {op} 'Total Loss'") for op in ("<>", "="))
    counts = [(run, t.count()) for run, t in enumerate(_land_in_two(spark, early, late), 1)]
    return spark.createDataFrame(counts, "run int, row_count bigint")


@query
def bronze_schema_evolution(spark, sf):
    claims = fx.raw_claims(spark, sf)
    early, late = (claims.where(f"INCIDENT_SEVERITY {op} 'Total Loss'") for op in ("<>", "="))
    wider = late.withColumn("REGION_CODE", F.substring("INCIDENT_STATE", 1, 2))
    *_, bronze = _land_in_two(spark, early, wider)
    return bronze.select("TRANSACTION_ID", "LOSS_DT", "INCIDENT_HOUR_OF_THE_DAY", "REGION_CODE")


@query
def landing_reconciliation(spark, sf):
    totals = []
    for feed in ("claims", "employee"):
        files = csv_files.reconcile(spark, fx.landing(spark, sf)[feed], fx.bronze(spark, sf, feed))
        totals.append(files.agg(
            F.sum("landed").alias("landed"), F.sum("loaded").alias("loaded"),
            F.sum(F.abs("difference")).alias("difference"),
        ).select(F.lit(feed).alias("feed"), "*"))
    return totals[0].unionAll(totals[1])


@query
def reconciliation_ledger(spark, sf):
    """What each of three runs counted: a drop of claims, nothing new, a second drop."""
    claims, root = fx.raw_claims(spark, sf), scratch_path(spark, "ledger")
    early, late = (claims.where(f"INCIDENT_SEVERITY {op} 'Total Loss'") for op in ("<>", "="))
    runs = []
    for run, drop in enumerate((early, None, late), 1):
        if drop is not None:
            fx.land(drop, f"{root}/landing")
            fx.load_bronze(spark, f"{root}/landing", root, "claims")
        files = ledger.settle(spark, f"{root}/landing", f"{root}/bronze/claims", root, "claims")
        total = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("landed", "loaded", "difference")]
        runs.append(files.agg(*total).select(F.lit(run).alias("run"), "*"))
    return runs[0].unionAll(runs[1]).unionAll(runs[2])


@query
def schema_drift_report(spark, sf):
    """Columns of a second drop that do not fit the types of the first, over its files."""
    claims, root = fx.raw_claims(spark, sf), scratch_path(spark, "drift")
    early, late = (claims.where(f"INCIDENT_SEVERITY {op} 'Total Loss'") for op in ("<>", "="))
    fx.land(early, f"{root}/landing")
    stored = csv_files.load_or_infer_schema(spark, f"{root}/landing", f"{root}/schema")
    changed = late.withColumns({
        "CLAIM_AMOUNT": F.lit("n/a"), "AGE": F.concat("AGE", F.lit(".5")), "LOSS_DT": F.concat("LOSS_DT", F.lit(" 08:00:00")),
        "ROUTING_NUMBER": F.concat("ROUTING_NUMBER", F.lit("000")),
    })
    fx.land(changed, f"{root}/landing")
    found = drift.type_drift(spark, f"{root}/landing", stored)
    return found.groupBy("column_name", "stored_type", "seen_type").agg(F.sum("bad_values").alias("bad_values"))


@query
def table_scan(spark, sf):
    root = scratch_path(spark, "lake")
    tables.publish(fx.silver_claims(spark, sf), root, "silver", "silver_claims", "Typed claims")
    return local_times(tables.read_table(spark, root, "silver", "silver_claims"))


@query
def stream_table_scan(spark, sf):
    root = scratch_path(spark, "lake")
    tables.publish(fx.raw_claims(spark, sf), root, "bronze", "claims", "Raw claims")
    return through_sink(tables.read_table_stream(spark, root, "bronze", "claims"), "scanned")


@query
def publish_table(spark, sf):
    return tables.publish(
        silver.silver_employee(fx.raw_employee(spark, sf)), scratch_path(spark, "lake"), "silver", "silver_employee",
        "Distinct employee rows",
    )


@query
def publish_over_itself(spark, sf):
    """A table replaced by its own distinct rows."""
    root = scratch_path(spark, "lake")
    rows = tables.publish(fx.raw_employee(spark, sf), root, "silver", "silver_employee", "Employee rows as they came")
    return tables.publish(silver.silver_employee(rows), root, "silver", "silver_employee", "Distinct employee rows")


@query
def sql_query(spark, sf):
    return tables.run_sql(
        spark,
        """SELECT INSURANCE_TYPE, COUNT(DISTINCT POLICY_NUMBER) AS distinct_policies, COUNT(*) AS total_claims
           FROM claims_profile GROUP BY INSURANCE_TYPE""",
        claims_profile=fx.raw_claims(spark, sf),
    )


# Projections and scalar functions


@query
def rename_select(spark, sf):
    return project.rename_select(fx.raw_employee(spark, sf), AGENT_RENAMES)


@query
def snake_case_columns(spark, sf):
    claims = fx.raw_claims(spark, sf)
    return project.snake_case_columns(claims.toDF(*[c.replace("_", " ") for c in claims.columns]))


@query
def reporting_lag_days(spark, sf):
    return project.with_reporting_lag(fx.raw_claims(spark, sf)).select(
        "TRANSACTION_ID", "LOSS_DT", "REPORT_DT", "reporting_lag_days"
    )


@query
def policy_to_loss_days(spark, sf):
    return project.with_policy_to_loss(fx.raw_claims(spark, sf)).select(
        "TRANSACTION_ID", "POLICY_EFF_DT", "LOSS_DT", "policy_to_loss_days"
    )


@query
def claim_status_decode(spark, sf):
    return fx.raw_claims(spark, sf).select(
        "TRANSACTION_ID", "CLAIM_STATUS", project.decode_claim_status(F.col("CLAIM_STATUS")).alias("claim_status_desc")
    )


def _cast_query(name: str, kind: str) -> None:
    chosen = [c for c, t in CLAIM_TYPES.items() if t == kind]

    def run(spark, sf):
        claims = fx.raw_claims(spark, sf).select("TRANSACTION_ID", *chosen)
        return local_times(project.cast_columns(claims, CLAIM_TYPES))

    QUERIES[name] = run


for _name, _kind in {
    "parse_timestamp": "timestamp", "parse_dates": "date", "cast_decimals": "decimal(18,2)", "cast_ints": "int",
    "cast_long": "bigint", "cast_booleans": "boolean",
}.items():
    _cast_query(_name, _kind)


@query
def silver_typed(spark, sf):
    return local_times(project.type_claims(fx.raw_claims(spark, sf)))


@query
def date_spine(spark, sf):
    return dates.date_spine_covering(fx.silver_claims(spark, sf), ["policy_eff_dt", "loss_dt", "report_dt"])


@query
def date_key(spark, sf):
    key = dates.date_key(F.col("loss_dt")).alias("date_sk")
    return fx.silver_claims(spark, sf).select("transaction_id", "loss_dt", key)


@query
def date_parts(spark, sf):
    return dates.date_parts(fx.silver_claims(spark, sf).select("transaction_id", "loss_dt"), "loss_dt")


@query
def weekend_flag(spark, sf):
    return fx.silver_claims(spark, sf).select("transaction_id", dates.is_weekend(F.col("loss_dt")).alias("is_weekend"))


@query
def null_indicators(spark, sf):
    return fx.raw_claims(spark, sf).select(
        "TRANSACTION_ID",
        project.null_indicator(F.col("SOCIAL_CLASS")).alias("social_class_missing"),
        F.col("AUTHORITY_CONTACTED").isNotNull().cast("int").alias("authority_present"),
    )


@query
def post_agg_filter(spark, sf):
    counts = fx.raw_claims(spark, sf).groupBy("CUSTOMER_ID").agg(
        F.count("SOCIAL_CLASS").alias("non_null_count"),
        F.sum(project.null_indicator(F.col("SOCIAL_CLASS"))).alias("null_count"),
    )
    return project.having(counts, "non_null_count > 1 or null_count > 0")


@query
def surrogate_key(spark, sf):
    return fx.silver_claims(spark, sf).select("transaction_id", "customer_id", hash_key("customer_id").alias("customer_sk"))


@query
def surrogate_key_dense(spark, sf):
    customers = fx.silver_claims(spark, sf).select("customer_id").where("customer_id is not null").distinct()
    return with_dense_key(customers, ["customer_id"], "customer_sk")


# Deduplication


@query
def stream_distinct_rows(spark, sf):
    rows = fx.stream_of(fx.raw_employee, spark, sf)
    return through_sink(stream_dedup.distinct_rows_stream(rows), "distinct", fx.state_size(spark, sf))


@query
def stream_distinct_wider_rows(spark, sf):
    """Distinct rows of a feed delivered again by a second run in which half of the rows have a new column."""
    employee, root = fx.raw_employee(spark, sf), scratch_path(spark, "wider")
    grade = F.when(F.col("AGENT_ID").like("%1"), F.col("CITY"))
    for drop in (employee, employee.withColumn("GRADE", grade)):
        drop.write.mode("append").parquet(f"{root}/in")
        rows = spark.readStream.schema(drop.schema).option("maxFileAge", "36500d").parquet(f"{root}/in")
        with stream_state(spark, fx.state_size(spark, sf)):
            distinct = stream_dedup.distinct_rows_stream(rows)
            run_available_now(append_sink(distinct, f"{root}/table", f"{root}/checkpoint"))
    return spark.read.schema(rows.schema).parquet(f"{root}/table")


@query
def stream_dedup_by_key(spark, sf):
    rows = fx.stream_of(fx.raw_claims, spark, sf)
    first = stream_dedup.dedup_stream(rows, ["TRANSACTION_ID"])
    return through_sink(first, "dedup", fx.state_size(spark, sf)).select("TRANSACTION_ID")


@query
def dedup_customer(spark, sf):
    rows = fx.silver_claims(spark, sf).select("transaction_id", *CUSTOMER_ATTRIBUTES)
    return dedup_first(rows, ["customer_id"], ["transaction_id"])


@query
def dedup_policy(spark, sf):
    rows = fx.silver_claims(spark, sf).select("transaction_id", *POLICY_ATTRIBUTES)
    return dedup_first(rows, ["policy_number"], ["transaction_id"])


@query
def dedup_claims_deterministic(spark, sf):
    return dedup_claims(fx.raw_claims(spark, sf))


@query
def stream_dedup_bounded(spark, sf):
    """The event feed delivered twice; the delay covers the feed's whole span."""
    schema = fx.table(spark, sf, "events").schema
    feeds = [spark.readStream.schema(schema).option("maxFileAge", "36500d").parquet(f"{sf}/events.parque[t]") for _ in range(2)]
    twice = feeds[0].unionAll(feeds[1])
    timed = twice.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    once = stream_dedup.dedup_stream_bounded(timed, ["event_id"], "ts", "60 days")
    return local_times(through_sink(once, "events", fx.state_size(spark, sf)))


@query
def stream_late_rows(spark, sf):
    """Events with even ids, then all events: those behind the watermark of six hours are stored as late."""
    events = fx.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    root, rows = scratch_path(spark, "late"), events.select("event_id", "ts", "user_id", "event_type", "value")
    for drop in (rows.where("event_id % 2 = 0"), rows):
        drop.coalesce(1).write.mode("append").parquet(f"{root}/in")
        feed = spark.readStream.schema(rows.schema).option("maxFileAge", "36500d").parquet(f"{root}/in")
        late.dedup_with_late_rows(feed, ["event_id"], "ts", dt.timedelta(hours=6), f"{root}/out", f"{root}/checkpoint")
    found = [late.read_outcome(spark, f"{root}/out", o).select(F.lit(o).alias("outcome"), *rows.columns) for o in late.OUTCOMES]
    return local_times(found[0].unionAll(found[1]))


# Joins


def _keyed(spark, sf, dim, key: str, sk: str) -> DataFrame:
    claims = fx.silver_claims(spark, sf).select("transaction_id", key)
    return joins.join_dimension(claims, dim(spark, sf), F.col(key), key, sk)


@query
def join_agent_sk(spark, sf):
    return _keyed(spark, sf, fx.dim_agent, "agent_id", "agent_sk")


@query
def join_customer_sk(spark, sf):
    return _keyed(spark, sf, fx.dim_customer, "customer_id", "customer_sk")


@query
def join_policy_sk(spark, sf):
    return _keyed(spark, sf, fx.dim_policy, "policy_number", "policy_sk")


def _dated(spark, sf, col: str, role: str) -> DataFrame:
    claims = fx.silver_claims(spark, sf).select("transaction_id", F.to_date(col).alias("day"))
    return joins.join_date_role(claims, fx.dim_date(spark, sf), F.col("day"), role)


@query
def join_txn_date_sk(spark, sf):
    return _dated(spark, sf, "txn_date_time", "txn")


@query
def join_loss_date_sk(spark, sf):
    return _dated(spark, sf, "loss_dt", "loss")


@query
def join_report_date_sk(spark, sf):
    return _dated(spark, sf, "report_dt", "report")


@query
def orphan_claims(spark, sf):
    return joins.orphans(fx.raw_claims(spark, sf), fx.raw_employee(spark, sf), "AGENT_ID")


# Aggregations, sort, limit


@query
def row_counts(spark, sf):
    return profiling.row_counts(claims=fx.raw_claims(spark, sf), employee=fx.raw_employee(spark, sf))


@query
def null_counts_claims(spark, sf):
    return profiling.null_counts(fx.raw_claims(spark, sf))


@query
def null_counts_employee(spark, sf):
    return profiling.null_counts(fx.raw_employee(spark, sf))


@query
def distinct_insurance_types(spark, sf):
    return profiling.distinct_values(fx.raw_claims(spark, sf), "INSURANCE_TYPE")


@query
def claim_status_distribution(spark, sf):
    return profiling.value_distribution(fx.raw_claims(spark, sf), "CLAIM_STATUS")


@query
def incident_severity_distribution(spark, sf):
    return profiling.value_distribution(fx.raw_claims(spark, sf), "INCIDENT_SEVERITY")


@query
def incident_hour_distribution(spark, sf):
    hour = F.col("INCIDENT_HOUR_OF_THE_DAY")
    return profiling.value_distribution(
        fx.raw_claims(spark, sf), "INCIDENT_HOUR_OF_THE_DAY", order=hour.try_cast("int").asc_nulls_first()
    )


@query
def distinct_agents(spark, sf):
    return profiling.distinct_rows_count(fx.raw_claims(spark, sf), "AGENT_ID")


@query
def demographic_null_profile(spark, sf):
    return profiling.null_profile_by_key(fx.raw_claims(spark, sf), "CUSTOMER_ID", DEMOGRAPHIC_COLUMNS)


@query
def demographic_group_counts(spark, sf):
    return profiling.group_counts(fx.raw_claims(spark, sf), "CUSTOMER_ID", DEMOGRAPHIC_COLUMNS)


@query
def demographic_inconsistencies(spark, sf):
    return profiling.inconsistent_keys(fx.raw_claims(spark, sf), "CUSTOMER_ID", DEMOGRAPHIC_COLUMNS)


def _profiled(spark, sf) -> DataFrame:
    """The state after two drops of claims, each profiled when it came."""
    claims, root = fx.raw_claims(spark, sf), scratch_path(spark, "profile")
    total = F.col("INCIDENT_SEVERITY") == "Total Loss"
    for drop in (claims.where(~total), claims.where(total)):
        drop.write.mode("append").parquet(f"{root}/claims")
        state = profile_state.advance_profile(
            spark, f"{root}/claims", claims.schema, root, "demographics", "CUSTOMER_ID", DEMOGRAPHIC_COLUMNS
        )
    return state


@query
def incremental_null_counts(spark, sf):
    return profile_state.null_counts_of(_profiled(spark, sf))


@query
def incremental_null_profile(spark, sf):
    return profile_state.null_profile_of(_profiled(spark, sf), "CUSTOMER_ID")


@query
def incremental_inconsistencies(spark, sf):
    return profile_state.inconsistent_keys_of(_profiled(spark, sf), "CUSTOMER_ID")


@query
def distinct_policies_vs_claims(spark, sf):
    return profiling.distinct_vs_total(fx.raw_claims(spark, sf), "POLICY_NUMBER")


@query
def table_preview(spark, sf):
    claims = fx.raw_claims(spark, sf)
    return profiling.preview(claims, claims.columns)


# Data quality


def _rule_query(name: str, violated: Callable[[], "F.Column"]) -> None:
    def run(spark, sf):
        return fx.silver_claims(spark, sf).select("transaction_id", F.coalesce(violated(), F.lit(False)).alias("violated"))

    QUERIES[name] = run


for _name, _violated in {
    "rule_invalid_amount": quality.invalid_amount,
    "rule_missing_customer": lambda: quality.blank("customer_id"),
    "rule_missing_agent": lambda: quality.blank("agent_id"),
    "rule_missing_policy": lambda: quality.blank("policy_number"),
    "rule_policy_after_loss": quality.policy_after_loss,
}.items():
    _rule_query(_name, _violated)


@query
def flag_late_report(spark, sf):
    late = [r for r in quality.claim_rules() if r.action == "flag"]
    return quality.evaluate(fx.silver_claims(spark, sf), late).select(
        "transaction_id", "reporting_lag_days", "is_late_reported"
    )


def _joined_reasons(df: DataFrame) -> DataFrame:
    return df.withColumn("reasons", F.array_join("reasons", ","))


@query
def quarantine_claims(spark, sf):
    return local_times(_joined_reasons(quality.quarantined(fx.silver_claims(spark, sf), quality.claim_rules())))


@query
def clean_claims(spark, sf):
    return local_times(quality.clean(fx.silver_claims(spark, sf), quality.claim_rules()))


@query
def quality_metrics(spark, sf):
    return quality.rule_metrics(fx.silver_claims(spark, sf), quality.claim_rules())


@query
def stream_quality_gate(spark, sf):
    """Input without repeated ids, so that not only the ids but all values are defined."""
    root = scratch_path(spark, "gate")
    rows = fx.stream_of(fx.silver_claims, spark, sf)
    quality_gate_stream(rows, quality.claim_rules(), f"{root}/out", f"{root}/checkpoint")
    clean = read_gate(spark, f"{root}/out", "clean").withColumn("reasons", F.lit(""))
    held = _joined_reasons(read_gate(spark, f"{root}/out", "quarantine"))
    shown = ["transaction_id", "claim_amount", "is_late_reported", "reasons"]
    return clean.select(F.lit("clean").alias("outcome"), *shown).unionAll(
        held.select(F.lit("quarantine").alias("outcome"), *shown)
    )


@query
def stream_quality_metrics(spark, sf):
    """Rule counts stored per micro-batch, added up; a batch is one file here."""
    root = scratch_path(spark, "gate")
    rows = fx.stream_of(fx.silver_claims, spark, sf, maxFilesPerTrigger=1)
    quality_gate_stream(rows, quality.claim_rules(), f"{root}/out", f"{root}/checkpoint")
    return read_gate_metrics(spark, f"{root}/out")


# Silver and gold tables


@query
def silver_employee(spark, sf):
    return silver.silver_employee(fx.raw_employee(spark, sf))


@query
def silver_claims(spark, sf):
    return local_times(silver.silver_claims(fx.raw_claims(spark, sf)))


@query
def dim_date(spark, sf):
    """The calendar over all days the claims refer to."""
    claims = fx.silver_claims(spark, sf).withColumn("txn_dt", F.to_date("txn_date_time"))
    return gold.calendar(dates.date_spine_covering(claims, ["txn_dt", "loss_dt", "report_dt"]))


@query
def dim_agent(spark, sf):
    return gold.dim_agent(fx.silver_employee(spark, sf))


@query
def dim_customer(spark, sf):
    return gold.dim_customer(fx.silver_claims(spark, sf))


@query
def dim_policy(spark, sf):
    return gold.dim_policy(fx.silver_claims(spark, sf))


def _dims(spark, sf) -> list[DataFrame]:
    return [d(spark, sf) for d in (fx.dim_agent, fx.dim_customer, fx.dim_policy)]


@query
def fact_claims(spark, sf):
    return gold.fact_claims(fx.silver_claims(spark, sf), *_dims(spark, sf))


@query
def fact_claims_lookup(spark, sf):
    return gold.fact_claims_lookup(fx.silver_claims(spark, sf), *_dims(spark, sf), fx.dim_date(spark, sf))


@query
def fact_claims_gated(spark, sf):
    return gold.fact_claims(quality.clean(fx.silver_claims(spark, sf), quality.claim_rules()), *_dims(spark, sf))


@query
def scd1_upsert(spark, sf):
    """Customers as of the claims before 2018, brought up to date with the claims since."""
    order = ["txn_date_time", "transaction_id"]
    rows = fx.silver_claims(spark, sf).select(*CUSTOMER_ATTRIBUTES, *order)
    before = F.coalesce(F.col("txn_date_time") < F.to_timestamp(F.lit("2018-01-01 00:00:00")), F.lit(True))
    return local_times(scd.scd1_upsert(rows.where(before), rows.where(~before), "customer_id", order))


@query
def scd1_upsert_stored(spark, sf):
    """The same on a stored dimension: buckets that no claim since 2018 changes keep their files."""
    order, root = ["txn_date_time", "transaction_id"], scratch_path(spark, "lake")
    rows = fx.silver_claims(spark, sf).select(*CUSTOMER_ATTRIBUTES, *order)
    before = F.coalesce(F.col("txn_date_time") < F.to_timestamp(F.lit("2018-01-01 00:00:00")), F.lit(True))
    for some in (rows.where(before), rows.where(~before)):
        stored = scd.upsert_stored(
            some, root, "gold", "dim_customer", "Customers", "customer_id", scd.newest_first(order), order,
        )
    return local_times(stored.drop(scd.BUCKET))


@query
def star_integrity(spark, sf):
    dims = dict(zip(("agent_sk", "customer_sk", "policy_sk"), _dims(spark, sf)))
    return gold.star_integrity(fx.fact(spark, sf, gated=False), fx.silver_claims(spark, sf), dims)


@query
def lakehouse_end_to_end(spark, sf):
    raw = fx.landing(spark, sf)["claims"].rsplit("/", 1)[0]
    return end_to_end.run_pipeline(spark, raw, scratch_path(spark, "lake"))


@query
def lakehouse_incremental(spark, sf):
    """The fact after three runs, each on what is new: claims and half of the agents, more claims, the other agents.

    Ids are unique in the landed claims, so that the first arrival of an id is the defined survivor.
    """
    raw, root = scratch_path(spark, "landing"), scratch_path(spark, "lake")
    claims, employee = dedup_claims(fx.raw_claims(spark, sf)), fx.raw_employee(spark, sf)
    total, odd = F.col("INCIDENT_SEVERITY") == "Total Loss", F.col("AGENT_ID").rlike("[13579]$")
    drops = [(claims.where(~total), employee.where(odd)), (claims.where(total), None), (None, employee.where(~odd))]
    for drop in drops:
        for feed, rows in zip(end_to_end.FEEDS, drop):
            if rows is not None:
                fx.land(rows, f"{raw}/{feed}")
        fact = end_to_end.run_pipeline(spark, raw, root, incremental=True)
    return fact


# Marts


def _gated(spark, sf) -> DataFrame:
    return fx.fact(spark, sf, gated=True)


@query
def claims_by_policy_type(spark, sf):
    return marts.claims_by_policy_type(_gated(spark, sf), fx.dim_policy(spark, sf))


@query
def loss_ratio_by_policy_type(spark, sf):
    return marts.loss_ratio_by_policy_type(_gated(spark, sf), fx.dim_policy(spark, sf))


@query
def loss_ratio_policy_level(spark, sf):
    return marts.loss_ratio_policy_level(_gated(spark, sf), fx.dim_policy(spark, sf))


@query
def agent_claim_volume(spark, sf):
    return marts.agent_claim_volume(_gated(spark, sf), fx.dim_agent(spark, sf))


@query
def claims_by_loss_month(spark, sf):
    return marts.claims_by_loss_month(_gated(spark, sf), fx.dim_date(spark, sf))


@query
def reporting_lag_summary(spark, sf):
    return marts.reporting_lag_summary(_gated(spark, sf), fx.dim_policy(spark, sf))


@query
def odd_hour_claims(spark, sf):
    return marts.odd_hour_claims(_gated(spark, sf))


@query
def weekend_vs_weekday_claims(spark, sf):
    return marts.weekend_vs_weekday_claims(_gated(spark, sf), fx.dim_date(spark, sf))


# Streaming


@query
def stream_available_now(spark, sf):
    """A run of about four micro-batches, bounded by files."""
    files = fx.stored_files(fx.raw_claims, spark, sf)
    rows = fx.stream_of(fx.raw_claims, spark, sf, maxFilesPerTrigger=-(-files // 4))
    return through_sink(rows.select("TRANSACTION_ID", "CLAIM_STATUS", "LOSS_DT"), "drained")


@query
def stream_append_sink(spark, sf):
    return through_sink(fx.stream_of(fx.raw_claims, spark, sf), "appended")


@query
def stream_derive(spark, sf):
    return local_times(through_sink(project.type_claims(fx.stream_of(fx.raw_claims, spark, sf)), "derived"))


@query
def stream_silver_claims(spark, sf):
    rows = silver_claims_stream(fx.stream_of(fx.raw_claims, spark, sf))
    return through_sink(rows, "silver", fx.state_size(spark, sf)).select("transaction_id")
