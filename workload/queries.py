"""Every registered query: `(spark, sf_dir) -> DataFrame`."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import model as m
from tidemark.functions import instant_to_ntz
from tidemark.operators import journals as j
from tidemark.operators import registry as r
from tidemark.operators import windows as w
from tidemark.operators.copies import copy_file, copy_window, run_folder
from tidemark.plans import checks as c
from tidemark.sources.raw import RECORD, read_raw
from tidemark.sources.readers import FileSpec, flag_columns, read_source
from tidemark.sources.zones import scratch
from workload import scenarios
from workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# --- Sources ------------------------------------------------------------------


@query
def scan_source(spark, sf_dir):
    return t.table(spark, sf_dir, "orders")


@query
def read_currency_rates(spark, sf_dir):
    return read_source(spark, t.rates_file(spark, sf_dir))


@query
def read_country_currency(spark, sf_dir):
    countries = read_source(spark, t.country_file(spark, sf_dir))
    return flag_columns(countries, "IsActive")


@query
def read_manual_adjustments(spark, sf_dir):
    documents = read_source(spark, t.adjustments_file(spark, sf_dir))
    items = F.col("adjustments")
    return documents.select(
        "adjustment_batch_id",
        "source_system_name",
        instant_to_ntz("created_at").alias("created_at"),
        F.size(items).cast("bigint").alias("adjustment_count"),
        F.array_join(items["entity_reference"], ";").alias("entity_references"),
    )


@query
def read_source_metadata(spark, sf_dir):
    documents = read_source(spark, t.metadata_file(spark, sf_dir))
    return documents.select(
        "source_system_name",
        "source_type",
        "environment",
        "description",
        F.array_join(F.col("tables")["table"], ";").alias("listed_tables"),
    )


@query
def explode_adjustments(spark, sf_dir):
    documents = read_source(spark, t.adjustments_file(spark, sf_dir))
    return r.explode_adjustments(documents).withColumn(
        "created_at", instant_to_ntz("created_at")
    )


@query
def registry_from_metadata(spark, sf_dir):
    documents = read_source(spark, t.metadata_file(spark, sf_dir))
    number = F.replace("source_system_name", F.lit("supplier_"), F.lit(""))
    first_id = number.cast("bigint") * 2 + 1
    return r.registry_from_metadata(documents, t.NOW, first_id)


# --- Sinks --------------------------------------------------------------------


@query
def copy_sql_window(spark, sf_dir):
    orders = t.orders(spark, sf_dir)
    old = t.MARKS[t.ORDERS]
    high = w.high_mark(orders, "UpdatedAt", old)
    window = w.incremental_window(orders, "UpdatedAt", old, high)
    path = run_folder(f"{scratch(spark)}/bronze", "sqlserver/sales_local/dbo/orders", "1")
    copy_window(window, path)
    return spark.read.schema(window.schema).parquet(path)


def _copied(spark: SparkSession, spec: FileSpec, folder: str) -> DataFrame:
    """The records of the copy, as they lie in bronze."""
    base = scratch(spark)
    path = run_folder(f"{base}/bronze", folder, "1")
    copy_file(spark, spec, path, run_folder(f"{base}/rejected", folder, "1"))
    return read_raw(spark, replace(spec, path=path)).select(RECORD)


@query
def copy_csv_to_bronze(spark, sf_dir):
    return _copied(spark, t.rate_records_file(spark, sf_dir), "files/csv/currency_rates")


@query
def copy_json_to_bronze(spark, sf_dir):
    spec = t.adjustment_records_file(spark, sf_dir)
    return _copied(spark, spec, "files/json/manual_adjustments")


@query
def reject_split(spark, sf_dir):
    spec = t.damaged_file(spark, sf_dir)
    base = scratch(spark)
    good = run_folder(f"{base}/bronze", "files/csv/currency_rates", "1")
    bad = run_folder(f"{base}/rejected", "files/csv/currency_rates", "1")
    counts = copy_file(spark, spec, good, bad)
    kept = read_raw(spark, replace(spec, path=good)).select(
        F.lit("bronze").alias("Zone"), RECORD
    )
    if not counts.rejected:
        return kept
    rejected = spark.read.schema(f"{m.CORRUPT_RECORD} string, RateDate date").json(
        bad, columnNameOfCorruptRecord="_unused"
    )
    return kept.unionByName(
        rejected.select(F.lit("rejected").alias("Zone"), F.col(m.CORRUPT_RECORD).alias(RECORD))
    )


# --- Windows and marks --------------------------------------------------------


@query
def p_eligible_rows(spark, sf_dir):
    return w.eligible_rows(t.sources(spark, sf_dir), t.registry(spark))


@query
def current_high_watermark(spark, sf_dir):
    return w.current_high_watermark(t.sources(spark, sf_dir), t.registry(spark))


@query
def incremental_window(spark, sf_dir):
    payments = t.payments(spark, sf_dir)
    old = t.MARKS[t.PAYMENTS]
    high = w.high_mark(payments, "UpdatedAt", old)
    window = w.incremental_window(payments, "UpdatedAt", old, high)
    return window.select("event_id", "user_id", "value", "UpdatedAt")


@query
def watermark_state(spark, sf_dir):
    state = j.watermark_state(t.registry(spark), t.history(spark, sf_dir))
    return state.select("SourceObjectId", "SourceObjectName", "LastWatermarkValue")


# --- Journals -----------------------------------------------------------------


@query
def run_log_fold(spark, sf_dir):
    return j.run_state(t.run_journal(spark, sf_dir))


@query
def failed_run_record(spark, sf_dir):
    return j.fail_runs(
        t.run_log(spark, sf_dir),
        F.concat(F.lit("copy failed in run "), "RunId"),
        F.col("StartedAt") + F.expr("INTERVAL '5' MINUTE"),
    ).select(
        "RunId", "SourceObjectId", "Status", "NewWatermarkValue", "ErrorMessage", "EndedAt"
    )


@query
def failed_without_history(spark, sf_dir):
    return j.failed_without_history(
        t.run_log(spark, sf_dir), t.history(spark, sf_dir)
    ).select("RunId", "SourceObjectId", "StartedAt")


@query
def failed_with_history(spark, sf_dir):
    return j.failed_with_history(
        t.run_log(spark, sf_dir), t.history(spark, sf_dir)
    ).select("RunId", "SourceObjectId", "StartedAt")


@query
def latest_failed_run(spark, sf_dir):
    return j.latest_failed_run_of(t.run_log(spark, sf_dir), t.ORDERS)


@query
def latest_failed_run_per_source(spark, sf_dir):
    return j.latest_failed_run(t.run_log(spark, sf_dir))


# --- Registry -----------------------------------------------------------------


@query
def active_sources(spark, sf_dir):
    return r.active_sources(t.catalog(spark, sf_dir)).select(
        "SourceObjectId", "SourceSystemName", "SourceType", "SourceObjectName"
    )


@query
def route_sources(spark, sf_dir):
    routed = r.route_sources(r.active_sources(t.catalog(spark, sf_dir)))
    return routed.select("SourceObjectId", "SourceType", "Route")


@query
def null_watermark_sources(spark, sf_dir):
    return r.null_watermark_sources(t.catalog(spark, sf_dir)).select(
        "SourceObjectId", "SourceObjectName"
    )


@query
def guard_initial_load_done(spark, sf_dir):
    return r.guard_initial_load_done(t.catalog(spark, sf_dir))


def _target(catalog: DataFrame):
    """The first loaded SQL source of the catalog."""
    loaded = r.sql_sources(catalog).where(r.is_loaded())
    return loaded.agg(F.min("SourceObjectId")).first()[0]


def _destinations(registry: DataFrame) -> DataFrame:
    return registry.select(
        "SourceObjectId", "DestinationContainer", "DestinationFolder", "UpdatedAt"
    )


LATER = datetime(2024, 6, 2)


@query
def prepare_failure(spark, sf_dir):
    catalog = t.catalog(spark, sf_dir)
    return _destinations(r.prepare_failure(catalog, _target(catalog), LATER))


@query
def restore_config(spark, sf_dir):
    catalog = t.catalog(spark, sf_dir)
    target = _target(catalog)
    broken = r.set_destination(catalog, target, m.FAILURE_CONTAINER, LATER, "elsewhere")
    folder = "sqlserver/restored"
    return _destinations(r.restore_config(broken, target, folder, LATER))


@query
def preview_failure(spark, sf_dir):
    return r.preview_failure(r.sql_sources(t.catalog(spark, sf_dir)))


# --- Checks -------------------------------------------------------------------


@query
def v1_watermark_readiness(spark, sf_dir):
    return c.watermark_readiness(t.catalog(spark, sf_dir))


@query
def v2_empty_run_eligibility(spark, sf_dir):
    return c.eligibility(t.sources(spark, sf_dir), t.registry(spark))


@query
def v3_run_history_summary(spark, sf_dir):
    return c.run_history_summary(t.run_log(spark, sf_dir))


@query
def v4_watermark_history_summary(spark, sf_dir):
    return c.watermark_history_summary(t.registry(spark), t.history(spark, sf_dir))


@query
def v5_retry_readiness(spark, sf_dir):
    return c.retry_readiness(t.sources(spark, sf_dir), t.registry(spark))


@query
def v6_latest_failed_run(spark, sf_dir):
    return c.failed_run_check(t.run_log(spark, sf_dir))


@query
def v7_failed_run_history_check(spark, sf_dir):
    return c.failed_run_history_check(
        t.registry(spark), t.run_log(spark, sf_dir), t.history(spark, sf_dir)
    )


@query
def v8_retry_eligible_rows(spark, sf_dir):
    return c.retry_eligible_rows(t.sources(spark, sf_dir), t.registry(spark))


@query
def v9_retry_summary(spark, sf_dir):
    return c.retry_summary(
        t.registry(spark),
        t.run_log(spark, sf_dir),
        t.history(spark, sf_dir),
        t.sources(spark, sf_dir),
    )


@query
def v10_source_config(spark, sf_dir):
    return c.source_config(t.catalog(spark, sf_dir))


@query
def operational_summary(spark, sf_dir):
    return c.operational_summary(
        t.registry(spark),
        t.run_log(spark, sf_dir),
        t.history(spark, sf_dir),
        t.sources(spark, sf_dir),
    )


# --- Checks over one source per customer -------------------------------------


@query
def v2_eligibility_many_sources(spark, sf_dir):
    return c.eligibility(t.customer_changes(spark, sf_dir), t.catalog(spark, sf_dir))


@query
def v8_retry_rows_many_sources(spark, sf_dir):
    return c.retry_eligible_rows(
        t.customer_changes(spark, sf_dir), t.catalog(spark, sf_dir)
    )


@query
def pending_many_sources(spark, sf_dir):
    registry = r.sql_sources(t.catalog(spark, sf_dir))
    return w.pending_counts(t.customer_changes(spark, sf_dir), registry)


# --- Scenarios ----------------------------------------------------------------

QUERIES.update(
    scenario_insert=scenarios.insert,
    scenario_update=scenarios.update,
    scenario_refund=scenarios.refund,
    scenario_empty=scenarios.empty,
    scenario_retry=scenarios.retry,
)
