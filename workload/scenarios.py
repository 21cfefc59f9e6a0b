"""Scenarios on the given tables: insert, update, refund, empty run, retry."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import ntz
from tidemark.model import SENTINEL
from tidemark.operators.copies import succeeded_only
from tidemark.operators.registry import (
    prepare_failure,
    require_source,
    restore_config,
)
from tidemark.operators.store import ControlStore
from tidemark.operators.windows import high_mark, union_all
from tidemark.plans.checks import eligibility
from tidemark.plans.ingest import Ingestion
from tidemark.sources.tables import FrameTables
from tidemark.sources.zones import scratch, zone
from workload import tables as t

OLD = datetime(2001, 1, 1)
UPDATED = datetime(2001, 8, 2)
REFUNDED = datetime(2024, 2, 1)


def _loaded(
    spark: SparkSession, tables: dict[int, DataFrame]
) -> tuple[ControlStore, Ingestion]:
    """A store whose sources have had their initial load. `tables` may change then."""
    store = ControlStore(spark, scratch(spark)).create()
    store.save_registry(t.registry(spark, dict.fromkeys(tables, SENTINEL)), 1)
    ingestion = Ingestion(
        store, FrameTables(lambda row: tables[row.SourceObjectId]), _no_file, _Steps()
    )
    ingestion.run_active()
    return store, ingestion


def _no_file(row: Row):
    raise ValueError(f"{row.SourceObjectName} is not a file")


def _copied(store: ControlStore, source_id: int, run_id: str) -> DataFrame:
    """The bronze rows of a run, with its counts and marks as the journals have them."""
    source = store.source_row(source_id)
    folder = f"{zone(store.base, source.DestinationContainer)}/{source.DestinationFolder}"
    bronze = succeeded_only(store.spark.read.parquet(folder), store.runs(), source_id)
    run = store.runs().where(F.col("RunId") == run_id).select(
        F.col("RunId").alias("run_id"), "OldWatermarkValue", "RowsCopied"
    )
    advance = store.history().where(F.col("RunId") == run_id).select(
        F.col("RunId").alias("run_id"), "NewWatermarkValue"
    )
    # One row each: a run has one row in the folded log, and advances its mark once.
    return bronze.join(F.broadcast(run), "run_id").join(F.broadcast(advance), "run_id")


MARKS = ("OldWatermarkValue", "NewWatermarkValue", "RowsCopied")


def insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are loaded; new ones arrive; the second run copies those alone."""
    orders = t.orders(spark, sf_dir)
    tables = {t.ORDERS: orders.where(F.col("UpdatedAt") <= ntz(OLD))}
    store, ingestion = _loaded(spark, tables)
    tables[t.ORDERS] = orders
    (second,) = ingestion.run_active()
    return _copied(store, t.ORDERS, second.run_id).select(
        "o_orderkey", "o_totalprice", "UpdatedAt", *MARKS
    )


def update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are loaded; urgent open ones change price; the second run copies those."""
    changed = (F.col("o_orderstatus") == "O") & (
        F.col("o_orderpriority") == "1-URGENT"
    )
    orders = t.orders(spark, sf_dir)
    tables = {t.ORDERS: orders}
    store, ingestion = _loaded(spark, tables)
    tables[t.ORDERS] = orders.withColumns(
        {
            "o_totalprice": F.when(changed, F.col("o_totalprice") + 1).otherwise(
                F.col("o_totalprice")
            ),
            "UpdatedAt": F.when(changed, ntz(UPDATED)).otherwise(F.col("UpdatedAt")),
        }
    )
    (second,) = ingestion.run_active()
    return _copied(store, t.ORDERS, second.run_id).select(
        "o_orderkey", "o_totalprice", "UpdatedAt", *MARKS
    )


def refund(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and payments are loaded, then partly refunded; both marks advance."""
    orders, payments = t.orders(spark, sf_dir), t.payments(spark, sf_dir)
    tables = {t.ORDERS: orders, t.PAYMENTS: payments}
    store, ingestion = _loaded(spark, tables)
    low = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    tables[t.ORDERS] = orders.withColumns(
        {
            "o_orderstatus": F.when(low, "R").otherwise(F.col("o_orderstatus")),
            "UpdatedAt": F.when(low, ntz(REFUNDED)).otherwise(F.col("UpdatedAt")),
        }
    )
    large = F.col("value") >= 100
    tables[t.PAYMENTS] = payments.withColumns(
        {
            "value": F.when(large, -F.col("value")).otherwise(F.col("value")),
            "UpdatedAt": F.when(large, ntz(REFUNDED)).otherwise(F.col("UpdatedAt")),
        }
    )
    second = {o.source_id: o.run_id for o in ingestion.run_active()}
    refunded = {
        t.ORDERS: F.col("o_orderstatus") == "R",
        t.PAYMENTS: F.col("value") < 0,
    }
    return union_all(
        [
            _copied(store, source_id, run_id)
            .groupBy(*MARKS)
            .agg(
                F.count(F.lit(1)).alias("RowsInBronze"),
                F.count_if(refunded[source_id]).alias("RowsRefunded"),
            )
            .select(
                F.lit(t.NAMES[source_id]).alias("SourceObjectName"),
                *MARKS,
                "RowsInBronze",
                "RowsRefunded",
            )
            for source_id, run_id in second.items()
        ]
    )


class _Steps:
    """A clock that moves a second per reading: runs get an order."""

    def __init__(self):
        self.at = t.NOW

    def __call__(self) -> datetime:
        self.at += timedelta(seconds=1)
        return self.at


def _orders_store(
    spark: SparkSession, sf_dir: str, mark: datetime
) -> tuple[ControlStore, Ingestion]:
    """A store that knows Orders, already loaded up to `mark`."""
    store = ControlStore(spark, scratch(spark)).create()
    store.save_registry(t.registry(spark, {t.ORDERS: mark}), 1)
    loaded = {
        "WatermarkHistoryId": 0,
        "SourceObjectId": t.ORDERS,
        "RunId": "initial-load",
        "NewWatermarkValue": mark,
        "AppliedAt": t.NOW,
    }
    store.append_rows("watermark_history", [loaded], "initial-load")

    def open_table(row: Row) -> DataFrame:
        return t.orders(spark, sf_dir)

    return store, Ingestion(store, FrameTables(open_table), _no_file, _Steps())


def empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing is pending: the run is logged, the history gets no row."""
    orders = t.orders(spark, sf_dir)
    store, ingestion = _orders_store(spark, sf_dir, high_mark(orders, "UpdatedAt"))
    ingestion.run_active()
    check = eligibility({t.ORDERS: orders}, store.registry())
    run = store.runs().select(
        "SourceObjectId",
        "SourceObjectName",
        "Status",
        "RowsRead",
        "RowsCopied",
        "NewWatermarkValue",
    )
    entries = (
        store.history()
        .groupBy("SourceObjectId")
        .agg(F.count(F.lit(1)).alias("History_Rows"))
    )
    logged = run.join(entries, "SourceObjectId").drop("SourceObjectId")
    return check.join(logged, "SourceObjectName")


def retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A controlled failure, then a retry that reads the same rows."""
    store, ingestion = _orders_store(spark, sf_dir, OLD)
    registry = store.registry()
    target = require_source(registry, "sales_local", "dbo", "Orders")
    folder = registry.select("DestinationFolder").first()[0]

    store.save_registry(prepare_failure(registry, target, t.NOW), 2)
    ingestion.run_active()
    store.save_registry(restore_config(store.registry(), target, folder, t.NOW), 3)
    ingestion.run_active()

    history = store.history().select("RunId", "WatermarkHistoryId")
    return (
        store.runs()
        .join(history, "RunId", "left")
        .groupBy(
            "Status",
            "OldWatermarkValue",
            "CurrentHighWatermarkValue",
            "NewWatermarkValue",
            "RowsRead",
            "RowsCopied",
        )
        .agg(F.count("WatermarkHistoryId").alias("History_Rows"))
    )
