"""The given tables seen as sources, registries, run logs and landing files.

All of these grow with the tables. `catalog` is a registry with one source per
customer, `run_log` a log with one run per event; the five-source registry next
to them is only a handful of marks for tables that are read in full.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import model as m
from tidemark.functions import ntz, to_millis
from tidemark.operators.copies import write_file, write_records
from tidemark.operators.registry import destination_folder
from tidemark.sources.readers import FileSpec, TableSpec, read_source
from tidemark.sources.zones import scratch

CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS, PAYMENTS, RETURNS = range(1, 7)

NAMES = {
    CUSTOMERS: "Customers",
    PRODUCTS: "Products",
    ORDERS: "Orders",
    ORDER_ITEMS: "OrderItems",
    PAYMENTS: "Payments",
    RETURNS: "Returns",
}

# Not loaded, pending, pending, nothing pending, pending, no table.
MARKS = {
    CUSTOMERS: m.SENTINEL,
    PRODUCTS: datetime(2001, 6, 1),
    ORDERS: datetime(2001, 1, 1),
    ORDER_ITEMS: datetime(2002, 1, 1),
    PAYMENTS: datetime(2024, 1, 15),
    RETURNS: datetime(2001, 1, 1),
}

NOW = datetime(2024, 6, 1, 12, 0, 0)

# A failed run of at least this value carries a new mark and a history row:
# violations the checks have to find.
VIOLATION_FROM = 100.0


COLUMNS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, "
    "l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
    "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, "
    "p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spec = TableSpec("dbo", name, root=sf_dir, columns=COLUMNS[name])
    return read_source(spark, spec)


# --- Watermarked sources ------------------------------------------------------


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "UpdatedAt")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumnRenamed("l_shipdate", "UpdatedAt")


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return events.withColumnRenamed("ts", "UpdatedAt")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer changed when it last ordered."""
    last = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_orderdate").alias("UpdatedAt"))
    )
    return table(spark, sf_dir, "customer").join(last, "c_custkey", "left")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product changed when it was last shipped."""
    last = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.max("l_shipdate").alias("UpdatedAt"))
    )
    return table(spark, sf_dir, "part").join(last, "p_partkey", "left")


def sources(spark: SparkSession, sf_dir: str) -> dict[int, DataFrame]:
    return {
        CUSTOMERS: customers(spark, sf_dir),
        PRODUCTS: products(spark, sf_dir),
        ORDERS: orders(spark, sf_dir),
        ORDER_ITEMS: order_items(spark, sf_dir),
        PAYMENTS: payments(spark, sf_dir),
    }


def registry(spark: SparkSession, marks: dict[int, datetime] | None = None) -> DataFrame:
    """The registry of the five tables and of one that does not exist."""
    rows = ", ".join(
        f"({source_id}, '{NAMES[source_id]}', '{mark.isoformat(sep=' ')}')"
        for source_id, mark in (marks or MARKS).items()
    )
    listed = spark.sql(f"SELECT * FROM VALUES {rows} AS t(id, name, mark)")
    return listed.select(
        F.col("id").alias("SourceObjectId"),
        F.lit("sales_local").alias("SourceSystemName"),
        F.lit(m.SQL_TABLE).alias("SourceType"),
        F.lit("dbo").alias("SourceSchema"),
        F.col("name").alias("SourceObjectName"),
        F.lit("INCREMENTAL").alias("LoadType"),
        F.lit("UpdatedAt").alias("WatermarkColumn"),
        F.lit(True).alias("IsActive"),
        F.col("mark").cast("timestamp_ntz").alias("LastWatermarkValue"),
        F.lit("bronze").alias("DestinationContainer"),
    ).withColumns(
        {
            "DestinationFolder": destination_folder(),
            "DestinationFormat": F.lit("parquet"),
            "UpdatedAt": ntz(NOW),
        }
    )


# --- A registry that grows: one source per customer ---------------------------


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("c_nationkey")
    segment = F.col("c_mktsegment")
    source_type = (
        F.when(nation < 5, m.CSV_FILE)
        .when(nation < 10, m.JSON_FILE)
        .when(nation < 24, m.SQL_TABLE)
        .otherwise("XML_FILE")
    )
    mark = (
        F.when(segment == "BUILDING", ntz(m.SENTINEL))
        .when((segment == "MACHINERY") & (F.col("c_acctbal") < 0), ntz(None))
        .when(segment == "AUTOMOBILE", ntz(datetime(2000, 1, 1)))
        .otherwise(F.coalesce("UpdatedAt", ntz(m.SENTINEL)))
    )
    return customers(spark, sf_dir).select(
        F.col("c_custkey").alias("SourceObjectId"),
        F.lower(segment).alias("SourceSystemName"),
        source_type.alias("SourceType"),
        F.lit("dbo").alias("SourceSchema"),
        F.col("c_name").alias("SourceObjectName"),
        F.lit("INCREMENTAL").alias("LoadType"),
        F.lit("UpdatedAt").alias("WatermarkColumn"),
        (F.col("c_acctbal") >= 0).alias("IsActive"),
        mark.alias("LastWatermarkValue"),
        F.lit("bronze").alias("DestinationContainer"),
    ).withColumns(
        {
            "DestinationFolder": destination_folder(),
            "DestinationFormat": F.lit("parquet"),
            "UpdatedAt": ntz(NOW),
        }
    )


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all catalog sources: a customer's orders."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("SourceObjectId"),
        F.col("o_orderdate").alias("UpdatedAt"),
    )


# --- A run log and a history that grow: one run per event ---------------------


def _logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = " ".join(f"WHEN {number} THEN '{text}'" for number, text in NAMES.items())
    events = (
        table(spark, sf_dir, "events")
        .withColumn("StartedAt", to_millis("ts"))
        .selectExpr(
            "*",
            "CAST(1 + user_id % 5 AS INT) AS SourceObjectId",
            f"""CASE event_type WHEN 'error' THEN '{m.FAILED}'
                WHEN 'view' THEN '{m.RUNNING}' ELSE '{m.SUCCEEDED}' END AS Status""",
        )
    )
    return events.selectExpr(
        "event_id",
        "CAST(event_id AS STRING) AS RunId",
        "SourceObjectId",
        "CAST(user_id AS STRING) AS PipelineRunId",
        f"CASE SourceObjectId {names} END AS SourceObjectName",
        "Status",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS OldWatermarkValue",
        "StartedAt AS CurrentHighWatermarkValue",
        f"""CASE WHEN Status = '{m.SUCCEEDED}'
               OR (Status = '{m.FAILED}' AND value >= {VIOLATION_FROM})
            THEN StartedAt END AS NewWatermarkValue""",
        "CAST(floor(value) AS BIGINT) AS RowsRead",
        f"""CASE WHEN Status = '{m.SUCCEEDED}' THEN CAST(floor(value) AS BIGINT) END
            AS RowsCopied""",
        f"CASE WHEN Status = '{m.FAILED}' THEN props END AS ErrorMessage",
        "StartedAt",
        f"""CASE WHEN Status <> '{m.RUNNING}' THEN StartedAt + INTERVAL '1' MINUTE END
            AS EndedAt""",
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _logged(spark, sf_dir).select(m.INGESTION_RUN.names)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    applied = _logged(spark, sf_dir).where(F.col("NewWatermarkValue").isNotNull())
    return applied.select(
        F.col("event_id").alias("WatermarkHistoryId"),
        "SourceObjectId",
        "RunId",
        "NewWatermarkValue",
        F.col("EndedAt").alias("AppliedAt"),
    )


def run_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as it was written: a start, and an end where there is one."""
    runs = run_log(spark, sf_dir)
    blank = {
        name: F.lit(None).cast(m.INGESTION_RUN[name].dataType)
        for name in (
            "NewWatermarkValue",
            "RowsRead",
            "RowsCopied",
            "ErrorMessage",
            "EndedAt",
        )
    }
    started = runs.withColumns(
        {"Status": F.lit(m.RUNNING), **blank, "Seq": F.lit(1)}
    )
    ended = runs.where(F.col("Status") != m.RUNNING).withColumn("Seq", F.lit(2))
    return started.unionByName(ended)


# --- Landing files written from the tables ------------------------------------


def rates_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate per order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("RateDate"),
        F.col("o_orderstatus").alias("BaseCurrency"),
        F.col("o_orderpriority").alias("TargetCurrency"),
        F.col("o_totalprice").cast("decimal(18,4)").alias("ExchangeRate"),
        F.lit("reference_files").alias("SourceSystem"),
    )


def country_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A country per customer."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("CountryCode"),
        F.col("c_name").alias("CountryName"),
        F.col("c_mktsegment").alias("CurrencyCode"),
        F.concat(F.lit("Nation, "), "c_nationkey").alias("CurrencyName"),
        F.when(F.col("c_acctbal") >= 0, 1).otherwise(0).alias("IsActive"),
    )


def adjustment_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch per order, about the order and its customer."""

    def item(suffix: str, entity: str, key: str, kind: str, active) -> Column:
        return F.struct(
            F.concat(F.lit("ADJ-"), F.col("o_orderkey"), F.lit(suffix)).alias(
                "adjustment_id"
            ),
            F.lit(entity).alias("entity_type"),
            F.concat(F.lit(f"{entity.upper()}-"), F.col(key)).alias("entity_reference"),
            F.lit(kind).alias("adjustment_type"),
            F.concat(F.lit("Priority \""), "o_orderpriority", F.lit("\"")).alias(
                "reason"
            ),
            active.alias("is_active"),
        )

    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("BATCH-"), F.col("o_orderkey")).alias("adjustment_batch_id"),
        F.lit("reference_files").alias("source_system_name"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("created_at"),
        F.array(
            item("-A", "Order", "o_orderkey", "REFUND_REVIEW", status != "F"),
            item("-B", "Customer", "o_custkey", "CONTACT_UPDATE_REVIEW", status == "O"),
        ).alias("adjustments"),
    )


def metadata_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source system per supplier, with two tables."""

    def listed(name: str) -> Column:
        return F.struct(
            F.lit("dbo").alias("schema"),
            F.lit(name).alias("table"),
            F.lit("INCREMENTAL").alias("load_type"),
            F.lit("UpdatedAt").alias("watermark_column"),
        )

    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("supplier_"), F.col("s_suppkey")).alias("source_system_name"),
        F.lit("SQL Server").alias("source_type"),
        F.lit("dev").alias("environment"),
        F.concat(F.lit("Nation "), F.col("s_nationkey")).alias("description"),
        F.array(listed("Orders"), listed("Payments")).alias("tables"),
    )


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates as raw lines; partly filled orders lack a date, urgent
    filled ones three fields."""
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    price = F.concat(F.col("o_totalprice").cast("decimal(18,4)"), F.lit("06"))
    short = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    line = (
        F.when(
            F.col("o_orderstatus") == "P",
            F.concat_ws(
                ",",
                F.lit("notadate"),
                "o_orderkey",
                "o_orderpriority",
                price,
                F.lit("x"),
            ),
        )
        .when(short, F.concat_ws(",", date, "o_orderkey"))
        .otherwise(
            F.concat_ws(",", date, "o_orderkey", "o_orderpriority", price, F.lit("x"))
        )
    )
    return table(spark, sf_dir, "orders").select(line.alias("value"))


def rate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates as raw records: more decimals than declared or none, and a quoted text with
    quotes and a line break."""
    key = F.col("o_orderkey")
    rate = F.when(key % 3 == 0, "5").otherwise(F.concat(F.lit("17.0500"), key % 10))
    source = F.concat(F.lit('"ref ""'), key, F.lit('"",\nfiles"'))
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select(
        F.concat_ws(",", date, "o_orderstatus", "o_orderpriority", rate, source).alias("Record")
    )


def adjustment_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw lines: with a field that no schema declares, numbers spelled in
    their own way, and fields that are null or absent."""
    key = F.col("o_orderkey")
    absent = F.when(F.col("o_orderstatus") == "F", ', "source_system_name": null').otherwise("")
    return table(spark, sf_dir, "orders").select(
        F.concat(
            F.lit('{"created_at": "'),
            F.date_format("o_orderdate", "yyyy-MM-dd"),
            F.lit('T00:00:00.000Z", "adjustment_batch_id":"BATCH-'),
            key,
            F.lit('", "operator": {"id": '),
            key,
            F.lit('.50, "note": null}'),
            absent,
            F.lit(', "adjustments": [ ]}'),
        ).alias("Record")
    )


# Documents repeat their field names, so gzip leaves a twentieth. A gzipped file is one
# task's, so files have few enough documents for many tasks.
PACKED = {"compression": "gzip", "maxRecordsPerFile": 50_000}


class Landing:
    """Landing files written once per session and scale."""

    written: dict[tuple[str, str, str], str] = {}

    @classmethod
    def path(cls, spark: SparkSession, sf_dir: str, name: str, write) -> str:
        key = (spark.sparkContext.applicationId, sf_dir, name)
        if key not in cls.written:
            path = f"{scratch(spark)}/landing/{name}"
            write(path)
            cls.written[key] = path
        return cls.written[key]


def rates_file(spark: SparkSession, sf_dir: str) -> FileSpec:
    def write(path: str) -> None:
        write_file(rates_rows(spark, sf_dir), m.CSV_FILE, path)

    path = Landing.path(spark, sf_dir, "currency_rates", write)
    return FileSpec(m.CSV_FILE, path, m.CURRENCY_RATES)


def country_file(spark: SparkSession, sf_dir: str) -> FileSpec:
    def write(path: str) -> None:
        write_file(country_rows(spark, sf_dir), m.CSV_FILE, path)

    path = Landing.path(spark, sf_dir, "country_currency", write)
    return FileSpec(m.CSV_FILE, path, m.COUNTRY_CURRENCY)


def adjustments_file(spark: SparkSession, sf_dir: str) -> FileSpec:
    def write(path: str) -> None:
        write_file(adjustment_documents(spark, sf_dir), m.JSON_FILE, path, **PACKED)

    path = Landing.path(spark, sf_dir, "manual_adjustments", write)
    return FileSpec(m.JSON_FILE, path, m.MANUAL_ADJUSTMENTS, multi_line=False)


def metadata_file(spark: SparkSession, sf_dir: str) -> FileSpec:
    def write(path: str) -> None:
        write_file(metadata_documents(spark, sf_dir), m.JSON_FILE, path)

    path = Landing.path(spark, sf_dir, "source_system_metadata", write)
    return FileSpec(m.JSON_FILE, path, m.SOURCE_METADATA, multi_line=False)


def damaged_file(spark: SparkSession, sf_dir: str) -> FileSpec:
    def write(path: str) -> None:
        damaged_lines(spark, sf_dir).write.mode("overwrite").text(path)

    path = Landing.path(spark, sf_dir, "damaged_rates", write)
    return FileSpec(m.CSV_FILE, path, m.CURRENCY_RATES, header=False)


def rate_records_file(spark: SparkSession, sf_dir: str) -> FileSpec:
    spec = FileSpec(m.CSV_FILE, "", m.CURRENCY_RATES, multi_line=True)

    def write(path: str) -> None:
        write_records(rate_records(spark, sf_dir), spec, path)

    return replace(spec, path=Landing.path(spark, sf_dir, "rate_records", write))


def adjustment_records_file(spark: SparkSession, sf_dir: str) -> FileSpec:
    spec = FileSpec(m.JSON_FILE, "", m.MANUAL_ADJUSTMENTS, multi_line=False)

    def write(path: str) -> None:
        write_records(adjustment_records(spark, sf_dir), spec, path)

    return replace(spec, path=Landing.path(spark, sf_dir, "adjustment_records", write))
