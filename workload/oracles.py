"""The SQL each registered query must agree with, over the given tables."""

from __future__ import annotations

from tidemark import model as m
from workload import tables as t

SENTINEL = "TIMESTAMP '1900-01-01 00:00:00'"
NOW = "TIMESTAMP '2024-06-01 12:00:00'"
LATER = "TIMESTAMP '2024-06-02 00:00:00'"

# --- Fixed values: texts that the checks have to say -----------------------------


class Said:
    """Written out, so that a wrong text in the library doesn't pass on both sides."""

    CHANGES_ELIGIBLE = "CHANGES_ELIGIBLE_FOR_RETRY"
    CHANGES_PENDING = "CHANGES_PENDING"
    CURRENT_CONFIGURATION = "CURRENT_CONFIGURATION"
    EXPECTED_CONTAINER = "bronze"
    FAILURE_CONTAINER = "bronze_invalid_for_failure_test"
    FAIL_HISTORY = "FAIL_WATERMARK_HISTORY_EXISTS_FOR_FAILED_RUN"
    HISTORY_CHECK_AREA = "Latest failed run watermark history check"
    INVALID_FAILED_RUN = "NO_FAILED_RUN_FOUND_OR_INVALID"
    NOT_READY = "NOT_READY_INITIAL_LOAD_NOT_COMPLETED"
    NO_CHANGES_PENDING = "NO_CHANGES_PENDING"
    NO_FAILED_RUN = "NO_FAILED_RUN_FOUND_YET"
    NO_ROWS_PENDING = "NO_ROWS_PENDING_FOR_RETRY"
    PASS_EMPTY_READY = "PASS_EMPTY_READY"
    PASS_FAILED_RUN = "PASS_FAILED_RUN_RECORDED"
    PASS_NO_HISTORY = "PASS_NO_WATERMARK_HISTORY_FOR_FAILED_RUN"
    PASS_RETRY = "PASS_RETRY_VALIDATION"
    PASS_ROWS_ELIGIBLE = "PASS_ROWS_STILL_ELIGIBLE_FOR_RETRY"
    PREVIEW_ONLY = "PREVIEW_ONLY"
    PREVIEW_TEXT = "When @Action = PREPARE_FAILURE, DestinationContainer will be changed temporarily to force an ADF Copy Activity failure."
    READY_FOR_EMPTY_RUN = "READY_FOR_EMPTY_RUN_CHECK"
    RETRY_AREA = "Retry After Failure"
    REVIEW_REQUIRED = "REVIEW_REQUIRED"


# --- Common table expressions -------------------------------------------------

REGISTRY = (
    "registry(SourceObjectId, SourceObjectName, LastWatermarkValue) AS (VALUES "
    + ", ".join(
        f"({i}, '{t.NAMES[i]}', TIMESTAMP '{mark.isoformat(sep=' ')}')"
        for i, mark in t.MARKS.items()
    )
    + ")"
)

SOURCES = """
customers AS (
  SELECT c_custkey, max(o_orderdate) AS UpdatedAt
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey),
products AS (
  SELECT p_partkey, max(l_shipdate) AS UpdatedAt
  FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey),
payments AS (
  SELECT event_id, user_id, value, date_trunc('millisecond', ts) AS UpdatedAt
  FROM events WHERE event_type = 'purchase'),
changes AS (
  SELECT 1 AS SourceObjectId, UpdatedAt FROM customers
  UNION ALL SELECT 2, UpdatedAt FROM products
  UNION ALL SELECT 3, o_orderdate FROM orders
  UNION ALL SELECT 4, l_shipdate FROM lineitem
  UNION ALL SELECT 5, UpdatedAt FROM payments)
"""

STATS = """
stats AS (
  SELECT r.SourceObjectId, max(UpdatedAt) AS CurrentHighWatermarkValue,
         CAST(sum(CASE WHEN UpdatedAt > LastWatermarkValue THEN 1 ELSE 0 END)
              AS BIGINT) AS Eligible_Row_Count
  FROM registry r JOIN changes USING (SourceObjectId)
  GROUP BY r.SourceObjectId)
"""

RUNS = """
runs AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS RunId,
         CAST(1 + user_id % 5 AS INTEGER) AS SourceObjectId,
         CAST(user_id AS VARCHAR) AS PipelineRunId,
         CASE user_id % 5 WHEN 0 THEN 'Customers' WHEN 1 THEN 'Products'
              WHEN 2 THEN 'Orders' WHEN 3 THEN 'OrderItems' ELSE 'Payments'
         END AS SourceObjectName,
         CASE event_type WHEN 'error' THEN 'Failed' WHEN 'view' THEN 'Running'
              ELSE 'Succeeded' END AS Status,
         TIMESTAMP '2024-01-01 00:00:00' AS OldWatermarkValue,
         date_trunc('millisecond', ts) AS CurrentHighWatermarkValue,
         CASE WHEN event_type NOT IN ('error', 'view')
                OR (event_type = 'error' AND value >= 100)
              THEN date_trunc('millisecond', ts) END AS NewWatermarkValue,
         CAST(floor(value) AS BIGINT) AS RowsRead,
         CASE WHEN event_type NOT IN ('error', 'view')
              THEN CAST(floor(value) AS BIGINT) END AS RowsCopied,
         CASE WHEN event_type = 'error' THEN props END AS ErrorMessage,
         date_trunc('millisecond', ts) AS StartedAt,
         CASE WHEN event_type <> 'view'
              THEN date_trunc('millisecond', ts) + INTERVAL 1 MINUTE END AS EndedAt
  FROM events)
"""

HISTORY = """
history AS (
  SELECT event_id AS WatermarkHistoryId, SourceObjectId, RunId, NewWatermarkValue,
         EndedAt AS AppliedAt
  FROM runs WHERE NewWatermarkValue IS NOT NULL)
"""

LATEST_FAILED = """
latest_failed AS (
  SELECT * FROM runs WHERE Status = 'Failed'
  QUALIFY row_number() OVER (
    PARTITION BY SourceObjectId ORDER BY StartedAt DESC, RunId DESC) = 1)
"""

TRACES = """
traces AS (
  SELECT r.SourceObjectId, r.SourceObjectName, r.LastWatermarkValue,
         f.RunId AS FailedRunId, count(h.WatermarkHistoryId) AS History_Rows
  FROM registry r
  LEFT JOIN latest_failed f ON f.SourceObjectId = r.SourceObjectId
  LEFT JOIN history h ON h.RunId = f.RunId
  GROUP BY ALL)
"""

CATALOG = f"""
ordered AS (
  SELECT o_custkey, max(o_orderdate) AS UpdatedAt FROM orders GROUP BY o_custkey),
catalog AS (
  SELECT c_custkey AS SourceObjectId, lower(c_mktsegment) AS SourceSystemName,
         CASE WHEN c_nationkey < 5 THEN 'CSV_FILE' WHEN c_nationkey < 10 THEN 'JSON_FILE'
              WHEN c_nationkey < 24 THEN 'SQL_TABLE' ELSE 'XML_FILE' END AS SourceType,
         c_name AS SourceObjectName, c_acctbal >= 0 AS IsActive,
         CASE WHEN c_mktsegment = 'BUILDING' THEN {SENTINEL}
              WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0 THEN NULL
              WHEN c_mktsegment = 'AUTOMOBILE' THEN TIMESTAMP '2000-01-01 00:00:00'
              ELSE coalesce(UpdatedAt, {SENTINEL}) END AS LastWatermarkValue,
         'bronze' AS DestinationContainer,
         lower('sqlserver/' || c_mktsegment || '/dbo/' || c_name) AS DestinationFolder,
         'parquet' AS DestinationFormat, {NOW} AS UpdatedAt
  FROM customer LEFT JOIN ordered ON o_custkey = c_custkey),
target AS (
  SELECT min(SourceObjectId) AS id FROM catalog
  WHERE SourceType = 'SQL_TABLE' AND LastWatermarkValue > {SENTINEL})
"""


def given(*parts: str) -> str:
    return "WITH " + ", ".join(parts)


WITH_STATS = given(REGISTRY, SOURCES, STATS)
WITH_RUNS = given(RUNS)
WITH_HISTORY = given(REGISTRY, RUNS, HISTORY)
WITH_TRACES = given(REGISTRY, RUNS, HISTORY, LATEST_FAILED, TRACES)
WITH_CATALOG = given(CATALOG)
MANY = """
many AS (
  SELECT SourceObjectId, max(o_orderdate) AS CurrentHighWatermarkValue,
         CAST(sum(CASE WHEN o_orderdate > LastWatermarkValue THEN 1 ELSE 0 END)
              AS BIGINT) AS Eligible_Row_Count
  FROM catalog JOIN orders ON o_custkey = SourceObjectId
  WHERE SourceType = 'SQL_TABLE'
  GROUP BY SourceObjectId)
"""

WITH_MANY = given(CATALOG, MANY)
WITH_ALL = given(
    REGISTRY, SOURCES, STATS, RUNS, HISTORY, LATEST_FAILED, TRACES
)

EMPTY_STATUS = f"""
CASE WHEN LastWatermarkValue = {SENTINEL} THEN '{Said.NOT_READY}'
     WHEN Eligible_Row_Count = 0 THEN '{Said.PASS_EMPTY_READY}'
     ELSE '{Said.CHANGES_PENDING}' END
"""

RETRY_STATUS = f"""
CASE WHEN LastWatermarkValue = {SENTINEL} THEN '{Said.NOT_READY}'
     WHEN FailedRunId IS NULL THEN '{Said.NO_FAILED_RUN}'
     WHEN History_Rows = 0 AND coalesce(Eligible_Row_Count, 0) > 0
       THEN '{Said.PASS_RETRY}'
     ELSE '{Said.REVIEW_REQUIRED}' END
"""

RUN_COLUMNS = ", ".join(m.INGESTION_RUN.names)

ADJUSTMENTS = """
SELECT 'BATCH-' || o_orderkey AS adjustment_batch_id,
       'reference_files' AS source_system_name, o_orderdate AS created_at,
       'ADJ-' || o_orderkey || '-A' AS adjustment_id, 'Order' AS entity_type,
       'ORDER-' || o_orderkey AS entity_reference,
       'REFUND_REVIEW' AS adjustment_type,
       'Priority "' || o_orderpriority || '"' AS reason,
       o_orderstatus <> 'F' AS is_active
FROM orders
UNION ALL
SELECT 'BATCH-' || o_orderkey, 'reference_files', o_orderdate,
       'ADJ-' || o_orderkey || '-B', 'Customer', 'CUSTOMER-' || o_custkey,
       'CONTACT_UPDATE_REVIEW', 'Priority "' || o_orderpriority || '"',
       o_orderstatus = 'O'
FROM orders
"""

DESTINATIONS = """
SELECT SourceObjectId,
       CASE WHEN SourceObjectId = id THEN '{container}' ELSE DestinationContainer END
         AS DestinationContainer,
       CASE WHEN SourceObjectId = id THEN {folder} ELSE DestinationFolder END
         AS DestinationFolder,
       CASE WHEN SourceObjectId = id THEN {now} ELSE UpdatedAt END AS UpdatedAt
FROM catalog CROSS JOIN target
"""

ORACLES: dict[str, str] = {
    # --- Sources
    "scan_source": "SELECT * FROM orders",
    "read_currency_rates": """
        SELECT CAST(o_orderdate AS DATE) AS RateDate, o_orderstatus AS BaseCurrency,
               o_orderpriority AS TargetCurrency,
               CAST(o_totalprice AS DECIMAL(18,4)) AS ExchangeRate,
               'reference_files' AS SourceSystem
        FROM orders""",
    "read_country_currency": """
        SELECT CAST(c_custkey AS VARCHAR) AS CountryCode, c_name AS CountryName,
               c_mktsegment AS CurrencyCode, 'Nation, ' || c_nationkey AS CurrencyName,
               c_acctbal >= 0 AS IsActive
        FROM customer""",
    "read_manual_adjustments": """
        SELECT 'BATCH-' || o_orderkey AS adjustment_batch_id,
               'reference_files' AS source_system_name, o_orderdate AS created_at,
               CAST(2 AS BIGINT) AS adjustment_count,
               'ORDER-' || o_orderkey || ';CUSTOMER-' || o_custkey AS entity_references
        FROM orders""",
    "read_source_metadata": """
        SELECT 'supplier_' || s_suppkey AS source_system_name,
               'SQL Server' AS source_type, 'dev' AS environment,
               'Nation ' || s_nationkey AS description,
               'Orders;Payments' AS listed_tables
        FROM supplier""",
    "explode_adjustments": ADJUSTMENTS,
    "registry_from_metadata": f"""
        SELECT s_suppkey * 2 + n AS SourceObjectId,
               'supplier_' || s_suppkey AS SourceSystemName,
               'SQL_TABLE' AS SourceType, 'dbo' AS SourceSchema,
               name AS SourceObjectName, 'INCREMENTAL' AS LoadType,
               'UpdatedAt' AS WatermarkColumn, true AS IsActive,
               {SENTINEL} AS LastWatermarkValue, 'bronze' AS DestinationContainer,
               'sqlserver/supplier_' || s_suppkey || '/dbo/' || lower(name)
                 AS DestinationFolder,
               'parquet' AS DestinationFormat, {NOW} AS UpdatedAt
        FROM supplier
        CROSS JOIN (VALUES (1, 'Orders'), (2, 'Payments')) AS l(n, name)""",
    # --- Sinks
    "copy_sql_window": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               o_orderdate AS UpdatedAt, o_orderpriority
        FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01 00:00:00'""",
    "copy_csv_to_bronze": """
        SELECT strftime(o_orderdate, '%Y-%m-%d') || ',' || o_orderstatus || ','
               || o_orderpriority || ','
               || CASE WHEN o_orderkey % 3 = 0 THEN '5' ELSE '17.0500' || o_orderkey % 10 END
               || ',"ref ""' || o_orderkey || '"",' || chr(10) || 'files"' AS Record
        FROM orders""",
    "copy_json_to_bronze": """
        SELECT '{"created_at": "' || strftime(o_orderdate, '%Y-%m-%d')
               || 'T00:00:00.000Z", "adjustment_batch_id":"BATCH-' || o_orderkey
               || '", "operator": {"id": ' || o_orderkey || '.50, "note": null}'
               || CASE WHEN o_orderstatus = 'F' THEN ', "source_system_name": null' ELSE '' END
               || ', "adjustments": [ ]}' AS Record
        FROM orders""",
    "reject_split": """
        WITH lines AS (
          SELECT o_orderstatus, o_orderkey, o_orderpriority,
                 strftime(o_orderdate, '%Y-%m-%d') AS day,
                 CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS VARCHAR) || '06' AS price,
                 o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AS short
          FROM orders)
        SELECT CASE WHEN o_orderstatus = 'P' OR short THEN 'rejected' ELSE 'bronze' END
                 AS Zone,
               CASE WHEN short THEN day || ',' || o_orderkey
                    ELSE CASE WHEN o_orderstatus = 'P' THEN 'notadate' ELSE day END
                         || ',' || o_orderkey || ',' || o_orderpriority || ','
                         || price || ',x' END AS Record
        FROM lines""",
    # --- Windows and marks
    "p_eligible_rows": given(REGISTRY, SOURCES)
    + """
        SELECT SourceObjectId, UpdatedAt
        FROM changes JOIN registry USING (SourceObjectId)
        WHERE UpdatedAt > LastWatermarkValue""",
    "current_high_watermark": WITH_STATS
    + " SELECT SourceObjectId, CurrentHighWatermarkValue FROM stats",
    "incremental_window": given(SOURCES)
    + """
        SELECT event_id, user_id, value, UpdatedAt FROM payments
        WHERE UpdatedAt > TIMESTAMP '2024-01-15 00:00:00'""",
    "watermark_state": WITH_HISTORY
    + f"""
        SELECT SourceObjectId, SourceObjectName,
               coalesce((SELECT NewWatermarkValue FROM history h
                         WHERE h.SourceObjectId = r.SourceObjectId
                         ORDER BY AppliedAt DESC, WatermarkHistoryId DESC LIMIT 1),
                        {SENTINEL}) AS LastWatermarkValue
        FROM registry r""",
    # --- Journals
    "run_log_fold": WITH_RUNS
    + """
        SELECT RunId, SourceObjectId, PipelineRunId, SourceObjectName, Status,
               OldWatermarkValue, CurrentHighWatermarkValue, NewWatermarkValue,
               CASE WHEN Status <> 'Running' THEN RowsRead END AS RowsRead,
               RowsCopied, ErrorMessage, StartedAt, EndedAt
        FROM runs""",
    "failed_run_record": WITH_RUNS
    + """
        SELECT RunId, SourceObjectId, 'Failed' AS Status,
               CAST(NULL AS TIMESTAMP) AS NewWatermarkValue,
               'copy failed in run ' || RunId AS ErrorMessage,
               StartedAt + INTERVAL 5 MINUTE AS EndedAt
        FROM runs WHERE Status = 'Running'""",
    "failed_without_history": WITH_HISTORY
    + """
        SELECT RunId, SourceObjectId, StartedAt FROM runs
        WHERE Status = 'Failed' AND RunId NOT IN (SELECT RunId FROM history)""",
    "failed_with_history": WITH_HISTORY
    + """
        SELECT RunId, SourceObjectId, StartedAt FROM runs
        WHERE Status = 'Failed' AND RunId IN (SELECT RunId FROM history)""",
    "latest_failed_run": WITH_RUNS
    + f"""
        SELECT {RUN_COLUMNS} FROM runs WHERE Status = 'Failed' AND SourceObjectId = 3
        ORDER BY StartedAt DESC, RunId DESC LIMIT 1""",
    "latest_failed_run_per_source": given(RUNS, LATEST_FAILED)
    + f" SELECT {RUN_COLUMNS} FROM latest_failed",
    # --- Registry
    "active_sources": WITH_CATALOG
    + """
        SELECT SourceObjectId, SourceSystemName, SourceType, SourceObjectName
        FROM catalog WHERE IsActive""",
    "route_sources": WITH_CATALOG
    + """
        SELECT SourceObjectId, SourceType,
               CASE SourceType WHEN 'SQL_TABLE' THEN 'SQL_INCREMENTAL'
                    WHEN 'CSV_FILE' THEN 'CSV_COPY' WHEN 'JSON_FILE' THEN 'JSON_COPY'
               END AS Route
        FROM catalog WHERE IsActive""",
    "null_watermark_sources": WITH_CATALOG
    + """
        SELECT SourceObjectId, SourceObjectName FROM catalog
        WHERE SourceType = 'SQL_TABLE' AND LastWatermarkValue IS NULL""",
    "guard_initial_load_done": WITH_CATALOG
    + f"""
        SELECT SourceObjectId, SourceObjectName, LastWatermarkValue,
               CASE WHEN EXISTS (SELECT 1 FROM catalog d
                                 WHERE d.SourceObjectId = c.SourceObjectId
                                   AND d.LastWatermarkValue > {SENTINEL})
                    THEN 'PASS' ELSE '54003' END AS Guard_Status
        FROM catalog c WHERE SourceType = 'SQL_TABLE'""",
    "prepare_failure": WITH_CATALOG
    + DESTINATIONS.format(
        container=Said.FAILURE_CONTAINER, folder="DestinationFolder", now=LATER
    ),
    "restore_config": WITH_CATALOG
    + DESTINATIONS.format(
        container=Said.EXPECTED_CONTAINER, folder="'sqlserver/restored'", now=LATER
    ),
    "preview_failure": WITH_CATALOG
    + f"""
        SELECT '{Said.PREVIEW_ONLY}' AS Mode, SourceObjectName AS TargetSourceObject,
               '{Said.FAILURE_CONTAINER}' AS FailureDestinationContainer,
               '{Said.PREVIEW_TEXT}' AS Description
        FROM catalog WHERE SourceType = 'SQL_TABLE'""",
    # --- Checks
    "v1_watermark_readiness": WITH_CATALOG
    + f"""
        SELECT SourceObjectName, LastWatermarkValue,
               CASE WHEN LastWatermarkValue = {SENTINEL} THEN '{Said.NOT_READY}'
                    ELSE '{Said.READY_FOR_EMPTY_RUN}' END AS Readiness_Status
        FROM catalog WHERE SourceType = 'SQL_TABLE' ORDER BY SourceObjectName""",
    "v2_empty_run_eligibility": WITH_STATS
    + f"""
        SELECT SourceObjectName, LastWatermarkValue, CurrentHighWatermarkValue,
               Eligible_Row_Count, {EMPTY_STATUS} AS Validation_Status
        FROM stats JOIN registry USING (SourceObjectId) ORDER BY SourceObjectName""",
    "v3_run_history_summary": WITH_RUNS
    + """
        SELECT SourceObjectName, Status, count(*) AS Run_Count,
               max(StartedAt) AS Last_Run_StartedAt, max(EndedAt) AS Last_Run_EndedAt
        FROM runs GROUP BY ALL ORDER BY ALL""",
    "v4_watermark_history_summary": WITH_HISTORY
    + """
        SELECT SourceObjectName, count(WatermarkHistoryId) AS WatermarkHistory_Count,
               max(NewWatermarkValue) AS Last_History_Watermark,
               max(AppliedAt) AS Last_AppliedAt
        FROM registry LEFT JOIN history USING (SourceObjectId)
        GROUP BY SourceObjectName ORDER BY SourceObjectName""",
    "v5_retry_readiness": WITH_STATS
    + f"""
        SELECT SourceObjectName, LastWatermarkValue, CurrentHighWatermarkValue,
               CASE WHEN LastWatermarkValue = {SENTINEL} THEN '{Said.NOT_READY}'
                    WHEN CurrentHighWatermarkValue > LastWatermarkValue
                      THEN '{Said.CHANGES_ELIGIBLE}'
                    ELSE '{Said.NO_CHANGES_PENDING}' END AS Retry_Readiness_Status
        FROM registry LEFT JOIN stats USING (SourceObjectId)""",
    "v6_latest_failed_run": given(RUNS, LATEST_FAILED)
    + f"""
        SELECT PipelineRunId, SourceObjectName, Status, OldWatermarkValue,
               CurrentHighWatermarkValue, NewWatermarkValue, RowsRead, RowsCopied,
               ErrorMessage, StartedAt, EndedAt,
               CASE WHEN Status = 'Failed' AND NewWatermarkValue IS NULL
                    THEN '{Said.PASS_FAILED_RUN}' ELSE '{Said.INVALID_FAILED_RUN}'
               END AS Validation_Status
        FROM latest_failed""",
    "v7_failed_run_history_check": WITH_TRACES
    + f"""
        SELECT '{Said.HISTORY_CHECK_AREA}' AS ValidationArea, SourceObjectName,
               FailedRunId, History_Rows AS WatermarkHistory_Count,
               CASE WHEN FailedRunId IS NULL THEN '{Said.NO_FAILED_RUN}'
                    WHEN History_Rows = 0 THEN '{Said.PASS_NO_HISTORY}'
                    ELSE '{Said.FAIL_HISTORY}' END AS Validation_Status
        FROM traces""",
    "v8_retry_eligible_rows": WITH_STATS
    + f"""
        SELECT SourceObjectName, LastWatermarkValue, CurrentHighWatermarkValue,
               Eligible_Row_Count,
               CASE WHEN LastWatermarkValue = {SENTINEL} THEN '{Said.NOT_READY}'
                    WHEN Eligible_Row_Count > 0 THEN '{Said.PASS_ROWS_ELIGIBLE}'
                    ELSE '{Said.NO_ROWS_PENDING}' END AS Validation_Status
        FROM registry LEFT JOIN stats USING (SourceObjectId)""",
    "v9_retry_summary": WITH_ALL
    + f"""
        SELECT '{Said.RETRY_AREA}' AS ValidationArea, SourceObjectName,
               CASE WHEN FailedRunId IS NOT NULL THEN 'YES' ELSE 'NO' END
                 AS Failed_Run_Exists,
               coalesce(Eligible_Row_Count, 0) AS Eligible_Row_Count,
               History_Rows AS Failed_Run_WatermarkHistory_Count,
               {RETRY_STATUS} AS Validation_Status
        FROM traces LEFT JOIN stats USING (SourceObjectId)""",
    "v10_source_config": WITH_CATALOG
    + f"""
        SELECT '{Said.CURRENT_CONFIGURATION}' AS ResultType, SourceObjectId,
               SourceObjectName, LastWatermarkValue, DestinationContainer,
               DestinationFolder, DestinationFormat
        FROM catalog""",
    "operational_summary": WITH_ALL
    + f""",
        run_counts AS (
          SELECT SourceObjectId, count(*) FILTER (Status = 'Succeeded') AS s,
                 count(*) FILTER (Status = 'Failed') AS f,
                 count(*) FILTER (Status = 'Running') AS r,
                 max(StartedAt) AS Last_Run_StartedAt, max(EndedAt) AS Last_Run_EndedAt
          FROM runs GROUP BY SourceObjectId),
        marks AS (
          SELECT SourceObjectId, count(*) AS n,
                 max(NewWatermarkValue) AS Last_History_Watermark,
                 max(AppliedAt) AS Last_AppliedAt
          FROM history GROUP BY SourceObjectId)
        SELECT SourceObjectName, LastWatermarkValue, CurrentHighWatermarkValue,
               coalesce(Eligible_Row_Count, 0) AS Eligible_Row_Count,
               CASE WHEN Eligible_Row_Count IS NOT NULL THEN {EMPTY_STATUS} END
                 AS Empty_Run_Status,
               coalesce(s, 0) AS Succeeded_Run_Count, coalesce(f, 0) AS Failed_Run_Count,
               coalesce(r, 0) AS Running_Run_Count, Last_Run_StartedAt,
               Last_Run_EndedAt, coalesce(n, 0) AS WatermarkHistory_Count,
               Last_History_Watermark, Last_AppliedAt,
               CASE WHEN FailedRunId IS NOT NULL THEN 'YES' ELSE 'NO' END
                 AS Failed_Run_Exists,
               History_Rows AS Failed_Run_WatermarkHistory_Count,
               {RETRY_STATUS} AS Retry_Status
        FROM traces LEFT JOIN stats USING (SourceObjectId)
        LEFT JOIN run_counts USING (SourceObjectId)
        LEFT JOIN marks USING (SourceObjectId)
        ORDER BY SourceObjectName""",
    # --- Checks over one source per customer
    "v2_eligibility_many_sources": WITH_MANY
    + f"""
        SELECT SourceObjectName, LastWatermarkValue, CurrentHighWatermarkValue,
               Eligible_Row_Count, {EMPTY_STATUS} AS Validation_Status
        FROM many JOIN catalog USING (SourceObjectId)""",
    "v8_retry_rows_many_sources": WITH_MANY
    + f"""
        SELECT SourceObjectName, LastWatermarkValue, CurrentHighWatermarkValue,
               Eligible_Row_Count,
               CASE WHEN LastWatermarkValue = {SENTINEL} THEN '{Said.NOT_READY}'
                    WHEN Eligible_Row_Count > 0 THEN '{Said.PASS_ROWS_ELIGIBLE}'
                    ELSE '{Said.NO_ROWS_PENDING}' END AS Validation_Status
        FROM catalog LEFT JOIN many USING (SourceObjectId)
        WHERE SourceType = 'SQL_TABLE'""",
    "pending_many_sources": WITH_MANY
    + """
        SELECT SourceObjectId, Eligible_Row_Count FROM many
        WHERE Eligible_Row_Count > 0""",
    # --- Scenarios
    "scenario_insert": """
        WITH marks AS (
          SELECT max(o_orderdate) FILTER (o_orderdate <= TIMESTAMP '2001-01-01 00:00:00')
                   AS old, max(o_orderdate) AS new,
                 count(*) FILTER (o_orderdate > TIMESTAMP '2001-01-01 00:00:00') AS n
          FROM orders)
        SELECT o_orderkey, o_totalprice, o_orderdate AS UpdatedAt,
               old AS OldWatermarkValue, new AS NewWatermarkValue, n AS RowsCopied
        FROM orders, marks WHERE o_orderdate > old""",
    "scenario_update": """
        WITH marks AS (
          SELECT max(o_orderdate) AS old,
                 count(*) FILTER (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') AS n
          FROM orders)
        SELECT o_orderkey, o_totalprice + 1 AS o_totalprice,
               TIMESTAMP '2001-08-02 00:00:00' AS UpdatedAt, old AS OldWatermarkValue,
               TIMESTAMP '2001-08-02 00:00:00' AS NewWatermarkValue, n AS RowsCopied
        FROM orders, marks
        WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'""",
    "scenario_refund": """
        WITH refunds AS (
          SELECT 'Orders' AS SourceObjectName, max(o_orderdate) AS OldWatermarkValue,
                 count(*) FILTER (o_orderstatus = 'P' AND o_orderpriority = '5-LOW') AS n
          FROM orders
          UNION ALL
          SELECT 'Payments', max(date_trunc('millisecond', ts)), count(*) FILTER (value >= 100)
          FROM events WHERE event_type = 'purchase')
        SELECT SourceObjectName, OldWatermarkValue,
               TIMESTAMP '2024-02-01 00:00:00' AS NewWatermarkValue, n AS RowsCopied,
               n AS RowsInBronze, n AS RowsRefunded
        FROM refunds""",
    "scenario_empty": f"""
        SELECT 'Orders' AS SourceObjectName, max(o_orderdate) AS LastWatermarkValue,
               max(o_orderdate) AS CurrentHighWatermarkValue,
               CAST(0 AS BIGINT) AS Eligible_Row_Count,
               '{Said.PASS_EMPTY_READY}' AS Validation_Status, 'Succeeded' AS Status,
               CAST(0 AS BIGINT) AS RowsRead, CAST(0 AS BIGINT) AS RowsCopied,
               max(o_orderdate) AS NewWatermarkValue, CAST(1 AS BIGINT) AS History_Rows
        FROM orders""",
    "scenario_retry": """
        WITH pending AS (
          SELECT count(*) FILTER (o_orderdate > TIMESTAMP '2001-01-01 00:00:00') AS n,
                 max(o_orderdate) AS high
          FROM orders)
        SELECT 'Failed' AS Status, TIMESTAMP '2001-01-01 00:00:00' AS OldWatermarkValue,
               high AS CurrentHighWatermarkValue,
               CAST(NULL AS TIMESTAMP) AS NewWatermarkValue,
               CAST(NULL AS BIGINT) AS RowsRead, CAST(NULL AS BIGINT) AS RowsCopied,
               CAST(0 AS BIGINT) AS History_Rows
        FROM pending
        UNION ALL
        SELECT 'Succeeded', TIMESTAMP '2001-01-01 00:00:00', high, high, n, n, 1
        FROM pending""",
}
