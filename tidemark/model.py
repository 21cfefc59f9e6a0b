"""Schemas of the control tables and sample files, and the fixed values."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import types as T

# --- Fixed values: the texts and codes users of the checks rely on -----------

# Mark of a source whose initial load has not been done.
SENTINEL = datetime(1900, 1, 1)

# Source types.
SQL_TABLE = "SQL_TABLE"
CSV_FILE = "CSV_FILE"
JSON_FILE = "JSON_FILE"

# Run states.
RUNNING = "Running"
SUCCEEDED = "Succeeded"
FAILED = "Failed"

# Storage zones.
ZONES = ("landing", "bronze", "rejected", "metadata", "evidence")

# Check states.
NOT_READY = "NOT_READY_INITIAL_LOAD_NOT_COMPLETED"
READY_FOR_EMPTY_RUN = "READY_FOR_EMPTY_RUN_CHECK"
PASS_EMPTY_READY = "PASS_EMPTY_READY"
CHANGES_PENDING = "CHANGES_PENDING"
CHANGES_ELIGIBLE = "CHANGES_ELIGIBLE_FOR_RETRY"
NO_CHANGES_PENDING = "NO_CHANGES_PENDING"
PASS_FAILED_RUN = "PASS_FAILED_RUN_RECORDED"
INVALID_FAILED_RUN = "NO_FAILED_RUN_FOUND_OR_INVALID"
NO_FAILED_RUN = "NO_FAILED_RUN_FOUND_YET"
PASS_NO_HISTORY = "PASS_NO_WATERMARK_HISTORY_FOR_FAILED_RUN"
FAIL_HISTORY = "FAIL_WATERMARK_HISTORY_EXISTS_FOR_FAILED_RUN"
PASS_ROWS_ELIGIBLE = "PASS_ROWS_STILL_ELIGIBLE_FOR_RETRY"
NO_ROWS_PENDING = "NO_ROWS_PENDING_FOR_RETRY"
PASS_RETRY = "PASS_RETRY_VALIDATION"
REVIEW_REQUIRED = "REVIEW_REQUIRED"

# Constant columns of the checks.
HISTORY_CHECK_AREA = "Latest failed run watermark history check"
RETRY_AREA = "Retry After Failure"

# Controlled failure: actions, result types, destination values, messages.
PREVIEW = "PREVIEW"
PREPARE_FAILURE = "PREPARE_FAILURE"
RESTORE_CONFIGURATION = "RESTORE_CONFIGURATION"
CURRENT_CONFIGURATION = "CURRENT_CONFIGURATION"
FAILURE_PREPARED = "FAILURE_CONFIGURATION_PREPARED"
CONFIGURATION_RESTORED = "CONFIGURATION_RESTORED"
PREVIEW_ONLY = "PREVIEW_ONLY"
RESTORE_NOTE = "RESTORE_COMMAND_NOTE"
EXPECTED_CONTAINER = "bronze"
FAILURE_CONTAINER = "bronze_invalid_for_failure_test"
PREVIEW_TEXT = (
    "When @Action = PREPARE_FAILURE, DestinationContainer will be changed "
    "temporarily to force an ADF Copy Activity failure."
)
RESTORE_TEXT = (
    "After failure evidence is captured, run this script with "
    "@Action = RESTORE_CONFIGURATION."
)

# Guard numbers and messages.
GUARD_MESSAGES = {
    54001: "Target SourceObject was not found.",
    54002: (
        "Invalid @Action. Expected PREVIEW, PREPARE_FAILURE, or "
        "RESTORE_CONFIGURATION."
    ),
    54003: (
        "Initial full load does not appear to be completed. Do not prepare "
        "failure before watermarks have advanced."
    ),
    55001: "Target SourceObject was not found.",
}

# --- Control tables -----------------------------------------------------------

SOURCE_OBJECT = T.StructType(
    [
        T.StructField("SourceObjectId", T.IntegerType()),
        T.StructField("SourceSystemName", T.StringType()),
        T.StructField("SourceType", T.StringType()),
        T.StructField("SourceSchema", T.StringType()),
        T.StructField("SourceObjectName", T.StringType()),
        T.StructField("LoadType", T.StringType()),
        T.StructField("WatermarkColumn", T.StringType()),
        T.StructField("IsActive", T.BooleanType()),
        T.StructField("LastWatermarkValue", T.TimestampNTZType()),
        T.StructField("DestinationContainer", T.StringType()),
        T.StructField("DestinationFolder", T.StringType()),
        T.StructField("DestinationFormat", T.StringType()),
        T.StructField("UpdatedAt", T.TimestampNTZType()),
    ]
)

INGESTION_RUN = T.StructType(
    [
        T.StructField("RunId", T.StringType()),
        T.StructField("SourceObjectId", T.IntegerType()),
        T.StructField("PipelineRunId", T.StringType()),
        T.StructField("SourceObjectName", T.StringType()),
        T.StructField("Status", T.StringType()),
        T.StructField("OldWatermarkValue", T.TimestampNTZType()),
        T.StructField("CurrentHighWatermarkValue", T.TimestampNTZType()),
        T.StructField("NewWatermarkValue", T.TimestampNTZType()),
        T.StructField("RowsRead", T.LongType()),
        T.StructField("RowsCopied", T.LongType()),
        T.StructField("ErrorMessage", T.StringType()),
        T.StructField("StartedAt", T.TimestampNTZType()),
        T.StructField("EndedAt", T.TimestampNTZType()),
    ]
)

# The run journal: one row per state change, `Seq` counts them within a run.
RUN_JOURNAL = T.StructType(
    INGESTION_RUN.fields + [T.StructField("Seq", T.IntegerType())]
)

# The registry journal: one row per change, `Version` counts them per source.
SOURCE_JOURNAL = T.StructType(
    SOURCE_OBJECT.fields + [T.StructField("Version", T.LongType())]
)

WATERMARK_HISTORY = T.StructType(
    [
        T.StructField("WatermarkHistoryId", T.LongType()),
        T.StructField("SourceObjectId", T.IntegerType()),
        T.StructField("RunId", T.StringType()),
        T.StructField("NewWatermarkValue", T.TimestampNTZType()),
        T.StructField("AppliedAt", T.TimestampNTZType()),
    ]
)

# --- Sample files -------------------------------------------------------------

CURRENCY_RATES = T.StructType(
    [
        T.StructField("RateDate", T.DateType()),
        T.StructField("BaseCurrency", T.StringType()),
        T.StructField("TargetCurrency", T.StringType()),
        T.StructField("ExchangeRate", T.DecimalType(18, 4)),
        T.StructField("SourceSystem", T.StringType()),
    ]
)

# IsActive is a 0/1 flag in the file; read as BooleanType it would be NULL.
COUNTRY_CURRENCY = T.StructType(
    [
        T.StructField("CountryCode", T.StringType()),
        T.StructField("CountryName", T.StringType()),
        T.StructField("CurrencyCode", T.StringType()),
        T.StructField("CurrencyName", T.StringType()),
        T.StructField("IsActive", T.IntegerType()),
    ]
)

# created_at carries a zone (`Z`); read as TimestampNTZType it would be NULL.
MANUAL_ADJUSTMENTS = T.StructType(
    [
        T.StructField("adjustment_batch_id", T.StringType()),
        T.StructField("source_system_name", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField(
            "adjustments",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("adjustment_id", T.StringType()),
                        T.StructField("entity_type", T.StringType()),
                        T.StructField("entity_reference", T.StringType()),
                        T.StructField("adjustment_type", T.StringType()),
                        T.StructField("reason", T.StringType()),
                        T.StructField("is_active", T.BooleanType()),
                    ]
                )
            ),
        ),
    ]
)

SOURCE_METADATA = T.StructType(
    [
        T.StructField("source_system_name", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("environment", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField(
            "tables",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("schema", T.StringType()),
                        T.StructField("table", T.StringType()),
                        T.StructField("load_type", T.StringType()),
                        T.StructField("watermark_column", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

# The column that holds a line or document the declared schema does not fit.
CORRUPT_RECORD = "_corrupt_record"


class GuardError(Exception):
    """A guard refused; `number` is one of GUARD_MESSAGES."""

    def __init__(self, number: int):
        self.number = number
        super().__init__(f"{number}: {GUARD_MESSAGES[number]}")
