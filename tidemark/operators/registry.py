"""The source registry: selection, routing, guarded changes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ntz
from tidemark.model import (
    CSV_FILE,
    EXPECTED_CONTAINER,
    FAILURE_CONTAINER,
    JSON_FILE,
    PREPARE_FAILURE,
    PREVIEW,
    PREVIEW_ONLY,
    PREVIEW_TEXT,
    RESTORE_CONFIGURATION,
    RESTORE_NOTE,
    RESTORE_TEXT,
    SENTINEL,
    SQL_TABLE,
    GuardError,
)

SQL_ROUTE = "SQL_INCREMENTAL"
CSV_ROUTE = "CSV_COPY"
JSON_ROUTE = "JSON_COPY"
ROUTES = {SQL_TABLE: SQL_ROUTE, CSV_FILE: CSV_ROUTE, JSON_FILE: JSON_ROUTE}


def active_sources(registry: DataFrame) -> DataFrame:
    return registry.where("IsActive")


def route_sources(registry: DataFrame) -> DataFrame:
    """Add `Route`: which kind of load serves a source. NULL: none does."""
    route = F.lit(None).cast("string")
    for source_type, name in ROUTES.items():
        route = F.when(F.col("SourceType") == source_type, name).otherwise(route)
    return registry.withColumn("Route", route)


def route_of(source_type: str) -> str:
    """`route_sources` for one value; raises for an unknown type."""
    if source_type not in ROUTES:
        raise ValueError(f"no load serves source type {source_type!r}")
    return ROUTES[source_type]


def sql_sources(registry: DataFrame) -> DataFrame:
    return registry.where(F.col("SourceType") == SQL_TABLE)


def find_source(
    registry: DataFrame,
    system: str,
    schema: str,
    name: str,
    source_type: str = SQL_TABLE,
) -> DataFrame:
    """Registry rows with exactly this identity; case matters."""
    return registry.where(
        (F.col("SourceSystemName") == system)
        & (F.col("SourceType") == source_type)
        & (F.col("SourceSchema") == schema)
        & (F.col("SourceObjectName") == name)
    )


def null_watermark_sources(registry: DataFrame) -> DataFrame:
    """SQL sources with no mark at all, which the empty-run check lets pass."""
    return sql_sources(registry).where(F.col("LastWatermarkValue").isNull())


def is_loaded() -> Column:
    """Initial load done: a mark above the sentinel. A NULL mark is not."""
    return F.coalesce(F.col("LastWatermarkValue") > ntz(SENTINEL), F.lit(False))


def guard_initial_load_done(registry: DataFrame) -> DataFrame:
    """The initial-load guard as a column, for every SQL source."""
    return sql_sources(registry).select(
        "SourceObjectId",
        "SourceObjectName",
        "LastWatermarkValue",
        F.when(is_loaded(), "PASS").otherwise("54003").alias("Guard_Status"),
    )


# --- Guards: they run when called, on the driver ------------------------------


def require_source(
    registry: DataFrame, system: str, schema: str, name: str, number: int = 54001
):
    """The id of a SQL source, or GuardError 54001 (55001 for the retry checks)."""
    found = find_source(registry, system, schema, name).select("SourceObjectId").first()
    if found is None or found[0] is None:
        raise GuardError(number)
    return found[0]


def require_action(action: str) -> None:
    if action not in (PREVIEW, PREPARE_FAILURE, RESTORE_CONFIGURATION):
        raise GuardError(54002)


def require_loaded(registry: DataFrame, source_id) -> None:
    target = registry.where(F.col("SourceObjectId") == F.lit(source_id))
    if target.where(is_loaded()).isEmpty():
        raise GuardError(54003)


# --- Changes ------------------------------------------------------------------


def set_destination(
    registry: DataFrame,
    source_id,
    container: str,
    now: datetime,
    folder: str | None = None,
) -> DataFrame:
    """The registry with one destination changed; every other row as it was."""
    mine = F.col("SourceObjectId") == F.lit(source_id)

    def change(column: str, value: Column) -> Column:
        return F.when(mine, value).otherwise(F.col(column))

    changes = {
        "DestinationContainer": change("DestinationContainer", F.lit(container)),
        "UpdatedAt": change("UpdatedAt", ntz(now)),
    }
    if folder is not None:
        changes["DestinationFolder"] = change("DestinationFolder", F.lit(folder))
    return registry.withColumns(changes)


def prepare_failure(registry: DataFrame, source_id, now: datetime) -> DataFrame:
    """Point a loaded source at a container that does not work."""
    require_loaded(registry, source_id)
    return set_destination(registry, source_id, FAILURE_CONTAINER, now)


def restore_config(
    registry: DataFrame, source_id, folder: str, now: datetime
) -> DataFrame:
    """Give a source its expected container and folder back."""
    return set_destination(registry, source_id, EXPECTED_CONTAINER, now, folder)


def preview_failure(targets: DataFrame) -> DataFrame:
    """What `prepare_failure` would do to each target; changes nothing."""
    return targets.select(
        F.lit(PREVIEW_ONLY).alias("Mode"),
        F.col("SourceObjectName").alias("TargetSourceObject"),
        F.lit(FAILURE_CONTAINER).alias("FailureDestinationContainer"),
        F.lit(PREVIEW_TEXT).alias("Description"),
    )


def restore_note(targets: DataFrame) -> DataFrame:
    """The reminder that goes with the preview."""
    return targets.select(
        F.lit(RESTORE_NOTE).alias("NoteType"), F.lit(RESTORE_TEXT).alias("Note")
    )


# --- Registry rows from source metadata documents -----------------------------


def destination_folder() -> Column:
    """Where a SQL source lands: lower-cased system, schema and table."""
    return F.lower(
        F.concat_ws(
            "/",
            F.lit("sqlserver"),
            F.col("SourceSystemName"),
            F.col("SourceSchema"),
            F.col("SourceObjectName"),
        )
    )


def registry_from_metadata(
    documents: DataFrame, now: datetime, first_id: Column | int = 1
) -> DataFrame:
    """Registry rows of the tables a source system document lists.

    Ids count up from `first_id` within a document, so several documents need a
    column of first ids; a plain number would give them the same ids. New sources are
    active and carry the sentinel. A document without tables has no rows.
    """
    if isinstance(first_id, int) and len(documents.select("source_system_name").take(2)) > 1:
        raise ValueError("several documents need a column of first ids")
    first = F.lit(first_id) if isinstance(first_id, int) else first_id
    listed = documents.select(
        F.col("source_system_name").alias("SourceSystemName"),
        first.alias("first_id"),
        F.posexplode("tables").alias("pos", "t"),
    )
    return listed.select(
        (F.col("first_id") + F.col("pos")).alias("SourceObjectId"),
        "SourceSystemName",
        F.lit(SQL_TABLE).alias("SourceType"),
        F.col("t.schema").alias("SourceSchema"),
        F.col("t.table").alias("SourceObjectName"),
        F.col("t.load_type").alias("LoadType"),
        F.col("t.watermark_column").alias("WatermarkColumn"),
        F.lit(True).alias("IsActive"),
        ntz(SENTINEL).alias("LastWatermarkValue"),
        F.lit(EXPECTED_CONTAINER).alias("DestinationContainer"),
    ).withColumns(
        {
            "DestinationFolder": destination_folder(),
            "DestinationFormat": F.lit("parquet"),
            "UpdatedAt": ntz(now),
        }
    )


def explode_adjustments(documents: DataFrame) -> DataFrame:
    """One row per adjustment, with its batch; a batch without any has no row."""
    return documents.select(
        "adjustment_batch_id",
        "source_system_name",
        "created_at",
        F.inline("adjustments"),
    )
