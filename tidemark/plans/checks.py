"""The checks, each over all sources at once.

For a single source, filter the result (`SourceObjectName == "Orders"`). Three
different answers for an empty source are on purpose: the empty-run check
leaves it out, the retry row check counts NULL, the retry summary counts 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import model as m
from tidemark.functions import is_sentinel
from tidemark.operators.joins import at_most
from tidemark.operators.journals import latest_failed_run
from tidemark.operators.registry import sql_sources
from tidemark.operators.windows import (
    Sources,
    current_high_watermark,
    pending_counts,
    source_stats,
)


# Reports are sorted by name. The id lets a sort split a name that many systems
# share, and makes the order repeatable.
BY_NAME = ("SourceObjectName", "SourceObjectId")


def watermark_readiness(registry: DataFrame) -> DataFrame:
    """V1: has the initial load of each SQL source been done?"""
    return (
        sql_sources(registry)
        .orderBy(*BY_NAME)
        .select(
            "SourceObjectName",
            "LastWatermarkValue",
            F.when(is_sentinel("LastWatermarkValue"), m.NOT_READY)
            .otherwise(m.READY_FOR_EMPTY_RUN)
            .alias("Readiness_Status"),
        )
    )


def eligibility(sources: Sources, registry: DataFrame) -> DataFrame:
    """V2: would an incremental run now find nothing to copy?

    An empty source has no row here. A source with a NULL mark passes, as no
    row is above NULL; `null_watermark_sources` lists those.
    """
    sql = sql_sources(registry)
    return (
        source_stats(sources, sql)
        .join(sql, "SourceObjectId")
        .orderBy(*BY_NAME)
        .select(
            "SourceObjectName",
            "LastWatermarkValue",
            "CurrentHighWatermarkValue",
            "Eligible_Row_Count",
            empty_run_status().alias("Validation_Status"),
        )
    )


def empty_run_status() -> Column:
    return (
        F.when(is_sentinel("LastWatermarkValue"), m.NOT_READY)
        .when(F.col("Eligible_Row_Count") == 0, m.PASS_EMPTY_READY)
        .otherwise(m.CHANGES_PENDING)
    )


def run_history_summary(runs: DataFrame) -> DataFrame:
    """V3: runs per source name and status."""
    return (
        runs.groupBy("SourceObjectName", "Status")
        .agg(
            F.count(F.lit(1)).alias("Run_Count"),
            F.max("StartedAt").alias("Last_Run_StartedAt"),
            F.max("EndedAt").alias("Last_Run_EndedAt"),
        )
        .orderBy("SourceObjectName", "Status")
    )


def history_per_source(history: DataFrame) -> DataFrame:
    """History reduced to one row per source id."""
    return history.groupBy("SourceObjectId").agg(
        F.count("WatermarkHistoryId").alias("WatermarkHistory_Count"),
        F.max("NewWatermarkValue").alias("Last_History_Watermark"),
        F.max("AppliedAt").alias("Last_AppliedAt"),
    )


def watermark_history_summary(registry: DataFrame, history: DataFrame) -> DataFrame:
    """V4: history per SQL source; one without history stays, with count 0.

    The history is reduced before the join, which then meets one row per source
    instead of every advance ever made. Sources that share a name share a row.
    """
    return (
        sql_sources(registry)
        .select("SourceObjectId", "SourceObjectName")
        .join(history_per_source(history), "SourceObjectId", "left")
        .groupBy("SourceObjectName")
        .agg(
            F.coalesce(F.sum("WatermarkHistory_Count"), F.lit(0)).alias(
                "WatermarkHistory_Count"
            ),
            F.max("Last_History_Watermark").alias("Last_History_Watermark"),
            F.max("Last_AppliedAt").alias("Last_AppliedAt"),
        )
        .orderBy("SourceObjectName")
    )


def retry_readiness(sources: Sources, registry: DataFrame) -> DataFrame:
    """V5: is anything above the mark of each SQL source?"""
    sql = sql_sources(registry)
    return sql.join(
        current_high_watermark(sources, sql), "SourceObjectId", "left"
    ).select(
        "SourceObjectName",
        "LastWatermarkValue",
        "CurrentHighWatermarkValue",
        F.when(is_sentinel("LastWatermarkValue"), m.NOT_READY)
        .when(
            F.col("CurrentHighWatermarkValue") > F.col("LastWatermarkValue"),
            m.CHANGES_ELIGIBLE,
        )
        .otherwise(m.NO_CHANGES_PENDING)
        .alias("Retry_Readiness_Status"),
    )


def failed_run_check(runs: DataFrame) -> DataFrame:
    """V6: the latest failed run per source, and whether it is recorded well.

    A source without a failed run has no row; the second state means a failed
    run that carries a new mark. The run log alone is asked, so runs of file sources
    are checked too, while the checks that look at marks and history cover SQL sources.
    """
    good = (F.col("Status") == m.FAILED) & F.col("NewWatermarkValue").isNull()
    return latest_failed_run(runs).select(
        "PipelineRunId",
        "SourceObjectName",
        "Status",
        "OldWatermarkValue",
        "CurrentHighWatermarkValue",
        "NewWatermarkValue",
        "RowsRead",
        "RowsCopied",
        "ErrorMessage",
        "StartedAt",
        "EndedAt",
        F.when(good, m.PASS_FAILED_RUN)
        .otherwise(m.INVALID_FAILED_RUN)
        .alias("Validation_Status"),
    )


def failed_run_traces(
    registry: DataFrame, runs: DataFrame, history: DataFrame
) -> DataFrame:
    """Per SQL source: its latest failed run and that run's history rows.

    Adds FailedRunId, History_Ids (non-NULL ids) and History_Rows to the
    registry. There is at most one failed run per registry row, so a registry
    of known size bounds the set of ids the history is filtered by, and only
    matching history rows are shuffled. A larger registry makes no such
    promise: the history is then counted per run first, which also reduces a
    run written many times, and joined without a hint.
    """
    sql = sql_sources(registry)
    failed = latest_failed_run(
        runs.select("RunId", "SourceObjectId", "Status", "StartedAt")
    ).select("SourceObjectId", F.col("RunId").alias("FailedRunId"))
    known = sql.join(failed, "SourceObjectId", "left")

    traces = history.select("RunId", "WatermarkHistoryId")
    if at_most(sql.select("SourceObjectId")):
        wanted = known.where(F.col("FailedRunId").isNotNull()).select(
            F.col("FailedRunId").alias("RunId")
        )
        traces = traces.join(F.broadcast(wanted), "RunId", "left_semi")
    counts = traces.groupBy("RunId").agg(
        F.count("WatermarkHistoryId").alias("History_Ids"),
        F.count(F.lit(1)).alias("History_Rows"),
    )
    # A source without a failed run must match nothing. Such sources may be many;
    # a key of their own each keeps their NULLs out of one task.
    own_key = F.concat(F.lit("no run of "), F.col("SourceObjectId").cast("string"))
    same_run = F.coalesce("FailedRunId", own_key) == F.col("RunId")
    return (
        known.join(counts, same_run & F.col("FailedRunId").isNotNull(), "left")
        .drop("RunId")
        .fillna(0, ["History_Ids", "History_Rows"])
    )


def failed_run_history_check(
    registry: DataFrame, runs: DataFrame, history: DataFrame
) -> DataFrame:
    """V7: the latest failed run must have left no history."""
    return failed_run_traces(registry, runs, history).select(
        F.lit(m.HISTORY_CHECK_AREA).alias("ValidationArea"),
        "SourceObjectName",
        "FailedRunId",
        F.col("History_Ids").alias("WatermarkHistory_Count"),
        F.when(F.col("FailedRunId").isNull(), m.NO_FAILED_RUN)
        .when(F.col("History_Ids") == 0, m.PASS_NO_HISTORY)
        .otherwise(m.FAIL_HISTORY)
        .alias("Validation_Status"),
    )


def retry_eligible_rows(sources: Sources, registry: DataFrame) -> DataFrame:
    """V8: how many rows would a retry read? NULL for an empty source."""
    sql = sql_sources(registry)
    return sql.join(source_stats(sources, sql), "SourceObjectId", "left").select(
        "SourceObjectName",
        "LastWatermarkValue",
        "CurrentHighWatermarkValue",
        "Eligible_Row_Count",
        F.when(is_sentinel("LastWatermarkValue"), m.NOT_READY)
        .when(F.col("Eligible_Row_Count") > 0, m.PASS_ROWS_ELIGIBLE)
        .otherwise(m.NO_ROWS_PENDING)
        .alias("Validation_Status"),
    )


def retry_status() -> Column:
    """State of the retry summary from mark, failed run, traces and count."""
    return (
        F.when(is_sentinel("LastWatermarkValue"), m.NOT_READY)
        .when(F.col("FailedRunId").isNull(), m.NO_FAILED_RUN)
        .when(
            (F.col("History_Rows") == 0) & (F.col("Eligible_Row_Count") > 0),
            m.PASS_RETRY,
        )
        .otherwise(m.REVIEW_REQUIRED)
    )


def failed_run_exists() -> Column:
    return F.when(F.col("FailedRunId").isNotNull(), "YES").otherwise("NO")


def retry_summary(
    registry: DataFrame, runs: DataFrame, history: DataFrame, sources: Sources
) -> DataFrame:
    """V9: failed run, its traces and the pending rows in one line per source.

    After a good retry this says REVIEW_REQUIRED: the failed run is still the
    latest failed one and nothing is pending any more.
    """
    return (
        failed_run_traces(registry, runs, history)
        .join(pending_counts(sources, sql_sources(registry)), "SourceObjectId", "left")
        .fillna(0, ["Eligible_Row_Count"])
        .select(
            F.lit(m.RETRY_AREA).alias("ValidationArea"),
            "SourceObjectName",
            failed_run_exists().alias("Failed_Run_Exists"),
            "Eligible_Row_Count",
            F.col("History_Rows").alias("Failed_Run_WatermarkHistory_Count"),
            retry_status().alias("Validation_Status"),
        )
    )


def source_config(
    registry: DataFrame, result_type: str = m.CURRENT_CONFIGURATION
) -> DataFrame:
    """V10: the configuration of the given registry rows."""
    return registry.select(
        F.lit(result_type).alias("ResultType"),
        "SourceObjectId",
        "SourceObjectName",
        "LastWatermarkValue",
        "DestinationContainer",
        "DestinationFolder",
        "DestinationFormat",
    )


def run_facts(runs: DataFrame) -> DataFrame:
    """Counts, times and the latest failed run of every source, in one aggregation."""

    def runs_in(status: str) -> Column:
        return F.count_if(F.col("Status") == status)

    failed = F.when(F.col("Status") == m.FAILED, F.struct("StartedAt", "RunId"))
    return runs.groupBy("SourceObjectId").agg(
        runs_in(m.SUCCEEDED).alias("Succeeded_Run_Count"),
        runs_in(m.FAILED).alias("Failed_Run_Count"),
        runs_in(m.RUNNING).alias("Running_Run_Count"),
        F.max("StartedAt").alias("Last_Run_StartedAt"),
        F.max("EndedAt").alias("Last_Run_EndedAt"),
        F.max_by("RunId", failed).alias("FailedRunId"),
    )


def source_facts(registry: DataFrame, runs: DataFrame, history: DataFrame) -> DataFrame:
    """The registry with what both journals say of each source, each read once.

    A run's entries in the history count for the source that the history names and, if
    the run is a source's latest failed one, as that source's traces. So the history,
    reduced per run and source, meets the latest failed runs once, and what
    comes of it is summed per source. Sources that have no failed run get a key of their
    own there, so that they aren't gathered.
    """
    known = registry.join(run_facts(runs), "SourceObjectId", "left")
    own_key = F.concat(F.lit("no run of "), F.col("SourceObjectId").cast("string"))
    facts = known.select(
        F.coalesce("FailedRunId", own_key).alias("RunKey"),
        F.struct(*known.columns).alias("Facts"),
    )
    per_run = history.groupBy("RunId", "SourceObjectId").agg(
        F.count("WatermarkHistoryId").alias("Ids"),
        F.count(F.lit(1)).alias("Rows"),
        F.max("NewWatermarkValue").alias("Mark"),
        F.max("AppliedAt").alias("At"),
    )
    both = per_run.join(facts, F.col("RunId") == F.col("RunKey"), "full")

    def part(source: Column, **values: Column) -> Column:
        kinds = {"Facts": facts.schema["Facts"].dataType, "Ids": "bigint", "Rows": "bigint",
                 "Mark": "timestamp_ntz", "At": "timestamp_ntz"}
        nothing = F.lit(None)
        return F.struct(
            source.cast("bigint").alias("Id"),
            *(values.get(n, nothing).cast(kind).alias(n) for n, kind in kinds.items()),
        )

    totals = part(F.col("SourceObjectId"), Ids=F.col("Ids"), Mark=F.col("Mark"), At=F.col("At"))
    traces = part(F.col("Facts.SourceObjectId"), Facts=F.col("Facts"), Rows=F.col("Rows"))
    summed = (
        both.select(F.explode(F.array(totals, traces)).alias("part"))
        .select("part.*")
        .where(F.col("Id").isNotNull())
        .groupBy("Id")
        .agg(
            F.first("Facts", ignorenulls=True).alias("Facts"),
            F.sum("Ids").alias("WatermarkHistory_Count"),
            F.max("Mark").alias("Last_History_Watermark"),
            F.max("At").alias("Last_AppliedAt"),
            F.sum("Rows").alias("History_Rows"),
        )
        .where(F.col("Facts").isNotNull())
    )
    return summed.select(
        "Facts.*",
        "WatermarkHistory_Count",
        "Last_History_Watermark",
        "Last_AppliedAt",
        "History_Rows",
    ).fillna(
        0,
        [
            "Succeeded_Run_Count",
            "Failed_Run_Count",
            "Running_Run_Count",
            "WatermarkHistory_Count",
            "History_Rows",
        ],
    )


def operational_summary(
    registry: DataFrame, runs: DataFrame, history: DataFrame, sources: Sources
) -> DataFrame:
    """One line per SQL source across all checks.

    Every source is read once: the pass that finds the high mark also counts
    the pending rows; and so is each journal. Empty_Run_Status is NULL for a source
    without rows.
    """
    sql = sql_sources(registry)
    return (
        source_facts(sql, runs, history)
        .join(source_stats(sources, sql), "SourceObjectId", "left")
        .withColumn(
            "Empty_Run_Status",
            F.when(F.col("Eligible_Row_Count").isNotNull(), empty_run_status()),
        )
        .fillna(0, ["Eligible_Row_Count"])
        .orderBy(*BY_NAME)
        .select(
            "SourceObjectName",
            "LastWatermarkValue",
            "CurrentHighWatermarkValue",
            "Eligible_Row_Count",
            "Empty_Run_Status",
            "Succeeded_Run_Count",
            "Failed_Run_Count",
            "Running_Run_Count",
            "Last_Run_StartedAt",
            "Last_Run_EndedAt",
            "WatermarkHistory_Count",
            "Last_History_Watermark",
            "Last_AppliedAt",
            failed_run_exists().alias("Failed_Run_Exists"),
            F.col("History_Rows").alias("Failed_Run_WatermarkHistory_Count"),
            retry_status().alias("Retry_Status"),
        )
    )
