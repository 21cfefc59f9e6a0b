"""Folding the append-only journals into states.

Nothing is updated in place. A run writes one row per state change, the
registry one row per change of a source, the history one row per advance of a
mark; these functions give the current state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tidemark.functions import ntz
from tidemark.model import (
    FAILED,
    INGESTION_RUN,
    RUNNING,
    SENTINEL,
    SOURCE_OBJECT,
    SUCCEEDED,
)

def latest_per_key(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row per key in the given order.

    The rank filter gets a partial step below the exchange, so a partition
    sends at most one row per key, also for a key that owns most of the rows.
    """
    ranked = Window.partitionBy(key).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def last_run_rows(journal: DataFrame) -> DataFrame:
    """The last journal row of each run."""
    return latest_per_key(
        journal, "RunId", F.col("Seq").desc(), F.col("EndedAt").desc_nulls_last()
    )


def run_state(journal: DataFrame) -> DataFrame:
    """One row per run, in its last journalled state."""
    return last_run_rows(journal).select(INGESTION_RUN.names)


def last_source_rows(journal: DataFrame) -> DataFrame:
    """The last journal row of each source."""
    return latest_per_key(journal, "SourceObjectId", F.col("Version").desc())


def registry_state(journal: DataFrame) -> DataFrame:
    """One row per source, as last changed."""
    return last_source_rows(journal).select(SOURCE_OBJECT.names)


def watermark_state(registry: DataFrame, history: DataFrame) -> DataFrame:
    """The registry with each mark as last applied, or the sentinel if never."""
    applied = history.groupBy("SourceObjectId").agg(
        F.max_by(
            "NewWatermarkValue", F.struct("AppliedAt", "WatermarkHistoryId")
        ).alias("Applied")
    )
    mark = F.coalesce("Applied", ntz(SENTINEL))
    return (
        registry.join(applied, "SourceObjectId", "left")
        .withColumn("LastWatermarkValue", mark)
        .select(registry.columns)
    )


def latest_failed_run(runs: DataFrame) -> DataFrame:
    """The latest failed run of every source; RunId breaks ties."""
    return latest_per_key(
        runs.where(F.col("Status") == FAILED),
        "SourceObjectId",
        F.col("StartedAt").desc(),
        F.col("RunId").desc(),
    )


def latest_failed_run_of(runs: DataFrame, source_id) -> DataFrame:
    """The latest failed run of one source: a top-1, without a full sort."""
    mine = F.col("SourceObjectId") == F.lit(source_id)
    return (
        runs.where(mine & (F.col("Status") == FAILED))
        .orderBy(F.col("StartedAt").desc(), F.col("RunId").desc())
        .limit(1)
    )


def failed_with_history(runs: DataFrame, history: DataFrame) -> DataFrame:
    """Failed runs that left a trace in the watermark history: violations."""
    return _failed(runs).join(_traced(history), "RunId", "left_semi")


def failed_without_history(runs: DataFrame, history: DataFrame) -> DataFrame:
    """Failed runs as they should be."""
    return _failed(runs).join(_traced(history), "RunId", "left_anti")


def _failed(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("Status") == FAILED)


def _traced(history: DataFrame) -> DataFrame:
    # Distinct before the join: a RunId written many times is reduced where it
    # is read and cannot fill one task. The join reuses this partitioning.
    return history.select("RunId").where(F.col("RunId").isNotNull()).distinct()


# --- Attempts: runs that repeat each other --------------------------------------

_ATTEMPT = "-attempt-"


def attempt_id(name: str, number: int) -> str:
    """The run id of an attempt at a batch."""
    return f"{name}{_ATTEMPT}{number}"


def batch_of(run_id: Column) -> Column:
    """The batch of an attempt, which names its folder; of other runs the run id."""
    return F.regexp_replace(run_id, f"{_ATTEMPT}[0-9]+$", "")


def attempts(journal: DataFrame, name: str) -> list[Row]:
    """The runs of all attempts at one batch: as many as there were failures, and one.

    Only their own rows of the run journal are folded.
    """
    return run_state(journal.where(F.col("RunId").startswith(name + _ATTEMPT))).collect()


# --- State changes of runs, for one run or for any number ---------------------


def complete_runs(
    running: DataFrame, new_mark: Column, read: Column, copied: Column, now: Column
) -> DataFrame:
    """Running rows to succeeded ones."""
    return _ended(running, SUCCEEDED, now).withColumns(
        {
            "NewWatermarkValue": new_mark.cast("timestamp_ntz"),
            "RowsRead": read.cast("bigint"),
            "RowsCopied": copied.cast("bigint"),
        }
    )


def fail_runs(running: DataFrame, message: Column, now: Column) -> DataFrame:
    """Running rows to failed ones: a message, and no new mark."""
    return _ended(running, FAILED, now).withColumns(
        {
            "NewWatermarkValue": ntz(None),
            "ErrorMessage": message.cast("string"),
        }
    )


def _ended(running: DataFrame, status: str, now: Column) -> DataFrame:
    return running.where(F.col("Status") == RUNNING).withColumns(
        {"Status": F.lit(status), "EndedAt": now.cast("timestamp_ntz")}
    )
