"""High marks, pending rows and incremental windows.

Functions that look at many sources take them in one of two forms:

- `{SourceObjectId: DataFrame}`, for tables of their own. Marks and watermark
  columns are looked up for the ids in the mapping only, so the lookup is never
  larger than the mapping the caller built, and enter the plan as literals.
- one DataFrame with `SourceObjectId` and `UpdatedAt`, for any number of sources
  that share a place. Marks are joined.

Either way each source is read once and its rows are not shuffled: a partition
reduces to one row per source before the exchange.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import above, count_where, to_millis, up_to
from tidemark.operators.joins import join_side

Sources = Mapping[int, DataFrame] | DataFrame


@dataclass(frozen=True)
class Mark:
    """What a read needs to know about one source."""

    source_id: int
    name: str
    value: datetime | None
    column: str


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def marks_of(registry: DataFrame, sources: Mapping[int, DataFrame]) -> list[Mark]:
    """Marks of the mapped sources; ids without a registry row are left out."""
    rows = (
        registry.where(F.col("SourceObjectId").isin(list(sources)))
        .select(
            "SourceObjectId",
            "SourceObjectName",
            "LastWatermarkValue",
            "WatermarkColumn",
        )
        .collect()
    )
    return [Mark(*row) for row in rows]


def tag(
    sources: Sources, registry: DataFrame, pending_only: bool = False
) -> DataFrame:
    """Rows of all registered sources: SourceObjectId, UpdatedAt, Pending.

    With `pending_only`, rows at or below their mark are left out, at the scan
    where marks are literals.
    """
    if isinstance(sources, DataFrame):
        return _tag_shared(sources, registry, pending_only)
    frames = []
    for mark in marks_of(registry, sources):
        value = F.col(mark.column)
        pending = above(value, mark.value)
        rows = sources[mark.source_id]
        frames.append(
            (rows.where(pending) if pending_only else rows).select(
                F.lit(mark.source_id).alias("SourceObjectId"),
                value.alias("UpdatedAt"),
                pending.alias("Pending"),
            )
        )
    if not frames:
        return registry.sparkSession.createDataFrame(
            [], "SourceObjectId int, UpdatedAt timestamp_ntz, Pending boolean"
        )
    return union_all(frames)


def _tag_shared(
    rows: DataFrame, registry: DataFrame, pending_only: bool
) -> DataFrame:
    first_pending = to_millis("LastWatermarkValue") + F.expr("INTERVAL '0.001' SECOND")
    marks = registry.select("SourceObjectId", first_pending.alias("FirstPending"))
    tagged = join_side(
        rows.select("SourceObjectId", "UpdatedAt"), marks, "SourceObjectId"
    ).select(
        "SourceObjectId",
        "UpdatedAt",
        (F.col("UpdatedAt") >= F.col("FirstPending")).alias("Pending"),
    )
    return tagged.where("Pending") if pending_only else tagged


def _high() -> Column:
    # The cut is monotone, so it is made once per source and not per row.
    return to_millis(F.max("UpdatedAt")).alias("CurrentHighWatermarkValue")


def current_high_watermark(sources: Sources, registry: DataFrame) -> DataFrame:
    """Highest mark in each source: (SourceObjectId, CurrentHighWatermarkValue).

    An empty source has no row. Sources that share a frame are reduced first, and only
    then is the registry asked which of them it knows.
    """
    if isinstance(sources, DataFrame):
        known = registry.select("SourceObjectId")
        highs = sources.groupBy("SourceObjectId").agg(_high())
        return highs.join(known, "SourceObjectId", "left_semi")
    return tag(sources, registry).groupBy("SourceObjectId").agg(_high())


def source_stats(sources: Sources, registry: DataFrame) -> DataFrame:
    """High mark and pending count per source, in one pass over one column.

    Columns: SourceObjectId, CurrentHighWatermarkValue, Eligible_Row_Count. An
    empty source has no row.
    """
    pending = count_where(F.col("Pending")).alias("Eligible_Row_Count")
    return tag(sources, registry).groupBy("SourceObjectId").agg(_high(), pending)


def pending_counts(sources: Sources, registry: DataFrame) -> DataFrame:
    """Rows above the mark per source; a source with none has no row.

    Unlike `source_stats` this needs no maximum, so the bound goes down to the
    scan and files below the mark are skipped.
    """
    return (
        tag(sources, registry, pending_only=True)
        .groupBy("SourceObjectId")
        .agg(F.count(F.lit(1)).alias("Eligible_Row_Count"))
    )


def eligible_rows(sources: Sources, registry: DataFrame) -> DataFrame:
    """The pending rows themselves: (SourceObjectId, UpdatedAt)."""
    return tag(sources, registry, pending_only=True).select(
        "SourceObjectId", to_millis("UpdatedAt").alias("UpdatedAt")
    )


def high_mark(
    df: DataFrame, watermark_column: str, old: datetime | None = None
) -> datetime | None:
    """The high mark of one source as a driver value; None when it has none.

    With the old mark given, rows above it are asked first: that bound goes
    down to the scan, so all that was copied before is skipped. Only a source
    with nothing new is read in full, one column of it.
    """
    value = F.col(watermark_column)
    highest = to_millis(F.max(value)).alias("high")
    if old is not None:
        high = df.where(above(value, old)).agg(highest).first()["high"]
        if high is not None:
            return high
    return df.agg(highest).first()["high"]


def incremental_window(
    df: DataFrame,
    watermark_column: str,
    old: datetime | None,
    high: datetime | None,
) -> DataFrame:
    """Rows above `old` and not above `high`, mark column cut to milliseconds.

    `high` must have been taken before the copy starts: rows that arrive while
    it runs stay above the new mark and belong to the next window.
    """
    value = F.col(watermark_column)
    return df.where(above(value, old) & up_to(value, high)).withColumn(
        watermark_column, to_millis(value)
    )


def next_mark(old: datetime | None, high: datetime | None) -> datetime | None:
    """The mark after a good run: never moves back, skips a missing high."""
    known = [mark for mark in (old, high) if mark is not None]
    return max(known) if known else None
