"""What a table load asks of its source: the marks it spans, and a window.

Two kinds: any DataFrame the session can read, and a table behind JDBC.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession

from tidemark.functions import to_millis
from tidemark.functions.marks import MILLISECOND, floor_millis
from tidemark.operators.windows import high_mark, incremental_window
from tidemark.sources.readers import (
    TableSpec,
    jdbc_bounds_options,
    jdbc_options,
    jdbc_predicates,
    jdbc_range_options,
    jdbc_starts_options,
)


@dataclass(frozen=True)
class Bounds:
    """Extremes of a table, taken before its copy starts."""

    high: datetime | None = None
    low: datetime | None = None
    low_key: int | None = None
    high_key: int | None = None


class FrameTables:
    """Tables the session reads as DataFrames, from their registry row."""

    def __init__(self, open_table: Callable[[Row], DataFrame]):
        self.open_table = open_table

    def bounds(self, source: Row) -> Bounds:
        table = self.open_table(source)
        old = source.LastWatermarkValue
        return Bounds(high_mark(table, source.WatermarkColumn, old))

    def window(self, source: Row, old: datetime | None, bounds: Bounds) -> DataFrame:
        return incremental_window(
            self.open_table(source), source.WatermarkColumn, old, bounds.high
        )


class JdbcTables:
    """Tables of one database, read in parallel ranges.

    The database takes the extremes itself. With `equal_counts` it also says where ranges
    of equally many rows start, in the order of mark and key, which costs it a sort of the
    window; `keys` names whole-number key columns, by which rows of one mark are told
    apart. Without, ranges are equally wide: of the key if there is one, else of the mark,
    from the lowest one present, as from the sentinel on all rows of an initial load would
    fall into the last range. A burst of changes falls into few of those.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        partitions: int,
        options: Mapping[str, str] | None = None,
        keys: Mapping[str, str] | None = None,
        equal_counts: bool = True,
    ):
        self.spark = spark
        self.equal_counts = equal_counts
        self.partitions = partitions
        self.keys = keys or {}
        self.base = TableSpec("", "", jdbc_url=url, options=options or {})

    def spec(self, source: Row) -> TableSpec:
        return replace(
            self.base, schema=source.SourceSchema, table=source.SourceObjectName
        )

    def bounds(self, source: Row) -> Bounds:
        key = self.keys.get(source.SourceObjectName)
        options = jdbc_bounds_options(
            self.spec(source), source.WatermarkColumn, key, source.LastWatermarkValue
        )
        row = (
            self._read(options)
            .withColumn("HighMark", to_millis("HighMark"))
            .first()
            .asDict()
        )
        return Bounds(
            row["HighMark"], row["LowMark"], row.get("LowKey"), row.get("HighKey")
        )

    def window(self, source: Row, old: datetime | None, bounds: Bounds) -> DataFrame:
        if self.equal_counts and self._has_rows(old, bounds):
            rows = self._read_ranges(source, self.window_predicates(source, old, bounds))
        else:
            rows = self._read(self.window_options(source, old, bounds))
        return incremental_window(rows, source.WatermarkColumn, old, bounds.high)

    @staticmethod
    def _has_rows(old: datetime | None, bounds: Bounds) -> bool:
        return old is not None and bounds.high is not None and bounds.high > old

    def window_predicates(self, source: Row, old: datetime, bounds: Bounds) -> list[str]:
        """Ranges of equally many rows of the window; one row each comes to the driver."""
        key = self.keys.get(source.SourceObjectName)
        high = floor_millis(bounds.high) + MILLISECOND
        options = jdbc_starts_options(
            self.spec(source), source.WatermarkColumn, key, old, high, self.partitions
        )
        starts = [tuple(row) for row in self._read(options).collect()]
        return jdbc_predicates(source.WatermarkColumn, key, starts)

    def _read_ranges(self, source: Row, predicates: list[str]) -> DataFrame:
        options = jdbc_options(self.spec(source))
        url, table = options.pop("url"), options.pop("dbtable")
        return self.spark.read.jdbc(url, table, predicates=predicates, properties=options)

    def window_options(
        self, source: Row, old: datetime | None, bounds: Bounds
    ) -> dict[str, str]:
        spec = self.spec(source)
        if not self._has_rows(old, bounds):
            return jdbc_options(spec)  # the window is empty; no ranges to cut
        key = self.keys.get(source.SourceObjectName)
        if key is not None and bounds.low_key is not None:
            column, low, high = key, str(bounds.low_key), str(bounds.high_key + 1)
        else:
            column = source.WatermarkColumn
            low = max(old, bounds.low).isoformat(sep=" ")
            high = (floor_millis(bounds.high) + MILLISECOND).isoformat(sep=" ")
        return jdbc_range_options(spec, column, low, high, self.partitions)

    def _read(self, options: dict[str, str]) -> DataFrame:
        return self.spark.read.format("jdbc").options(**options).load()
