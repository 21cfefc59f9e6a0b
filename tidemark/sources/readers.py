"""Reading sources: tables through JDBC or Parquet, landing files as CSV or JSON.

Schemas are declared; none is inferred from the data. Which reader serves a source depends
on its `SourceType` alone; names and places are parameters.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import CORRUPT_RECORD, CSV_FILE, JSON_FILE, SQL_TABLE

CSV_OPTIONS = {"quote": '"', "escape": '"'}
# By default the writer trims text, and the reader takes "" for NULL.
CSV_WRITE = {
    **CSV_OPTIONS,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CSV_READ = {**CSV_OPTIONS, "nullValue": "\0"}


@dataclass(frozen=True)
class FileSpec:
    """A landing file or folder of one layout; one path per source."""

    source_type: str
    path: str
    schema: T.StructType
    header: bool = True
    # True: a document or CSV record may span lines, and a file is one task.
    # False: one per line, and large files are split. None: True for JSON alone.
    multi_line: bool | None = None
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class TableSpec:
    """A table by name, under a Parquet root or behind a JDBC address."""

    schema: str
    table: str
    root: str | None = None
    # Columns of the Parquet files; without them Spark reads a footer first.
    columns: T.StructType | str | None = None
    jdbc_url: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    source_type: str = SQL_TABLE


def read_source(spark: SparkSession, spec: FileSpec | TableSpec) -> DataFrame:
    """The rows of a source, whatever its type."""
    if isinstance(spec, TableSpec):
        return read_table(spark, spec)
    return read_file(spark, spec)


def read_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    if spec.jdbc_url is not None:
        return spark.read.format("jdbc").options(**jdbc_options(spec)).load()
    if spec.root is None:
        raise ValueError(f"{spec.schema}.{spec.table} has neither a root nor an address")
    reader = spark.read.options(**spec.options)
    if spec.columns is not None:
        reader = reader.schema(spec.columns)
    return reader.parquet(f"{spec.root.rstrip('/')}/{spec.table}.parquet")


def read_file(spark: SparkSession, spec: FileSpec) -> DataFrame:
    """Typed rows; the first line or document that does not fit fails the read."""
    options = {**file_options(spec), "mode": "FAILFAST"}
    return load_file(spark.read.schema(spec.schema).options(**options), spec)


def read_with_rejects(spark: SparkSession, spec: FileSpec) -> DataFrame:
    """Typed rows plus the raw text of those that do not fit (else NULL)."""
    options = file_options(spec)
    return load_file(spark.read.schema(with_reject(spec)).options(**options), spec)


def with_reject(spec: FileSpec) -> T.StructType:
    """The schema of the file, and a column for what does not fit it."""
    return T.StructType(
        spec.schema.fields + [T.StructField(CORRUPT_RECORD, T.StringType())]
    )


def spans_lines(spec: FileSpec) -> bool:
    """Whether a record of the file may have more than one line."""
    return spec.source_type == JSON_FILE if spec.multi_line is None else spec.multi_line


def file_options(spec: FileSpec) -> dict[str, str | bool]:
    """Options of a file reader, for batches and streams."""
    common = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT_RECORD,
        "multiLine": spans_lines(spec),
    }
    if spec.source_type == CSV_FILE:
        # Header names are checked against the schema, and all columns are
        # parsed: with pruning, a bad value in an unused column goes unseen.
        own = {
            **CSV_READ,
            "header": spec.header,
            "enforceSchema": not spec.header,
            "columnPruning": False,
        }
    elif spec.source_type == JSON_FILE:
        own = {"timeZone": "UTC"}
    else:
        raise ValueError(f"no file reader for source type {spec.source_type!r}")
    return {**common, **own, **spec.options}


def load_file(reader: DataFrameReader, spec: FileSpec) -> DataFrame:
    return reader.csv(spec.path) if spec.source_type == CSV_FILE else reader.json(spec.path)


def flag_columns(df: DataFrame, *columns: str) -> DataFrame:
    """0/1 flags of a file as booleans."""
    return df.withColumns({c: F.col(c) == 1 for c in columns})


# --- JDBC ---------------------------------------------------------------------

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_$#@]*\Z")


def qualified(*names: str) -> str:
    """A dotted SQL name of plain identifiers; anything else is refused."""
    for name in names:
        if not _NAME.match(name):
            raise ValueError(f"not a plain SQL identifier: {name!r}")
    return ".".join(names)


def jdbc_options(spec: TableSpec) -> dict[str, str]:
    """Options for the whole table. Filters on it go to the database."""
    return {
        "url": spec.jdbc_url,
        "dbtable": qualified(spec.schema, spec.table),
        "preferTimestampNTZ": "true",
        "fetchsize": "10000",
        **spec.options,
    }


def jdbc_bounds_options(
    spec: TableSpec,
    watermark_column: str,
    key_column: str | None = None,
    above: datetime | None = None,
) -> dict[str, str]:
    """Options that let the database take the extremes: one row back.

    The high mark is that of all rows; the ends of the ranges are those of the
    rows above the stored mark, or one range would hold nearly the whole window.
    """
    options = jdbc_options(spec)
    table = options.pop("dbtable")
    column = qualified(watermark_column)

    def new(name: str) -> str:
        if above is None:
            return name
        mark = above.isoformat(timespec="milliseconds")
        return f"CASE WHEN {column} > '{mark}' THEN {name} END"

    wanted = f"MIN({new(column)}) AS LowMark, MAX({column}) AS HighMark"
    if key_column is not None:
        key = qualified(key_column)
        wanted += f", MIN({new(key)}) AS LowKey, MAX({new(key)}) AS HighKey"
    options["query"] = f"SELECT {wanted} FROM {table}"
    return options


def jdbc_range_options(
    spec: TableSpec, column: str, low: str, high: str, partitions: int
) -> dict[str, str]:
    """Options to read a table in parallel ranges of one column.

    The ranges only spread the work; a window filter is still needed.
    """
    return {
        **jdbc_options(spec),
        "partitionColumn": qualified(column),
        "lowerBound": low,
        "upperBound": high,
        "numPartitions": str(partitions),
    }


def jdbc_starts_options(
    spec: TableSpec,
    watermark_column: str,
    key_column: str | None,
    old: datetime,
    high: datetime,
    ranges: int,
) -> dict[str, str]:
    """Options to ask for the first row of each of `ranges` parts of a window that have
    equally many rows: at most `ranges` rows back, whatever the table has.

    Rows are ordered by mark, then by key. A bulk change that gives very many rows one
    mark is cut by the key, and a gap in either costs nothing.
    """
    options = jdbc_options(spec)
    table = options.pop("dbtable")
    mark = qualified(watermark_column)
    key = qualified(key_column) if key_column else None
    order = ", ".join(filter(None, (mark, key)))
    columns = f"{mark} AS Mark" + (f", {key} AS RowKey" if key else "")
    low, top = (m.isoformat(sep=" ", timespec="milliseconds") for m in (old, high))
    options["query"] = (
        f"SELECT Mark{', RowKey' if key else ''} FROM (SELECT {columns}, "
        f"ROW_NUMBER() OVER (ORDER BY {order}) AS Place, COUNT(*) OVER () AS Total "
        f"FROM {table} WHERE {mark} > '{low}' AND {mark} <= '{top}') ranked "
        f"WHERE (Place - 1) % FLOOR((Total + {ranges - 1}) / {ranges}) = 0"
    )
    return options


def jdbc_predicates(
    watermark_column: str, key_column: str | None, starts: list[tuple]
) -> list[str]:
    """Conditions that put every row with a mark into just one range.

    starts: (mark,) or (mark, key) of the first row of each range. The first range takes
    all that is below the second, so starts need not be exact.
    """
    mark = qualified(watermark_column)
    key = qualified(key_column) if key_column else None

    def below(start: tuple) -> str:
        at = f"'{start[0].isoformat(sep=' ', timespec='microseconds')}'"
        if key is None:
            return f"{mark} < {at}"
        return f"({mark} < {at} OR ({mark} = {at} AND {key} < {int(start[1])}))"

    cuts = [below(start) for start in sorted(set(starts))[1:]]
    if not cuts:
        return [f"{mark} IS NOT NULL"]
    inner = [f"NOT {_whole(a)} AND {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [cuts[0], *inner, f"NOT {_whole(cuts[-1])}"]


def _whole(condition: str) -> str:
    return condition if condition.startswith("(") else f"({condition})"
