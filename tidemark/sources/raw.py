"""Landing files as raw records, and whether each fits its schema.

A copy that stays in its format must not go through typed rows: parsing drops fields that
no schema declares, adds those that are absent, and respells numbers. So files are read as
text, cut into records, and parsed beside that, only to tell good records from others.

A record is a CSV line, or more lines where a quoted field has line breaks; a JSON
document on a line, or the document that a whole file is. Line breaks within records and
carriage returns before line feeds are part of them. Blank lines are no records. Files are
UTF-8.

Where records may span lines, a file is one row of one task, as it is for the typed readers.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from tidemark.model import CORRUPT_RECORD, CSV_FILE, JSON_FILE
from tidemark.sources.readers import FileSpec, file_options, spans_lines, with_reject

RECORD, FITS = "Record", "Fits"

# Options of readers that the parsing expressions don't take.
_NOT_OF_PARSERS = ("multiLine", "header", "enforceSchema", "columnPruning")


def read_raw(spark: SparkSession, spec: FileSpec) -> DataFrame:
    """Record and Fits of all records of a landing file or folder."""
    return judged(raw_text(spark.read, spec), spec)


def raw_text(reader: DataFrameReader | DataStreamReader, spec: FileSpec) -> DataFrame:
    """Lines, or whole files; of CSV also where they are from. For batches and streams."""
    if spec.source_type not in (CSV_FILE, JSON_FILE):
        raise ValueError(f"no file reader for source type {spec.source_type!r}")
    # Lines end at line feeds only, so that a carriage return before one stays.
    reader = reader.option("lineSep", "\n").options(**spec.options)
    text = reader.text(spec.path, wholetext=spans_lines(spec))
    if spec.source_type == JSON_FILE:
        return text
    return text.select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
    )


def judged(text: DataFrame, spec: FileSpec) -> DataFrame:
    """Record and Fits of what `raw_text` has read."""
    if spec.source_type == CSV_FILE:
        records = text.mapInArrow(_csv_records(spec), f"{RECORD} string")
        fits = _fits_csv(F.col(RECORD), spec)
    else:
        records = text.select(F.col("value").alias(RECORD)).where(F.col(RECORD).rlike(r"\S"))
        fits = _fits_json(F.col(RECORD), spec)
    return records.select(RECORD, F.coalesce(fits, F.lit(False)).alias(FITS))


def _parser_options(spec: FileSpec) -> dict[str, str]:
    return {
        key: str(value).lower() if isinstance(value, bool) else str(value)
        for key, value in file_options(spec).items()
        if key not in _NOT_OF_PARSERS
    }


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _fits_csv(record: Column, spec: FileSpec) -> Column:
    line = F.regexp_replace(record, r"\r$", "")
    parsed = F.from_csv(line, _ddl(with_reject(spec)), _parser_options(spec))
    return parsed[CORRUPT_RECORD].isNull()


def _fits_json(record: Column, spec: FileSpec) -> Column:
    """A document fits if it parses, an array of documents if all do."""
    options = _parser_options(spec)

    def fits(text: Column) -> Column:
        return F.from_json(text, with_reject(spec), options)[CORRUPT_RECORD].isNull()

    items = F.from_json(record, T.ArrayType(T.StringType()), options)
    return F.when(record.rlike(r"^\s*\["), F.forall(items, fits)).otherwise(fits(record))


def csv_form(spec: FileSpec) -> tuple[str, str, str]:
    """Separator, quote and escape of a CSV file."""
    options = {key.lower(): value for key, value in spec.options.items()}
    sep = options.get("sep", options.get("delimiter", ","))
    return sep, options.get("quote", '"'), options.get("escape", '"')


def header_line(spec: FileSpec) -> str:
    """The header that fits the schema, quoted where it has to be."""
    sep, quote, _ = csv_form(spec)
    return sep.join(
        quote + name.replace(quote, quote * 2) + quote
        if any(c in name for c in (sep, quote, "\n"))
        else name
        for name in spec.schema.names
    )


def record_pattern(spec: FileSpec) -> re.Pattern[str]:
    """A CSV record without its line feed. Quoted fields may hold line feeds; one whose
    quote never ends takes the rest. Nothing is gone over twice."""
    sep, quote, escape = map(re.escape, csv_form(spec))
    if quote == escape:
        inside = f"[^{quote}]*+(?:{quote}{quote}[^{quote}]*+)*+"
    else:
        inside = f"(?:[^{quote}{escape}]++|{escape}.?|{quote}{quote})*+"
    field = f"(?:{quote}{inside}{quote}?[^{sep}\\n]*+|[^{sep}\\n]*+)"
    return re.compile(f"{field}(?:{sep}{field})*+", re.DOTALL)


def split_records(text: str, pattern: re.Pattern[str]) -> Iterator[str]:
    at = 0
    while at < len(text):
        end = pattern.match(text, at).end()
        yield text[at:end]
        at = end + 1  # past the line feed


def _csv_records(spec: FileSpec):
    """Records without the headers, of which each file has to have one that fits."""
    whole, header = spans_lines(spec), spec.header
    pattern = record_pattern(spec)
    sep, quote, _ = csv_form(spec)
    names = [name.lower() for name in spec.schema.names]

    def check(line: str, path: str) -> None:
        form = {"delimiter": sep, "quotechar": quote}
        found = next(csv.reader([line.removesuffix("\r")], **form), [])
        if [name.lower() for name in found] != names:
            raise ValueError(f"the header of {path} doesn't fit the schema: {line!r}")

    def run(batches):
        block, due = None, False
        for batch in batches:
            out = []
            for value, path, start in zip(
                *(batch.column(c).to_pylist() for c in ("value", "path", "start")), strict=True
            ):
                if whole or (path, start) != block:  # the first row of a file or of a split
                    block, due = (path, start), header and start == 0
                for record in split_records(value, pattern) if whole else (value,):
                    if not record.strip():
                        continue
                    if due:
                        check(record, path)
                        due = False
                    else:
                        out.append(record)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=[RECORD])

    return run
