"""The copies: a table window to Parquet, a landing file record by record as it is.

Each copy overwrites the folder of its own run and nothing else, so a replay
leaves the zone as it was. Rows are counted while they are written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.model import CORRUPT_RECORD, CSV_FILE, JSON_FILE, SUCCEEDED
from tidemark.operators.joins import at_most, join_side
from tidemark.operators.journals import batch_of
from tidemark.sources.raw import FITS, RECORD, header_line, judged, raw_text
from tidemark.sources.readers import CSV_WRITE, FileSpec, spans_lines


@dataclass(frozen=True)
class Counts:
    read: int
    copied: int
    rejected: int = 0


def run_folder(base: str, folder: str, run_id: str) -> str:
    return f"{base.rstrip('/')}/{folder}/run_id={run_id}"


def write_file(df: DataFrame, source_type: str, path: str, **options: str | int) -> None:
    """Write rows in the format of their source."""
    writer = df.write.mode("overwrite").options(**options)
    if source_type == CSV_FILE:
        writer.options(**CSV_WRITE).option("header", True).csv(path)
    elif source_type == JSON_FILE:
        writer.option("timeZone", "UTC").option("ignoreNullFields", False).json(path)
    else:
        raise ValueError(f"no file writer for source type {source_type!r}")


def copy_window(window: DataFrame, path: str) -> Counts:
    """Write a window as Parquet: one stage, read to write, no exchange."""
    seen = Observation()
    counted = window.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").parquet(path)
    rows = seen.get.get("rows") or 0
    return Counts(rows, rows)


def copy_frame(text: DataFrame, spec: FileSpec, path: str, rejected_path: str) -> Counts:
    """Write good records as they came to `path`; the others to `rejected_path`.

    The pass that writes the good records counts the others, so the input is read
    again only when there are some. Every CSV part gets the header, if files have one.
    A JSON document that spans lines gets a file of its own.
    """
    records = judged(text, spec)
    seen = Observation()
    counted = records.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col(FITS)).alias("rejected")
    )
    write_records(counted.where(FITS).select(RECORD), spec, path)
    rows = seen.get.get("rows") or 0
    rejected = seen.get.get("rejected") or 0
    if rejected:
        bad = records.where(~F.col(FITS)).select(F.col(RECORD).alias(CORRUPT_RECORD))
        write_file(bad, JSON_FILE, rejected_path)
    return Counts(rows, rows - rejected, rejected)


def write_records(records: DataFrame, spec: FileSpec, path: str) -> None:
    """Write raw records in the form of their file; the frame has just that column."""
    writer_options = {"lineSep": "\n", "maxRecordsPerFile": 0}
    line = F.col(records.columns[0])
    if spec.source_type == CSV_FILE:
        if spec.header:
            # The low bits of these ids count the rows of a partition, which is a file.
            first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
            # It ends as the records do.
            end = F.when(line.endswith("\r"), "\r\n").otherwise("\n")
            header = F.concat(F.lit(header_line(spec)), end)
            line = F.concat(F.when(first, header).otherwise(""), line)
    elif spans_lines(spec):
        line = F.regexp_replace(line, r"\n\z", "")  # the writer ends the file so
        writer_options["maxRecordsPerFile"] = 1
    records.select(line.alias(RECORD)).write.mode("overwrite").options(**writer_options).text(path)


def copy_file(
    spark: SparkSession, spec: FileSpec, path: str, rejected_path: str
) -> Counts:
    """The whole landing file; there is no mark in a file load."""
    return copy_frame(raw_text(spark.read, spec), spec, path, rejected_path)


def succeeded_only(bronze: DataFrame, runs: DataFrame, source_id) -> DataFrame:
    """Bronze rows of succeeded runs of one source; `run_id` is the partition.

    The attempts at a batch of a stream share a folder, which counts once one of them has
    succeeded. Run ids are broadcast when there are few enough, so that folders of other
    runs are pruned and not read.
    """
    good = runs.where(
        (F.col("Status") == SUCCEEDED) & (F.col("SourceObjectId") == F.lit(source_id))
    ).select(batch_of(F.col("RunId")).alias("run_id"))
    if at_most(good):
        return bronze.join(F.broadcast(good), "run_id", "left_semi")
    return join_side(bronze, good.distinct(), "run_id", "left_semi")
