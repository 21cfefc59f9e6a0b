"""What several operators share: reading the tables, and texts as bytes in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the separators of words.
BLANKS = " \t\n\x0b\f\r"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(spark: SparkSession, size: int = 4 << 20) -> None:
    """Has batches for Python end at `size` bytes, not only at a number of rows.

    Long texts would make batches of gigabytes else. A session's own bound stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, size)


def blobs(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null reads as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [value or b"" for value in column.cast(kind).to_pylist()]


def runs(
    batches: Iterator[pa.RecordBatch], column: str, size: int
) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that none has much over `size` bytes of text.

    A text that is longer by itself makes a batch of one row.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        kind = batch.column(column).type
        sizes = (
            batch.column(column)
            .cast(pa.large_binary() if pa.types.is_large_string(kind) else pa.binary())
            .to_pylist()
        )
        start = total = 0
        for row, value in enumerate(sizes):
            total += len(value or b"")
            if total >= size or row == len(sizes) - 1:
                yield batch.slice(start, row + 1 - start)
                start, total = row + 1, 0


def squeeze(texts: list[bytes]) -> pa.Array:
    """Texts that are about to be shuffled, compressed one by one."""
    coder = zstandard.ZstdCompressor(level=6)
    return pa.array([coder.compress(t) for t in texts], pa.binary())


def expand(column: pa.Array) -> list[bytes]:
    decoder = zstandard.ZstdDecompressor()
    return [decoder.decompress(t) for t in column.to_pylist()]


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def word_array(text: Column) -> Column:
    """The words between ASCII white space; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+")
    return F.array_remove(parts, "")
