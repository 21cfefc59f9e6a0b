"""Repeated token windows by Rabin-Karp hashes counted in Spark.

Words are what stands between ASCII white space. Every window of `window` words gets
the polynomial hash of its words' 64-bit hashes, and `check_bytes` bytes of a second,
independent polynomial. A task gathers texts to blocks of about `block_windows`
windows, sorts a block's hashes and sends each hash once, in slices by hash range: a
hash that occurs twice in a block is known to repeat there, so a window that a third
of all texts share costs one entry a block. A range counts its hashes over all blocks
and sends the places of repeated ones back to their block, which merges them into
maximal intervals of words to remove.

A false match needs equal hashes of 64 + 8 * check_bytes bits, 72 by default: over n
different windows about n * n / 2^73 are expected, far less than one below 1e10. Raise
`check_bytes`, which cost a byte a window each, for corpora beyond that.

Null and empty texts have no words. Repeated rows are texts that occur again, so all of
their windows go. Rows that share doc_id and text get the same result. The documents
have to be a table that is read again in the same order when a task is redone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import blobs, bounded, expand, runs, squeeze

_U = np.uint64
_ONE, _TWO = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
_META = -1


def rolled(ids: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """The polynomial hash of every run of `size` values, by doubling."""
    power, length, have = [base], 1, ids
    out, done = None, 0
    rest = size
    while rest:
        if rest & 1:
            if out is None:
                out, done = have, length
            else:
                n = len(ids) - done - length + 1
                out = out[:n] * power[-1] + have[done : done + n]
                done += length
        rest >>= 1
        if rest:
            n = len(ids) - 2 * length + 1
            have = have[:n] * power[-1] + have[length : length + n]
            power.append(_U((int(power[-1]) ** 2) & (2**64 - 1)))
            length *= 2
    return out


def window_hashes(text: bytes, window: int) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of words, and two hashes of each window."""
    words = text.split()
    if len(words) < window:
        return len(words), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    other = (ids ^ (ids >> _U(29))) * _TWO
    return len(words), rolled(ids, window, _ONE), rolled(other, window, _TWO)


def squeezed(values: np.ndarray) -> tuple[int, bytes]:
    """Ascending 64-bit values as differences of as few bytes as the largest needs."""
    steps = np.diff(values, prepend=_U(0))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return width, steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def restored(width: int, packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(packed, np.uint8).reshape(-1, width)
    return np.cumsum(wide.view("<u8").reshape(-1), dtype=np.uint64)


def text_key(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def intervals(starts: np.ndarray, size: int) -> np.ndarray:
    """Ascending starts of runs of `size` as maximal intervals, flattened from, to."""
    if not len(starts):
        return np.zeros(0, np.int64)
    first = np.flatnonzero(np.diff(starts, prepend=starts[0] - size - 1) > size)
    last = np.append(first[1:], len(starts)) - 1
    return np.stack([starts[first], starts[last] + size], axis=1).reshape(-1)


_ROW = ["range", "block", "width", "hashes", "checks", "places"]
_ROW_TYPES = "range int, block long, width int, hashes binary, checks binary, places binary"


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=_ROW
    )


def hash_slices(docs: DataFrame, hasher, ranges: int, block_windows: int, check: int) -> DataFrame:
    """Slices of blocks by hash range, and a row with each block's texts.

    `hasher` maps a text to a count to keep and two arrays of hashes.
    """

    def run(batches):
        serial = TaskContext.get().partitionId() << 32
        ids, texts, counts, sizes, hashes, checks, total = [], [], [], [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal serial, ids, texts, counts, sizes, hashes, checks, total
            one = np.concatenate(hashes)
            two = np.concatenate(checks)
            order = np.lexsort((two, one)) if check else np.argsort(one, kind="stable")
            one = one[order]
            two = two[order]
            sent = np.ones(len(one), bool)
            same = (one[1:] == one[:-1]) & (two[1:] == two[:-1])
            sent[1:] &= ~same
            again = np.zeros(len(one), bool)
            again[1:] |= same
            again[:-1] |= same
            meta = pa.table(
                {
                    "id": ids,
                    "key": pa.array(texts, pa.int64()),
                    "n": pa.array(counts, pa.int64()),
                    "hashes": pa.array(sizes, pa.int64()),
                }
            )
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, meta.schema) as out:
                out.write_table(meta)
            rows = [
                (
                    int(serial % ranges),
                    serial,
                    _META,
                    sink.getvalue().to_pybytes(),
                    b"",
                    np.packbits(_scatter(order[again], len(one))).tobytes(),
                )
            ]
            one, two, order = one[sent], two[sent], order[sent].astype("<u4")
            part = ((one >> _U(32)) * _U(ranges)) >> _U(32)
            cuts = np.searchsorted(part, np.arange(ranges + 1, dtype=np.uint64))
            for r in range(ranges):
                a, b = cuts[r], cuts[r + 1]
                if a == b:
                    continue
                width, packed = squeezed(one[a:b])
                rows.append(
                    (
                        r,
                        serial,
                        width,
                        packed,
                        two[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :check].tobytes(),
                        order[a:b].view(np.uint8).reshape(-1, 4)[:, :_width(total)].tobytes(),
                    )
                )
            yield _emit(rows)
            serial += 1
            ids, texts, counts, sizes, hashes, checks, total = [], [], [], [], [], [], 0

        for batch in runs(batches, "text", 1 << 20):
            for key, text in zip(
                batch.column("id").to_pylist(), blobs(batch.column("text")), strict=True
            ):
                n, one, two = hasher(text)
                ids.append(key)
                texts.append(text_key(text))
                counts.append(n)
                sizes.append(len(one))
                hashes.append(one)
                checks.append(two & _U((1 << (8 * check)) - 1) if check else two & _U(0))
                total += len(one)
            if total >= block_windows:
                yield from flush()
        if ids:
            yield from flush()

    return docs.mapInArrow(run, _ROW_TYPES)


def _width(total: int) -> int:
    """Bytes of a place within a block; places are below the block's windows."""
    return max(1, (max(total, 1).bit_length() + 7) // 8)


def _scatter(at: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, np.uint8)
    out[at] = 1
    return out


def _bytes_to_ints(packed: bytes, width: int) -> np.ndarray:
    wide = np.zeros((len(packed) // width, 4), np.uint8)
    wide[:, :width] = np.frombuffer(packed, np.uint8).reshape(-1, width)
    return wide.view("<u4").reshape(-1)


def repeated_places(table: pa.Table) -> pa.Table:
    """Of one hash range: per block the places whose hash other blocks have as well."""
    blocks, widths = table.column("block").to_pylist(), table.column("width").to_pylist()
    rows, found = [], []
    for i, (block, width) in enumerate(zip(blocks, widths, strict=True)):
        hashes, places = table.column("hashes")[i].as_py(), table.column("places")[i].as_py()
        if width == _META:
            rows.append((block, _META, hashes, places))
        else:
            one = restored(width, hashes)
            found.append((block, one, table.column("checks")[i].as_py(), places))
    if found:
        one = np.concatenate([f[1] for f in found])
        source = np.repeat(np.arange(len(found)), [len(f[1]) for f in found])
        check = len(found[0][2]) // max(1, len(found[0][1]))
        two = np.zeros((len(one), 8), np.uint8)
        if check:
            two[:, :check] = np.frombuffer(b"".join(f[2] for f in found), np.uint8).reshape(
                -1, check
            )
        two = two.view("<u8").reshape(-1)
        order = np.lexsort((two, one)) if check else np.argsort(one)
        same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
        again = np.zeros(len(one), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        start = 0
        for i, (block, own, _, places) in enumerate(found):
            flags = again[start : start + len(own)]
            start += len(own)
            if flags.any():
                width = len(places) // len(own)
                kept = np.frombuffer(places, np.uint8).reshape(-1, width)[flags]
                rows.append((block, width, b"", kept.tobytes()))
    block, width, meta, places = zip(*rows, strict=True) if rows else ((),) * 4
    return pa.table(
        {
            "block": pa.array(block, pa.int64()),
            "width": pa.array(width, pa.int32()),
            "meta": pa.array(meta, pa.binary()),
            "places": pa.array(places, pa.binary()),
        }
    )


def block_flags(table: pa.Table) -> tuple[pa.Table, list[np.ndarray]]:
    """Of one block: its texts, and which of each text's hashes are repeated."""
    marks, texts, local = [], None, b""
    for width, meta, places in zip(
        *(table.column(c).to_pylist() for c in ("width", "meta", "places")), strict=True
    ):
        if width == _META:
            texts, local = pa.ipc.open_stream(meta).read_all(), places
        else:
            marks.append(_bytes_to_ints(places, width))
    sizes = texts.column("hashes").to_numpy()
    flags = np.unpackbits(np.frombuffer(local, np.uint8))[: sizes.sum()].astype(bool)
    for at in marks:
        flags[at] = True
    return texts, np.split(flags, np.cumsum(sizes)[:-1])


def _merged(kind: str, window: int):
    """Of one block: per text its words and the intervals to remove."""

    def run(table: pa.Table) -> pa.Table:
        texts, flags = block_flags(table)
        spans = [intervals(np.flatnonzero(f), window) for f in flags]
        return pa.table(
            {
                "id": texts.column("id"),
                "text_key": texts.column("key"),
                "n_words": texts.column("n"),
                "spans": pa.array(spans, pa.list_(pa.int64())),
            }
        )

    return run, f"id {kind}, text_key long, n_words long, spans array<long>"


def repeated(
    docs: DataFrame,
    window: int = 35,
    block_windows: int = 1 << 20,
    range_bytes: int = 8 << 20,
    check_bytes: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per text: id, text_key, n_words and the word intervals to remove.

    A hash range covers about `range_bytes` of text, so ranges grow in number, not
    in size. A window that also starts within the same block but is sent once stays
    marked in its block; equal windows of other blocks meet the one that was sent.
    """
    bounded(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = int(size // range_bytes) + 1
    slices = hash_slices(
        docs, lambda text: window_hashes(text, window), ranges, block_windows, check_bytes
    )
    counted = slices.groupBy("range").applyInArrow(
        repeated_places, "block long, width int, meta binary, places binary"
    )
    run, schema = _merged(docs.schema["id"].dataType.simpleString(), window)
    return counted.groupBy("block").applyInArrow(run, schema)


def keyed(docs: DataFrame) -> DataFrame:
    """id, text_key and the compressed text, ready for a shuffle."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = blobs(batch.column("text"))
            keys = pa.array([text_key(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), squeeze(texts), keys], names=["id", "packed", "text_key"]
            )

    return docs.mapInArrow(run, f"id {kind}, packed binary, text_key long")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: words, removed words and the digest of the words that stay."""
    found = repeated(docs, id_col=id_col, text_col=text_col, **options)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    texts = keyed(docs)
    # Equal (id, text) rows have equal results.
    spans = found.dropDuplicates(["id", "text_key"]).select(
        F.col("id").alias("span_id"), F.col("text_key").alias("span_key"), "n_words", "spans"
    )
    joined = texts.join(
        spans.hint("shuffle_hash"),
        F.col("id").eqNullSafe(F.col("span_id")) & (F.col("text_key") == F.col("span_key")),
        "left",
    ).select("id", "packed", "n_words", "spans")

    def run(batches):
        for batch in batches:
            removed, digests = [], []
            for text, spans in zip(
                expand(batch.column("packed")), batch.column("spans").to_pylist(), strict=True
            ):
                words = text.split()
                kept, at, gone = [], 0, 0
                for a, b in zip(spans[::2], spans[1::2], strict=True):
                    kept += words[at:a]
                    gone += b - a
                    at = b
                kept += words[at:]
                removed.append(gone)
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("n_words"),
                    pa.array(removed, pa.int64()),
                    pa.array(digests, pa.string()),
                ],
                names=["id", "n_words", "n_removed", "kept_sha256"],
            )

    return joined.mapInArrow(
        run, f"id {kind}, n_words long, n_removed long, kept_sha256 string"
    ).withColumnRenamed("id", id_col)
