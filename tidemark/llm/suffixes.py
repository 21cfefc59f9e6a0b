"""Repeated byte strings by run-length compressed Burrows-Wheeler indexes.

A byte goes if it is covered by a string of `length` bytes that also starts earlier:
in a document with a smaller id, or in the same one before it.

1. Anchors. Every window of `length` bytes has an anchor, its `gram`-byte piece with
   the least hash (the leftmost of equals). Equal windows have equal anchors, so only
   windows whose anchor occurs twice can repeat. Anchors are about one in forty
   bytes; they are counted by hash range, and places of repeated ones come back.
2. Spans. The windows of one anchor occurrence are a stretch of text of less than
   twice `length`. Spans of repeated anchors are dealt to shards by anchor hash, so
   all places where a string can occur meet in one shard. A span that a task has seen
   before is known to repeat; it goes at once and isn't sent, so a passage that a third of all
   documents share costs one span a task.
3. Index. A shard orders its distinct spans as they stand in the corpus, leaves out those
   that are the only form of text around their anchor, builds the others'
   Burrows-Wheeler transform, keeps its runs with a sampled text position at every run
   end, and streams every span through it from its end, one LF step a byte. The row of
   a position lies in an interval of rows that share `length` bytes, whose least
   position says whether the match (its statistic cut at `length`) starts earlier.
   Shards grow in number with the corpus, not in size.

Ids have to be integers; null comes first. Documents are (id, text) pairs: rows equal
in both are one document read twice and get the same result, and of equal ids with
different texts a digest of the text decides the order. Null and empty texts have no
bytes. The documents have to be a table that is read again in the same order.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.minhash import mixed
from tidemark.llm.substrings import (
    block_flags,
    hash_slices,
    intervals,
    keyed,
    repeated_places,
    rolled,
    text_key,
)
from tidemark.llm.text import blobs, bounded, expand, runs

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_FIRST = -(1 << 63)


def anchors(text: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first and last window start of each anchor occurrence, in text order."""
    if len(text) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.frombuffer(text, np.uint8).astype(np.uint64) + _U(1)
    hashes = rolled(data, gram, _BASE)
    hashes = (hashes ^ (hashes >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> _U(29)
    # The least of each window, by doubling, with the places in step.
    width = length - gram + 1
    best, at, size = hashes, np.arange(len(hashes)), 1
    while size < width:
        step = min(size, width - size)
        a, b = best[:-step], best[step:]
        later = b < a
        best = np.where(later, b, a)
        at = np.where(later, at[step:], at[:-step])
        size += step
    cut = np.flatnonzero(np.diff(at, prepend=-1))
    # The least of many hashes lies near 0; ranges and shards need it spread again.
    return mixed(best[cut]), cut, np.append(cut[1:], len(at)) - 1


def _first_rows(fresh: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of each row the first one of its run of equals; `fresh` says where runs begin."""
    heads = np.flatnonzero(fresh)
    return np.repeat(rows[heads], np.diff(np.append(heads, len(fresh))))


def _single(fresh: np.ndarray) -> np.ndarray:
    """Which rows are a run of their own."""
    return fresh & np.append(fresh[1:], True)


class RunIndex:
    """The run-length compressed transform of spans in corpus order."""

    def __init__(self, spans: list[bytes], length: int):
        self.length = length
        sizes = np.array([len(s) for s in spans])
        self.ends = np.cumsum(sizes + 1) - 1  # where each span's own separator stands
        n = int(self.ends[-1]) + 1
        symbols = np.frombuffer(b"\0".join(spans) + b"\0", np.uint8).astype(np.int64) + 1
        symbols[self.ends] = 0
        order = self._sorted(symbols, n, int(sizes.max()) + 1)
        before = symbols[order - 1]
        before[order == 0] = 0
        starts = np.flatnonzero(np.diff(before, prepend=-1))
        self.starts, self.heads = starts, before[starts]
        last = np.append(starts[1:], n) - 1
        self.samples = order[last]  # a text position at every run end
        # Rows that begin with a symbol are in the order of its runs.
        lengths = last - starts + 1
        by_head = np.argsort(self.heads, kind="stable")
        self.goes = np.empty(len(starts), np.int64)
        self.goes[by_head] = np.cumsum(lengths[by_head]) - lengths[by_head]
        self.classes = np.flatnonzero(self._breaks(order, n))
        self.first = np.minimum.reduceat(order, self.classes)

    def _sorted(self, symbols: np.ndarray, n: int, longest: int) -> np.ndarray:
        """Suffix order; suffixes that agree to their separators go by span."""
        stop = np.repeat(self.ends, np.diff(self.ends, prepend=-1))
        place = np.arange(n)
        key = np.zeros(n, np.int64)
        for i in range(7):
            inside = place + i <= stop
            key = (key << 9) | np.where(inside, symbols[np.minimum(place + i, stop)], 0)
        key[self.ends] = np.arange(len(self.ends))
        k = 7
        order = np.argsort(key, kind="stable")
        # Separators come first, each with a rank of its own: the first row of its equals.
        fresh = np.ones(n, bool)
        fresh[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = _first_rows(fresh, np.arange(n))
        self.stop, self.rank, self.depth, k = stop, rank.copy(), 7, 7
        rows = np.flatnonzero(~_single(fresh))
        while len(rows) and k < longest:
            # Only rows that still have equals are sorted on, within their range.
            if k <= self.length:
                self.rank, self.depth = rank.copy(), k
            at = order[rows]
            key = rank[at] * n + rank[np.minimum(at + k, stop[at])]
            by_key = np.argsort(key, kind="stable")
            at, key = at[by_key], key[by_key]
            order[rows] = at
            fresh = np.ones(len(at), bool)
            fresh[1:] = key[1:] != key[:-1]
            rank[at] = _first_rows(fresh, rows)
            rows = rows[~_single(fresh)]
            k *= 2
        if k <= self.length:
            self.rank, self.depth = rank, k
        return order

    def _breaks(self, order: np.ndarray, n: int) -> np.ndarray:
        """Rows that don't share `length` bytes with the row before."""
        out = np.ones(n, bool)
        a, b = order[1:], order[:-1]
        long_ = (self.stop[a] - a >= self.length) & (self.stop[b] - b >= self.length)
        same, at = long_, 0
        while True:  # pieces of `depth` bytes that cover `length`
            x, y = np.where(same, a + at, a), np.where(same, b + at, b)
            same = same & (self.rank[x] == self.rank[y])
            if at + self.depth >= self.length:
                break
            at = min(at + self.depth, self.length - self.depth)
        out[1:] = ~same
        del self.rank, self.stop
        return out

    def earlier(self) -> list[np.ndarray]:
        """Per span, whether the match at each window start begins earlier."""
        count = len(self.ends)
        begin = np.concatenate([[0], self.ends[:-1] + 1])
        sizes = self.ends - begin
        out = [np.zeros(max(0, s - self.length + 1), bool) for s in sizes]
        flat = np.zeros(int(self.ends[-1]) + 1, bool)
        row, span, place = np.arange(count), np.arange(count), self.ends.copy()
        while len(row):
            run = np.searchsorted(self.starts, row, "right") - 1
            row = self.goes[run] + row - self.starts[run]
            place = place - 1
            inside = place >= begin[span]
            row, span, place = row[inside], span[inside], place[inside]
            whole = place + self.length <= self.ends[span]
            interval = np.searchsorted(self.classes, row[whole], "right") - 1
            flat[place[whole]] = self.first[interval] < place[whole]
        for i, a in enumerate(begin):
            out[i] = flat[a : a + len(out[i])]
        return out


_SPANS = (
    "shard int, ids array<long>, keys array<long>, starts array<long>, sizes array<int>, "
    "anchors array<long>, data binary, gone array<int>"
)


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    kinds = [pa.int32(), longs, longs, longs, ints, longs, pa.binary(), ints]
    names = [part.split()[0] for part in _SPANS.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
    )


def _spans(texts: DataFrame, length: int, gram: int, shards: int, block_bytes: int) -> DataFrame:
    """Spans of repeated anchors by shard; spans a block has twice are gone at once."""

    def run(batches):
        coder = zstandard.ZstdCompressor(level=1)
        for batch in runs(batches, "packed", block_bytes // 2):
            todo = sorted(
                zip(
                    (_FIRST if i is None else i for i in batch.column("id").to_pylist()),
                    batch.column("text_key").to_pylist(),
                    expand(batch.column("packed")),
                    batch.column("flags").to_pylist(),
                    strict=True,
                ),
                key=lambda x: x[:2],
            )
            seen: set[bytes] = set()
            deal: dict[int, tuple] = {}
            gone = ([], [], [], [])
            before = None
            for key, digest, text, flags in todo:
                if (key, digest) == before:  # the same document read twice
                    continue
                before = (key, digest)
                hashes, first, last = anchors(text, length, gram)
                at = np.flatnonzero(np.unpackbits(np.frombuffer(flags, np.uint8))[: len(first)])
                where = ((hashes[at] >> _U(32)) * _U(shards)) >> _U(32)
                ends = last[at] + length
                for shard, a, b, anchor in zip(
                    where.tolist(),
                    first[at].tolist(),
                    ends.tolist(),
                    hashes[at].view(np.int64).tolist(),
                    strict=True,
                ):
                    part = text[a:b]
                    if part in seen:
                        for column, value in zip(gone, (key, digest, a, b - a), strict=True):
                            column.append(value)
                        continue
                    seen.add(part)
                    slot = deal.setdefault(shard, ([], [], [], [], [], []))
                    values = (key, digest, a, b - a, anchor, part)
                    for column, value in zip(slot, values, strict=True):
                        column.append(value)
            rows = [
                (shard, *columns, coder.compress(b"".join(parts)), [])
                for shard, (*columns, parts) in deal.items()
            ]
            if gone[0]:
                rows.append((hash(gone[0][0]) % shards, *gone[:3], [], [], b"", gone[3]))
            if rows:
                yield _span_batch(rows)

    return texts.mapInArrow(run, _SPANS)


_GONE = "id long, text_key long, spans array<long>"


def _indexed(length: int):
    """Of one shard: the intervals of each document that start earlier too."""

    def run(table: pa.Table) -> pa.Table:
        decoder = zstandard.ZstdDecompressor()
        spans, out = [], {}
        for row in table.to_pylist():
            if row["gone"]:
                for i, k, a, n in zip(
                    row["ids"], row["keys"], row["starts"], row["gone"], strict=True
                ):
                    out.setdefault((i, k), []).extend((a, a + n))
                continue
            data, at = decoder.decompress(row["data"], max_output_size=sum(row["sizes"])), 0
            for i, k, a, n, anchor in zip(
                row["ids"], row["keys"], row["starts"], row["sizes"], row["anchors"], strict=True
            ):
                spans.append((i, k, a, data[at : at + n], anchor))
                at += n
        spans.sort(key=lambda s: s[:3])
        seen: dict[bytes, tuple] = {}
        distinct, forms = [], Counter()
        for i, k, a, part, anchor in spans:
            if part not in seen:
                seen[part] = (i, k, a)
                distinct.append((i, k, a, part, anchor))
                forms[anchor] += 1
            elif seen[part] != (i, k, a):
                out.setdefault((i, k), []).extend((a, a + len(part)))
        # A window is found only where its anchor is, and never twice around one anchor.
        distinct = [s for s in distinct if forms[s[4]] > 1]
        if distinct:
            found = RunIndex([s[3] for s in distinct], length).earlier()
            for (i, k, a, *_), earlier in zip(distinct, found, strict=True):
                if earlier.any():
                    cuts = intervals(np.flatnonzero(earlier), length) + a
                    out.setdefault((i, k), []).extend(cuts.tolist())
        return pa.table(
            {
                "id": pa.array([i for i, _ in out], pa.int64()),
                "text_key": pa.array([k for _, k in out], pa.int64()),
                "spans": pa.array(list(out.values()), pa.list_(pa.int64())),
            }
        )

    return run


def _joined(texts: DataFrame, side: DataFrame, how: str) -> DataFrame:
    side = side.select(
        F.col("id").alias("other_id"), F.col("text_key").alias("other_key"), side.columns[-1]
    )
    on = (F.coalesce(texts["id"], F.lit(_FIRST)) == F.col("other_id")) & (
        texts["text_key"] == F.col("other_key")
    )
    return texts.join(side.hint("shuffle_hash"), on, how).drop("other_id", "other_key")


def spans_to_remove(
    docs: DataFrame,
    length: int = 100,
    gram: int = 20,
    range_bytes: int = 64 << 20,
    shard_bytes: int = 1 << 20,
    block_bytes: int = 4 << 20,
    block_anchors: int = 1 << 18,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, text_key and `spans` (flat byte intervals, unordered) of texts with any.

    A null id reads as the least long.
    """
    bounded(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def hasher(text: bytes):
        hashes, first, _ = anchors(text, length, gram)
        return len(first), hashes, np.zeros(len(hashes), np.uint64)

    def flagged(table: pa.Table) -> pa.Table:
        texts, flags = block_flags(table)
        some = [f.any() for f in flags]
        packed = [np.packbits(f).tobytes() for f in flags]
        return pa.table(
            {
                "id": pa.array(texts.column("id").to_pylist(), pa.int64()).fill_null(_FIRST),
                "text_key": texts.column("key"),
                "flags": pa.array(packed, pa.binary()),
            }
        ).filter(pa.array(some, pa.bool_()))

    slices = hash_slices(docs, hasher, int(total // range_bytes) + 1, block_anchors, 0)
    flags = (
        slices.groupBy("range")
        .applyInArrow(repeated_places, "block long, width int, meta binary, places binary")
        .groupBy("block")
        .applyInArrow(flagged, "id long, text_key long, flags binary")
        .dropDuplicates(["id", "text_key"])
    )
    shards = int(total // shard_bytes) + 1
    spans = _spans(_joined(keyed(docs), flags, "inner"), length, gram, shards, block_bytes)
    return (
        spans.groupBy("shard")
        .applyInArrow(_indexed(length), _GONE)
        .groupBy("id", "text_key")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )


def repeated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """id, packed text, text_key and `spans` (null if none) of every document."""
    gone = spans_to_remove(docs, id_col=id_col, text_col=text_col, **options)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return _joined(keyed(docs), gone, "left")


def merged(spans: list[int] | None) -> list[tuple[int, int]]:
    """Flat intervals in any order as maximal ones; touching intervals are one."""
    out: list[list[int]] = []
    for a, b in sorted(zip(spans[::2], spans[1::2], strict=True)) if spans else ():
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at:a])
        at = b
    parts.append(text[at:])
    return b"".join(parts)


def report(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per row: bytes, removed bytes, removed runs and the digest of what stays."""

    def run(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(
                expand(batch.column("packed")), batch.column("spans").to_pylist(), strict=True
            ):
                spans = merged(spans)
                rest = kept(text, spans)
                digest = hashlib.sha256(rest).hexdigest()
                rows.append((len(text), len(text) - len(rest), len(spans), digest))
            columns = zip(*rows, strict=True) if rows else ((),) * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
                ],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    found = repeated(docs, id_col=id_col, **options).select("id", "packed", "spans")
    return found.mapInArrow(
        run, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    ).withColumnRenamed("id", id_col)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options):
    """The documents without repeated strings; all columns stay, empty texts too.

    A cut that would split a UTF-8 character leaves the character's bytes whole.
    """
    columns = docs.columns
    found = spans_to_remove(docs, id_col=id_col, text_col=text_col, **options).select(
        F.col("id").alias("found_id"), F.col("text_key").alias("found_key"), "spans"
    )
    rows = docs.select(F.struct(*columns).alias("row"), F.col(text_col).alias("text"))

    def key(batches):
        for batch in batches:
            keys = pa.array([text_key(t) for t in blobs(batch.column("text"))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), keys], names=["row", "key"])

    struct = rows.schema["row"].dataType.simpleString()
    number = F.coalesce(F.col("row")[id_col].cast("long"), F.lit(_FIRST))
    on = (number == F.col("found_id")) & (F.col("key") == F.col("found_key"))
    joined = rows.mapInArrow(key, f"row {struct}, key long").join(
        found.hint("shuffle_hash"), on, "left"
    )

    def run(batches):
        for batch in batches:
            texts = []
            for raw, spans in zip(
                batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True
            ):
                if not spans:
                    texts.append(raw)
                    continue
                text, whole = raw.encode(), []
                for a, b in merged(spans):
                    while a < b and text[a] & 0xC0 == 0x80:
                        a += 1
                    while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
                        b -= 1
                    whole.append((a, b))
                texts.append(kept(text, whole).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"]
            )

    changed = joined.select("row", F.col("row")[text_col].alias("text"), "spans").mapInArrow(
        run, f"row {struct}, text string"
    )
    return changed.select(
        *(
            F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c)
            for c in columns
        )
    )
