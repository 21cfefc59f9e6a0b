"""Benchmark decontamination by a broadcast set of token windows.

Words are runs of a-z (after lower-casing A-Z), digits and non-ASCII characters.
Every window of `window` consecutive words of a benchmark item is looked up in every
text; an item with fewer words, but at least one, is one window of its own. Hash hits
are verified word by word. Words inside an occurrence are hit.

The benchmark is broadcast in blocks of at most `block_bytes` of text, as many as it
takes: each block is one narrow step that adds its hits to the rows, and the documents are
never shuffled. All blocks pass through the driver, one at a time, and stay with the
executors for the whole pass, so the benchmark has to fit their memory.

Null and empty texts have no words. Repeated rows are judged one by one. Items without
text or words are never found; those without an id hit, and count as one item without a
name. An empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import blobs, bounded

#: To lower case, and ASCII that is no part of a word to a blank.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def _rolled(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of `size` ids."""
    n = len(ids) - size + 1
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * _BASE + ids[i : i + n]
    return out


def _by_name(item: str | None) -> tuple[bool, str]:
    return item is None, item or ""


class Index:
    """The windows of one block of items, by length."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                found = windows.setdefault(size, {}).setdefault(tuple(ids[i : i + size]), set())
                found.add(item)
        self.windows = windows
        self.hashes = {
            size: np.unique([_rolled(np.array(w, np.uint64), size)[0] for w in found])
            for size, found in windows.items()
        }

    def hits(self, words: list[bytes], hit: np.ndarray, items: set[str]) -> None:
        """Marks the hit words and adds the items found."""
        get = self.vocabulary.get
        ids = np.array([get(w, 0) for w in words], np.uint64)
        for size, found in self.windows.items():
            if len(ids) < size:
                continue
            known = np.concatenate([[0], np.cumsum(ids > 0)])
            at = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(at):
                continue
            rolled = _rolled(ids, size)[at]
            hashes = self.hashes[size]
            place = np.minimum(np.searchsorted(hashes, rolled), len(hashes) - 1)
            for i in at[hashes[place] == rolled]:
                who = found.get(tuple(ids[i : i + size].tolist()))
                if who is not None:
                    hit[i : i + size] = True
                    items |= who


def _blocks(
    benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int
) -> Iterator[list[tuple[str, list[bytes]]]]:
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")
    ).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = total // block_bytes + 1
    if parts > 1:
        items = items.repartition(parts, "item", "text")
    block, size = [], 0
    for row in items.toLocalIterator():
        raw = row.text.encode()
        block.append((row.item, words_of(raw)))
        size += len(raw)
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = 4 << 20,
) -> DataFrame:
    """id, text, `hits` (one byte a word, 1 if hit) and `items` of every row."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.lit(b"").alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    bounded(docs.sparkSession)
    schema = rows.schema
    context = docs.sparkSession.sparkContext
    for block in _blocks(benchmark, item_col, item_text_col, block_bytes):
        index = context.broadcast(Index(block, window))

        def add(batches, index=index):
            for batch in batches:
                hits, items = [], []
                before = zip(
                    blobs(batch.column("text")),
                    batch.column("hits").to_pylist(),
                    batch.column("items").to_pylist(),
                    strict=True,
                )
                for text, old, found in before:
                    words = words_of(text)
                    hit = np.zeros(len(words), bool)
                    if old:
                        hit |= np.frombuffer(old, bool)
                    who = set(found)
                    index.value.hits(words, hit, who)
                    hits.append(hit.tobytes() if hit.any() else b"")
                    items.append(sorted(who, key=_by_name))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        batch.column("text"),
                        pa.array(hits, pa.binary()),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names=["id", "text", "hits", "items"],
                )

        rows = rows.mapInArrow(add, schema)
    return rows


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per row: words, hit words, items with an occurrence, and whether any is hit."""
    marked = mark(docs, benchmark, id_col=id_col, **options)
    kind = marked.schema["id"].dataType.simpleString()

    def count(batches):
        for batch in batches:
            out = []
            for text, hit, items in zip(
                blobs(batch.column("text")),
                batch.column("hits").to_pylist(),
                batch.column("items").to_pylist(),
                strict=True,
            ):
                named = ",".join(sorted(i for i in items if i is not None))
                digest = hashlib.sha256(named.encode()).hexdigest()
                out.append((len(words_of(text)), sum(hit or b""), len(items), digest))
            n_words, n_hit, n_items, digests = zip(*out, strict=True) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array(n_items, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array([n > 0 for n in n_hit], pa.bool_()),
                ],
                names=["id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return marked.mapInArrow(
        count,
        f"id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, "
        "contaminated boolean",
    ).withColumnRenamed("id", id_col)


def cut(text: bytes, hits: bytes) -> bytes:
    """The text without its hit words and what stands between neighbouring ones."""
    flat = text.translate(_WORDS)
    spans = [m.span() for m in re.finditer(rb"[^ ]+", flat)]
    out, at, end = [], 0, 0
    for hit, group in groupby(hits):
        n = len(list(group))
        if hit:
            out.append(text[end : spans[at][0]])
            end = spans[at + n - 1][1]
        at += n
    out.append(text[end:])
    return b"".join(out)


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    drop_share: float = 0.5,
    text_col: str = "text",
    **options,
) -> DataFrame:
    """The documents, with hit words cut out of their texts.

    A document of which `drop_share` or more of the words are hit goes as a whole.
    All columns stay; only the text changes, and only where it was hit.
    """
    columns = docs.columns
    packed = docs.select(F.struct(*columns).alias("row"), F.col(text_col).alias("text"))
    marked = mark(packed, benchmark, id_col="row", text_col="text", **options)
    marked = marked.withColumnRenamed("id", "row")

    def apply(batches):
        for batch in batches:
            texts, keep = [], []
            for text, null, hit in zip(
                blobs(batch.column("text")),
                batch.column("text").is_null().to_pylist(),
                batch.column("hits").to_pylist(),
                strict=True,
            ):
                share = sum(hit) / len(hit) if hit else 0.0
                keep.append(share < drop_share)
                texts.append(None if null else cut(text, hit).decode() if hit else text.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"]
            ).filter(pa.array(keep, pa.bool_()))

    schema = marked.select("row", "text").schema
    cleaned = marked.select("row", "text", "hits").mapInArrow(apply, schema)
    return cleaned.select(
        *(
            F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c)
            for c in columns
        )
    )
