"""Toxicity by compression distance.

Two zstandard dictionaries are made, one of toxic and one of ordinary text: each holds
the words most typical of its own class, by the z-score of their document frequencies,
after the `common` most frequent words of all, if any are asked for. A text is cut into
windows of `window_words` words, ASCII punctuation left out, and each window is compressed
with either dictionary. Where the toxic dictionary saves bytes against the ordinary one,
the window is closer to toxic text; as matches are substrings, forms of a typical word
that were never seen count as well. Every word stands between edges, so that matches
from a word's start save more than those within it. On held-out rows at sf0.1 windows of one
word did best.

A document's largest difference, the mean of its three largest and its length are
calibrated to a probability on the sample by a logistic curve. The sample has at most
`sample_rows` labelled rows, those with the least hash of their id, without texts over
`sample_text_bytes`; it bounds what is learned from, not what is scored. Without rows of
both labels every score is the share of the label there is (0 without any).

Null and empty texts are one empty window. Ids aren't inputs of a score; rows with a
null id or label are scored but not learned from, repeated labels are learned from as
often as they occur, and conflicting ones as both.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import blobs, bounded


#: A-Z to lower case, other ASCII but digits and letters to a blank.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


#: At the start of all windows and the end of both dictionaries. It always matches, so a
#: window is never stored raw, and each further match shows in the length.
_PRIMER = b"\x01\x02\x03\x04\x05\x06\x07\x08\x0e\x0f\x10\x11\x12\x13\x14\x15"


def framed(words: list[bytes], edge: bytes) -> bytes:
    """Words with an edge before and after each, which makes whole words worth more."""
    return edge + edge.join(words) + edge


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    level: int
    min_match: int
    window_words: int
    edge: bytes
    weights: tuple[float, ...]
    prior: float

    def meter(self, memory: int = 200_000) -> Callable[[bytes], int]:
        """What a window saves with the toxic dictionary; remembers `memory` windows."""

        def one(content: bytes) -> zstandard.ZstdCompressor:
            return zstandard.ZstdCompressor(
                compression_params=zstandard.ZstdCompressionParameters.from_level(
                    self.level,
                    source_size=64,
                    dict_size=len(content),
                    min_match=self.min_match,
                    write_content_size=0,
                    write_dict_id=0,
                ),
                dict_data=zstandard.ZstdCompressionDict(
                    content, dict_type=zstandard.DICT_TYPE_RAWCONTENT
                ),
            )

        toxic, ordinary = one(self.toxic).compress, one(self.ordinary).compress

        @lru_cache(memory)
        def gain(window: bytes) -> int:
            return len(ordinary(window)) - len(toxic(window))

        return gain

    def features(self, text: bytes, gain: Callable[[bytes], int]) -> tuple[float, ...]:
        words, size = words_of(text), self.window_words
        gains = [
            gain(_PRIMER + framed(words[i : i + size], self.edge))
            for i in range(0, max(1, len(words)), size)
        ]
        gains.sort(reverse=True)
        top, mean = gains[:3], sum(gains) / len(gains)
        spread = math.sqrt(sum((g - mean) ** 2 for g in gains) / len(gains))
        return 1.0, gains[0], sum(top) / len(top), mean, spread, math.log(len(gains))

    def probability(self, features: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(features), self.prior)
        return 1 / (1 + np.exp(-np.clip(features @ np.array(self.weights), -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic curve, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(
    texts: list[bytes],
    toxic: list[bool],
    typical: int = 60,
    common: int = 0,
    min_count: int = 4,
    min_score: float = 3.0,
    level: int = 6,
    min_match: int = 6,
    window_words: int = 1,
    edge: bytes = b"\n\n\n",
    folds: int = 8,
) -> Model:
    """Dictionaries from the texts, and the curve that calibrates them.

    The texts are dealt to `folds`, and the curve is fitted to each fold under
    dictionaries built from the others, which are close to those that stay: these are
    built from all texts.
    """
    total = sum(toxic)
    prior = total / max(1, len(texts))
    if not 0 < total < len(texts):
        return Model(b"", b"", level, min_match, window_words, edge, (), prior)
    # Each class dealt in turn, so that every fold has its share of both.
    order = sorted(range(len(texts)), key=lambda i: (toxic[i], i))
    fold = {i: n % folds for n, i in enumerate(order)}
    counts = [(Counter(), Counter()) for _ in range(folds)]
    sizes = [[0, 0] for _ in range(folds)]
    for i, (text, bad) in enumerate(zip(texts, toxic, strict=True)):
        counts[fold[i]][bad].update(set(words_of(text)))
        sizes[fold[i]][bad] += 1
    every = tuple(sum((c[side] for c in counts), Counter()) for side in (0, 1))
    whole = [sum(s[side] for s in sizes) for side in (0, 1)]

    def built(without: int | None) -> Model:
        good, bad = every
        n_good, n_bad = whole
        if without is not None:
            good, bad = (every[side] - counts[without][side] for side in (0, 1))
            n_good, n_bad = (max(1, whole[side] - sizes[without][side]) for side in (0, 1))
        both = good + bad

        def score(word: bytes) -> float:
            p = both[word] / (n_good + n_bad)
            spread = math.sqrt(p * (1 - p) * (1 / n_good + 1 / n_bad)) + 1e-9
            return (bad[word] / n_bad - good[word] / n_good) / spread

        known = {w: score(w) for w, n in both.items() if n >= min_count}
        words = sorted(known, key=lambda w: (-known[w], w))
        shared = sorted(both, key=lambda w: (-both[w], w))[:common][::-1]
        base = framed(shared, edge) if shared else b""
        ends = (words[:typical], words[::-1][:typical])
        tops = [framed([w for w in end if abs(known[w]) >= min_score], edge) for end in ends]
        size = max(map(len, tops))
        parts = [base + top.rjust(size) + _PRIMER for top in tops]
        return Model(*parts, level, min_match, window_words, edge, (), prior)

    x, y = [], []
    for part in range(folds):
        model = built(part)
        gain = model.meter()
        x += [model.features(t, gain) for i, t in enumerate(texts) if fold[i] == part]
        y += [bad for i, bad in enumerate(toxic) if fold[i] == part]
    weights = _logistic(np.array(x), np.array(y, float))
    return replace(built(None), weights=tuple(weights))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column | None = None,
    sample_rows: int = 8000,
    sample_text_bytes: int = 1 << 15,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    **options,
) -> Model:
    """Trains on labelled rows; `usable` is a condition on `id`."""
    marked = labels.select(F.col(id_col).alias("id"), (F.col(label_col) == 1).alias("bad"))
    marked = marked.where("id is not null and bad is not null")
    if usable is not None:
        marked = marked.where(usable)
    chosen = marked.orderBy(F.xxhash64("id"), "id", "bad").limit(sample_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    sample = texts.where(F.octet_length("text") <= sample_text_bytes).join(
        F.broadcast(chosen), "id"
    )
    rows = sorted((r.id, r.text.encode(), r.bad) for r in sample.toLocalIterator())
    return train([r[1] for r in rows], [r[2] for r in rows], **options)


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"):
    """Per row: id and score."""
    bounded(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        gain = model.meter() if model.weights else None
        for batch in batches:
            texts = blobs(batch.column("text"))
            if model.weights:
                x = np.array([model.features(t, gain) for t in texts]).reshape(-1, 6)
            else:
                x = np.zeros((len(texts), 6))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(model.probability(x), pa.float64())],
                names=["id", "score"],
            )

    return rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def without_toxic(
    docs: DataFrame, model: Model, threshold: float, text_col: str = "text"
) -> DataFrame:
    """The documents with a score below the threshold; all columns stay."""
    columns = docs.columns
    packed = docs.select(F.struct(*columns).alias("row"), F.col(text_col).alias("text"))
    kept = scores(packed, model, id_col="row").where(F.col("score") < threshold)
    return kept.select(*(F.col("row")[c].alias(c) for c in columns))
