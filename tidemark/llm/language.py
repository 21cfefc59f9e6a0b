"""Language identification by rank-order profiles of character n-grams.

A text's letters are lower-cased, everything else counts as a space, and n-grams of
one to three characters are counted; a space may stand at either end of one, not
within. A profile is the `size` most frequent n-grams in order, ties by code points. A
document's distance to a language sums over its own profile how far each n-gram is out
of place in the language's, or `size` where it is missing. The nearest language wins,
ties by name.

Profiles are learned from at most `rows_per_lang` rows of each language, those with
the least hash of their id; counts are added up in Spark, and only profiles come to
the driver. What is predicted isn't bounded: every text is read whole.

The score is the share of the winner in the inverse distances. A text that is null or
has no letter is `und` with score 0, also where nothing was learned. Rows with a null
language or id aren't learned from.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.graph import stored
from tidemark.llm.text import blobs, bounded
from tidemark.operators.joins import at_most

UNKNOWN = "und"
_SHIFT = 21  # bits of a code point


@cache
def _letters() -> np.ndarray:
    """Of each code point, its lower case if it is a letter, else a space."""
    table = np.full(0x110000, 32, np.int64)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            lower = char.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def gram_counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams in ascending order, and how often each occurs."""
    codes = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    x = _letters()[codes]
    x = np.concatenate([[32], x, [32]])
    space = x == 32
    stays = ~space
    stays[0] = True
    stays[1:] |= ~space[:-1]
    x, space = x[stays], space[stays]
    two = (x[:-1] << _SHIFT) | x[1:]
    three = (two[:-1] << _SHIFT) | x[2:]
    grams = np.concatenate([x[~space], two, three[~space[1:-1]]])
    return np.unique(grams, return_counts=True)


def profile(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    if len(grams) > size:  # all that tie with the last place come along
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))][:size]


#: Parts of a language that are ranked apart.
_PARTS = 64


def learn(
    docs: DataFrame,
    usable: Column | None = None,
    size: int = 300,
    rows_per_lang: int = 1000,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> dict[str, list[int]]:
    """The profile of each language; `usable` is a condition on `id`."""
    bounded(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where("id is not null and lang is not null and text is not null")
    if usable is not None:
        rows = rows.where(usable)
    # Least hashes of parts of a language first, so that no task ranks a whole one.
    ranked = rows.select("id", "lang", F.xxhash64("id").alias("hash"))
    ranked = ranked.withColumn("part", F.pmod("hash", F.lit(_PARTS)))
    for keys in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy("hash", "id")
        ranked = ranked.withColumn("place", F.row_number().over(order))
        ranked = ranked.where(F.col("place") <= rows_per_lang).drop("place")
    chosen = stored(ranked.select("id", "lang").dropDuplicates())
    if at_most(chosen):  # so the texts of the others aren't shuffled
        chosen = F.broadcast(chosen)

    def run(batches):
        for batch in batches:
            for lang, text in zip(
                batch.column("lang").to_pylist(), blobs(batch.column("text")), strict=True
            ):
                grams, counts = gram_counts(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(grams), pa.string()),
                        pa.array(grams, pa.int64()),
                        pa.array(counts, pa.int64()),
                    ],
                    names=["lang", "gram", "n"],
                )

    places = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = (
        rows.join(chosen, ["id", "lang"], "left_semi")
        .select("lang", "text")
        .mapInArrow(run, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(places))
        .where(F.col("place") <= size)
    )
    found: dict[str, list[int]] = {}
    for row in top.orderBy("lang", "place").select("lang", "gram").toLocalIterator():
        found.setdefault(row.lang, []).append(row.gram)
    return found


def predict(
    docs: DataFrame,
    profiles: dict[str, list[int]],
    size: int = 300,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id, lang_pred and score."""
    bounded(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    names = sorted(profiles)

    def run(batches):
        grams = np.unique(np.array([g for n in names for g in profiles[n]], np.int64))
        # The place of each known n-gram in each language; `missing` where it has none.
        missing = 1 << 20
        places = np.full((len(grams) + 1, len(names)), missing, np.int64)
        for column, name in enumerate(names):
            places[np.searchsorted(grams, profiles[name]), column] = np.arange(
                len(profiles[name])
            )
        for batch in batches:
            langs, scores = [], []
            for text in blobs(batch.column("text")):
                own = profile(*gram_counts(text), size)
                if not len(own) or not names:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                at = np.searchsorted(grams, own)
                at[(at == len(grams)) | (grams[np.minimum(at, len(grams) - 1)] != own)] = -1
                apart = np.abs(places[at] - np.arange(len(own))[:, None])
                distance = np.minimum(apart, size).sum(axis=0)
                near = 1 / (1.0 + distance)
                best = int(np.argmin(distance))
                langs.append(names[best])
                scores.append(float(near[best] / near.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["id", "lang_pred", "score"],
            )

    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed(
        "id", id_col
    )
