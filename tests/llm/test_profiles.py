"""Language profiles and their distance against a plain version."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np

from tidemark.llm import language


def test_rows_that_are_learned_from_are_those_of_least_hash(spark, tmp_path):
    """However a language's rows are cut to parts, the same ones are chosen."""
    rows = [(i, f"text {zlib.crc32(str(i).encode())} abc", "xy"[i % 2]) for i in range(400)]
    rows += [(1, "text again", "y"), (None, "no id", "x"), (5, None, "y"), (6, "no language", None)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5).write.parquet(path)
    docs = spark.read.parquet(path)
    few = language.learn(docs, rows_per_lang=30, size=40)
    hashes = {
        r.doc_id: r.h
        for r in docs.selectExpr("doc_id", "xxhash64(doc_id) h").where("doc_id is not null").collect()
    }
    for lang in "xy":
        mine = [(k, t) for k, t, g in rows if g == lang and k is not None and t is not None]
        ranked = sorted((k for k, _ in mine), key=lambda k: (hashes[k], k))[:30]
        counts = Counter()
        for key, text in mine:
            if key in ranked:
                grams, n = language.gram_counts(text.encode())
                counts.update(dict(zip(grams.tolist(), n.tolist(), strict=True)))
        want = sorted(counts, key=lambda g: (-counts[g], g))[:40]
        assert few[lang] == want


def test_nearest_profile_by_out_of_place_distance(spark, tmp_path):
    """Predictions are those of summed rank differences, counted one by one."""
    texts = ["abc abd", "xyz xyw xyz", "abc xyz abc", "q", "ABC abd", "xyz"]
    path = str(tmp_path / "docs")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(path)
    docs = spark.read.parquet(path)
    first, second = (language.gram_counts(t.encode()) for t in ("abc abd abc", "xyz xyw xyz"))
    profiles = {
        name: language.profile(np.asarray(g), np.asarray(n), 300).tolist()
        for name, (g, n) in (("a", first), ("x", second))
    }
    got = {r.doc_id: r.lang_pred for r in language.predict(docs, profiles).collect()}
    for key, text in enumerate(texts):
        grams, n = language.gram_counts(text.encode())
        mine = language.profile(np.asarray(grams), np.asarray(n), 300).tolist()
        cost = {}
        for name, other in profiles.items():
            place = {g: i for i, g in enumerate(other)}
            cost[name] = sum(abs(i - place[g]) if g in place else 300 for i, g in enumerate(mine))
        assert cost[got[key]] == min(cost.values()), (text, cost, got[key])
