"""Large groups of texts that are nearly, but not quite, near enough to be linked."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from tests.llm import brute
from tidemark.llm import minhash


def group(count, changes, seed, words=220):
    """Copies of one text with as many words changed at random places, each its own."""
    draw = random.Random(seed)
    page = [f"p{seed}w{i}" for i in range(words)]
    for i in range(count):
        text = list(page)
        for k in draw.sample(range(words), changes):
            text[k] = f"g{seed}d{i}c{k}"
        yield " ".join(text)


def smallest_linked(texts, percent=85):
    """Of each text the smallest number reachable, by a product of the 0/1 matrix of all
    shingles with itself."""
    words = [t.split() for t in texts]
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in words]
    number = {}
    cells = [(i, number.setdefault(x, len(number))) for i, s in enumerate(sets) for x in s]
    marks = np.zeros((len(sets), len(number)), np.float32)
    marks[tuple(zip(*cells, strict=True))] = 1
    common, n = marks @ marks.T, marks.sum(axis=1)
    similar = common / (n[:, None] + n - common)
    links = 100 * common >= percent * (n[:, None] + n - common)
    least = np.arange(len(sets))
    while True:
        new = np.array([least[row].min() for row in links])
        if (new == least).all():
            return similar, least.tolist()
        least = new


def test_group_just_under_the_threshold_makes_few_rows(spark, tmp_path):
    """2000 texts with similarities from 0.80 to 0.84 mostly, some of them linked."""
    texts = list(group(2000, 6, 1, 350))
    # A word more at the end: linked with their own copy.
    texts += [texts[i] + " tail" for i in range(0, 2000, 20)]
    similar, want = smallest_linked(texts)
    near = similar[:2000, :2000][np.triu_indices(2000, 1)]
    assert ((near > 0.8) & (near < 0.85)).mean() > 0.9
    path = str(tmp_path / "docs")
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(path)
    found = minhash.near_duplicates(spark.read.parquet(path)).collect()
    assert [r.component_id for r in sorted(found, key=lambda r: r.doc_id)] == want
    assert max(Counter(want).values()) < 2000


@pytest.mark.parametrize("block", [2, 7, 512])
def test_links_found_only_by_the_second_phase(spark, tmp_path, block):
    """Clusters of linked texts around a text that none of them is linked with."""
    texts = [t for s in range(6) for t in group(9, 7, s)]
    texts += [f"{t} extra" for t in texts[::3]]
    docs = list(enumerate(texts))
    path = str(tmp_path / f"docs{block}")
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(path)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.read.parquet(path), block=block).collect()}
    assert got == {r[0]: r[2] for r in brute.near_duplicates(docs)}


def test_sizes_of_intersections_of_coded_sets():
    draw = np.random.default_rng(4)
    leader = np.unique(draw.integers(0, 1 << 63, 300).astype(np.uint64))
    others = np.unique(draw.integers(0, 1 << 63, 500).astype(np.uint64))
    sets = [
        np.unique(np.concatenate([draw.choice(leader, n), draw.choice(others, n)]))
        for n in (0, 1, 50, 200, 200, 200)
    ]
    kept = [np.packbits(np.isin(leader, s)).tobytes() for s in sets]
    extra = [s[~np.isin(s, leader)].tobytes() for s in sets]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    apart = ~np.eye(len(sets), dtype=bool)  # of a set with itself nothing is asked
    for width in (8, 64, 1 << 13):
        got = minhash.common_sizes(kept, extra, width)
        assert got[apart].tolist() == np.array(want)[apart].tolist()
