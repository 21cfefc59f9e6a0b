"""Components of edge tables, and how many intermediate tables they and op8 write."""

from __future__ import annotations

import random
from pathlib import Path

import pytest

from tests.llm import brute
from tidemark.llm import graph, minhash


def folders(spark):
    return set(Path(spark.conf.get("spark.checkpoint.dir")).glob("tidemark-*"))


def edge_table(spark, path, edges):
    rows = [tuple(None if x is None else f"{x:05}".encode() for x in e) for e in edges]
    spark.createDataFrame(rows, "x binary, y binary").repartition(3).write.parquet(str(path))
    return spark.read.parquet(str(path))


def least_reachable(edges):
    near = {}
    for x, y in edges:
        if x is not None and y is not None and x != y:
            near.setdefault(x, set()).add(y)
            near.setdefault(y, set()).add(x)
    least = {}
    for start in sorted(near):
        queue = [] if start in least else [start]
        while queue:
            node = queue.pop()
            if node not in least:
                least[node] = start
                queue.extend(near[node])
    return least


DRAW = random.Random(3)
GRAPHS = {
    "none": [],
    "loops and nulls": [(1, 1), (None, 2), (3, None), (4, 5), (4, 5), (5, 4)],
    "star outwards": [(1, i) for i in range(2, 40)],
    "star around its largest": [(99, i) for i in range(2, 40)],
    "chain": [(i, i + 1) for i in range(60)],
    "chain, mixed up": [*zip(p := DRAW.sample(range(200), 50), p[1:], strict=False)],
    "random": [(DRAW.randrange(300), DRAW.randrange(300)) for _ in range(170)],
    "two leaves of two stars": [*((1, i) for i in range(10, 20)), *((2, i) for i in range(19, 30))],
    "a star's centre is another's leaf": [*((5, i) for i in range(10, 20)), (1, 5)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components_are_the_least_nodes_reachable(spark, tmp_path, name):
    edges = GRAPHS[name]
    found = graph.components(edge_table(spark, tmp_path / "edges", edges)).collect()
    got = {int(r.node): int(r.component) for r in found}
    assert len(found) == len(got)
    assert got == least_reachable(edges)


def test_edges_that_are_stars_already_are_written_once(spark, tmp_path):
    edges = edge_table(spark, tmp_path / "edges", [(k, 100 * k + i) for k in range(1, 5) for i in range(9)])
    before = folders(spark)
    assert graph.components(edges).count() == 40
    assert len(folders(spark) - before) == 1


def test_intermediate_tables_of_near_duplicates(spark, tmp_path):
    """Profiles, pairs, sets, alike and coded members, and each components' edges."""
    draw = random.Random(5)
    texts = [" ".join(f"w{draw.randrange(900)}" for _ in range(200)) for _ in range(12)]
    texts += [f"{t} tail" for t in texts[:6]] + texts[6:9]
    docs = list(enumerate(texts))
    path = str(tmp_path / "docs")
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(path)
    before = folders(spark)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.read.parquet(path)).collect()}
    assert got == {r[0]: r[2] for r in brute.near_duplicates(docs)}
    assert len(folders(spark) - before) == 7
