"""The stages of the corpus pipeline as a chain, on a table that has every odd case."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_operators import DOCS, ITEMS, SCHEMA
from tidemark.llm.queries import vocabulary


@pytest.fixture
def sf_dir(spark, tmp_path):
    def write(rows, name, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))

    def tables(docs, labels):
        write(docs, "documents", SCHEMA)
        write(ITEMS, "benchmark", "item_id string, text string")
        write(labels, "labels", "doc_id long, quality int, toxic int")
        return str(tmp_path)

    return tables


def cut(raw, mask):
    return bytes(b for b, gone in zip(raw, mask, strict=True) if not gone)


def test_stages_one_after_another(spark, sf_dir):
    """Nobody is labelled toxic, so all pass the first stage; the plain versions say what
    each later one keeps of what the one before kept."""
    folder = sf_dir([(k, t, "en", "s", 5, "key", "row") for k, t in DOCS], [(1, 1, 0)])
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns, name
            kept.append({r.doc_id: r.text for r in docs.collect()})
    toxic, copies, passages, clean = kept
    assert toxic == dict(DOCS)
    assert set(copies) == {k for k, _, _, yes in brute.near_duplicates(DOCS, 5, 80) if yes}
    rows = list(copies.items())
    for (key, text), found in zip(rows, brute.suffixes(rows), strict=True):
        raw = (text or "").encode()
        left = (passages[key] or "").encode()
        # Bytes of a character that a cut would split stay.
        assert 0 <= len(left) - (len(raw) - found[2]) <= 6 * found[3]
        assert found[2] or passages[key] == text
    hits = brute.hits(list(passages.items()), ITEMS)
    assert set(clean) == {k for k, n, hit, *_ in hits if 2 * hit < n or not hit}
    assert all(clean[k] == passages[k] for k, _, hit, *_ in hits if k in clean and not hit)
    assert not any(h[5] for h in brute.hits(list(clean.items()), ITEMS))
    brute.check_packing(list(clean.items()), docs.collect(), vocabulary())


def test_run_on_empty_tables(spark, sf_dir):
    folder = sf_dir([], [])
    assert corpus_pipeline.run(spark, folder).count() == 0
