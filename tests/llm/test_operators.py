"""The operators against plain versions, on a small table that has every odd case."""

from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import decontaminate, language, minhash, packing, rules, substrings, suffixes
from tidemark.llm import toxicity, urls
from tidemark.llm.queries import vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, id long, key string, row string"


def odd_texts() -> list[str | None]:
    """Null, empty, blanks, copies, near copies, shared passages, one long text."""
    draw = random.Random(7)

    def prose(n, size=400):
        return " ".join(f"w{draw.randrange(size)}é" for _ in range(n))

    shared, page = prose(60), prose(200)
    words = page.split()
    near = " ".join([*words[:100], "changed", *words[101:]])
    benchmark = "one two Three four five six seven eight nine ten eleven"
    texts = [
        None, "", " \t\n", "a", "a b", "A B", "a b c", "#$%&|<>*", "x" * 250, "é" * 150,
        page, page, page.upper(), near, near + " tail",
        prose(80) + "\n" + shared, shared + " " + prose(90), prose(40) + shared,
        "line here\n" * 30, "same same same same " * 40, "\x0b\x0c\r\n words\x85between\xa0these",
        prose(50) + " " + benchmark + ", " + prose(30), benchmark, "SHORT-ITEM", "short item, twice short item",
        prose(20000, 50000), prose(3000, 5),
    ]
    return texts + [prose(draw.randrange(1, 300)) for _ in range(20)]


DOCS = list(enumerate(odd_texts()))
ITEMS = [
    ("b1", "one two three four five six seven eight nine ten eleven"),
    ("b2", "short item"), ("b3", ""), ("b4", None), (None, "a b c"), ("b5", "never found at all"),
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return tmp_path_factory.mktemp("tables")


@pytest.fixture(scope="module")
def write(spark, folder):
    """Tables as operators get them: read from storage, in several files."""

    def write(rows, schema=SCHEMA, parts=3):
        path = str(folder / uuid.uuid4().hex)
        spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
        return spark.read.parquet(path)

    return write


@pytest.fixture(scope="module")
def docs(write):
    return write([(k, t, "en", "s", 5, "key", "row") for k, t in DOCS])


@pytest.fixture(scope="module")
def empty(write):
    return write([], parts=1)


@pytest.fixture(scope="module")
def items(write):
    return write(ITEMS, "item_id string, text string", 1)


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_quality_counts(docs):
    want = sorted((k, *brute.base_counts(t)) for k, t in DOCS)
    assert rows(rules.quality(docs), "doc_id", *BASE) == want


def test_quality_order_moves_no_verdict(docs):
    def kept(gains):
        measured = [rules.Measured(r.name, 1.0, g) for r, g in zip(rules.RULES, gains, strict=True)]
        return rows(rules.quality(docs, measured=measured), "doc_id", "kept")

    n = len(rules.RULES)
    assert kept(range(n)) == kept(range(n, 0, -1)) == rows(rules.quality(docs), "doc_id", "kept")


def test_quality_order_is_by_rejection_per_cost():
    measured = [
        rules.Measured(r.name, s, g)
        for r, s, g in zip(rules.RULES[:3], (1.0, 2.0, 1.0), (0.2, 0.9, 0.1), strict=True)
    ]
    got = [r.name for r in rules.ordered(rules.RULES[:3], measured)]
    assert got == [rules.RULES[1].name, rules.RULES[0].name, rules.RULES[2].name]


def test_substrings(docs):
    got = rows(substrings.report(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.substrings(DOCS))


def test_substrings_over_many_blocks(docs):
    got = substrings.report(docs, window=3, block_windows=64, range_bytes=4096)
    want = sorted(brute.substrings(DOCS, 3))
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_urls(spark, write):
    hosts = ["net", "a.net", "example.net", "A.Example.NET", "xexample.net", "example.com", "b.org",
             "org.", "", "a.b.example.com", "net.com"]
    paths = ["", "/", "/en/", "/en", "/de/1", "/fr/x/", "/en/?q=/de/", "?x", "#/en/", "//en/"]
    pages = [f"http://{h}{p}" for h in hosts for p in paths]
    pages += [None, "", "no scheme", "://", "http://a.net/en/\n://example.net/en/", pages[0]]
    table = write(list(enumerate(pages)), "page_id long, url string")
    got = urls.verdicts(table, urls.rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")
    assert {tuple(r) for r in got.collect()} == {(i, *brute.url(u)) for i, u in enumerate(pages)}
    assert got.count() == len(pages)
    assert urls.verdicts(table.where("false"), urls.rule_table(spark)).count() == 0


def test_urls_of_very_many_parts(spark, write):
    """Depths that rules have are found at any depth of the URL; extra columns play no part."""
    rules = [("block", "a.b.c", "/1/2/3/"), ("allow", "c", "/1/"), ("block", "b.c", "/1/2/x")]
    deep = "/".join(str(i) for i in range(1, 40001))
    hosts = ["c", "b.c", "a.b.c", "x." * 300 + "a.b.c", ".".join(["y"] * 20000) + ".c"]
    pages = [f"http://{h}/{p}" for h in hosts for p in (deep, "1/2/xyz", "1/2", "1", "")]
    table = write([(i, u, "h", "p", 1) for i, u in enumerate(pages)],
                  "page_id long, url string, host string, path string, size int")
    frame = spark.createDataFrame(rules, "verdict string, host string, path string")
    got = {r.page_id: (r.rule, r.verdict) for r in urls.verdicts(table, frame).collect()}
    for i, u in enumerate(pages):
        host, path = u.split("://")[1].split("/", 1)
        fit = [(h + p, v) for v, h, p in rules
               if (host == h or host.endswith("." + h)) and f"/{path}".startswith(p)]
        assert got[i] == max(fit, key=lambda x: len(x[0]), default=(None, "allow"))


HIT = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


@pytest.mark.parametrize("block_bytes", [4 << 20, 10])
def test_decontaminate(docs, items, block_bytes):
    got = decontaminate.report(docs, items, block_bytes=block_bytes)
    assert rows(got, *HIT) == sorted(brute.hits(DOCS, ITEMS))


def test_decontaminate_nothing(docs, empty, items):
    assert rows(decontaminate.report(docs, items.where("false")), *HIT) == sorted(brute.hits(DOCS, []))
    assert decontaminate.report(empty, items).count() == 0


def test_clean_cuts_hits_alone(docs, items):
    cleaned = decontaminate.clean(docs, items)
    assert cleaned.schema.names == docs.schema.names
    got = {r.doc_id: r.text for r in cleaned.collect()}
    for (key, text), hit in zip(DOCS, brute.hits(DOCS, ITEMS), strict=True):
        if not hit[2]:
            assert got[key] == text
        elif 2 * hit[2] >= hit[1]:
            assert key not in got
    # Cuts may bring words together that were apart, never more than there were.
    left = brute.hits(list(got.items()), ITEMS)
    assert not any(h[5] for h in left)


NEAR = ["doc_id", "n_shingles", "component_id", "kept"]


def test_near_duplicates(docs):
    assert rows(minhash.near_duplicates(docs), *NEAR) == sorted(brute.near_duplicates(DOCS))


def test_near_duplicates_at_another_threshold(docs):
    got = minhash.near_duplicates(docs, words=5, percent=80, block=2)
    assert rows(got, *NEAR) == sorted(brute.near_duplicates(DOCS, 5, 80))


def test_near_duplicates_of_null_and_repeated_ids(write, empty):
    page, other = DOCS[10][1], DOCS[14][1]
    pairs = [(None, page), (None, page + " x"), (3, page), (3, page), (9, "q r s t"), (None, "q r s t"),
             (None, "n n2 n3"), (None, None), (3, other), (None, "only null ids here at all"),
             (None, "only null ids here at all")]
    table = write([(k, t, None, None, None, None, None) for k, t in pairs])
    got = {tuple(r) for r in minhash.near_duplicates(table).select(*NEAR).collect()}
    assert got == set(brute.near_duplicates(pairs))
    assert minhash.near_duplicates(empty).count() == 0


def test_one_of_each(docs, write, empty):
    got = minhash.one_of_each(docs)
    assert got.schema.names == docs.schema.names
    want = sorted(k for k, _, _, kept in brute.near_duplicates(DOCS, 5, 80) if kept)
    assert rows(got, "doc_id") == [(k,) for k in want]
    page = DOCS[10][1]
    pairs = [(1, page), (1, page), (1, page + " x"), (2, page), (None, page), (4, ""), (4, ""), (5, None)]
    table = write([(k, t, None, None, None, None, None) for k, t in pairs])
    left = [r.text for r in minhash.one_of_each(table).collect()]
    assert sorted(t or "" for t in left if not t) == ["", "", ""]
    assert len([t for t in left if t]) == 1
    assert minhash.one_of_each(empty).count() == 0


def test_signatures_estimate_the_similarity():
    import numpy as np

    draw = np.random.default_rng(3)
    values = draw.integers(0, 2**63, 3000).astype(np.uint64)
    one, other = np.sort(values[:2000]), np.sort(values[500:2500])
    got = minhash.signatures([one, other, values[:0]], 128)
    assert abs((got[0] == got[1]).mean() - 1500 / 2500) < 0.15
    assert (minhash.signatures([one], 128)[0] == got[0]).all()


SPANS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 5000, "range_bytes": 9000, "block_anchors": 64, "block_bytes": 4096}])
def test_suffixes(docs, options):
    assert rows(suffixes.report(docs, **options), *SPANS) == sorted(brute.suffixes(DOCS))


def test_suffixes_of_null_ids_and_repeated_rows(write, empty):
    page = DOCS[10][1]
    pairs = [(None, page), (2, page), (2, page), (1, None)]
    table = write([(k, t, None, None, None, None, None) for k, t in pairs])
    got = sorted((str(r.doc_id), r.n_removed) for r in suffixes.report(table).collect())
    n = len(page.encode())
    assert got == [("1", 0), ("2", n), ("2", n), ("None", 0)]
    assert suffixes.report(empty).count() == 0


def test_deduplicated_keeps_the_first_of_each_passage(docs):
    found = suffixes.deduplicated(docs)
    assert found.schema.names == docs.schema.names
    got = {r.doc_id: r.text for r in found.collect()}
    assert set(got) == {k for k, _ in DOCS}
    for (key, text), row in zip(DOCS, brute.suffixes(DOCS), strict=True):
        if not row[2]:
            assert got[key] == text
        else:  # at most three bytes stay at either end of a removed run
            assert 0 <= len(got[key].encode()) - (row[1] - row[2]) <= 6 * row[3]


@pytest.mark.parametrize("limits", [{}])
def test_packing(docs, empty, limits):
    pieces = packing.pack(docs, vocabulary(), **limits)
    used, padded = brute.check_packing(DOCS, pieces.collect(), vocabulary())
    assert used >= 0.95 * padded
    assert packing.pack(empty, vocabulary()).count() == 0


def test_language_on_held_out_rows(spark, write):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/documents.parquet")
    profiles = language.learn(table, F.crc32(F.col("id").cast("string")) % 3 != 1)
    got = language.predict(table, profiles).join(table.select("doc_id", "lang"), "doc_id")
    held = got.where("crc32(cast(doc_id as string)) % 3 = 1 and lang_pred != 'und'")
    right, total = held.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert total > 30 and right >= 0.95 * total


def test_language_of_odd_texts(docs, empty):
    profiles = language.learn(docs)
    got = {r.doc_id: r for r in language.predict(docs, profiles).collect()}
    assert {got[k].lang_pred for k in (0, 1, 2, 7)} == {"und"} and got[3].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language.predict(empty, profiles).count() == 0
    nothing = language.predict(docs, language.learn(empty)).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_toxicity_on_held_out_rows(spark):
    from tidemark.llm.queries import op2_toxicity

    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = op2_toxicity(spark, sf).where("held_out").join(labels, "doc_id")
    bad = held.where("toxic = 1").agg(F.avg("predicted")).first()[0]
    good = held.where("toxic = 0").agg(F.avg("predicted")).first()[0]
    assert bad > 0.75 and good < 0.05


def test_toxicity_of_odd_texts(docs, empty, write):
    labels = write([(k, k % 2) for k, _ in DOCS] + [(None, 1), (3, None), (4, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    got = toxicity.scores(docs, model)
    assert got.count() == len(DOCS)
    assert got.where("score is null or score < 0 or score > 1").count() == 0
    kept = toxicity.without_toxic(docs, model, 2.0)
    assert kept.schema.names == docs.schema.names and kept.count() == len(DOCS)
    assert toxicity.scores(empty, model).count() == 0
    one_sided = toxicity.learn(docs, labels.where("toxic = 1"))
    assert {r.score for r in toxicity.scores(docs, one_sided).collect()} == {1.0}
    assert {r.score for r in toxicity.scores(docs, toxicity.learn(docs, labels.where("false"))).collect()} == {0.0}
