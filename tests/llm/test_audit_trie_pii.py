"""Filter audit, prefix trie and personal data against plain versions."""

from __future__ import annotations

import random
import uuid

import numpy as np
import pytest

from tests.llm import brute
from tests.llm.test_operators import DOCS, SCHEMA
from tidemark.llm import audit, pii, trie


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return tmp_path_factory.mktemp("tables")


@pytest.fixture(scope="module")
def write(spark, folder):
    def write(rows, schema, parts=3):
        path = str(folder / uuid.uuid4().hex)
        spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
        return spark.read.parquet(path)

    return write


LABELS = "doc_id long, quality int, toxic int"


def test_audit_of_odd_rows(write):
    sources = ["a", "b", None, ""]
    docs = [(k, t, sources[k % 4]) for k, t in DOCS if t is None or len(t) < 20000]
    page = DOCS[10][1]
    # Null and repeated ids; copies over sources; one hot text and one hot id.
    docs += [(None, page, "a"), (None, page, "a"), (3, page, "b"), (10, page, "b"), (7, "", "new")]
    docs += [(500 + i, "hot text", "a") for i in range(40)] + [(900, f"t {i}", "b") for i in range(40)]
    labels = [(k, k % 2, k % 3 == 0) for k in range(60)] + [
        (None, 1, 1), (3, 1, None), (4, 0, 0), (4, 1, 1), (900, 1, 1), (10**6, 1, 1)
    ]
    labels = [(k, q, None if x is None else int(x)) for k, q, x in labels]
    table = write([(k, t, "en", s, 5, "key", "row") for k, t, s in docs], SCHEMA)
    got = audit.audit(table, write(labels, LABELS))
    assert got.columns[:3] == ["part", "filter_order", "step"]
    assert sorted(map(tuple, got.collect())) == brute.audit(docs, labels)


def test_audit_of_empty_tables(write):
    docs, labels = write([], SCHEMA, 1), write([], LABELS, 1)
    assert audit.audit(docs, labels).count() == 0
    one = write([(1, None, None, None, 0, "", "")], SCHEMA, 1)
    got = audit.audit(one, labels).collect()
    assert len(got) == 600 and {r.part for r in got} == {""}
    assert {(r.removed, r.kept) for r in got if r.filter_order[r.step - 1] == "A"} == {(1, 0)}


def test_audit_plan_joins_each_mark_not_each_prefix(write):
    """The number of joins doesn't depend on the number of prefixes."""
    frame = audit.audit(write([(1, "a b", "", "s", 1, "", "")], SCHEMA, 1), write([], LABELS, 1))
    assert frame._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 6


TURNS = "conv_id long, turn long, role string, text string, depth long, key string, n long"


def talks(draw, convs, longest, kinds, ids):
    rows = []
    for c in draw.sample(ids, convs):
        for i in range(draw.randrange(1, longest)):
            text = draw.choice([None, "", "a", "a b", "c  d e", "é x\ty"][:kinds])
            rows.append((c, draw.choice([None, i, i]), draw.choice([None, "", "user"]), text))
    return rows


@pytest.mark.parametrize(
    ("seed", "options"),
    [
        (1, {}),
        (2, {"block": 2, "shard_turns": 5}),
        (3, {"block": 1, "shard_turns": 1}),
        (4, {"block": 3, "shard_turns": 40, "family": 7, "heads": 2}),
    ],
)
def test_trie(write, seed, options):
    draw = random.Random(seed)
    rows = talks(draw, 60, 9, 6 if seed % 2 else 3, range(-50, 200))
    rows += [(7, i, "user", "long") for i in range(70)] + [(8, i, "user", "long") for i in range(71)]
    rows += [(40, 5, "user", "same"), (40, 5, "user", "same"), (40, 5, "user", "other"), (None, 1, "user", "x")]
    table = write([(*r, 9, "key", 3) for r in rows], TURNS, 5)
    got = sorted(map(tuple, trie.prefix_nodes(table, **options).collect()), key=str)
    plain = {k: v for k, v in options.items() if k in ("family", "heads")}
    assert got == brute.prefix_nodes(rows, **plain)


def test_trie_of_copies_and_nothing(write):
    # A third of all conversations say the same; they come from many shards.
    rows = [(c, i, "user", f"t{i}" if c % 3 == 0 else f"{c}") for c in range(300) for i in range(4)]
    table = write([(*r, 9, "key", 3) for r in rows], TURNS, 6)
    got = sorted(map(tuple, trie.prefix_nodes(table, shard_turns=20).collect()), key=str)
    assert got == brute.prefix_nodes(rows)
    assert trie.prefix_nodes(write([], TURNS, 1)).count() == 0
    assert trie.prefix_nodes(write([(None, 1, "a", "b", 1, "", 1)], TURNS, 1)).count() == 0


def test_bitmaps_hold_members_by_position_and_turn():
    paths = [(np.array(p), np.array(p)) for p in ([1, 2, 3], [1, 2], [1, 4])]
    index = trie.Bitmaps([10, 20, 30], paths)
    assert index.postings == {(0, 1, 1): 0b111, (1, 2, 2): 0b011}
    assert index.members(0b101) == [10, 30] and index.longer(2) == 0b001
    steps = [(k, bits, i) for _, _, k, bits, i in index.walk([(0, 0)] * 3)]
    assert steps[0] == (0, 0b111, 0) and (1, 0b011, 0) in steps and (1, None, 2) in steps


def plain_spans(text):
    found = brute.base_spans(text)
    return [(k, *s) for k in pii.KINDS for s in found[k]]


def test_base_spans_are_those_of_the_patterns():
    draw = random.Random(5)
    for _ in range(20000):
        letters = draw.choice(["01.- +()", "a@.-1 ", "12 -", "+12().- x", "é@a.b1", "0123456789 -"])
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(60)))
        assert pii.base_spans(text)[0] == brute.base_spans(text)
        pii.candidates(text)


def long_texts(n):
    return ["x" * n + "@", "1" * n, "1." * n, "+1 " * n, "a@" * n, "1 " * n, "(at)" * n]


def test_long_runs_take_linear_time():
    import time

    for text in long_texts(100_000):
        start = time.perf_counter()
        pii.candidates(text)
        assert time.perf_counter() - start < 20


def test_report_of_odd_texts(write):
    texts = [
        None, "", "no data", "mail me: a.b+c@d-e.org.", "(é) 10.0.0.255, 10.0.0.256 and 1.2.3.4.5",
        "card 4111 1111 1111 1111, +1 (555) 010-9999;", "4111111111111112", "a@b.c@d.e", *long_texts(2000),
    ]
    docs = [(k, t, "en", "s", 5, "key", "row") for k, t in enumerate(texts)]
    docs += [(None, texts[3], None, None, None, None, None), (3, texts[3], "", "", 1, "", "")]
    got = pii.report(write(docs, SCHEMA)).collect()
    assert len(got) == len(docs)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    for key, text, *_ in docs:
        base = plain_spans(text)
        for r in by_id[key]:
            want = [sum(k == kind for k, *_ in base) for kind in pii.KINDS]
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == want
            assert r.base_sha256 == brute.sha(pii.joined(base).encode())
            assert set(pii.joined(base).split(",")) - {""} <= set(r.spans.split(","))
    assert by_id[None][0].spans == by_id[3][1].spans
    assert pii.report(write([], SCHEMA, 1)).count() == 0


def test_looser_forms_are_learned_from_the_others(write):
    base = [f"write to mail name{i}@host{i}.com or call +1 (555) 010-{1000 + i} ok" for i in range(60)]
    loose = [f"contact name{i} [at] host{i} [dot] com, phone (555) 010-{1000 + i} ok" for i in range(60)]
    plain = [f"version 4.{i} of the book, page {i}, in 19{i + 10}" for i in range(60)]
    texts = base + loose + plain
    table = write([(k, t, "en", "s", 5, "", "") for k, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r.spans for r in pii.report(table).collect()}
    for k, text in enumerate(texts):
        kinds = [x.split(":")[0] for x in got[k].split(",") if x]
        assert kinds == ([] if k >= 120 else ["email", "phone"]), text
    k = 60
    spans = [x.split(":") for x in got[k].split(",")]
    assert [texts[k][int(a) : int(b)] for _, a, b in spans] == ["name0 [at] host0 [dot] com", "(555) 010-1000"]
    model = pii.fit(pii.stored(pii.scan(table)))
    masked = {r.doc_id: r.text for r in pii.redacted(table, model).collect()}
    assert masked[k] == "contact [email], phone [phone] ok" and masked[150] == texts[150]


def test_votes_that_say_nothing_are_found_out():
    """Reliabilities of made-up labelers come out near the truth."""
    draw = np.random.default_rng(2)
    truth = draw.random(20000) < 0.4
    right = np.array([0.95, 0.9, 0.9, 0.5, 0.85, 0.9, 0.8])
    agrees = draw.random((20000, 7)) < right
    votes = np.where(agrees == truth[:, None], 2, 0)
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    q, theta = pii.reliabilities(patterns, counts.astype(float))
    assert np.abs(theta[1, :, 2] - right).max() < 0.03
    assert ((q[inverse.ravel()] > 0.5) == truth).mean() > 0.97
