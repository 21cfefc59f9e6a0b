"""Packing under each of its three limits, against the plain check."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from tests.llm import brute
from tidemark.llm import packing
from tidemark.llm.queries import vocabulary

PATTERN = r"A: [^\n]*"


def talks():
    """Questions and answers; answers bear the loss. Some have none, some little else."""
    draw = random.Random(11)

    def line(mark, n):
        return mark + " ".join(f"word{draw.randrange(300)}é" for _ in range(draw.randrange(1, n)))

    texts = [None, "", "Q: alone", "A: alone", line("A: ", 3000), line("Q: ", 3000)]
    for _ in range(80):
        pairs = [line("Q: ", 40) + "\n" + line("A: ", 60) for _ in range(draw.randrange(1, 8))]
        texts.append("\n".join(pairs))
    return list(enumerate(texts))


def loss_flags(text, coder):
    """Of each token, the end id included, whether it bears loss."""
    flags = []
    for part in re.split(f"({PATTERN})", text or ""):
        ids = coder.encode(part, add_special_tokens=False).ids
        flags += [bool(re.fullmatch(PATTERN, part))] * len(ids)
    return [*flags, True]


@pytest.mark.parametrize(
    "limits",
    [
        {"loss_pattern": PATTERN, "max_loss": 500, "max_tokens": 4096},
        {"loss_pattern": PATTERN, "max_loss": 64, "max_tokens": 512, "max_segments": 3},
        {"loss_pattern": PATTERN},
        {"max_loss": 300},
        {"max_segments": 2},
    ],
)
def test_all_three_limits_hold(spark, tmp_path, limits):
    from tokenizers import Tokenizer

    docs, coder = talks(), Tokenizer.from_file(vocabulary())
    path = str(tmp_path / "talks")
    spark.createDataFrame(docs, "doc_id long, text string").repartition(2).write.parquet(path)
    pieces = packing.pack(spark.read.parquet(path), vocabulary(), pool=16, **limits).collect()
    tokens = limits.get("max_tokens", 4096)
    brute.check_packing(docs, pieces, vocabulary(), tokens)
    masked = "loss_pattern" in limits
    flags = {k: loss_flags(t, coder) for k, t in docs}
    loss, segments = defaultdict(int), defaultdict(int)
    for p in pieces:
        part = flags[p.doc_id][p.start : p.start + p.length]
        loss[p.sequence_id] += sum(part) if masked else p.length
        segments[p.sequence_id] += 1
    most = limits.get("max_loss") or tokens
    assert max(loss.values()) <= most
    assert max(segments.values()) <= limits.get("max_segments", 256)
    if most < tokens:  # the limit is reached, so it is what cuts
        assert max(loss.values()) == most
    if "max_segments" in limits:
        assert max(segments.values()) == limits["max_segments"]


@pytest.mark.parametrize(("count", "size"), [(1001, 3), (2000, 9), (3000, 11), (40, 700)])
def test_short_documents_need_little_padding(spark, tmp_path, count, size):
    """All in one partition; the segment limit comes long before the token limit."""
    docs = [(i, " ".join(["a"] * (size - 1))) for i in range(count)]
    path = str(tmp_path / "short")
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(path)
    pieces = packing.pack(spark.read.parquet(path), vocabulary()).collect()
    used, padded = brute.check_packing(docs, pieces, vocabulary())
    assert used == count * size and padded <= 1.05 * used


def test_words_are_encoded_as_within_their_text():
    """Words with marks, digits, contractions, odd letters; and a memory that is too small."""
    import numpy as np
    from tokenizers import Tokenizer

    draw, coder = random.Random(3), Tokenizer.from_file(vocabulary())
    parts = ["'", "s", "t", "re", "S", "ll", "é", "É", "1", "!", ".", "<|", " ", "İ", "Σ", "ß",
             "\xa0", "ﬁ", "́", "\x1c", "½", "“", "<|endoftext|>"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 14))) for _ in range(3000)]
    encoder = packing.Encoder(vocabulary(), size=20_000)
    for at in range(0, len(texts), 50):
        part = texts[at : at + 50]
        for text, got in zip(part, encoder.encode([t.encode() for t in part]), strict=True):
            want = np.array(coder.encode(text, add_special_tokens=False).ids, "<u4")
            assert got == want.tobytes(), text
        kept = [*encoder.young.items(), *encoder.old.items()]
        assert sum(len(k) + len(v) for k, v in kept) < 3 * 20_000 + 100_000
