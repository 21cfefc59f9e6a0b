"""How evenly the suffix operator deals anchors."""

from __future__ import annotations

import random

import numpy as np

from tidemark.llm import suffixes


def test_anchor_hashes_fill_all_ranges_alike():
    draw = random.Random(3)
    text = " ".join(f"w{draw.randrange(10**6)}" for _ in range(40000)).encode()
    hashes, first, last = suffixes.anchors(text, 100, 20)
    assert first[0] == 0 and last[-1] == len(text) - 100
    assert (first[1:] == last[:-1] + 1).all()
    for ranges in (8, 64):
        part = ((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        counts = np.bincount(part.astype(int), minlength=ranges)
        assert counts.max() < 1.5 * counts.mean()


def test_index_agrees_with_a_plain_search():
    draw = random.Random(1)
    for length in (8, 20, 100):
        for _ in range(30):
            letters = draw.choice([b"ab", b"abcdefgh", b"a", bytes(range(256))])
            base = bytes(draw.choice(letters) for _ in range(300))
            spans = {base[:length]}
            for _ in range(draw.randrange(1, 30)):
                a, n = draw.randrange(100), draw.randrange(length, 2 * length)
                noise = bytes(draw.choice(letters) for _ in range(n // 2))
                spans.add(base[a : a + n] if draw.random() < 0.7 else base[a : a + n - n // 2] + noise)
            spans = sorted(spans, key=lambda s: draw.random())
            seen, want = set(), []
            for span in spans:
                parts = [span[a : a + length] for a in range(len(span) - length + 1)]
                want.append([part in seen or seen.add(part) for part in parts])
            got = suffixes.RunIndex(spans, length).earlier()
            assert [g.tolist() for g in got] == [[bool(x) for x in w] for w in want]
