"""Plain single-process versions of the operators, on lists of (id, text) pairs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def base_counts(text):
    words = SPACE_WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if SPACE_WORD.search(x)]
    seen = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if seen[tuple(words[i : i + 3])] > 1:
            covered.update((i, i + 1, i + 2))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


def substrings(docs, window=35):
    texts = [SPACE_WORD.findall(t or "") for _, t in docs]
    seen = Counter(
        tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1)
    )
    out = []
    for (key, _), w in zip(docs, texts, strict=True):
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = True
        rest = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((key, len(w), int(gone.sum()), sha(rest.encode())))
    return out


RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def url(text):
    host = path = ""
    if text is not None and "://" in text:
        rest = re.split(r"[?#]", text.split("://", 1)[1], maxsplit=1)[0]
        host, slash, tail = rest.partition("/")
        host, path = lower(host), slash + tail
    best = None
    for verdict, h, p in RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = (h + p, verdict)
    return host, path, *(best or (None, "allow"))


def hits(docs, items, window=10):
    wanted = defaultdict(set)
    for item, text in items:
        words = ALNUM_WORD.findall(lower(text or ""))
        if not words:
            continue
        size = min(window, len(words))
        for i in range(len(words) - size + 1):
            wanted[tuple(words[i : i + size])].add(None if item is None else str(item))
    sizes = {len(w) for w in wanted}
    out = []
    for key, text in docs:
        words = ALNUM_WORD.findall(lower(text or ""))
        hit, found = np.zeros(len(words), bool), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if (who := wanted.get(tuple(words[i : i + size]))) is not None:
                    hit[i : i + size] = True
                    found |= who
        n = int(hit.sum())
        named = ",".join(sorted(i for i in found if i is not None))
        out.append((key, len(words), n, len(found), sha(named.encode()), n > 0))
    return out


def near_duplicates(docs, size=3, percent=85):
    sets = []
    for _, text in docs:
        words = SPACE_WORD.findall(lower(text or ""))
        if len(words) < size:
            sets.append({tuple(words)} if words else set())
        else:
            sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)})
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in holders[x] if j < i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[find(i)].append(docs[i][0])
    out = []
    for i, (key, _) in enumerate(docs):
        least = min((k for k in groups[find(i)] if k is not None), default=None)
        out.append((key, len(sets[i]), least if sets[i] else key, not sets[i] or key == least))
    return out


def suffixes(docs, length=100):
    """Ids must differ; null comes first."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0))
    seen, gone = set(), {}
    for i in order:
        raw = (docs[i][1] or "").encode()
        mask = np.zeros(len(raw), bool)
        for a in range(len(raw) - length + 1):
            part = raw[a : a + length]
            if part in seen:
                mask[a : a + length] = True
            seen.add(part)
        gone[i] = (raw, mask)
    out = []
    for i, (key, _) in enumerate(docs):
        raw, mask = gone[i]
        spans = int((np.diff(mask.astype(int), prepend=0) == 1).sum())
        rest = np.frombuffer(raw, np.uint8)[~mask].tobytes()
        out.append((key, len(raw), int(mask.sum()), spans, sha(rest)))
    return out


def check_packing(docs, pieces, vocabulary, limit=4096):
    """Each token of each document once; sequences gapless and within the limit."""
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(vocabulary)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == {key for key, _ in docs}
    for key, text in docs:
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        for p in sorted(by_doc[key], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            raw = np.array(ids[at : at + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(raw)
            at += p.length
        assert at == len(ids)
    used = padded = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= limit
        used += at
        padded += at if at & (at - 1) == 0 else limit
    return used, padded


def audit(docs, labels):
    """docs: (id, text, part); labels: (id, quality, toxic)."""
    from itertools import permutations

    facts = []
    for key, text, part in docs:
        t = text or ""
        words = SPACE_WORD.findall(t)
        smaller = [k for k, u, _ in docs if k is not None and (u or "") == t]
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": key is not None and any(k < key for k in smaller),
        }
        mine = [x for x in labels if key is not None and x[0] == key]
        facts.append(
            (part or "", {f for f, x in fails.items() if x}, any(x[1] == 1 for x in mine),
             any(x[2] == 1 for x in mine))
        )
    removed, out = Counter(), {}
    for part in {f[0] for f in facts}:
        for order in map("".join, permutations("ABCDE")):
            left = [f for f in facts if f[0] == part]
            everything = left
            for step, name in enumerate(order, 1):
                gone = [f for f in left if name in f[1]]
                left = [f for f in left if name not in f[1]]
                failing = [f for f in everything if name in f[1]]
                removed[part, name] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), len(failing) - len(gone),
                    sum(f[1] == {name} for f in everything),
                    sum(f[2] for f in gone), sum(f[3] for f in gone),
                ]
    return sorted((*k, *v, removed[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def prefix_nodes(turns, family=20, heads=4):
    """turns: (conv, turn, role, text); the nodes as sorted tuples."""
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            digest = hashlib.md5((text or "").encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, role or "", digest, text or ""))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - int(math.fmod(c, family))
        rebuilt[c] = own.get(base, [])[:h] + mine[h:]
    members, children = defaultdict(list), defaultdict(set)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
            if d:
                children[tuple(path[: d - 1])].add(tuple(path[:d]))
    saved, leaves = Counter(), Counter()
    for node in members:
        words = len(SPACE_WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(members[node]) - 1) * words
            leaves[node[:d]] += not children[node]
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(who), len(node), parent, len(who), len(children[node]), leaves[node],
                    saved[node], sha(ends.encode())))
    return sorted(out, key=str)


_PII = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def base_spans(text):
    """By kind, the spans of the base patterns that their checks let pass."""

    def good(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(x) <= 255 for x in found.split("."))
        if kind == "phone":
            return 9 <= len(digits) <= 15
        if kind == "email":
            return True
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0

    return {k: [m.span() for m in p.finditer(text or "") if good(k, m[0])] for k, p in _PII.items()}
