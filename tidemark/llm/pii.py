"""Personal data: weak labelers vote on candidate spans, and their votes train a classifier.

Candidates of a kind are the spans of its strict grammar, those of them that a checksum or
count rejects, and looser forms (addresses written with "at" and "dot", numbers with other
separators, telephone numbers without a plus). Labelers vote for, against or not at all:
grammar, checksum, gazetteers (issuers, top-level domains, calling codes, reserved
networks), words before that hint at the kind or at something else, what a span touches,
and its usual shape.

1. One pass over the texts writes each document's base spans and its candidates: place,
   votes, and a few coarse features. No text is kept.
2. Votes are counted over all candidates. There are at most 3^7 patterns a kind, so the
   counts fit the driver whatever the corpus has. Expectation-maximisation estimates,
   for each labeler and class, how often it votes which way, and a probability for each
   pattern. Pseudo-counts say that labelers are more often right than wrong, so that a kind
   with few candidates isn't turned around.
3. Features are counted with these probabilities, again over all candidates; a code has
   fewer than 11,000 values a kind. A logistic curve for each kind is fitted to that, and a
   candidate from a probability of `least` on becomes a span.

Base spans always stay; added ones overlap neither them nor each other, where the order
of the kinds, then the place, decides. Scanning takes time linear in a text's length.

Null texts read as empty. Each row is a document, whatever its id; ids of any type, null or
repeated, come back as they are. Other columns aren't read. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import stored
from tidemark.llm.text import bounded

KINDS = ("email", "ip", "card", "phone")

# The base grammars, without the backtracking that long runs would cost. A match is
# possible at the start of a run only, and takes the whole run.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Looser forms. Around "at" and "dot" in brackets there may be blanks.
_AT = r"[\[({<]\s?(?:at|@|arroba|chez)\s?[\])}>]"
_DOT = r"(?:\.|\s?[\[({<]\s?(?:dot|punto|point|punkt|\.)\s?[\])}>]\s?)"
_AT_SIGN = re.compile(rf"@|{_AT}", re.I)
_LOOSE_EMAIL = re.compile(
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{{0,63}}\s?(?:@|{_AT})\s?"
    rf"[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}})+",
    re.I,
)
_LOOSE_IP = re.compile(
    r"(?<![0-9.])[0-9]{1,3}(?:\s?[\[({]\s?(?:\.|dot)\s?[\])}]\s?[0-9]{1,3}){3}(?![0-9])", re.I
)
_LOOSE_CARD = re.compile(r"(?<![0-9])[0-9]{4}(?:[._/ -]{1,2}[0-9]{4}){3}(?![0-9])")
_LOOSE_PHONE = re.compile(
    r"(?<![0-9+(])(?:00[ -]?[0-9]{1,3}[ .-])?\(?[0-9]{2,4}\)?[ .-][0-9]{2,4}[ .-][0-9]{3,4}(?![0-9])"
)

# Gazetteers and hint words.
_TOP_LEVEL = frozenset("com org net edu gov mil int info biz io eu uk de fr es it us ca mx".split())
_ISSUER = re.compile(r"4|5[1-5]|2[2-7]|3[47]|3[068]|6011|6[45]|35|62")
_CALLING = re.compile(r"(?:\+|00)?(?:1(?!\d{11})|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])")
_HINTS = {
    "email": "email e-mail mail contact correo courriel write".split(),
    "ip": "ip host server address from client ping network".split(),
    "card": "card visa mastercard credit debit payment tarjeta carte karte".split(),
    "phone": "phone tel call mobile fax telefon teléfono téléphone cell".split(),
}
_FOILS = (
    "version order invoice isbn issn license licence token id ref no nr section release "
    "build serial tracking commit hash page"
).split()
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")

LABELERS = ("grammar", "checksum", "gazetteer", "hint", "foil", "edge", "shape")
AGAINST, SILENT, FOR = 0, 1, 2


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            floor = match.end()
            out.append((start, floor))
        at = text.find("@", max(floor, at + 1))
    return out


def _octets(text: str) -> bool:
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in text.split(".")))


def base_spans(text: str) -> tuple[dict[str, list], dict[str, list]]:
    """By kind, the (start, end) that hold, and those that a check turns down."""
    good: dict[str, list] = {k: [] for k in KINDS}
    bad: dict[str, list] = {k: [] for k in KINDS}
    good["email"] = _emails(text)
    for m in _IP.finditer(text):
        (good if _octets(m[0]) else bad)["ip"].append(m.span())
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19:
            (good if luhn(d) else bad)["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            (good if 9 <= len(_digits(m[0])) <= 15 else bad)["phone"].append(m.span())
    return good, bad


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def _loose(text: str) -> list[tuple[str, int, int]]:
    out = []
    if _AT_SIGN.search(text):
        out += [("email", *m.span()) for m in _LOOSE_EMAIL.finditer(text)]
    for kind, pattern in (("ip", _LOOSE_IP), ("card", _LOOSE_CARD), ("phone", _LOOSE_PHONE)):
        out += [(kind, *m.span()) for m in pattern.finditer(text)]
    return out


def _kind_of(char: str) -> int:
    """What stands beside a span: nothing or a blank, a mark, a letter, a digit, a sign."""
    if not char or char.isspace():
        return 0
    if char in ".,;:!?)]}>('\"":
        return 1
    return 2 if char.isalpha() else 3 if char.isdigit() else 4


def _check(kind: str, raw: str, digits: str) -> int:
    if kind == "card":
        ok = 13 <= len(digits) <= 19 and luhn(digits)
    elif kind == "ip":
        ok = _octets(".".join(re.findall("[0-9]+", raw)))
    elif kind == "phone":
        ok = 9 <= len(digits) <= 15
    else:
        ok = raw[-2:].isalpha()
    return FOR if ok else AGAINST


def _gazetteer(kind: str, raw: str, digits: str) -> int:
    if kind == "card":
        return FOR if _ISSUER.match(digits) else AGAINST
    if kind == "phone":
        return FOR if _CALLING.match(raw) else SILENT
    if kind == "ip":
        first = int(re.match("[0-9]+", raw)[0][-3:])
        return FOR if 0 < first < 224 else AGAINST
    return FOR if re.split(r"[^A-Za-z0-9-]+", raw.rstrip(")]}> "))[-1].lower() in _TOP_LEVEL else SILENT


def _shape(kind: str, raw: str, digits: str) -> int:
    if kind == "card":
        ok = len(digits) in (15, 16) and re.fullmatch(r"\d+|\d{4}(?:\D{1,2}\d{3,6})+", raw)
    elif kind == "phone":
        ok = len(set(digits)) > 2 and re.search(r"\d{3,4}$|\d\d[ .-]\d\d$", raw)
    elif kind == "ip":
        ok = not re.search(r"(?<!\d)0\d", raw)
    else:
        ok = len(raw) < 100 and re.search("[A-Za-z]", raw[:64])
    return FOR if ok else AGAINST


def describe(text: str, kind: str, a: int, b: int, strict: bool) -> tuple[int, int]:
    """Votes of the labelers and features of a candidate, as numbers."""
    raw = text[a : min(b, a + 400)]
    digits = _digits(raw)
    before = [w.lower() for w in _WORD.findall(text[max(0, a - 40) : a])][-4:]
    hint = FOR if any(w in _HINTS[kind] for w in before) else SILENT
    foil = AGAINST if any(w in _FOILS for w in before) else SILENT
    left, right = _kind_of(text[a - 1 : a]), _kind_of(text[b : b + 1])
    # Letters and digits around a span say that it is part of something longer.
    glued = left in (2, 3) or right in (2, 3)
    check = _check(kind, raw, digits)
    votes = (
        FOR if strict else SILENT,
        check,
        _gazetteer(kind, raw, digits),
        hint,
        foil,
        AGAINST if glued else FOR,
        _shape(kind, raw, digits),
    )
    marks = {c for c in raw if not c.isalnum()}
    separator = (
        0 if not marks else 5 if len(marks) > 1 else
        1 if " " in marks else 2 if "-" in marks else 3 if "." in marks else 4
    )
    context = FOR if hint == FOR else AGAINST if foil == AGAINST else SILENT
    parts = (min(7, (b - a) // 4), separator, left, right, context, check)
    return _pack(votes, (3,) * len(LABELERS)), _pack(parts, FEATURES)


#: Values that each feature has: length, separators, sides, words before, checksum.
FEATURES = (8, 6, 5, 5, 3, 3)


def _pack(values: tuple[int, ...], sizes: tuple[int, ...]) -> int:
    out = 0
    for value, size in zip(values, sizes, strict=True):
        out = out * size + value
    return out


def _unpack(codes: np.ndarray, sizes: tuple[int, ...]) -> np.ndarray:
    out = []
    for size in reversed(sizes):
        out.append(codes % size)
        codes = codes // size
    return np.array(out[::-1]).T


def candidates(text: str) -> tuple[dict[str, list], list[tuple]]:
    """Base spans by kind, and (kind, start, end, base, votes, features) of all candidates."""
    if not _MAYBE.search(text):
        return {k: [] for k in KINDS}, []
    good, bad = base_spans(text)
    out = [(k, a, b, True) for k in KINDS for a, b in good[k]]
    taken = sorted((a, b) for k in KINDS for a, b in good[k])
    starts = np.array([a for a, _ in taken])
    ends = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0, int)

    def free(a: int, b: int) -> bool:
        i = int(np.searchsorted(starts, b))  # spans that begin before b
        return i == 0 or int(ends[i - 1]) <= a

    more = {(k, a, b): True for k in KINDS for a, b in bad[k]}
    for span in _loose(text):
        more.setdefault(span, False)
    out += [(k, a, b, False) for k, a, b in more if free(a, b)]
    rows = []
    for kind, a, b, base in out:
        strict = base or more.get((kind, a, b), False)
        rows.append((KINDS.index(kind), a, b, base, *describe(text, kind, a, b, strict)))
    return good, rows


_MAYBE = re.compile(rf"[0-9]|@|{_AT}", re.I)

_FIELDS = (
    ("kind", "int"), ("start", "long"), ("end", "long"), ("base", "boolean"), ("votes", "int"),
    ("features", "int"),
)
_BASE = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string"
_SCAN = f"{_BASE}, candidates array<struct<{', '.join(f'{n}: {t}' for n, t in _FIELDS)}>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, counts and digest of the base spans, and the candidates."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    arrow = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}
    struct = pa.list_(pa.struct([(n, arrow[t]) for n, t in _FIELDS]))
    names = [n for n, _ in _FIELDS]

    def run(batches):
        for batch in batches:
            counts, digests, found = [], [], []
            for text in batch.column("text").to_pylist():
                good, rows = candidates(text or "")
                counts.append([len(good[k]) for k in KINDS])
                base = joined([(k, *s) for k in KINDS for s in good[k]])
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                found.append([dict(zip(names, r, strict=True)) for r in rows])
            columns = np.array(counts, np.int64).reshape(-1, len(KINDS)).T
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    *(pa.array(c) for c in columns),
                    pa.array(digests, pa.string()),
                    pa.array(found, struct),
                ],
                names=["id", *(f"n_{k}" for k in KINDS), "base_sha256", "candidates"],
            )

    return rows.mapInArrow(run, f"id {kind}, {_SCAN}")


def reliabilities(
    votes: np.ndarray, counts: np.ndarray, rounds: int = 100, pseudo: float = 2.0
) -> tuple[np.ndarray, np.ndarray]:
    """By expectation-maximisation: the probability of each pattern to be personal data,
    and theta[class, labeler, vote], how often a labeler votes so for a class."""
    prior = np.array([[4, 2, 1], [1, 2, 4]], float) * pseudo  # class false, true
    said = votes - 1
    q = 0.5 + 0.45 * said.sum(axis=1) / np.maximum(1, np.abs(said).sum(axis=1))
    one_hot = np.eye(3)[votes]  # pattern, labeler, vote
    theta = np.zeros((2, votes.shape[1], 3))
    for _ in range(rounds):
        share = np.stack([counts * (1 - q), counts * q])
        theta = np.einsum("cp,plv->clv", share, one_hot) + prior[:, None, :]
        theta /= theta.sum(axis=2, keepdims=True)
        log = np.einsum("plv,clv->cp", one_hot, np.log(theta))
        log += np.log((share.sum(axis=1) + pseudo) / (share.sum() + 2 * pseudo))[:, None]
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        if np.abs(new - q).max(initial=0) < 1e-9:
            q = new
            break
        q = new
    return q, theta


def _one_hot(features: np.ndarray) -> np.ndarray:
    columns = [np.ones((len(features), 1))]
    columns += [np.eye(n)[features[:, i]] for i, n in enumerate(FEATURES)]
    return np.concatenate(columns, axis=1)


def logistic(features: np.ndarray, good: np.ndarray, counts: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights of a logistic curve over one-hot features, by Newton's steps."""
    x = _one_hot(features)
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (good - counts * p) - ridge * w
        bend = (x * (counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass(frozen=True)
class Model:
    """Weights by kind; kinds without any candidate have none and add nothing."""

    weights: dict[int, np.ndarray]
    theta: dict[int, np.ndarray]
    least: float = 0.5

    def accepts(self, kind: int, features: np.ndarray) -> np.ndarray:
        if kind not in self.weights or not len(features):
            return np.zeros(len(features), bool)
        score = _one_hot(_unpack(features, FEATURES)) @ self.weights[kind]
        return 1 / (1 + np.exp(-np.clip(score, -30, 30))) >= self.least


def fit(scanned: DataFrame, least: float = 0.5) -> Model:
    """From a stored scan."""
    rows = scanned.select(F.explode("candidates").alias("c")).select("c.*")
    patterns = rows.groupBy("kind", "votes").count().toPandas()
    theta, parts = {}, []
    for kind, group in patterns.groupby("kind"):
        votes = _unpack(group["votes"].to_numpy(), (3,) * len(LABELERS))
        q, theta[int(kind)] = reliabilities(votes, group["count"].to_numpy(float))
        parts += zip(group["kind"].tolist(), group["votes"].tolist(), q.tolist(), strict=True)
    known = scanned.sparkSession.createDataFrame(parts, "kind int, votes int, q double")
    summed = (
        rows.join(F.broadcast(known), ["kind", "votes"])
        .groupBy("kind", "features")
        .agg(F.count("*").alias("n"), F.sum("q").alias("good"))
        .toPandas()
    )
    weights = {
        int(kind): logistic(
            _unpack(group["features"].to_numpy(), FEATURES),
            group["good"].to_numpy(float),
            group["n"].to_numpy(float),
        )
        for kind, group in summed.groupby("kind")
    }
    return Model(weights, theta, least)


def chosen(rows: list[tuple], model: Model) -> list[tuple[str, int, int]]:
    """Base spans and accepted candidates, which overlap nothing that is in already."""
    spans = [(KINDS[k], a, b) for k, a, b, base, *_ in rows if base]
    extra = sorted((k, a, b, f) for k, a, b, base, _, f in rows if not base)
    if not extra:
        return spans
    added: list[tuple[str, int, int]] = []
    for number, kind in enumerate(KINDS):
        mine = [x for x in extra if x[0] == number]
        taken = sorted((a, b) for _, a, b in added)
        new, end = [], -1
        for (_, a, b, _), yes in zip(
            mine, model.accepts(number, np.array([x[3] for x in mine], int)), strict=True
        ):
            if yes and a >= end and not any(a < y and x < b for x, y in _near(taken, a, b)):
                new.append((kind, a, b))
                end = b
        added += new
    return spans + added


def _near(taken: list[tuple[int, int]], a: int, b: int) -> list[tuple[int, int]]:
    """Those of disjoint spans that may overlap [a, b)."""
    i = bisect_left(taken, (b, -1))
    j = i
    while j and taken[j - 1][1] > a:
        j -= 1
    return taken[j:i]


def report(
    docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, base counts and digest, and all spans. Learns from `docs` if need be."""
    bounded(docs.sparkSession)
    scanned = stored(scan(docs, id_col, text_col))
    model = fit(scanned) if model is None else model
    names = [n for n, _ in _FIELDS]

    def run(batches):
        for batch in batches:
            spans = [
                joined(chosen([tuple(c[n] for n in names) for c in found], model))
                for found in batch.column("candidates").to_pylist()
            ]
            kept = [c for c in batch.schema.names if c != "candidates"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(spans, pa.string())],
                names=[*kept, "spans"],
            )

    kind = scanned.schema["id"].dataType.simpleString()
    schema = f"id {kind}, {_BASE}, spans string"
    return scanned.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def redacted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents with each span replaced by its kind in brackets; overlapping spans
    of two kinds become one, of the kind that starts first."""
    bounded(docs.sparkSession)

    @F.pandas_udf("string")
    def mask(texts):
        def one(text):
            if text is None:
                return None
            parts, at = [], 0
            spans = sorted(chosen(candidates(text)[1], model), key=lambda s: (s[1], -s[2]))
            for kind, a, b in spans:
                if a >= at:
                    parts += [text[at:a], f"[{kind}]"]
                at = max(at, b)
            return "".join([*parts, text[at:]])

        return texts.map(one)

    return docs.withColumn(text_col, mask(F.col(text_col)))
