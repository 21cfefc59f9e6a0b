"""Quality rules as a cascade that stops at the first rule a document fails.

The rules are plain Column expressions. On a sample every rule is timed and its
share of rejected documents is measured; the cascade then asks those first that
reject most per second. A CASE expression evaluates its branches in order, so a
document pays only for the rules up to the one that rejects it. The order moves
cost, never verdicts: a document is kept if no rule rejects it.

Texts that are null or empty have no words and fail the base rule. Repeated rows
are judged one by one; other columns of the input are not looked at.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import word_array

SYMBOLS = "#*$%&|<>"

#: Frequent function words of the languages the rules know.
STOP_WORDS = (
    "the of and to in that is for der die und das ist von mit den "
    "el la los las de que y en un le les des et du est dans pour une"
).split()

#: Positions take so many low bits of a packed long, hash bits take the rest.
_POSITION_BITS = 30


@dataclass(frozen=True)
class Facts:
    """Columns of a text that the base counts have anyway, so that no rule works them out anew."""

    text: Column
    words: Column
    n_words: Column
    word_chars: Column
    n_symbols: Column
    lines: Column


@dataclass(frozen=True)
class Rule:
    """`rejects` maps a text's facts to a boolean; null counts as false."""

    name: str
    rejects: Callable[[Facts], Column]


@dataclass(frozen=True)
class Measured:
    name: str
    seconds: float
    rejected: float

    @property
    def gain(self) -> float:
        return self.rejected / max(self.seconds, 1e-4)


def _number(text: Column, kind: str) -> Column:
    """How many characters of a class a text has; what lies between them is cut in runs."""
    return F.length(F.regexp_replace(text, f"[^{kind}]+", ""))


def _lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \t\n\x0B\f\r]"))


def facts(docs: DataFrame) -> DataFrame:
    """Adds the columns of `Facts` to `text`, which isn't null."""
    return docs.withColumn("words", word_array(F.col("text"))).select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _number(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        _lines_with_words(F.col("text")).alias("lines"),
    )


def _symbols(of: Facts) -> Column:
    return 10 * of.n_symbols > of.n_words


def _shouting(of: Facts) -> Column:
    return _number(of.text, "A-ZÀ-ÖØ-Þ") > _number(of.text, "a-zß-öø-ÿ")


def _exclaiming(of: Facts) -> Column:
    return 3 * _number(of.text, "!") > of.n_words


def _word_length(of: Facts) -> Column:
    return (of.word_chars < 3 * of.n_words) | (of.word_chars > 12 * of.n_words)


def _digits(of: Facts) -> Column:
    return 4 * _number(of.text, "0-9") > of.word_chars


def _repeated_lines(of: Facts) -> Column:
    return 10 * F.size(F.array_distinct(of.lines)) < 7 * F.size(of.lines)


def _no_stop_words(of: Facts) -> Column:
    words = F.array_distinct(F.split(F.lower(of.text), r"[ \t\n\x0B\f\r]+"))
    known = F.array(*map(F.lit, STOP_WORDS))
    return F.size(F.array_intersect(known, words)) < 2


#: The columns of a table that `facts` made.
FACTS = tuple(f.name for f in fields(Facts))

RULES = (
    Rule("symbols", _symbols),
    Rule("shouting", _shouting),
    Rule("exclaiming", _exclaiming),
    Rule("word_length", _word_length),
    Rule("digits", _digits),
    Rule("repeated_lines", _repeated_lines),
    Rule("no_stop_words", _no_stop_words),
)


def known() -> Facts:
    return Facts(*(F.col(name) for name in FACTS))


def measure(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    text_col: str = "text",
    sample_rows: int = 2000,
    repeats: int = 2,
    sample_bytes: int = 1 << 14,
) -> list[Measured]:
    """Seconds and rejected share of each rule on at most `sample_rows` rows.

    The rows are the first of texts up to `sample_bytes` bytes, so the driver takes 32 MB
    at most, from as few partitions as have that many; a limit within a plan would read
    each partition and send its rows to one task. A job over an empty rule is timed too
    and taken off. Nothing else depends on the sample.
    """
    texts = docs.select(F.coalesce(text_col, F.lit("")).alias("text"))
    taken = texts.where(F.octet_length("text") <= sample_bytes).take(sample_rows)
    sample = facts(docs.sparkSession.createDataFrame(taken, texts.schema)).cache()
    try:
        rows = sample.count()

        def timed(rejects: Column) -> tuple[float, int]:
            best, found = float("inf"), 0
            for _ in range(repeats):
                start = time.perf_counter()
                found = sample.agg(F.count_if(rejects)).first()[0]
                best = min(best, time.perf_counter() - start)
            return best, found

        floor, _ = timed(F.lit(False) & (F.length("text") < 0))
        out = []
        for rule in rules:
            seconds, found = timed(rule.rejects(known()))
            out.append(Measured(rule.name, max(seconds - floor, 1e-4), found / max(rows, 1)))
        return out
    finally:
        sample.unpersist()


def ordered(rules: Sequence[Rule], measured: Sequence[Measured]) -> list[Rule]:
    """By rejection per second, the highest first; ties by name."""
    gain = {m.name: m.gain for m in measured}
    return sorted(rules, key=lambda rule: (-gain[rule.name], rule.name))


def cascade(rules: Sequence[Rule], of: Facts) -> Column:
    """The name of the first rule that rejects, else null."""
    verdict = None
    for rule in rules:
        test = rule.rejects(of)
        verdict = (
            F.when(test, F.lit(rule.name)) if verdict is None else verdict.when(test, rule.name)
        )
    return F.lit(None).cast("string") if verdict is None else verdict


def _measures(docs: DataFrame) -> DataFrame:
    """Adds the base counts to `text`, which isn't null."""
    docs = facts(docs)
    # Each window of three words as a long: hash above, position below.
    packed = F.transform(
        "words",
        lambda word, i: F.shiftleft(
            F.shiftright(
                F.xxhash64(word, F.get("words", i + 1), F.get("words", i + 2)), _POSITION_BITS
            ),
            _POSITION_BITS,
        ).bitwiseOR(i.cast("long")),
    )
    docs = docs.select(
        "*",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("words") >= 3, F.sort_array(F.slice(packed, 1, F.size("words") - 2))
        ).alias("windows"),
    )

    def same(one: Column, other: Column) -> Column:
        return F.shiftright(one, _POSITION_BITS) == F.shiftright(other, _POSITION_BITS)

    # Windows whose hash bits have a neighbour; few in most texts.
    alike = F.filter(
        "windows",
        lambda x, i: same(x, F.get("windows", i - 1)) | same(x, F.get("windows", i + 1)),
    )
    low = F.lit((1 << _POSITION_BITS) - 1).cast("long")
    docs = docs.withColumn("alike", alike)
    # Those again by their words, so that equal hash bits decide nothing.
    spelled = F.sort_array(
        F.transform(
            "alike",
            lambda x: F.struct(
                *(
                    F.get("words", x.bitwiseAND(low).cast("int") + i).alias(f"w{i}")
                    for i in range(3)
                ),
                x.bitwiseAND(low).cast("int").alias("at"),
            ),
        )
    )
    docs = docs.withColumn("spelled", F.when(F.size("alike") > 0, spelled))

    def equal(one: Column, other: Column) -> Column:
        return (
            (one["w0"] == other["w0"]) & (one["w1"] == other["w1"]) & (one["w2"] == other["w2"])
        )

    places = F.sort_array(
        F.transform(
            F.filter(
                "spelled",
                lambda x, i: equal(x, F.get("spelled", i - 1))
                | equal(x, F.get("spelled", i + 1)),
            ),
            lambda x: x["at"],
        )
    )
    docs = docs.withColumn("places", places)
    # A window adds the words that the window before it doesn't cover.
    covered = F.aggregate(
        F.transform(
            "places", lambda at, i: F.least(F.lit(3), at - F.coalesce(F.get("places", i - 1), at - 3))
        ),
        F.lit(0),
        lambda total, n: total + n,
    )
    return docs.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))


def quality(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 50,
    sample_rows: int = 2000,
    measured: Sequence[Measured] | None = None,
) -> DataFrame:
    """Base counts, the base verdict and the cascade's verdict of every row.

    Documents that fail the base rule never reach the cascade. `rejected_by` is
    the first rejecting rule in the measured order, so it may change between runs
    where several rules reject; `kept` can't.
    """
    if measured is None:
        measured = measure(docs, rules, text_col, sample_rows)
    base = _measures(
        docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    )
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )
    first = F.when(failed, F.lit("base")).otherwise(cascade(ordered(rules, measured), known()))
    return base.withColumn("rejected_by", first).select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.col("rejected_by").isNull().alias("kept"),
        "rejected_by",
    )
