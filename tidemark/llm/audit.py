"""Audit of interacting filters: what each removes after any others, by id relations.

Every filter has one table of the ids that fail it, and every prefix of an order of
filters is a set, so five filters have 32 prefixes however many orders there are:

* survivors of a prefix: the rows left-anti the ids that fail any of its filters;
* removed by a filter after a prefix: the rows left-semi the filter's own ids, then
  left-anti the ids of the prefix;
* redundant: the same with left-semi in the second place.

Rows that fail nothing are in all survivors and only counted. Ids are numbers given to
rows as they are written, so repeated rows and null or repeated doc_ids are rows of their
own. All joins are on that id: the rows and the ids are shuffled once each, and every
prefix is a mark on the row, not a pass over the data. Counts are summed by part before
they leave a task, so a part with a third of all rows is no large group.

Null texts read as empty, null parts as the empty string. A row without a doc_id is
smaller than none and has no smaller one. Of repeated labels of a doc_id any 1 counts.
Other columns aren't read. Empty tables give no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import stored
from tidemark.llm.skew import left_join
from tidemark.llm.text import word_array

#: Filters of a text alone; `words` stands for its words.
TextFilter = tuple[str, Column]

#: Name of the filter that fails rows whose text some smaller doc_id has too.
COPIES = "E"


def text_filters() -> list[TextFilter]:
    """Few words, few distinct words, many capitals, symbols."""
    words, text = F.col("words"), F.col("text")
    count = F.size(words)
    return [
        ("A", count < 200),
        ("B", 100 * F.size(F.array_distinct(words)) < 50 * count),
        ("C", 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text)),
        ("D", text.rlike("[#$%&*|]")),
    ]


def failing(
    docs: DataFrame, labels: DataFrame, filters: list[TextFilter],
    id_col: str, text_col: str, part_col: str,
) -> DataFrame:
    """rid, part, good, toxic and `fails`, the names of the filters a row fails."""
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    facts = docs.select(
        F.col(id_col).alias("doc"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text,
    ).select("doc", "part", "text", word_array(F.col("text")).alias("words"))
    facts = stored(
        facts.select(
            F.monotonically_increasing_id().alias("rid"),
            "doc",
            "part",
            F.unhex(F.sha2("text", 256)).alias("digest"),
            *(test.alias(name) for name, test in filters),
        )
    )
    least = stored(
        facts.groupBy("digest")
        .agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
        .where("least < most")
        .select("digest", "least")
    )
    one = [
        F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(name)
        for c, name in (("quality", "good"), ("toxic", "toxic"))
    ]
    marked = (
        labels.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("doc"))
        .agg(*one)
        .where("good or toxic")
    )
    rows = left_join(left_join(facts, least, "digest").drop("digest"), marked, "doc")
    tests = [F.when(F.col(name), F.lit(name)) for name, _ in filters]
    tests.append(F.when(F.col("doc") > F.col("least"), F.lit(COPIES)))
    no = F.lit(False)
    return rows.select(
        "rid",
        "part",
        F.coalesce("good", no).alias("good"),
        F.coalesce("toxic", no).alias("toxic"),
        F.array_compact(F.array(*tests)).alias("fails"),
    )


def audit(
    docs: DataFrame,
    labels: DataFrame,
    filters: list[TextFilter] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """Per part, order and step: kept, removed, redundant and the losses.

    `filters` are tests over `text` and `words`; the filter of copies comes last. Each
    has a name of one letter. labels: id, quality, toxic.
    """
    filters = text_filters() if filters is None else filters
    names = [name for name, _ in filters] + [COPIES]
    bit = {name: 1 << i for i, name in enumerate(names)}
    sets = range(1 << len(names))
    rows = stored(failing(docs, labels, filters, id_col, text_col, part_col))

    # One id table per filter, side by side in one folder.
    ids = stored(rows.select(F.explode("fails").alias("filter"), "rid"), "filter")
    bits = F.create_map(*(F.lit(x) for pair in bit.items() for x in pair))
    ids = ids.select(
        F.col("rid").alias("failed"), bits[F.col("filter")].alias("bit")
    ).hint("shuffle_hash")
    some = rows.where(F.size("fails") > 0).select("rid", "part", "good", "toxic").repartition("rid")

    def failed(mark: str) -> Column:
        """The id is in a table of the filters marked."""
        return (F.col("rid") == F.col("failed")) & (F.col(mark).bitwiseAND(F.col("bit")) != 0)

    def each(name: str, values) -> Column:
        return F.explode(F.array(*map(F.lit, values))).alias(name)

    survivors = some.select("*", each("prefix", sets)).join(ids, failed("prefix"), "left_anti")
    after = F.explode(
        F.filter(F.array(*map(F.lit, sets)), lambda s: s.bitwiseAND(F.col("own")) == 0)
    ).alias("prefix")
    own = some.select("*", each("own", bit.values())).join(ids, failed("own"), "left_semi")
    own = own.select("*", after)
    removed = own.join(ids, failed("prefix"), "left_anti")
    redundant = own.join(ids, failed("prefix"), "left_semi")
    names_of = ("dirty", "removed", "good_lost", "toxic_lost", "redundant")

    def counts(frame: DataFrame, **ones) -> DataFrame:
        have = [F.coalesce(ones.get(n, F.lit(0)).cast("long"), F.lit(0)).alias(n) for n in names_of]
        set_of = F.lit(0) if "own" not in frame.columns else F.col("own")
        return frame.select("part", "prefix", set_of.alias("own"), *have)

    one = F.lit(1)
    counted = stored(
        counts(survivors, dirty=one)
        .unionByName(
            counts(removed, removed=one, good_lost=F.col("good"), toxic_lost=F.col("toxic"))
        )
        .unionByName(counts(redundant, redundant=one))
        .groupBy("part", "prefix", "own")
        .agg(*(F.sum(n).alias(n) for n in names_of))
    )

    parts = rows.groupBy("part").agg(
        F.count("*").alias("total"), F.count_if(F.size("fails") > 0).alias("some")
    )
    steps = docs.sparkSession.createDataFrame(
        [
            ("".join(order), step, sum(bit[x] for x in order[: step - 1]), bit[name])
            for order in permutations(names)
            for step, name in enumerate(order, 1)
        ],
        "filter_order string, step int, prefix int, own int",
    )
    cells = [(s, b) for s in sets for b in bit.values() if not s & b]
    cell = F.explode(
        F.array(*(F.struct(F.lit(s).alias("prefix"), F.lit(b).alias("own")) for s, b in cells))
    )
    table = (
        parts.withColumn("cell", cell)
        .select("part", "total", "some", "cell.*")
        .withColumn("next", F.col("prefix").bitwiseOR(F.col("own")))
        .join(counted.where("own > 0").drop("dirty"), ["part", "prefix", "own"], "left")
        .join(
            counted.where("own = 0").select("part", F.col("prefix").alias("next"), "dirty"),
            ["part", "next"],
            "left",
        )
        .na.fill(0, list(names_of))
    )
    # A prefix of k filters comes before a filter in k! (n - k - 1)! orders.
    size, last = F.bit_count("prefix"), len(names) - 1
    weights = F.array(*(F.lit(factorial(k) * factorial(last - k)) for k in range(last + 1)))
    full = F.lit(sets[-1])
    sums = table.groupBy("part", "own").agg(
        F.sum(F.col("removed") * F.get(weights, size)).alias("shapley"),
        F.max(F.when(F.col("next") == full, F.col("removed"))).alias("unique_fails"),
    )
    return (
        table.join(sums, ["part", "own"])
        .join(F.broadcast(steps), ["prefix", "own"])
        .select(
            "part",
            "filter_order",
            "step",
            (F.col("total") - F.col("some") + F.col("dirty")).alias("kept"),
            "removed",
            "redundant",
            "unique_fails",
            "good_lost",
            "toxic_lost",
            "shapley",
        )
    )
