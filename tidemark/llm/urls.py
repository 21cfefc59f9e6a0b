"""URL filters by host and path rules.

A URL is expanded into pairs of a host suffix (by labels) and a path prefix
that ends in a slash, and each rule into its own pair, cut at its last slash. Of a URL's
pairs only those with as many labels and slashes as some rule has are made, as no other
can be equal to a rule's; so a URL of very many slashes costs no more than its length.
Both sides carry a SHA-256 of the pair and meet in an equi-join on its first
eight hex digits; the whole digest, and the rest of a rule that doesn't end in a
slash, are confirmed afterwards. Distinct (host, path) pairs are judged once, so a
hot URL counts once in the join.

A URL that is null or has no `://` has an empty host and path. The longest rule
text wins; of equal texts a block wins over an allow. A URL no rule fits gets the
`default` verdict. Repeated rows each get their verdict; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import ascii_lower

#: verdict, host, path
Rule = tuple[str, str, str]

RULES: tuple[Rule, ...] = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

PREFIX_DIGITS = 8


def rule_table(spark, rules: Sequence[Rule] = RULES) -> DataFrame:
    rows = spark.createDataFrame(list(rules), "verdict string, host string, path string")
    return rows.select(
        "verdict",
        ascii_lower(F.col("host")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
    )


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _suffixes(host: Column, depths: list[int]) -> Column:
    """The last labels of a host, as many as each depth says, if there are so many."""
    labels = F.split(host, r"\.")
    count = F.size(labels)
    fit = F.filter(F.array(*map(F.lit, depths)), lambda n: n <= count)
    return F.transform(fit, lambda n: F.array_join(F.slice(labels, count - n + 1, n), "."))


def _prefixes(path: Column, depths: list[int]) -> Column:
    """The path up to its n-th slash for each depth n that it has; empty for 0."""
    fit = F.filter(F.array(*map(F.lit, depths)), lambda n: n <= _slashes(path))
    return F.transform(
        fit,
        lambda n: F.when(n == 0, "").otherwise(
            F.concat(F.call_function("substring_index", path, F.lit("/"), n), F.lit("/"))
        ),
    )


def _digest(host: Column, prefix: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), prefix), 256)


def verdicts(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    pages = pages.select(
        F.col(id_col).alias("id"),
        host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
    )
    prefix = F.regexp_replace("path", "[^/]*$", "")
    # Rules have few different depths, and an expansion to any other meets none.
    depths = rules.select(
        F.collect_set(F.size(F.split("host", r"\."))).alias("labels"),
        F.collect_set(_slashes(prefix)).alias("slashes"),
    ).first()
    labels, slashes = sorted(depths.labels) or [1], sorted(depths.slashes) or [0]
    keyed = rules.select(
        F.col("verdict").alias("rule_verdict"),
        F.col("path").alias("rule_path"),
        F.concat("host", "path").alias("rule"),
        _digest(F.col("host"), prefix).alias("rule_digest"),
    ).withColumn("key", F.substring("rule_digest", 1, PREFIX_DIGITS))
    asked = (
        pages.select("host", "path")
        .distinct()
        .select("host", "path", F.explode(_suffixes(F.col("host"), labels)).alias("suffix"))
        .select("host", "path", "suffix", F.explode(_prefixes(F.col("path"), slashes)).alias("prefix"))
        .select("host", "path", _digest(F.col("suffix"), F.col("prefix")).alias("digest"))
        .withColumn("key", F.substring("digest", 1, PREFIX_DIGITS))
    )
    found = (
        asked.join(keyed, "key")
        .where(
            (F.col("digest") == F.col("rule_digest"))
            & F.expr("startswith(path, rule_path)")
        )
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    F.length("rule").alias("size"),
                    F.when(F.col("rule_verdict") == "block", 1).otherwise(0).alias("block"),
                    "rule",
                    "rule_verdict",
                )
            ).alias("best")
        )
    )
    return pages.join(found, ["host", "path"], "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
