"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    audit,
    decontaminate,
    language,
    licenses,
    minhash,
    packing,
    pii,
    rules,
    substrings,
    suffixes,
    toxicity,
    trie,
    urls,
)
from tidemark.llm.text import table

#: Scores from here on are predicted toxic.
REJECTED_FROM = 0.3

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def vocabulary() -> str:
    """Where the installed word vocabulary lies, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_quality_rules(spark, sf_dir):
    return rules.quality(table(spark, sf_dir, "documents")).drop("rejected_by")


def tree_path() -> Column:
    """Where a document lies in the tree of its source, as the table has no paths.

    Ids are dealt in ranges to packages, and in shorter ones to folders of these. By a
    checksum of the id, 1 of 25 documents is named as a licence file of its folder, and
    1 of 25 lies in the package itself as one. Null parts are left out.
    """
    name = F.col("doc_id").cast("string")
    drawn = F.crc32(name) % 25
    package, folder = F.expr("doc_id div 4000"), F.expr("doc_id div 400")
    return F.concat_ws(
        "/",
        "source",
        package.cast("string"),
        F.when(drawn != 1, folder.cast("string")),
        F.when(drawn < 2, F.concat(F.lit("LICENSE."), name)).otherwise(name),
    )


@query
def op3_license_scans(spark, sf_dir):
    return licenses.scan(
        table(spark, sf_dir, "documents"), licenses.template_table(spark), tree_path()
    )


@query
def op6_url_filters(spark, sf_dir):
    return urls.verdicts(table(spark, sf_dir, "pages"), urls.rule_table(spark))


@query
def op7_decontaminate(spark, sf_dir):
    return decontaminate.report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query
def op9_pack(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


@query
def op8_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_substrings(spark, sf_dir):
    return substrings.report(table(spark, sf_dir, "documents"))


@query
def op10_suffixes(spark, sf_dir):
    return suffixes.report(table(spark, sf_dir, "documents"))


def toxicity_model(docs: DataFrame, labels: DataFrame):
    """Learned from labelled rows outside the held-out quarter."""
    return toxicity.learn(
        docs,
        labels,
        F.crc32(F.col("id").cast("string")) % 4 != 2,
    )


@query
def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.scores(docs, model)
    return scored.select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out"),
        "score",
        (F.col("score") >= REJECTED_FROM).cast("int").alias("predicted"),
    )


@query
def op4_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    profiles = language.learn(docs, F.crc32(F.col("id").cast("string")) % 3 != 1)
    return language.predict(docs, profiles).select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"),
        "lang_pred",
        "score",
    )


@query
def op11_filter_audit(spark, sf_dir):
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_prefix_trie(spark, sf_dir):
    return trie.prefix_nodes(table(spark, sf_dir, "conversations"))


@query
def op13_pii(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))
