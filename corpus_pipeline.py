"""The corpus pipeline: each stage reads what the stage before it wrote.

Toxic documents go first, then all but one document of each group of near copies,
then passages that repeat across documents, then benchmark passages; what is left is
packed. Stages that cut texts set `n_chars`, where there is such a column, to the new
length. Documents without text pass every filter and are packed as an end id alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, minhash, packing, suffixes, toxicity
from tidemark.llm.queries import REJECTED_FROM, toxicity_model, vocabulary
from tidemark.llm.text import table
from tidemark.sources.zones import scratch


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn(
        "n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind))
        .otherwise(F.col("n_chars"))
    )


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model, REJECTED_FROM)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out strings of 100 bytes that an earlier document, or place, has too."""
    return _counted(suffixes.deduplicated(docs))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out; texts that are mostly benchmark go as a whole."""
    return _counted(decontaminate.clean(docs, table(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Workers that other stages have used before have less memory to spare.
    return packing.pack(docs, vocabulary(), memory=12 << 20)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_copies),
    ("suffix_array", drop_passages),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: Compression distances and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{scratch(spark)}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
