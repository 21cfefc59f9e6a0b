"""Joins of many rows to one row per key, where a key may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it has more than one in this many rows; so there are fewer than this.
HOT_SHARE = 1000


def left_join(rows: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """The rows with the columns of `side`, which has one row per key and no null key.

    Hot keys, fewer than HOT_SHARE by their definition, meet a broadcast of just their
    rows of the side; rows without a key meet nothing; the others are shuffled. Both
    frames should be stored, as they are read more than once.
    """
    total = rows.count()
    hot = F.broadcast(
        rows.where(F.col(key).isNotNull())
        .groupBy(key)
        .count()
        .where(F.col("count") * HOT_SHARE > total)
        .select(key)
    )
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in side.schema if f.name != key]
    keyed = rows.where(F.col(key).isNotNull())
    return (
        keyed.join(hot, key, "left_semi")
        .join(F.broadcast(side.join(hot, key, "left_semi")), key, "left")
        .unionByName(keyed.join(hot, key, "left_anti").join(side, key, "left"))
        .unionByName(rows.where(F.col(key).isNull()).select("*", *missing))
    )
