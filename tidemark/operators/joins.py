"""Joining many rows to one row per key, without gathering a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when it is known to have at most this many narrow
# rows (an id and a RunId: some 20 MB).
BROADCAST_ROWS = 200_000

# Places that the rows of one key are dealt to; each row of the side goes to all.
SALTS = 16


def at_most(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame has no more than `rows` rows."""
    return df.count() <= rows


def join_side(
    rows: DataFrame,
    side: DataFrame,
    key: str,
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join (`inner` or `left_semi`) rows to a side with one row per key, in one pass.

    Nothing is counted beforehand and the rows are read once. A side that the engine
    sees to be small is broadcast, and no row is shuffled. Otherwise the rows of a key
    are dealt to `salts` tasks in turn, and the side, which is narrow, is sent to all of
    them: a key with a third of all rows gives a task one part in `3 * salts`. The rows
    should come from storage, as their turn is their place in it. NULL keys match nothing.
    """
    salt = "_salt"
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    dealt = rows.where(F.col(key).isNotNull()).withColumn(salt, turn)
    return dealt.join(side.withColumn(salt, everywhere), [key, salt], how).drop(salt)
