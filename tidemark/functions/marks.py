"""Watermark expressions.

Marks have millisecond precision. Cutting every row's timestamp to milliseconds
before comparing would hide the column from the scan, so the bounds move
instead: with whole-millisecond marks, `cut(x) > old` is `x >= old + 1 ms` and
`cut(x) <= high` is `x < high + 1 ms`. Both stay plain column-against-literal
comparisons that Parquet and JDBC take as pushed filters.

Nothing here depends on the session time zone.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.model import SENTINEL

MILLISECOND = timedelta(milliseconds=1)


def floor_millis(value: datetime) -> datetime:
    """The driver-side twin of `to_millis`."""
    return value.replace(microsecond=value.microsecond // 1000 * 1000)


def ntz(value: datetime | None) -> Column:
    """A zone-less timestamp literal; NULL for None."""
    text = None if value is None else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def is_sentinel(mark: Column | str) -> Column:
    """True where the initial load has not been done; unknown for NULL."""
    return (F.col(mark) if isinstance(mark, str) else mark) == ntz(SENTINEL)


def to_millis(col: Column | str) -> Column:
    """Cut a zone-less timestamp to milliseconds, in whole-number arithmetic.

    `date_trunc` would go through TIMESTAMP, and so through the session zone.
    Interval division rounds half up, hence the half millisecond taken off; the
    origin lies before any date in use, so the quotient is never negative.
    """
    ts = (F.col(col) if isinstance(col, str) else col).cast("timestamp_ntz")
    origin = ntz(datetime(1, 1, 1)) - F.expr("INTERVAL '1' DAY")
    half = F.expr("INTERVAL '0.000500' SECOND")
    return origin + (ts - origin - half) / F.lit(1000) * F.lit(1000)


def above(col: Column, mark: datetime | None) -> Column:
    """Rows strictly above a mark. Unknown for a NULL mark or a NULL value."""
    if mark is None:
        return F.lit(None).cast("boolean")
    return col >= ntz(floor_millis(mark) + MILLISECOND)


def up_to(col: Column, mark: datetime | None) -> Column:
    """Rows at or below a mark. Unknown for a NULL mark or a NULL value."""
    if mark is None:
        return F.lit(None).cast("boolean")
    return col < ntz(floor_millis(mark) + MILLISECOND)


def count_where(condition: Column) -> Column:
    """Conditional count that is NULL, not 0, over no rows at all."""
    return F.sum(F.when(condition, 1).otherwise(0))


def instant_to_ntz(col: Column | str) -> Column:
    """An instant as the UTC wall clock, whatever the session zone."""
    ts = F.col(col) if isinstance(col, str) else col
    seconds = F.unix_micros(ts) * F.lit("0.000001").cast("decimal(7,6)")
    zero = F.lit(0)
    return ntz(datetime(1970, 1, 1)) + F.make_dt_interval(
        zero, zero, zero, seconds.cast("decimal(18,6)")
    )
