"""Hashing, cleaning, time and rounding expressions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from lamina.schemas import MONEY


def row_hash(columns: Sequence[str]) -> Column:
    """MD5 over the text of the columns. NULLs are skipped, not kept as empty."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))


def moment(as_of: datetime) -> Column:
    """A zone-free timestamp constant, independent of the session time zone."""
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def money(column: Column) -> Column:
    return column.cast(MONEY)


def or_zero(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit(0).cast(MONEY))


def lower_trim(column: str) -> Column:
    return F.lower(F.trim(column))


def upper_trim(column: str) -> Column:
    return F.upper(F.trim(column))


# Timestamps are subtracted as zone-free values: timestampdiff() would go
# through the session zone and be an hour off across a clock change.

def elapsed_minutes(start: str, stop: str) -> Column:
    """Whole minutes: seconds rounded half to even, then truncated toward zero."""
    seconds = f"cast(cast(`{stop}` - `{start}` as interval second) as decimal(20, 6))"
    return F.expr(f"cast(cast(bround({seconds}, 0) as bigint) div 60 as int)")


def elapsed_days(start: str, stop: str) -> Column:
    """Whole days, truncated toward zero, negative when stop lies before start."""
    return F.expr(f"extract(day from (`{stop}` - `{start}`))").cast("int")


def date_key(day: Column) -> Column:
    """yyyymmdd as a number, by arithmetic (no date formatter in the hot path)."""
    day = day.cast("date")
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def padded_name(day: str, pattern: str) -> Column:
    """Day or month name, blank-padded to nine characters."""
    return F.rpad(F.date_format(day, pattern), 9, " ")


def exact_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator / denominator in decimal arithmetic, rounded half up once.

    NULL when the denominator is zero or NULL.
    """
    whole = denominator.cast("decimal(20,0)")
    return F.round(numerator / F.nullif(whole, F.lit(0).cast("decimal(20,0)")), digits)
