"""Calendar expressions on zone-free timestamps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, functions as F

from marketlane.functions.columns import as_column


def day(ts: str | Column) -> Column:
    return F.to_date(as_column(ts))


def month_start(d: str | Column) -> Column:
    return F.trunc(F.to_date(as_column(d)), "MM")


def yyyymm(ts: str | Column) -> Column:
    c = as_column(ts)
    return F.year(c) * 100 + F.month(c)


def months_between_starts(start: str | Column, end: str | Column) -> Column:
    """Whole calendar months from one month start to another."""
    a, b = as_column(start), as_column(end)
    return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)


def epoch_seconds(ts: str | Column) -> Column:
    """Seconds since 1970 of a zone-free timestamp, whatever the session zone."""
    c = as_column(ts)
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def whole_seconds(ts: str | Column) -> Column:
    """Zone-free timestamp without its fraction of a second."""
    c = as_column(ts)
    parts = [f(c) for f in (F.year, F.month, F.day, F.hour, F.minute)]
    return F.make_timestamp_ntz(*parts, F.second(c).cast("decimal(8,6)"))


def in_span(ts: str | Column, first: str, last: str | None = None) -> Column:
    """Half-open range of whole days: unlike ``to_date(ts) = ds`` it reaches the scan."""
    c = as_column(ts)
    end = F.date_add(F.lit(last or first).cast("date"), 1)
    return (c >= F.lit(first).cast("timestamp_ntz")) & (c < end.cast("timestamp_ntz"))


def in_days(ts: str | Column, days: Sequence[str]) -> Column:
    """Rows of the listed days, behind a range that reaches the scan."""
    listed = [date.fromisoformat(d) for d in days]
    return in_span(ts, min(days), max(days)) & F.to_date(as_column(ts)).isin(listed)


def not_expired(ts: str | Column, as_of: str, months: int) -> Column:
    """``ts + months > as_of``: rows that retention still keeps."""
    c = as_column(ts)
    limit = F.lit(as_of).cast("timestamp_ntz")
    # Cheap pushable bound first; the exact end-of-month clamp decides near it.
    bound = F.expr(f"timestamp_ntz '{as_of}' - interval {months} month - interval 4 day")
    return (c >= bound) & (c + F.expr(f"interval '{months}' month") > limit)
