"""Windows, calendar differences and the two-ended active rule.

Everything works on DATE and TIMESTAMP_NTZ without consulting the session zone,
and every "today" is an explicit ``as_of`` so that a rebuilt table is repeatable.
"""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


class Span(NamedTuple):
    """Half-open date window [lo, hi)."""

    lo: date
    hi: date


def in_span(col: Column, span: Span, kind: str | DataType = "date") -> Column:
    """Half-open membership written with literals of the column's type, to reach the scan."""
    return (col >= F.lit(span.lo).cast(kind)) & (col < F.lit(span.hi).cast(kind))


def active_on(start: Column, end: Column, as_of: date) -> Column:
    day = F.lit(as_of)
    return F.coalesce(start <= day, F.lit(False)) & (end.isNull() | (end > day))


def minutes_between(a: Column, b: Column) -> Column:
    """Minute boundaries crossed from ``a`` to ``b`` (10:00:59 to 10:01:00 is 1)."""
    days = F.datediff(F.to_date(b), F.to_date(a)).cast("long")
    clock = (F.hour(b) - F.hour(a)) * 60 + (F.minute(b) - F.minute(a))
    return days * 1440 + clock


def days_between(a: Column, b: Column) -> Column:
    return F.datediff(F.to_date(b), F.to_date(a)).cast("long")


def month_of(col: Column) -> Column:
    return F.trunc(F.to_date(col), "MM")


def swapped_day_month(d: Column) -> Column:
    """Day and month exchanged; a day beyond 12 cannot be a month and gives NULL."""
    return F.when(
        F.day(d).between(1, 12), F.make_date(F.year(d), F.day(d), F.month(d))
    )


def age_years(dob: Column, as_of: date) -> Column:
    return F.floor(F.months_between(F.lit(as_of), dob) / 12).cast("long")
