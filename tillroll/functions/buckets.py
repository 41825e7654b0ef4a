"""Time buckets and display expressions used by the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sale_date(ts: str | Column = "purchased_at") -> Column:
    """Calendar day of a purchase."""
    return F.to_date(_c(ts))


def sale_month(ts: str | Column = "purchased_at") -> Column:
    """``yyyy-MM`` label."""
    return F.date_format(_c(ts), "yyyy-MM")


def sale_year(ts: str | Column = "purchased_at") -> Column:
    """Calendar year as int."""
    return F.year(_c(ts))


def month_of_day(day: str | Column = "sale_date") -> Column:
    """``yyyy-MM`` label of a date (same label as ``sale_month`` of its timestamps)."""
    return F.date_format(_c(day), "yyyy-MM")


def year_of_month(month: str | Column = "sale_month") -> Column:
    """Year of a ``yyyy-MM`` label."""
    return F.substring(_c(month), 1, 4).cast("int")


def month_to_date(month: str | Column = "sale_month") -> Column:
    """``yyyy-MM`` → first day of that month (NULL for a bad label)."""
    return F.try_to_date(F.concat(_c(month), F.lit("-01")), "yyyy-MM-dd")


def display_name(first: str | Column = "first_name", last: str | Column = "last_name") -> Column:
    """``first || ' ' || last`` — NULL when either part is NULL (not concat_ws)."""
    return F.concat(_c(first), F.lit(" "), _c(last))
