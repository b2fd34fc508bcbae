"""Date helpers: cohort keys, month arithmetic and look-back flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ref_from_text(c: Column | str, length: int = 6) -> Column:
    """Cohort from raw date text: drop dashes, keep the first ``length`` chars.

    ``length=6`` gives ``yyyyMM``; the daily variant takes the first 10 chars
    of the text first and keeps 8 (``yyyyMMdd``).
    """
    text = _col(c).cast("string")
    if length == 8:
        text = F.substring(text, 1, 10)
    return F.substring(F.replace(text, F.lit("-"), F.lit("")), 1, length)


def ref_from_date(c: Column | str) -> Column:
    """Cohort from a parsed date: ``yyyyMM``."""
    return F.date_format(_col(c), "yyyyMM")


def month_start(ref: Column | str) -> Column:
    """``yyyyMM`` cohort -> first day of that month (date)."""
    return F.to_date(F.concat(_col(ref).cast("string"), F.lit("01")), "yyyyMMdd")


def month_label(d: Column | str) -> Column:
    """Date -> ``MM/yyyy`` label."""
    return F.date_format(_col(d), "MM/yyyy")


def months_between(end: Column | str, start: Column | str) -> Column:
    """Spark's month difference (fractional, rounded to 8 digits)."""
    return F.months_between(_col(end), _col(start))


def truncated_months(end: Column | str, start: Column | str) -> Column:
    """Whole months between two dates, truncated toward zero."""
    return F.months_between(_col(end), _col(start)).cast("int")


def flag_within(months: Column, k: int) -> Column:
    """1 when ``months <= k`` else 0 (NULL months -> 0)."""
    return F.when(months <= F.lit(k), F.lit(1)).otherwise(F.lit(0))
