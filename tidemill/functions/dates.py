"""Dates given as ``yyyy``, ``yyyy-MM`` or ``yyyy-MM-dd``."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FORMS = re.compile(r"(\d{4})(?:-(\d{2})(?:-(\d{2}))?)?")


def period(date: str) -> tuple[dt.date, dt.date]:
    """First day of the period ``date`` names, and first day after it."""
    match = _FORMS.fullmatch(date)
    if match is None:
        raise ValueError(f"not yyyy, yyyy-MM or yyyy-MM-dd: {date!r}")
    year, month, day = (int(g) if g else None for g in match.groups())
    first = dt.date(year, month or 1, day or 1)
    if day:
        return first, first + dt.timedelta(days=1)
    if month:
        return first, (first + dt.timedelta(days=31)).replace(day=1)
    return first, dt.date(year + 1, 1, 1)


def _literal(df: DataFrame, column: str, day: dt.date) -> Column:
    # Same type as the column, so that the comparison reaches the file statistics.
    kind = df.schema[column].dataType
    text = F.lit(day.isoformat())
    return text if isinstance(kind, T.StringType) else text.cast(kind)


def in_period(df: DataFrame, column: str, date: str) -> Column:
    """``column`` falls on ``date`` at the granularity of ``date``."""
    first, after = period(date)
    value = F.col(column)
    return (value >= _literal(df, column, first)) & (value < _literal(df, column, after))


def before_period(df: DataFrame, column: str, date: str) -> Column:
    """``column`` lies before ``date`` at the granularity of ``date``."""
    return F.col(column) < _literal(df, column, period(date)[0])


def after_period(df: DataFrame, column: str, date: str) -> Column:
    """``column`` lies after ``date`` at the granularity of ``date``."""
    return F.col(column) >= _literal(df, column, period(date)[1])


def year_month(value: Column) -> Column:
    """``yyyy-MM`` of a date."""
    return F.substring(value.cast("string"), 1, 7)


def day_text(value: Column) -> Column:
    """``yyyy-MM-dd`` of a date."""
    return F.substring(value.cast("string"), 1, 10)
