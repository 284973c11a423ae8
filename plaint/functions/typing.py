"""Casts of raw text. A value that cannot be cast becomes NULL; nothing throws under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plaint.functions.columns import column


def instant(text: Column | str) -> Column:
    """Timestamp text such as ``2024-01-05 10:00:00.123+00``."""
    return F.try_to_timestamp(column(text))


def whole(text: Column | str) -> Column:
    """Integer text; a fraction is cut off, so both ``4`` and ``4.0`` give 4."""
    return column(text).try_cast("decimal(38,18)").try_cast("int")


def real(text: Column | str) -> Column:
    """Double text."""
    return column(text).try_cast("double")


def day(moment: Column | str) -> Column:
    """The (UTC) date of an instant."""
    return F.to_date(column(moment))


def part(text: Column | str, index: int, separator: str = ",") -> Column:
    """The ``index``-th piece of separated text, counted from 0; NULL when there is none."""
    return F.get(F.split(column(text), separator), index)
