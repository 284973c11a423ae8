"""Small helpers shared by the column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(value: Column | str) -> Column:
    """A column, given itself or its name."""
    return F.col(value) if isinstance(value, str) else value
