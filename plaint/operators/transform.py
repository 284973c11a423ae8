"""From the text columns of an export to typed, cleaned tickets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaint.functions import text, typing
from plaint.schemas import RAW_COLUMNS, TICKET_COLUMNS

_CASTS = {
    "timestamp": typing.instant,
    "last_activity": typing.instant,
    "star": typing.whole,
    "count_reopen": typing.whole,
}


def type_tickets(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 16 known columns, four of them cast; other columns go unless named in ``keep``."""
    typed = [_CASTS.get(name, F.col)(name).alias(name) for name in RAW_COLUMNS]
    return raw.select(*typed, *keep)


def clean_text(df: DataFrame, columns: Sequence[str] = ("comment",)) -> DataFrame:
    """Quotes and line ends out of the named columns."""
    return df.withColumns({name: text.one_line(name) for name in columns})


def split_coords(df: DataFrame) -> DataFrame:
    """``coords`` ("longitude,latitude") becomes two doubles."""
    parts = {
        "longitude": typing.real(typing.part("coords", 0)),
        "latitude": typing.real(typing.part("coords", 1)),
    }
    return df.withColumns(parts).drop("coords")


def transform_tickets(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The whole cleaning step, which Catalyst collapses into one projection of the scan."""
    cleaned = split_coords(clean_text(type_tickets(raw, keep)))
    return cleaned.select(*TICKET_COLUMNS, *keep)
