"""Row filters of the jobs and reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaint.functions import typing
from plaint.functions.columns import column

Day = str | dt.date


def as_date(ds: Day) -> dt.date:
    return dt.date.fromisoformat(ds) if isinstance(ds, str) else ds


def present(value: Column | str) -> Column:
    """Neither NULL nor ''."""
    value = column(value)
    return value.isNotNull() & (value != "")


def on_day(df: DataFrame, ds: Day, moment: str = "timestamp") -> DataFrame:
    """Rows of one UTC date. Catalyst turns the date into a range that reaches the scan."""
    return df.filter(typing.day(moment) == F.lit(as_date(ds)))


def since(df: DataFrame, start: str, moment: str = "timestamp") -> DataFrame:
    """Rows from ``start`` on."""
    return df.filter(F.col(moment) >= F.lit(start).cast("timestamp"))


def has_value(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where each column is neither NULL nor ''."""
    return df.filter(reduce(Column.__and__, [present(name) for name in columns]))


def not_blank_keep_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where no column is ''; a NULL stays."""
    return df.filter(reduce(Column.__and__, [~F.col(name).eqNullSafe("") for name in columns]))


def id_present(df: DataFrame, key: str = "ticket_id") -> DataFrame:
    """Rows with an id; under three-valued logic a NULL id goes as well."""
    return df.filter(F.col(key) != "")


def selected(clusters: Sequence[int], cluster: Column | str = "cluster") -> Column:
    """Is the cluster, read as an integer, one of ``clusters``?"""
    if not clusters:
        return F.lit(False)
    return F.coalesce(column(cluster).try_cast("int").isin(*clusters), F.lit(False))


def filter_clusters(df: DataFrame, clusters: Sequence[int], cluster: str = "cluster") -> DataFrame:
    """Rows of the selected clusters, or all rows when that leaves none.

    Whether any row is left is a scalar subquery over one column (a partial aggregate), so the
    choice is part of the plan and not of the driver's code.
    """
    chosen = selected(clusters, cluster)
    found = df.agg(F.coalesce(F.bool_or(chosen), F.lit(False)).alias("found")).scalar()
    return df.filter(chosen | ~found)


# Why a ticket gets no vector.
NO_ID = "missing ticket_id"
NO_URL = "missing photo"
NO_BYTES = "photo not available"


def embed_guard(df: DataFrame, content: str = "content") -> DataFrame:
    """Add ``reject_reason``: the first thing missing for a vector, NULL when nothing is."""
    size = F.coalesce(F.octet_length(content), F.lit(0))
    reason = (
        F.when(~present("ticket_id"), NO_ID).when(~present("photo"), NO_URL).when(size == 0, NO_BYTES)
    )
    return df.withColumn("reject_reason", reason)
