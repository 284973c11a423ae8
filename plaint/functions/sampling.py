"""A reproducible random order of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plaint.functions.columns import column


def draw(seed: int | str, identity: list[Column | str]) -> Column:
    """A hash of seed and identity: 32 hexadecimal digits, evenly spread.

    It depends on the row alone, so a sample is the same for every partitioning and every retry.
    ``identity`` should tell rows apart; rows that share it are drawn together.
    """
    parts = [F.coalesce(column(c).cast("string"), F.lit("")) for c in identity]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts).cast("binary"))


def sketch_size(rank_error: float) -> int:
    """Items of a KLL sketch whose quantiles are off by at most this share of all rows, in 99 of 100
    sketches: the published fit for one rank is 2.296 / k ** 0.9021."""
    if not 0 < rank_error < 1:
        raise ValueError("rank_error is a share of the rows")
    return int(min(max((2.296 / rank_error) ** (1 / 0.9021) + 1, 8), 65_535))
