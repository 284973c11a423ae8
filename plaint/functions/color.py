"""Colours as arrays of four integers 0..255 (red, green, blue, alpha)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plaint.functions.columns import column

# The ten colours of the common categorical map "tab10", opaque.
PALETTE = [
    [31, 119, 180, 255],
    [255, 127, 14, 255],
    [44, 160, 44, 255],
    [214, 39, 40, 255],
    [148, 103, 189, 255],
    [140, 86, 75, 255],
    [227, 119, 194, 255],
    [127, 127, 127, 255],
    [188, 189, 34, 255],
    [23, 190, 207, 255],
]
# The colour of a point without a known cluster, and of a bar without one.
GRAY = [128, 128, 128, 255]
GRAY_HEX = "#888888"
# Positions repeat after 20, and a random channel lies in 150..255.
CYCLE = 20
LOWEST, HIGHEST = 150, 255


def _literal(color: list[int]) -> Column:
    return F.array(*[F.lit(channel) for channel in color])


def gray() -> Column:
    return _literal(GRAY)


def palette_color(position: Column | str) -> Column:
    """Colour of the cluster at ``position`` (from 0); past the last colour, the last one."""
    index = F.least(F.pmod(column(position), F.lit(CYCLE)), F.lit(len(PALETTE) - 1))
    return F.element_at(F.array(*map(_literal, PALETTE)), index.cast("int") + 1)


def rgba_text(color: Column | str, separator: str = ",") -> Column:
    """``rgba(r,g,b,a)`` with alpha as a share of 255."""
    color = column(color)
    channels = [F.get(color, i).cast("string") for i in range(3)]
    alpha = (F.get(color, 3) / F.lit(255.0)).cast("string")
    return F.concat(F.lit("rgba("), F.concat_ws(separator, *channels, alpha), F.lit(")"))


def hex_text(color: Column | str) -> Column:
    """``#rrggbb``; gray where there is no colour."""
    color = column(color)
    text = F.format_string("#%02x%02x%02x", *[F.get(color, i) for i in range(3)])
    return F.when(color.isNull(), GRAY_HEX).otherwise(text)


def name_color(name: Column | str) -> Column:
    """A light colour drawn from the name, the same in every run."""
    digest = F.md5(column(name))
    span = F.lit(HIGHEST - LOWEST + 1)

    def channel(i: int) -> Column:
        drawn = F.conv(F.substring(digest, 1 + 6 * i, 6), 16, 10).cast("int")
        return F.lit(LOWEST) + F.pmod(drawn, span)

    return F.array(*[channel(i) for i in range(4)])
