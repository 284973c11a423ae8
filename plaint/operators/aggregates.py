"""Counts, palettes, medians and texts per cluster."""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from plaint.functions import color, text
from plaint.functions.sampling import sketch_size
from plaint.operators.filters import selected
from plaint.operators.topn import sample_per_group

LARGEST = sys.float_info.max

INSTRUCTION = (
    "Summarise what the following public comments have in common. Write one or two short, clear "
    "sentences in Thai about the main issue. Use no emoji or special characters, and do not "
    "begin by referring to the comments."
)


def cluster_counts(df: DataFrame, key: str = "cluster") -> DataFrame:
    """Rows per cluster. Rows without a cluster are not counted."""
    counted = df.filter(F.col(key).isNotNull()).groupBy(key)
    return counted.agg(F.count(F.lit(1)).alias("count"))


def distinct_clusters(df: DataFrame, key: str = "cluster", as_int: bool = False) -> DataFrame:
    """The clusters present, in text order, or as integers in number order."""
    value = F.col(key).try_cast("int") if as_int else F.col(key)
    return df.select(value.alias(key)).filter(F.col(key).isNotNull()).distinct().orderBy(key)


def palette(df: DataFrame, key: str = "cluster") -> DataFrame:
    """``cluster, position, color``: colours in text order of the clusters (10 before 2).

    The window runs over the distinct clusters, one row each.
    """
    clusters = df.select(key).filter(F.col(key).isNotNull()).distinct()
    position = F.row_number().over(Window.orderBy(key)) - 1
    return clusters.select(key, position.alias("position")).withColumn(
        "color", color.palette_color("position")
    )


def _bound(brackets: dict[str, Row], field: str) -> Column:
    """The given bound of the bracket of the column that a row comes from."""
    whens = [F.when(F.col("name") == name, F.lit(b[field])) for name, b in brackets.items()]
    return F.coalesce(*whens, F.lit(None).cast("double"))


def _ranked(counts: DataFrame, order: str) -> DataFrame:
    """Add the rows up to each entry and the two middle ranks of each column, counted from 1."""
    by_name = Window.partitionBy("name")
    upto = by_name.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("rows").over(by_name)
    return counts.select(
        "*",
        F.sum("rows").over(upto).alias("upto"),
        F.floor((total + 1) / 2).alias("first"),
        (F.floor(total / 2) + 1).alias("second"),
    )


def _halved(value: Column) -> Column:
    """Half a value, so that the width of no finite bracket overflows."""
    return F.least(F.greatest(value, F.lit(-LARGEST)), F.lit(LARGEST)) / 2


def _by_magnitude(value: Column) -> Column:
    """A scale on which far outliers and infinities are near: below 710 either way."""
    return F.signum(value) * F.log1p(F.least(F.abs(value), F.lit(LARGEST)))


def _tighter(
    values: DataFrame, brackets: dict[str, Row], cells: int, scale: Callable[[Column], Column]
) -> dict[str, Row]:
    """Cut each bracket into cells of equal width on a scale, count them, and keep the cells of
    the middle rows."""
    low, high = _bound(brackets, "low"), _bound(brackets, "high")
    width = scale(high) - scale(low)
    cell = F.when(width > 0, F.floor((scale(F.col("value")) - scale(low)) / F.nullif(width, F.lit(0.0)) * F.lit(cells)))
    cell = F.coalesce(cell, F.lit(0))
    cell = (
        F.when(F.col("value") < low, F.lit(-1))
        .when(F.col("value") > high, F.lit(cells))
        .when(high > low, F.least(cell, F.lit(cells - 1)))
        .otherwise(F.lit(0))
    )
    counts = values.groupBy("name", cell.alias("cell")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    middle = _ranked(counts, "cell").filter(
        (F.col("upto") >= F.col("first")) & (F.col("upto") - F.col("rows") < F.col("second"))
    )
    found = middle.groupBy("name").agg(
        F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    return {row.name: row for row in found.collect()}


def exact_medians(
    df: DataFrame, columns: Sequence[str], few: int = 1_000_000, cells: int = 65_536
) -> DataFrame:
    """One row with the interpolated median of each column; NULL and NaN do not count.

    Spark's exact median holds every distinct value of a column in one buffer. Here brackets
    around the median are tightened by counts over equal cells until they hold few rows; values
    outside are then only counted, and values inside are counted one by one. All counts are
    combined before the shuffle, so one value may hold any share of the rows. The driver sees one
    row per column.
    """
    fields = [
        F.struct(F.lit(name).alias("name"), F.nanvl(name, F.lit(None)).alias("value"))
        for name in columns
    ]
    values = df.select(F.inline(F.array(*fields))).filter(F.col("value").isNotNull())
    spans = values.groupBy("name").agg(
        F.count(F.lit(1)).alias("rows"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    brackets = {row.name: row for row in spans.collect()}
    # Where one scale leaves a bracket as it is, as around a far outlier, the other cuts it.
    scales, idle = [_halved, _by_magnitude], 0
    while idle < len(scales) and any(b.rows > few and b.low < b.high for b in brackets.values()):
        tighter = _tighter(values, brackets, cells, scales[0])
        idle = idle + 1 if tighter == brackets else 0
        brackets, scales = tighter, scales[::-1]

    value = F.col("value")
    clipped = (
        F.when(value < _bound(brackets, "low"), float("-inf"))
        .when(value > _bound(brackets, "high"), float("inf"))
        .otherwise(value)
    )
    counts = values.groupBy("name", clipped.alias("value")).agg(F.count(F.lit(1)).alias("rows"))

    def at(name: str, rank: str) -> Column:
        reached = (F.col("name") == name) & (F.col("upto") >= F.col(rank))
        return F.min(F.when(reached, value))

    medians = [((at(name, "first") + at(name, "second")) / 2).alias(name) for name in columns]
    return _ranked(counts, "value").agg(*medians)


def sketched_medians(df: DataFrame, columns: Sequence[str], rank_error: float = 0.001) -> DataFrame:
    """One row with a value near the median of each column, in one scan; NULL and NaN do not count.

    The value is one of the column's, and its rank is off the middle by at most ``rank_error`` of the
    rows, with a probability of 99 %. Sketches of a few kilobytes are merged before and after the
    shuffle, so any number of rows, ties and infinities cost the same.
    """
    size = F.lit(sketch_size(rank_error))
    sketches = df.agg(
        *[F.kll_sketch_agg_double(F.nanvl(F.col(name).cast("double"), F.lit(None)), size).alias(name) for name in columns],
        *[F.count(F.nanvl(F.col(name).cast("double"), F.lit(None))).alias(f"_{name}") for name in columns],
    )
    middle = F.lit(0.5)
    return sketches.select(
        *[F.when(F.col(f"_{name}") > 0, F.kll_sketch_get_quantile_double(name, middle)).alias(name) for name in columns]
    )


def map_center(
    df: DataFrame,
    columns: Sequence[str] = ("latitude", "longitude"),
    rank_error: float | None = None,
) -> DataFrame:
    """Median latitude and longitude of the rows, exact unless a ``rank_error`` is allowed."""
    if rank_error is not None:
        return sketched_medians(df, columns, rank_error)
    return exact_medians(df, columns)


def map_counts(df: DataFrame, clusters: Sequence[int], most: int, key: str = "cluster") -> DataFrame:
    """One row: points shown and present, clusters selected and present.

    An empty selection shows all points, and at most ``most`` are shown.
    """
    per_cluster = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    chosen = F.coalesce(F.sum(F.when(selected(clusters, key), F.col("rows"))), F.lit(0))
    total = F.coalesce(F.sum("rows"), F.lit(0))
    shown = F.least(F.when(chosen > 0, chosen).otherwise(total), F.lit(most))
    return per_cluster.agg(
        shown.alias("shown_points"),
        total.alias("total_points"),
        F.lit(len(set(clusters))).cast("long").alias("selected_clusters"),
        F.count(key).alias("total_clusters"),
    )


def cluster_samples(
    df: DataFrame,
    n: int = 10,
    key: str = "cluster",
    comment: str = "comment",
    identity: Sequence[str] = ("ticket_id",),
) -> DataFrame:
    """``cluster, comments``: n sampled comments per cluster, in sample order (NULL as '').

    At most n rows of a cluster are left when its list is built.
    """
    drawn = sample_per_group(df.select(key, comment, *identity), key, n, identity=identity)
    items = F.collect_list(F.struct("position", text.or_blank(comment).alias("comment")))
    ordered = F.transform(F.sort_array(items), lambda item: item["comment"])
    return drawn.groupBy(key).agg(ordered.alias("comments"))


def cluster_prompt(samples: DataFrame, instruction: str = INSTRUCTION) -> DataFrame:
    """Add ``prompt``: the instruction, an empty line, and the comments as a list."""
    lines = F.concat_ws("\n", F.transform("comments", text.bullet_line))
    return samples.withColumn("prompt", F.concat(F.lit(instruction + "\n\n"), lines))


def cluster_means(df: DataFrame, key: str = "cluster", vector: str = "vector") -> DataFrame:
    """``cluster, mean``: the mean vector of each cluster, combined before the shuffle."""
    rows = df.filter(F.col(key).isNotNull() & F.col(vector).isNotNull())
    means = rows.groupBy(key).agg(Summarizer.mean(array_to_vector(vector)).alias("mean"))
    return means.select(key, vector_to_array("mean").alias("mean"))
