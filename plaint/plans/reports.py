"""The two report pages as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaint.functions import color, text
from plaint.operators import aggregates, summaries, topn
from plaint.operators.filters import filter_clusters
from plaint.operators.joins import color_points
from plaint.schemas import COMPONENTS, DASHBOARD_COLUMNS
from plaint.sources import pages as page_source

# Rows of the dashboard, points of the map, comments read and shown per cluster.
DASHBOARD_ROWS = 200_000
MAP_POINTS = 100_000
PROMPT_COMMENTS = 10
SHOWN_COMMENTS = 3

# Tells dashboard rows apart, also those whose id is blank.
IDENTITY = ("id", "last_activity", "address")


def dashboard_columns(clustered: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 11 columns of the reports under their names there."""
    return clustered.withColumnsRenamed({"ticket_id": "id"}).select(*DASHBOARD_COLUMNS, *keep)


def dashboard_scan(
    clustered: DataFrame, n: int | None = DASHBOARD_ROWS, direct: int = topn.DIRECT
) -> DataFrame:
    """The 11 columns of the reports for the newest rows, or for all rows, in no order, when n is
    None; vectors are not read."""
    columns = dashboard_columns(clustered)
    return columns if n is None else topn.newest(columns, n, ties=("id",), direct=direct)


def load_dashboard(clustered: DataFrame, n: int | None = DASHBOARD_ROWS) -> DataFrame:
    """The dashboard rows, persisted for the reports that share them (at most n narrow rows).

    All rows (n is None) are not persisted: each report then reads the columns that it shows."""
    rows = dashboard_scan(clustered, n)
    return rows if n is None else rows.persist(StorageLevel.MEMORY_AND_DISK)


@dataclass
class ClusterReport:
    bars: DataFrame
    scatter: DataFrame
    samples: DataFrame


def cluster_bars(dashboard: DataFrame) -> DataFrame:
    """``cluster, count, bar_color``, largest first."""
    counts = aggregates.cluster_counts(dashboard)
    lookup = aggregates.palette(dashboard).select("cluster", "color")
    bars = counts.join(lookup, "cluster", "left").select(
        "cluster", "count", color.hex_text("color").alias("bar_color")
    )
    return topn.order_counts(bars)


def cluster_scatter(dashboard: DataFrame) -> DataFrame:
    """``id, cluster, PC1, PC2, PC3, color``: the points of the component plot."""
    colored = color_points(dashboard, aggregates.palette(dashboard))
    return colored.select("id", "cluster", *COMPONENTS, color.rgba_text("color").alias("color"))


def component_vectors(dashboard: DataFrame) -> DataFrame:
    """Add ``vector``, the three components; NULL for rows without them."""
    known = F.coalesce(*COMPONENTS).isNotNull()
    return dashboard.withColumn("vector", F.when(known, F.array(*COMPONENTS)))


def cluster_samples(
    dashboard: DataFrame,
    summarizer: summaries.Summarizer | None = None,
    identity: Sequence[str] = IDENTITY,
    prompt_comments: int = PROMPT_COMMENTS,
    shown_comments: int = SHOWN_COMMENTS,
) -> DataFrame:
    """``cluster, color, summary, comments``: the table under the plot.

    One sample serves both: the comments shown are the first of those summarised. Without a
    callable, the summary is the comment in the middle of the cluster's components.
    """
    drawn = aggregates.cluster_samples(dashboard, prompt_comments, identity=identity)
    if summarizer:
        table = summaries.summarize_prompts(aggregates.cluster_prompt(drawn), summarizer)
    else:
        central = summaries.central_comments(component_vectors(dashboard), identity="id")
        table = drawn.join(central, "cluster", "left")
    colored = color_points(table, aggregates.palette(dashboard))
    shown = F.transform(F.slice("comments", 1, shown_comments), text.bullet_line)
    return colored.select(
        "cluster",
        color.rgba_text("color", ", ").alias("color"),
        F.coalesce("summary", F.lit(summaries.NO_SUMMARY)).alias("summary"),
        shown.alias("comments"),
    ).orderBy("cluster")


def cluster_report(
    dashboard: DataFrame,
    summarizer: summaries.Summarizer | None = None,
    identity: Sequence[str] = IDENTITY,
) -> ClusterReport:
    """All parts of the cluster page. ``dashboard`` comes from ``load_dashboard``."""
    return ClusterReport(
        cluster_bars(dashboard),
        cluster_scatter(dashboard),
        cluster_samples(dashboard, summarizer, identity),
    )


@dataclass
class MapReport:
    points: DataFrame
    center: DataFrame
    counts: DataFrame


def map_points(
    dashboard: DataFrame,
    clusters: Sequence[int],
    n: int = MAP_POINTS,
    identity: Sequence[str] = IDENTITY,
    direct: int = topn.DIRECT,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Sampled points of the selected clusters, with colour and short comment."""
    colors = aggregates.palette(dashboard)
    points = topn.sample_n(filter_clusters(dashboard, clusters), n, identity=identity, direct=direct)
    return color_points(points, colors).select(
        "id",
        "latitude",
        "longitude",
        "cluster",
        "color",
        text.short_comment("comment").alias("short_comment"),
        "photo",
        "address",
        *keep,
    )


def map_report(
    dashboard: DataFrame,
    clusters: Sequence[int],
    n: int = MAP_POINTS,
    identity: Sequence[str] = IDENTITY,
    rank_error: float | None = None,
) -> MapReport:
    """All parts of the map page. ``dashboard`` comes from ``load_dashboard``.

    ``rank_error`` allows a sketched center, for dashboards of very many rows."""
    return MapReport(
        map_points(dashboard, clusters, n, identity),
        aggregates.map_center(filter_clusters(dashboard, clusters), rank_error=rank_error),
        aggregates.map_counts(dashboard, clusters, n),
    )


def traffic_items(pages: DataFrame, **options) -> DataFrame:
    """News items of fetched pages that have a time or a description."""
    return page_source.either_field(page_source.extract_list_items(pages, **options))
