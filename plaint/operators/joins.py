"""Joins on one key."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaint.functions import color, vector
from plaint.operators.filters import id_present, present
from plaint.schemas import COMPONENTS

SPREAD = 1_024


def left_join(
    left: DataFrame, rights: Sequence[DataFrame], key: str, spread_by: Sequence[str]
) -> DataFrame:
    """Left joins on ``key`` with right sides that have no blank key.

    Rows of the left without a key match nothing, but hashed by key alone they would all meet in
    one task, and a third of the tickets may be among them. They get one of 1,024 stand-in keys
    drawn from ``spread_by``; the second condition keeps a stand-in from ever matching. All joins
    share the one shuffle of the left. Keys that many tickets have are left to AQE, which splits
    skewed partitions.
    """
    part = F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)).cast("string")
    stand_in = F.when(present(key), F.col(key)).otherwise(part)
    joined = left.withColumn("_key", stand_in)
    for right in rights:
        other = right.withColumnRenamed(key, "_match")
        same = (F.col("_key") == F.col("_match")) & (F.col(key) == F.col("_match"))
        joined = joined.join(other, same, "left").drop("_match")
    return joined.drop("_key")


def join_vectors(todo: DataFrame, vectors: DataFrame, key: str = "ticket_id") -> DataFrame:
    """Tickets with their vectors. An id present n times on both sides gives n x n rows."""
    return todo.join(vectors, key, "inner")


def clustered_columns(df: DataFrame, own: Sequence[str]) -> DataFrame:
    """All columns of the vectors, the cluster as text, and the components."""
    return df.select(*own, F.col("cluster").cast("string").alias("cluster"), *COMPONENTS)


def join_clusters_components(
    vectors: DataFrame,
    clusters: DataFrame,
    components: DataFrame,
    key: str = "ticket_id",
    spread_by: Sequence[str] = ("timestamp", "photo"),
) -> DataFrame:
    """All vectors with cluster and components from two separate predictions.

    Rows without an id stay, with NULLs. An id present n times in all three gives n^3 rows;
    ``models.predict`` adds the same columns in place, with no join and no repeated rows.
    """
    clusters = id_present(clusters, key).select(key, "cluster")
    components = id_present(components, key).select(key, *COMPONENTS)
    joined = left_join(vectors, [clusters, components], key, spread_by)
    return clustered_columns(joined, vectors.columns)


def assign_clusters(
    df: DataFrame, names: list[str], centers: np.ndarray, column: str = "vector"
) -> DataFrame:
    """Add ``cluster``, the name of the nearest given center. Map-only: nothing is joined."""
    return df.withColumn("cluster", vector.nearest(column, names, centers))


def color_points(df: DataFrame, palette: DataFrame, key: str = "cluster") -> DataFrame:
    """Add ``color`` from a palette (``cluster, color``); gray where the palette has none."""
    lookup = palette.select(key, F.col("color").alias("_color"))
    joined = df.join(lookup, key, "left")
    return joined.select(*df.columns, F.coalesce("_color", color.gray()).alias("color"))
