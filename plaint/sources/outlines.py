"""District outlines from KML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaint.functions import color

_RING = T.StructType(
    [T.StructField("LinearRing", T.StructType([T.StructField("coordinates", T.StringType())]))]
)
_POLYGON = T.StructType([T.StructField("outerBoundaryIs", _RING)])
PLACEMARK = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("Polygon", _POLYGON),
        T.StructField(
            "MultiGeometry", T.StructType([T.StructField("Polygon", T.ArrayType(_POLYGON))])
        ),
    ]
)


def ring_points(coordinates: Column) -> Column:
    """``lon,lat[,alt]`` tuples between blanks, as an array of ``lon, lat``."""
    tuples = F.filter(F.split(coordinates, r"\s+"), lambda t: t != "")

    def point(t: Column) -> Column:
        parts = F.split(t, ",")
        return F.struct(
            F.get(parts, 0).try_cast("double").alias("lon"),
            F.get(parts, 1).try_cast("double").alias("lat"),
        )

    return F.transform(tuples, point)


def outlines(placemarks: DataFrame) -> DataFrame:
    """``name, location, color``: one row per exterior ring; inner rings are left out."""
    single = F.array("Polygon.outerBoundaryIs.LinearRing.coordinates")
    several = F.transform(
        "MultiGeometry.Polygon", lambda p: p["outerBoundaryIs"]["LinearRing"]["coordinates"]
    )
    rings = F.concat(single, F.coalesce(several, F.array().cast("array<string>")))
    rows = placemarks.select("name", F.explode(rings).alias("ring"))
    return rows.filter(F.col("ring").isNotNull()).select(
        "name", ring_points(F.col("ring")).alias("location"), color.name_color("name").alias("color")
    )


def read_outlines(spark: SparkSession, path: str) -> DataFrame:
    """The outlines of all placemarks in KML files."""
    reader = spark.read.format("xml").option("rowTag", "Placemark").schema(PLACEMARK)
    return outlines(reader.load(path))
