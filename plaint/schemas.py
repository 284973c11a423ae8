"""Declared table schemas. Everything is nullable, as in a load with declared columns."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_COLUMNS = [
    "ticket_id",
    "type",
    "organization",
    "comment",
    "photo",
    "photo_after",
    "coords",
    "address",
    "subdistrict",
    "district",
    "province",
    "timestamp",
    "state",
    "star",
    "count_reopen",
    "last_activity",
]

# The export is read as text only: one bad value must become NULL, not fail a day, and schema
# inference would cost a second pass over files that cannot be split.
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

_TYPED = {
    "timestamp": T.TimestampType(),
    "last_activity": T.TimestampType(),
    "star": T.IntegerType(),
    "count_reopen": T.IntegerType(),
}

TICKET_SCHEMA = T.StructType(
    [
        T.StructField(name, _TYPED.get(name, T.StringType()))
        for name in RAW_COLUMNS
        if name != "coords"
    ]
    + [T.StructField("longitude", T.DoubleType()), T.StructField("latitude", T.DoubleType())]
)
TICKET_COLUMNS = TICKET_SCHEMA.fieldNames()

VECTOR_TYPE = T.ArrayType(T.DoubleType())
VECTOR_SCHEMA = T.StructType([*TICKET_SCHEMA.fields, T.StructField("vector", VECTOR_TYPE)])

PHOTO_SCHEMA = T.StructType(
    [T.StructField("url", T.StringType()), T.StructField("content", T.BinaryType())]
)

COMPONENTS = ["PC1", "PC2", "PC3"]
DASHBOARD_COLUMNS = [
    "id",
    "comment",
    "address",
    "photo",
    "latitude",
    "longitude",
    "last_activity",
    "cluster",
    *COMPONENTS,
]
