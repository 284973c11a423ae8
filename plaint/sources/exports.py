"""Daily ticket exports: multi-line CSV files in one folder per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plaint.schemas import RAW_SCHEMA, TICKET_SCHEMA

# Quotes inside a field are doubled, fields may span lines.
RAW_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
}
# Blanks around a value are part of it; Spark's writer would trim them.
KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# The processed export also keeps NULL apart from '', on both sides.
PROCESSED_OPTIONS = {
    **RAW_OPTIONS,
    **KEEP_BLANKS,
    "nullValue": "\\N",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def day_folder(root: str, stage: str, ds: str) -> str:
    """The folder of one day: ``raw/{ds}`` or ``processed/{ds}`` below the root."""
    return f"{root.rstrip('/')}/{stage}/{ds}"


def raw_path(root: str, ds: str) -> str:
    """The files of one day's export. A day may be one file or many."""
    return f"{day_folder(root, 'raw', ds)}/*"


def processed_path(root: str, ds: str) -> str:
    return f"{day_folder(root, 'processed', ds)}/transformed_data"


def read_ticket_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The 16 text columns of an export.

    A file with multi-line fields cannot be split, so it is one task: land a large day as many
    files.
    """
    return spark.read.schema(RAW_SCHEMA).options(**RAW_OPTIONS).csv(path)


def read_day(spark: SparkSession, root: str, ds: str) -> DataFrame:
    """The raw export of one day."""
    return read_ticket_csv(spark, raw_path(root, ds))


def land_raw(text: DataFrame, root: str, ds: str) -> None:
    """Write the raw text of one day, replacing what was there.

    ``text`` has one row per CSV document in ``value`` (each with its header) and a number or name
    for it in ``part``. Every document becomes its own file, so none is cut or joined.
    """
    documents = text.select(text["part"].cast("string").alias("part"), "value")
    folder = f"{day_folder(root, 'raw', ds)}"
    documents.write.mode("overwrite").partitionBy("part").option("lineSep", "\n").text(folder)


def export_csv(df: DataFrame, path: str) -> None:
    """Write tickets as CSV with a header and all fields quoted, one file per task.

    NULL is written as ``\\N`` and a quote as two, so that ``load_processed_csv`` reads back the
    same rows.
    """
    df.write.mode("overwrite").options(**PROCESSED_OPTIONS, quoteAll="true").csv(path)


def load_processed_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Exported tickets (a folder or a wildcard) under the declared schema."""
    return spark.read.schema(TICKET_SCHEMA).options(**PROCESSED_OPTIONS).csv(path)
