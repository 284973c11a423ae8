"""New landing files into the ticket table."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plaint.operators.transform import transform_tickets
from plaint.schemas import RAW_SCHEMA
from plaint.sources import tables
from plaint.sources.exports import RAW_OPTIONS

# The folder of a day's export, wherever in the path of a landing file it is.
EXPORT_DAY = r"/(\d{4}-\d{2}-\d{2})(?=/)"


def export_of(file: Column, pattern: str = EXPORT_DAY) -> Column:
    """The export that a landing file belongs to: the last folder in its path that names a day.

    NULL where no folder does."""
    found = F.regexp_extract_all(file, F.lit(pattern), F.lit(1))
    return F.when(F.size(found) > 0, F.element_at(found, -1))


def incremental_ingest(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    export_pattern: str = EXPORT_DAY,
) -> StreamingQuery:
    """Process files that no earlier run has processed, then stop.

    Each row is landed under the export that its file belongs to (a day in the file's path), so that
    the daily jobs find it by that day: ``export_pattern`` says where the path names it.

    The checkpoint must be in a folder that outlives the run. There is no state and no watermark.
    A batch may be repeated after a failure; it then replaces its own partitions of the table. Their
    names hold the stream's id, which lives in the checkpoint: several streams may write to one table,
    and a new checkpoint is a new stream.
    """
    reader = spark.readStream.schema(RAW_SCHEMA).options(**RAW_OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def write(batch: DataFrame, batch_id: int) -> None:
        noted = batch.sparkSession.read.text(f"{checkpoint.rstrip('/')}/metadata").first()
        stream_id = json.loads(noted.value)["id"]
        name = f"stream-{stream_id}-batch-{batch_id:09d}"
        tables.append_batch(transform_tickets(batch, keep=["export"]), table, name)

    rows = reader.csv(landing).select("*", export_of(F.col("_metadata.file_path"), export_pattern).alias("export"))
    stream = rows.writeStream.foreachBatch(write)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
