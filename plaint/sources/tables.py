"""Parquet tables of tickets and vectors.

A table has two partition levels: ``landed``, the export or batch that brought the rows, and
``day``, the UTC date of the ticket. A day's export holds tickets of two UTC dates (its own zone
is ahead of UTC), so one level could not serve both: ``landed`` is what a repeated run replaces,
and ``day`` is what a read by date prunes.

Beside them, ``_days/day=<date>/<landed>`` are empty files, made after each append: which exports
have rows of a date. A read by date lists these and opens only the folders that they name, however
many exports the table has. Readers of the whole table do not see them.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaint.functions import typing
from plaint.operators.filters import Day, as_date, on_day, since
from plaint.schemas import TICKET_SCHEMA, VECTOR_SCHEMA

PARTITIONS = ["landed", "day"]
DAYS = "_days"
# Spark's name of the folder of rows without a date.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
# Beyond so many dates, all folders are listed by Spark, in parallel, and not those of the notes one by one.
MANY_DAYS = 100
# Rows of a vector table up to which their hashes are broadcast to the tickets (about 20 MB).
BROADCAST_HELD = 250_000
# Texts take about half the room of the default codec.
COMPRESSED = {"compression": "zstd"}
# Between an export and the batch of a stream that read some of its files.
STREAMED = ".stream-"


def _with_partitions(schema: T.StructType) -> T.StructType:
    """The schema with its partition columns: known types, and no file is opened to infer them."""
    return T.StructType(
        [
            *schema.fields,
            T.StructField("landed", T.StringType()),
            T.StructField("day", T.DateType()),
        ]
    )


def _dated(df: DataFrame, counted: Observation, *also: str) -> DataFrame:
    """Rows with their day, dealt for writing and counted on the way.

    REBALANCE gives files of an even size: small shuffle partitions are merged, and a day that
    holds most of the rows is split over several tasks.
    """
    rows = df.withColumn("day", typing.day("timestamp")).hint("rebalance", *also, "day")
    return rows.observe(counted, F.count(F.lit(1)).alias("rows"))


def _append(df: DataFrame, path: str, landed: str, replace: bool) -> int:
    """Write rows under ``landed`` and return how many, counted during the write."""
    counted = Observation()
    writer = _dated(df, counted).write.mode("overwrite" if replace else "append").options(**COMPRESSED)
    writer.partitionBy("day").parquet(landed_folder(path, landed))
    _note_days(df.sparkSession, path, [landed])
    return counted.get["rows"]


def _folder(spark: SparkSession, path: str):
    """A folder and its file system, whatever store it is in."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, system = _folder(spark, path)
    return system.exists(folder)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder that a job staged itself; whether it was there."""
    folder, system = _folder(spark, path)
    return system.delete(folder, True)


def _names(spark: SparkSession, path: str, pattern: str = "*") -> list[str]:
    """Names in a folder; none when it is not there. Only this one folder is listed."""
    folder, system = _folder(spark, path)
    found = system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, pattern))
    return sorted(status.getPath().getName() for status in found or [])


def landed_folder(path: str, landed: str) -> str:
    return f"{path.rstrip('/')}/landed={landed}"


def _note_days(spark: SparkSession, path: str, exports: Iterable[str]) -> None:
    """Note the dates of which these exports have rows. A note that is there stays as it is."""
    for landed in exports:
        for day in _names(spark, landed_folder(path, landed), "day=*"):
            note, system = _folder(spark, f"{path.rstrip('/')}/{DAYS}/{day}/{landed}")
            if not system.exists(note):
                system.create(note, True).close()


def _noted_days(spark: SparkSession, path: str) -> list[dt.date | None]:
    """The dates of which a table has rows, or had them before a run was repeated."""
    names = [name.removeprefix("day=") for name in _names(spark, f"{path.rstrip('/')}/{DAYS}", "day=*")]
    return [None if name == NO_DAY else dt.date.fromisoformat(name) for name in names]


def read_folders(spark: SparkSession, path: str, folders: list[str], schema: T.StructType) -> DataFrame:
    """Some folders of a table, with its partition columns; only these are listed."""
    whole = _with_partitions(schema)
    if not folders:
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).option("basePath", path).parquet(*folders)


def read_days(
    spark: SparkSession,
    path: str,
    days: Iterable[dt.date | None],
    schema: T.StructType = TICKET_SCHEMA,
    holds: Callable[[str], bool] = lambda landed: True,
) -> DataFrame:
    """Rows of some UTC dates (None: without a date), from the exports that ``holds`` takes.

    The notes name the folders. For very many dates, and without notes, the whole table is listed and
    its partitions are filtered.
    """
    wanted = list(days)
    if len(wanted) > MANY_DAYS or not exists(spark, f"{path.rstrip('/')}/{DAYS}"):
        table = read_table(spark, path, schema)
        known = F.col("day").isin([day for day in wanted if day is not None])
        asked = known | F.col("day").isNull() if None in wanted else known
        others = [name.removeprefix("landed=") for name in _names(spark, path, "landed=*")]
        return table.filter(asked & ~F.col("landed").isin([name for name in others if not holds(name)]))
    folders = []
    for day in wanted:
        name = f"day={day.isoformat() if day else NO_DAY}"
        noted = [landed for landed in _names(spark, f"{path.rstrip('/')}/{DAYS}/{name}") if holds(landed)]
        folders.extend(f"{landed_folder(path, landed)}/{name}" for landed in noted)
    return read_folders(spark, path, [folder for folder in folders if exists(spark, folder)], schema)


def append_tickets(df: DataFrame, path: str, landed: str, replace: bool = True) -> int:
    """Add tickets to the table; the rows written.

    With ``replace`` a repeated run of the same day leaves the table as one run does. Without it,
    rows are added as they are.
    """
    return _append(df.select(*TICKET_SCHEMA.fieldNames()), path, landed, replace)


def append_vectors(df: DataFrame, path: str, landed: str, replace: bool = True) -> int:
    """Add tickets with vectors to the vector table; the rows written."""
    return _append(df.select(*VECTOR_SCHEMA.fieldNames()), path, landed, replace)


def read_table(spark: SparkSession, path: str, schema: T.StructType = TICKET_SCHEMA) -> DataFrame:
    """The whole table, with its partition columns."""
    return spark.read.schema(_with_partitions(schema)).parquet(path)


def append_batch(df: DataFrame, path: str, batch: str) -> None:
    """Add a stream's batch of tickets, each row under the export in its column ``export``.

    A row goes to ``landed=<export>.<batch>``, and a repeated batch replaces just these folders. Rows
    whose export is not known go to ``landed=<batch>``.
    """
    spark = df.sparkSession
    landed = F.concat_ws(".", "export", F.lit(batch)).alias("landed")
    rows = _dated(df.select(*TICKET_SCHEMA.fieldNames(), landed), Observation(), "landed")
    writer = rows.write.mode("overwrite").options(partitionOverwriteMode="dynamic", **COMPRESSED)
    writer.partitionBy(*PARTITIONS).parquet(path)
    names = [*_names(spark, path, f"landed={batch}"), *_names(spark, path, f"landed=*.{batch}")]
    _note_days(spark, path, [name.removeprefix("landed=") for name in names])


def read_tickets(spark: SparkSession, path: str, ds: Day) -> DataFrame:
    """Tickets of one UTC date, from whichever export: the folders of other days are not listed."""
    table = read_days(spark, path, [as_date(ds)]).filter(F.col("day") == F.lit(as_date(ds)))
    return on_day(table, ds).drop(*PARTITIONS)


def read_landed(spark: SparkSession, path: str, landed: str) -> DataFrame:
    """Tickets that one export brought, of any date, at once or through a stream.

    Only the folder of the export and those of its streamed batches are listed and read."""
    names = [*_names(spark, path, f"landed={landed}"), *_names(spark, path, f"landed={landed}{STREAMED}*")]
    folders = [f"{path.rstrip('/')}/{name}" for name in names]
    return read_folders(spark, path, folders, TICKET_SCHEMA).drop(*PARTITIONS)


def not_in_table(todo: DataFrame, path: str, landed: str) -> DataFrame:
    """Rows of ``todo`` that no other export's partition of a vector table holds already.

    A row is known by all its ticket columns, so rows of other dates cannot hold it: only the dates of
    ``todo`` are read. Rows under ``landed`` itself do not count, since this run replaces them; ids repeat
    as they are. Held rows are narrow hashes. Up to ``BROADCAST_HELD`` of them go to where the tickets are
    read, and no ticket is shuffled; with none, ``todo`` itself is returned.
    """
    spark = todo.sparkSession
    if not exists(spark, path):
        return todo
    names = TICKET_SCHEMA.fieldNames()
    # One row per date.
    days = [row.day for row in todo.select(typing.day("timestamp").alias("day")).distinct().collect()]
    held = read_days(spark, path, days, VECTOR_SCHEMA, holds=lambda other: other != landed)
    rows = held.limit(BROADCAST_HELD + 1).count()
    if not rows:
        return todo
    key = F.struct(F.xxhash64(*names).alias("a"), F.hash(*names).alias("b"))
    held = held.select(key.alias("_row")).distinct()
    if rows <= BROADCAST_HELD:
        held = F.broadcast(held)
    return todo.withColumn("_row", key).join(held, "_row", "left_anti").drop("_row")


def read_tickets_since(spark: SparkSession, path: str, start: str) -> DataFrame:
    """Tickets from an instant on: earlier days are not listed."""
    first = F.to_date(F.lit(start).cast("timestamp"))
    if exists(spark, f"{path.rstrip('/')}/{DAYS}"):
        earliest = spark.range(1).select(first.alias("day")).first().day
        table = read_days(spark, path, [d for d in _noted_days(spark, path) if d and d >= earliest])
    else:
        table = read_table(spark, path)
    return since(table.filter(F.col("day") >= first), start).drop(*PARTITIONS)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """All tickets with vectors."""
    return read_table(spark, path, VECTOR_SCHEMA).drop(*PARTITIONS)


def publish_clustered(df: DataFrame, path: str, version: str, view: str) -> DataFrame:
    """Write a clustered table to a folder of its own, then note it as the current one.

    The note is a row in ``published``, added when the table is complete; nothing is overwritten,
    so a reader of an older run, of the same version too, reads on. ``read_clustered`` follows the
    notes in any session; ``view`` is for this one. Old runs stay until their owner clears them.
    """
    spark = df.sparkSession
    run = uuid.uuid4().hex
    target = f"{path.rstrip('/')}/version={version}/run={run}"
    df.write.parquet(target)
    note = spark.range(1).select(
        F.unix_micros(F.current_timestamp()).alias("at"),
        F.lit(version).alias("version"),
        F.lit(run).alias("run"),
        F.lit(df.schema.json()).alias("fields"),
    )
    note.coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/published")
    published = spark.read.schema(df.schema).parquet(target)
    published.createOrReplaceTempView(view)
    return published


def read_clustered(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The clustered table published last, of one version or of any."""
    notes = spark.read.schema("at long, version string, run string, fields string")
    notes = notes.json(f"{path.rstrip('/')}/published")
    if version is not None:
        notes = notes.filter(F.col("version") == version)
    last = notes.orderBy(F.desc("at"), "run").limit(1).first()
    if last is None:
        raise ValueError(f"nothing is published under {path}")
    schema = T.StructType.fromJson(json.loads(last.fields))
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/version={last.version}/run={last.run}")
