"""The daily jobs. An outside scheduler calls them; each may be repeated for the same day."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaint.operators import embed, models
from plaint.operators.filters import has_value, not_blank_keep_null
from plaint.operators.topn import cap_rows
from plaint.operators.transform import transform_tickets
from plaint.schemas import TICKET_COLUMNS
from plaint.session import scratch_dir
from plaint.sources import exports, tables
from plaint.sources.photos import fetch_photos


def daily_ingest(spark: SparkSession, root: str, table: str, ds: str, replace: bool = True) -> int:
    """One day's raw export, typed and cleaned, into the ticket table; the rows written."""
    raw = exports.read_day(spark, root, ds)
    return tables.append_tickets(transform_tickets(raw), table, landed=ds, replace=replace)


def daily_export(spark: SparkSession, root: str, ds: str) -> str:
    """One day's raw export, typed and cleaned, as CSV in the day's folder; its path."""
    path = exports.processed_path(root, ds)
    exports.export_csv(transform_tickets(exports.read_day(spark, root, ds)), path)
    return path


@dataclass
class Vectorized:
    """What a vector job did: rows it took, rows it wrote, and the rows it rejected."""

    fetched: int
    written: int
    rejects: DataFrame | None


def _staged(rows: DataFrame, purpose: str, by: Sequence[str] = ()) -> tuple[DataFrame, str]:
    """Rows as a table in the shared folder, with a folder per value of ``by``, and where it is."""
    path = scratch_dir(rows.sparkSession, purpose)
    rows.write.options(**tables.COMPRESSED).partitionBy(*by).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), path


def _vectorize(
    todo: DataFrame,
    photos: DataFrame | None,
    fetcher: Callable[[str], bytes] | None,
    table: str,
    landed: str,
    capped: bool = False,
    **options,
) -> Vectorized:
    """Vectors of ``todo`` into the table, in place of what an earlier run of ``landed`` wrote.

    Tickets that other partitions of the table hold are left out first; only for the others photos
    are fetched or embedded. What is left to do is staged in the shared folder where it took more than
    a scan (``capped``: an order), and photos and results always are: a lost executor does not run the
    models or the downloads a second time. Tickets whose photo the table does not list are not shuffled. Rejects stay there as a table; the other staged copies go.
    With no vector, a first run writes nothing and a repeated one empties its partition.
    """
    if photos is None and fetcher is None:
        raise ValueError("give a photo table or a fetcher")
    spark = todo.sparkSession
    left, done_with = tables.not_in_table(todo, table, landed), []
    if capped or left is not todo:
        left, left_at = _staged(left, "todo")
        done_with.append(left_at)
    todo, others = left, None
    if photos is None:
        photos, photos_at = _staged(fetch_photos(todo, fetcher), "photos")
        done_with.append(photos_at)
    else:
        # A fetcher was asked for all urls of the tickets; a photo table may lack most of them.
        todo, others = embed.split_by_photo(todo, photos)
    found = embed.vectorize_tickets(todo, photos, **options)
    if others is not None:
        found = found.unionByName(embed.without_vector(others))
    found = found.withColumn("accepted", F.col("reject_reason").isNull())
    staged, staged_at = _staged(found, "vectors", ["accepted"])
    counts = staged.agg(
        F.count(F.lit(1)).alias("fetched"), F.count_if("accepted").alias("accepted")
    ).first()
    # The folder of the accepted rows goes, that of the others is the table of rejects.
    rejects = staged.filter(~F.col("accepted")).drop("vector", "accepted") if counts.fetched else None
    done_with.append(f"{staged_at}/accepted=true" if counts.fetched else staged_at)
    written = 0
    if counts.accepted or tables.exists(spark, tables.landed_folder(table, landed)):
        written = tables.append_vectors(staged.filter("accepted"), table, landed)
    for path in done_with:
        tables.remove(spark, path)
    return Vectorized(counts.fetched, written, rejects)


def daily_vectorize(
    spark: SparkSession,
    tickets: str,
    photos: DataFrame | None,
    table: str,
    ds: str,
    max_rows: int | None = None,
    by_date: bool = False,
    fetcher: Callable[[str], bytes] | None = None,
    **options,
) -> Vectorized:
    """Vectors of the tickets that one day's export brought and that have an id and a photo.

    An export holds tickets of two UTC dates; ``by_date`` takes those of the date instead, from
    any export. ``max_rows`` takes only the first rows by time and id; by default all are taken.
    Tickets of the export that came through a stream are among them. Without a photo table,
    ``fetcher`` gets the photos. Further options go to ``vectorize_tickets``.
    """
    read = tables.read_tickets if by_date else tables.read_landed
    todo = cap_rows(has_value(read(spark, tickets, ds), ["photo", "ticket_id"]), max_rows)
    return _vectorize(todo, photos, fetcher, table, ds, capped=max_rows is not None, **options)


def backfill_vectors(
    spark: SparkSession,
    tickets: str,
    photos: DataFrame | None,
    table: str,
    since: str,
    fetcher: Callable[[str], bytes] | None = None,
    **options,
) -> Vectorized:
    """Vectors of all tickets from an instant on that the table does not hold yet.

    Only '' drops out before the models; a NULL id or photo is rejected there with its reason.
    """
    todo = not_blank_keep_null(
        tables.read_tickets_since(spark, tickets, since), ["photo", "ticket_id"]
    )
    todo = todo.select(*TICKET_COLUMNS)
    # The whole instant, in UTC: backfills from two instants are two runs.
    start = F.date_format(F.lit(since).cast("timestamp"), "yyyyMMdd'T'HHmmss.SSSSSS")
    landed = f"backfill-{spark.range(1).select(start).first()[0]}"
    return _vectorize(todo, photos, fetcher, table, landed, **options)


def refresh_clusters(
    spark: SparkSession,
    vectors: str,
    published: str,
    version: str,
    view: str = "tickets_clustered",
    model_root: str | None = None,
    k: int = models.CLUSTERS,
) -> DataFrame:
    """Fit both models on all vectors, and publish tickets with cluster and components.

    Predictions are made once, when the table is written, and not by every reader.
    """
    rows = tables.read_vectors(spark, vectors)
    # Each fit passes over its input several times: ids and vectors are read and decoded once.
    narrow = rows.select("ticket_id", "vector").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        scaler = models.fit_scaler(narrow)
        kmeans = models.fit_kmeans(narrow, k, scaler=scaler)
        pca = models.fit_pca(narrow, scaler=scaler)
    finally:
        narrow.unpersist()
    if model_root:
        models.save_model(kmeans, f"{model_root}/kmeans")
        models.save_model(pca, f"{model_root}/pca")
    done = models.predict(rows, kmeans, pca)
    return tables.publish_clustered(done, published, version, view)
