"""The jobs from a command line: ``spark-submit --py-files plaint.zip plaint/__main__.py JOB ...``."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from plaint.plans import jobs, reports
from plaint.schemas import PHOTO_SCHEMA
from plaint.session import configure, pin
from plaint.sources import pages, tables
from plaint.streaming.ingest import EXPORT_DAY, incremental_ingest


def named(reference: str | None) -> Callable | None:
    """The object that ``module:name`` stands for."""
    if reference is None:
        return None
    module, name = reference.split(":")
    return getattr(importlib.import_module(module), name)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="plaint")
    add = top.add_subparsers(dest="job", required=True).add_parser

    ingest = add("ingest", help="one day's raw export into the ticket table")
    export = add("export", help="one day's raw export as cleaned CSV")
    for job in (ingest, export):
        job.add_argument("--root", required=True, help="folder with raw/ and processed/")
        job.add_argument("--ds", required=True, help="day, YYYY-MM-DD")
    ingest.add_argument("--table", required=True)
    ingest.add_argument("--append", action="store_true", help="add to the day instead of replacing")

    stream = add("stream", help="new landing files into the ticket table, then stop")
    stream.add_argument("--landing", required=True)
    stream.add_argument("--table", required=True)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--files-per-batch", type=int)
    stream.add_argument("--export-pattern", default=EXPORT_DAY, help="where a file's path names its export")

    vectorize = add("vectorize", help="vectors of one day's tickets")
    backfill = add("backfill", help="vectors of all tickets from an instant on")
    vectorize.add_argument("--ds", required=True)
    vectorize.add_argument("--max-rows", type=int)
    vectorize.add_argument("--by-date", action="store_true", help="the date's tickets instead of the export's")
    backfill.add_argument("--since", required=True)
    for job in (vectorize, backfill):
        job.add_argument("--tickets", required=True, help="ticket table")
        job.add_argument("--photos", help="Parquet table of url and content")
        job.add_argument("--fetcher", help="module:name that maps a url to its bytes; instead of --photos")
        job.add_argument("--table", required=True, help="vector table")
        job.add_argument("--text-factory", help="module:name that returns a text embedder")
        job.add_argument("--image-factory", help="module:name that returns a photo embedder")
        job.add_argument("--batch-size", type=int, default=128)
        job.add_argument("--parallelism", type=int)

    refresh = add("refresh", help="fit both models and publish the clustered table")
    refresh.add_argument("--vectors", required=True)
    refresh.add_argument("--published", required=True)
    refresh.add_argument("--version", required=True)
    refresh.add_argument("--models")
    refresh.add_argument("--clusters", type=int, default=8)
    reported = add("report", help="the tables of both report pages from the published table")
    reported.add_argument("--published", required=True)
    reported.add_argument("--out", required=True, help="a new folder")
    reported.add_argument("--version", help="the last one by default")
    reported.add_argument("--clusters", type=int, nargs="*", default=[])
    reported.add_argument("--summarizer", help="module:name that maps a prompt to a text")
    reported.add_argument("--rank-error", type=float, help="sketch the center, off by this share of the rows")
    news = add("news", help="traffic news of saved pages")
    news.add_argument("--pages", required=True, help="HTML files")
    news.add_argument("--out", required=True, help="a new folder")
    return top


def report(spark: SparkSession, given: argparse.Namespace) -> str:
    """Write each part of the cluster page and of the map page as a Parquet table."""
    dashboard = reports.load_dashboard(tables.read_clustered(spark, given.published, given.version))
    parts_of = {
        "cluster": reports.cluster_report(dashboard, named(given.summarizer)),
        "map": reports.map_report(dashboard, given.clusters, rank_error=given.rank_error),
    }
    for page, parts in parts_of.items():
        for name, part in vars(parts).items():
            part.write.parquet(f"{given.out.rstrip('/')}/{page}_{name}")
    dashboard.unpersist()
    return f"reports written to {given.out}"


def run(spark: SparkSession, arguments: Sequence[str] | None = None) -> str:
    """Run the job and return one line about it."""
    given = parser().parse_args(arguments)
    pin(spark)
    if given.job == "ingest":
        rows = jobs.daily_ingest(spark, given.root, given.table, given.ds, not given.append)
        return f"{rows} tickets written"
    if given.job == "export":
        return f"written to {jobs.daily_export(spark, given.root, given.ds)}"
    if given.job == "stream":
        query = incremental_ingest(
            spark, given.landing, given.table, given.checkpoint, given.files_per_batch, given.export_pattern
        )
        query.awaitTermination()
        return "all landed files processed"
    if given.job == "refresh":
        jobs.refresh_clusters(
            spark,
            given.vectors,
            given.published,
            given.version,
            model_root=given.models,
            k=given.clusters,
        )
        return f"version {given.version} published"
    if given.job == "report":
        return report(spark, given)
    if given.job == "news":
        saved = pages.read_pages(spark, given.pages)
        reports.traffic_items(saved, key="page").write.parquet(given.out)
        return f"news written to {given.out}"
    photos = spark.read.schema(PHOTO_SCHEMA).parquet(given.photos) if given.photos else None
    options = {
        "fetcher": named(given.fetcher),
        "text_factory": named(given.text_factory),
        "image_factory": named(given.image_factory),
        "batch_size": given.batch_size,
        "parallelism": given.parallelism,
    }
    if given.job == "vectorize":
        done = jobs.daily_vectorize(
            spark, given.tickets, photos, given.table, given.ds, given.max_rows, given.by_date, **options
        )
    else:
        done = jobs.backfill_vectors(
            spark, given.tickets, photos, given.table, given.since, **options
        )
    return f"{done.fetched} tickets taken, {done.written} vectors written"


if __name__ == "__main__":
    session = configure(SparkSession.builder.appName("plaint")).getOrCreate()
    print(run(session))
    session.stop()
