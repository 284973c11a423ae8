"""Photos as ``url, content`` rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaint.operators.filters import present
from plaint.schemas import PHOTO_SCHEMA

HELD = 64  # photos that a task holds while it fetches


def read_photos(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """Downloaded photo files. Their url is ``prefix`` followed by the file name."""
    files = spark.read.format("binaryFile").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(F.concat(F.lit(prefix), name).alias("url"), "content")


def fetch_photos(
    tickets: DataFrame,
    fetcher: Callable[[str], bytes],
    url: str = "photo",
    threads: int = 16,
    parallelism: int | None = None,
) -> DataFrame:
    """Photos through a callable, once per distinct url; a failed one has empty content."""
    urls = tickets.filter(present(url)).select(F.col(url).alias("url")).distinct()
    if parallelism:
        urls = urls.repartition(parallelism)

    def one(address: str) -> bytes:
        try:
            return bytes(fetcher(address))
        except Exception:  # foreign code: any failure means that there is no photo
            return b""

    def fetch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for frame in frames:
                # A batch holds thousands of urls; only some photos are in memory at a time.
                for start in range(0, len(frame), HELD):
                    few = frame["url"].iloc[start : start + HELD]
                    yield pd.DataFrame({"url": few, "content": list(pool.map(one, few))})

    return urls.mapInPandas(fetch, PHOTO_SCHEMA)
