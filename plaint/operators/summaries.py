"""A short text per cluster."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaint.functions import text
from plaint.functions import vector as functions
from plaint.operators.aggregates import INSTRUCTION, cluster_means, cluster_prompt, cluster_samples

# Fixed value: what is shown when no summary could be made.
NO_SUMMARY = "Summary not available"

Summarizer = Callable[[str], str]


def central_comments(
    df: DataFrame, key: str = "cluster", vector: str = "vector", identity: str = "ticket_id"
) -> DataFrame:
    """``cluster, summary``: the comment whose vector is closest to the mean of its cluster.

    Means and minima are combined before the shuffle. Distances are compared to 9 decimals, and
    the id decides between equal ones, rows without an id last.
    """
    means = cluster_means(df, key, vector)
    rows = df.filter(F.col(vector).isNotNull()).select(key, identity, "comment", vector)
    distance = functions.distance(vector, "mean")
    ranked = rows.join(means, key).select(
        key,
        text.or_blank("comment").alias("comment"),
        F.struct(
            F.round(distance, 9).alias("distance"), F.col(identity).isNull().alias("unnamed"), identity
        ).alias("rank"),
    )
    return ranked.groupBy(key).agg(F.min_by("comment", "rank").alias("summary"))


def summarize_prompts(prompts: DataFrame, summarizer: Summarizer) -> DataFrame:
    """Replace ``prompt`` by ``summary``, one call per row; a fixed text when a call fails."""

    @F.pandas_udf("string")
    def summarize(batch: pd.Series) -> pd.Series:
        return batch.map(one)

    def one(prompt: str) -> str:
        try:
            return str(summarizer(prompt)).strip()
        except Exception:  # foreign code: any failure gives the fixed text
            return NO_SUMMARY

    # Each call is paid for: a filter on the result must not repeat it.
    called = summarize.asNondeterministic()
    return prompts.withColumn("summary", called("prompt")).drop("prompt")


def summarize_clusters(
    df: DataFrame,
    summarizer: Summarizer | None = None,
    n: int = 10,
    key: str = "cluster",
    identity: tuple[str, ...] = ("ticket_id",),
    instruction: str = INSTRUCTION,
) -> DataFrame:
    """``cluster, summary``. Without a callable, the central comment of the cluster.

    With one, it gets the prompt of n sampled comments, one call per cluster, in tasks. When it
    raises, the summary is a fixed text.
    """
    if summarizer is None:
        return central_comments(df, key)
    samples = cluster_samples(df, n, key, identity=identity)
    prompts = cluster_prompt(samples, instruction)
    return summarize_prompts(prompts, summarizer).select(key, "summary")
