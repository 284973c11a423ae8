"""Tickets made from the shared test tables, for queries and tests.

One ticket per document: the text is the comment, the events dealt to it give the times and the
state, and the id decides which fields are blank, missing or malformed. Nothing here is used by the jobs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plaint.functions import vector
from plaint.operators.transform import transform_tickets
from plaint.schemas import COMPONENTS, RAW_COLUMNS
from plaint.session import pin, scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: Column) -> Column:
    return column.cast("string")


def _photo_url(number: Column) -> Column:
    return F.concat(F.lit("http://img.example.com/"), _text(number), F.lit(".jpg"))


# Derived files and tables are written once per session and scale factor.
_WRITTEN: dict[tuple[str, str, str], str] = {}


def written_once(
    spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]
) -> str:
    """The folder that ``write`` filled on the first call."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        path = scratch_dir(spark, name)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 16 text columns of the export, and ``doc_id`` as the key of a test row.

    Not a table: a query reads the columns that it uses. Texts are shuffled once, and only where they
    meet times or states; they are neither sorted nor copied for that, since the narrow side is hashed.
    """
    documents = table(spark, sf_dir, "documents")
    # Every event belongs to a ticket: they are dealt out over the documents, whose ids count from 0.
    count = documents.agg(F.greatest(F.count(F.lit(1)), F.lit(1))).scalar()
    dealt = table(spark, sf_dir, "events").withColumn("doc_id", F.pmod("event_id", count))
    first = F.min_by(F.struct("ts", "event_type", "user_id"), "event_id").alias("first")
    histories = dealt.groupBy("doc_id").agg(first, F.max("ts").alias("touched"))
    histories = histories.select("doc_id", F.col("first.ts").alias("opened"), "first.event_type", "first.user_id", "touched")
    n = F.col("doc_id")
    columns = {
        "ticket_id": F.when(n % 97 == 13, F.lit(""))
        .when(n % 101 == 7, F.lit(None))
        .otherwise(F.concat(F.lit("T"), F.lpad(_text(n), 7, "0"))),
        "type": F.col("source"),
        "organization": F.concat(F.lit("Org-"), F.col("lang")),
        "comment": F.col("text"),
        "photo": F.when(n % 5 == 0, F.lit(""))
        .when(n % 7 == 0, F.lit(None))
        .otherwise(_photo_url(n)),
        "photo_after": F.lit(None).cast("string"),
        "coords": F.when(n % 89 == 3, F.lit("100.5"))
        .when(n % 83 == 5, F.lit("n/a,13.7"))
        .when(n % 79 == 11, F.lit(None))
        .otherwise(
            F.concat(
                F.lit("100."), _text(300 + n % 601), F.lit(",13."), _text(500 + (n * 7) % 401)
            )
        ),
        "address": F.concat(F.lit("Addr "), _text(n)),
        "subdistrict": F.concat(F.lit("S"), _text(n % 180)),
        "district": F.concat(F.lit("D"), _text(n % 50)),
        "province": F.lit("Bangkok"),
        "timestamp": F.concat(_text(F.col("opened")), F.lit("+00")),
        "state": F.col("event_type"),
        "star": F.when(n % 6 == 0, F.lit(None)).otherwise(_text(n % 6)),
        "count_reopen": _text(F.col("user_id") % 3),
        "last_activity": F.concat(_text(F.col("touched")), F.lit("+00")),
    }
    joined = documents.join(histories.hint("shuffle_hash"), "doc_id", "left")
    return joined.select(*[columns[name].alias(name) for name in RAW_COLUMNS], "doc_id")


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed and cleaned tickets, with ``doc_id``."""
    return transform_tickets(raw_tickets(spark, sf_dir), keep=["doc_id"])


def given_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, vector, cluster``: the given embeddings, and their label counted from 1."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
        (F.col("label") + 1).cast("string").alias("cluster"),
    )


def ticket_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets that have a given embedding, with it and its cluster."""
    given = given_vectors(spark, sf_dir).hint("shuffle_hash")
    return tickets(spark, sf_dir).join(given, "doc_id")


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tickets with the given cluster; NULL where there is no embedding."""
    given = given_vectors(spark, sf_dir).select("doc_id", "cluster")
    return tickets(spark, sf_dir).join(given, "doc_id", "left")


def label_means(spark: SparkSession, sf_dir: str) -> tuple[list[str], np.ndarray]:
    """Given centers: per label, the mean of its vectors. One row per label reaches the driver."""
    means = (
        given_vectors(spark, sf_dir)
        .groupBy(F.col("cluster").cast("int").alias("label"))
        .agg(Summarizer.mean(array_to_vector("vector")).alias("mean"))
        .select("label", vector_to_array("mean").alias("mean"))
        .orderBy("label")
        .collect()
    )
    return [str(row.label) for row in means], np.array([row.mean for row in means])


def given_components(spark: SparkSession, sf_dir: str) -> np.ndarray:
    """Given components: the means of the first three labels, each of length 1."""
    _, means = label_means(spark, sf_dir)
    return means[:3] / np.linalg.norm(means[:3], axis=1, keepdims=True)


def photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url, content``: a page stands for the photo of the ticket with its number."""
    return table(spark, sf_dir, "pages").select(
        _photo_url(F.col("page_id")).alias("url"), F.encode("html", "UTF-8").alias("content")
    )


def clustered_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tickets with given cluster and scores on the given components."""
    scored = given_vectors(spark, sf_dir).withColumn(
        "scores", vector.project("vector", given_components(spark, sf_dir))
    )
    components = [F.get("scores", i).alias(name) for i, name in enumerate(COMPONENTS)]
    return tickets(spark, sf_dir).join(
        scored.select("doc_id", "cluster", *components), "doc_id", "left"
    )


def news_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, html``: a page per document with the news list, by turns flat, nested, with items
    that are not closed, and with elements that are not closed."""
    n = F.col("doc_id")
    body = F.coalesce("text", F.lit(""))
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        body = F.replace(body, F.lit(sign), F.lit(name))
    lists = {
        0: "<li><h4>N{n}</h4><p>{d}</p></li><li><h4> N{n} <i>b</i></h4></li><li><span>x</span></li>",
        1: "<li><h4>N{n}</h4><ul><li><h4>in</h4><p>{d}</p></li></ul><p>after</p></li><li><p>last</p></li>",
        2: "<li><h4>N{n}</h4><p>{d}</p><li><h4>next<li><p>end<b> bold</b></ul><li><h4>out</h4></li>",
        3: "<li><h4>N{n}<br><p>{d}</ul></p>",
    }

    def page(items: str) -> Column:
        menu = '<html><ul id="menu"><li><h4>menu</h4></ul><div><UL class=a id="latest_traffic_list">'
        numbered = F.replace(F.lit(f"{menu}{items}</ul></div></html>"), F.lit("{n}"), _text(n))
        return F.replace(numbered, F.lit("{d}"), body)

    turn = F.pmod(n, F.lit(4))
    html = F.coalesce(*[F.when(turn == k, page(items)) for k, items in lists.items()])
    return table(spark, sf_dir, "documents").select(n.alias("page_id"), html.alias("html"))
