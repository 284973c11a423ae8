"""Vectors of text and photos, through a callable that the user supplies.

A factory is called once per task and returns the embedder, so a model is loaded once and not
per row. The embedder maps a list of values (``str`` or ``bytes``) to as many vectors. When a
batch fails, its values are tried one by one, and only those that fail are rejected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaint.functions import text as texts
from plaint.functions import vector
from plaint.operators.filters import NO_BYTES, NO_ID, NO_URL, embed_guard, present
from plaint.operators.joins import left_join

Embedder = Callable[[list], Sequence]
Factory = Callable[[], Embedder]

TEXT_WIDTH = 64
PHOTO_WIDTH = 64
BATCH = 128  # values per call of an embedder
CHARS = 1_000_000  # characters whose trigrams are counted at once (about 60 bytes each)
# Distinct urls of tickets up to which their hashes are broadcast (8 MB of hashes).
BROADCAST_URLS = 1_000_000

_RESULT = "struct<vector: array<double>, error: string>"


def _unit_rows(owner: np.ndarray, slots: np.ndarray, rows: int, width: int) -> np.ndarray:
    """Counts per row and slot, each row of length 1; a row without any stays zero."""
    counts = np.bincount(owner * width + slots, minlength=rows * width).reshape(rows, width)
    lengths = np.sqrt((counts * counts).sum(axis=1, keepdims=True, dtype=np.float64))
    return counts / np.where(lengths > 0, lengths, 1)


def trigram_embedder(width: int = TEXT_WIDTH) -> Factory:
    """Counts of hashed character trigrams of the whole text (with a space at each end), for all
    texts of a call at once, or of half a call where texts are long."""

    def embed(values: list[str]) -> np.ndarray:
        if len(values) > 1 and sum(map(len, values)) > CHARS:
            half = len(values) // 2
            return np.concatenate([embed(values[:half]), embed(values[half:])])
        joined = "".join(f" {value} " for value in values)
        code = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        slots = (code[:-2] * 961 + code[1:-1] * 31 + code[2:]) % width
        # A text of n characters has n + 2 with its spaces, and n trigrams.
        sizes = np.array([len(value) for value in values], np.int64)
        starts = np.cumsum(sizes + 2) - (sizes + 2)
        owner = np.repeat(np.arange(len(values)), sizes)
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[owner]
        return _unit_rows(owner, slots[place], len(values), width)

    return lambda: embed


def histogram_embedder(width: int = PHOTO_WIDTH) -> Factory:
    """Counts of the byte values of the whole photo, in equal ranges."""

    def embed(values: list[bytes]) -> np.ndarray:
        table = np.arange(256, dtype=np.int64) * width // 256
        # One photo at a time: photos are long, and a call's together may be too much.
        counts = np.stack([np.bincount(np.frombuffer(v, np.uint8), minlength=256) for v in values])
        owner = np.repeat(np.arange(len(values)), 256)
        rows = np.zeros((len(values), width))
        np.add.at(rows, (owner, np.tile(table, len(values))), counts.ravel())
        lengths = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
        return rows / np.where(lengths > 0, lengths, 1)

    return lambda: embed


def _embed_values(
    embedder: Embedder, values: list
) -> list[tuple[np.ndarray | None, str | None]]:
    try:
        vectors = [np.asarray(v, dtype=np.float64).ravel() for v in embedder(values)]
        if len(vectors) != len(values):
            raise ValueError(f"{len(vectors)} vectors for {len(values)} values")
        return [(v, None) for v in vectors]
    except Exception as error:  # the embedder is foreign code: any failure rejects its input
        if len(values) == 1:
            return [(None, f"embedding failed: {error}")]
        return [_embed_values(embedder, [value])[0] for value in values]


def _list_array(vectors: list[np.ndarray | None]) -> pa.Array:
    """Arrow lists from one flat buffer; a batch of wide vectors as Python floats would be huge."""
    found = [v for v in vectors if v is not None]
    ends = np.cumsum([0 if v is None else len(v) for v in vectors])
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], ends)), pa.int32()),
        pa.array(np.concatenate(found) if found else np.empty(0), pa.float64()),
        mask=pa.array([v is None for v in vectors], pa.bool_()),
    )


def embed(
    df: DataFrame, column: str, output: str, factory: Factory, batch_size: int = BATCH
) -> DataFrame:
    """Add ``output`` (a vector) and ``<output>_error``; both are NULL where ``column`` is NULL."""

    @F.arrow_udf(_RESULT)
    def kernel(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        embedder = factory()
        for batch in batches:
            given = np.flatnonzero(batch.is_valid().to_numpy(zero_copy_only=False))
            vectors: list = [None] * len(batch)
            errors: list = [None] * len(batch)
            for start in range(0, len(given), batch_size):
                # Only the values of a call are Python objects: an Arrow batch has thousands.
                chunk = given[start : start + batch_size]
                results = _embed_values(embedder, batch.take(pa.array(chunk)).to_pylist())
                for i, (found, error) in zip(chunk, results):
                    vectors[i], errors[i] = found, error
            yield pa.StructArray.from_arrays(
                [_list_array(vectors), pa.array(errors, pa.string())],
                names=["vector", "error"],
            )

    # Without this, a filter on the result is pushed below and the model runs again for it.
    embedded = kernel.asNondeterministic()
    done = df.withColumn("_embedded", embedded(F.col(column)))
    return done.withColumns(
        {output: F.col("_embedded.vector"), f"{output}_error": F.col("_embedded.error")}
    ).drop("_embedded")


def embed_text(
    df: DataFrame,
    column: str = "comment",
    factory: Factory | None = None,
    output: str = "text_vector",
    batch_size: int = BATCH,
) -> DataFrame:
    """Text vectors; a NULL text counts as ''."""
    filled = df.withColumn("_text", texts.or_blank(column))
    return embed(filled, "_text", output, factory or trigram_embedder(), batch_size).drop("_text")


def embed_image(
    df: DataFrame,
    column: str = "content",
    factory: Factory | None = None,
    output: str = "image_vector",
    batch_size: int = BATCH,
) -> DataFrame:
    """Photo vectors of a binary column. Decoding is the embedder's work."""
    return embed(df, column, output, factory or histogram_embedder(), batch_size)


def combine_vectors(
    df: DataFrame, first: str = "text_vector", second: str = "image_vector", output: str = "vector"
) -> DataFrame:
    """Add the text vector followed by the photo vector, together of length 1."""
    return df.withColumn(output, vector.l2_normalize(vector.concat(first, second)))


def vector_rows(df: DataFrame) -> DataFrame:
    """The records ``ticket_id, vector``."""
    return df.select("ticket_id", "vector")


def attach_photo_bytes(
    df: DataFrame, photos: DataFrame, spread_by: Sequence[str] = ("ticket_id",)
) -> DataFrame:
    """Add ``content``, the bytes of the photo; empty where there are none.

    ``photos`` has one row per url (``sources.photos``).
    """
    by_url = photos.filter(present("url")).select(F.col("url").alias("photo"), "content")
    joined = left_join(df, [by_url], "photo", spread_by)
    empty = F.lit(b"")
    return joined.select(*df.columns, F.coalesce("content", empty).alias("content"))


def photos_of(tickets: DataFrame, photos: DataFrame, most: int = BROADCAST_URLS) -> DataFrame:
    """The photos that tickets name.

    Urls are counted first. Up to ``most`` of them, their hashes go to where photos are read, and no
    photo is shuffled; a photo that shares a hash with another url stays, too. Beyond, photos and urls
    are joined by url, where Spark may put a Bloom filter of the urls below the shuffle.
    """
    urls = tickets.filter(present("photo")).select(F.col("photo").alias("url")).distinct()
    if urls.limit(most + 1).count() > most:
        return photos.join(urls, "url", "left_semi").select(*photos.columns)
    hashes = F.broadcast(urls.select(F.xxhash64("url").alias("_wanted")))
    named = photos.withColumn("_wanted", F.xxhash64("url"))
    return named.join(hashes, "_wanted", "left_semi").select(*photos.columns)


def split_by_photo(
    tickets: DataFrame, photos: DataFrame, most: int = BROADCAST_URLS
) -> tuple[DataFrame, DataFrame | None]:
    """Tickets whose url a photo table lists, and the others; all and None beyond ``most`` such urls.

    Only urls are shuffled: the hashes of those on both sides go to where tickets are read. A ticket that
    shares a hash with another url stays with the first. ``tickets`` are read for each part, so they must
    be the same rows every time, as those of a table are.
    """
    asked, listed = (
        df.filter(present(url)).select(F.xxhash64(url).alias("_known"))
        for df, url in ((tickets, "photo"), (photos, "url"))
    )
    known = asked.distinct().join(listed, "_known", "left_semi")
    if known.limit(most + 1).count() > most:
        return tickets, None
    keyed = tickets.withColumn("_known", F.xxhash64("photo"))
    named, others = (keyed.join(F.broadcast(known), "_known", how).drop("_known") for how in ("left_semi", "left_anti"))
    return named.select(*tickets.columns), others.select(*tickets.columns)


def without_vector(tickets: DataFrame) -> DataFrame:
    """What ``vectorize_tickets`` gives for tickets that have no photo: a reason, and no vector."""
    guarded = embed_guard(tickets.withColumn("_content", F.lit(b"")), "_content")
    return guarded.select(*tickets.columns, F.lit(None).cast("array<double>").alias("vector"), "reject_reason")


def vectorize_tickets(
    tickets: DataFrame,
    photos: DataFrame,
    text_factory: Factory | None = None,
    image_factory: Factory | None = None,
    batch_size: int = BATCH,
    parallelism: int | None = None,
) -> DataFrame:
    """Add ``vector`` and ``reject_reason``; exactly one of them is NULL in every row.

    Of a photo table, only the photos of these tickets are embedded (``photos_of``), where they are
    read: no photo byte is shuffled, only vectors are, and of a url that is listed several times one
    vector counts (the smallest, before any failure). Text is embedded only for tickets whose
    photo gave a vector. Rows keep their place: an id that occurs n times gives n rows.
    ``parallelism`` spreads the photos, and the rows right before the text model.
    """
    usable = photos_of(tickets, photos.filter(present("url") & (F.octet_length("content") > 0)))
    if parallelism:
        usable = usable.repartition(parallelism)
    seen = embed_image(usable, "content", image_factory, "_image", batch_size)
    seen = seen.select(F.col("url").alias("photo"), "_image", "_image_error")
    best = F.min(F.struct(F.col("_image").isNull().alias("failed"), "_image", "_image_error"))
    seen = seen.groupBy("photo").agg(best.alias("best")).select("photo", "best._image", "best._image_error")

    # One vector a url: hashed, so that the tickets with their texts need not be sorted.
    joined = left_join(tickets, [seen.hint("shuffle_hash")], "photo", ["ticket_id", "timestamp"])
    reason = (
        F.when(~present("ticket_id"), NO_ID)
        .when(~present("photo"), NO_URL)
        .when(F.col("_image_error").isNotNull(), F.col("_image_error"))
        .when(F.col("_image").isNull(), NO_BYTES)
    )
    guarded = joined.withColumn("_reason", reason).withColumn(
        "_text", F.when(F.col("_reason").isNull(), texts.or_blank("comment"))
    )
    if parallelism:
        guarded = guarded.repartition(parallelism)
    read = embed(guarded, "_text", "_words", text_factory or trigram_embedder(), batch_size)
    accepted = F.when(F.col("_reason").isNull(), F.col("_image"))
    read = read.withColumn("_image", accepted)
    combined = combine_vectors(read, "_words", "_image", "vector")
    return combined.select(
        *tickets.columns,
        "vector",
        F.coalesce("_reason", "_words_error").alias("reject_reason"),
    )
