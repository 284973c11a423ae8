"""Benchmark passages in documents: a prefix-filtered set join, with DataFrame functions only.

A window (13 words of an item, or a shorter item) is a set of shingles of at most three words at
known offsets. It can only stand where its rarest shingle stands, so the necessary prefix of a
window is that one shingle. Shingles of the benchmark are counted over all documents; windows with
a shingle that no document has are out. A place of the prefix shingle gives the window's start,
which has to lie within the document, and there the words themselves are compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaint.llm.batches import staged

WINDOW_WORDS = 13
SHINGLE_WORDS = 3
# Contaminated when 20 * n_hit >= n_words.
HIT_SHARE = 20
# Rows of the benchmark's tables (long keys, 13 words each at most) that are sent to all tasks; a
# larger benchmark is joined by shuffles.
BROADCAST_ROWS = 100_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression of a value that is computed once a row, though `use` names it in a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    """Lower-cased words; no word for NULL."""
    parts = F.split(F.translate(text, UPPER, UPPER.lower()), BETWEEN_WORDS)
    return F.coalesce(F.array_remove(parts, ""), F.array().cast("array<string>"))


def shingles(words: Column, size: Column) -> Column:
    """Hash of the run of `size` words at each position; none when there are fewer words."""

    def hashes(own: Column) -> Column:
        places = F.when(F.size(own) >= size, F.sequence(F.lit(0), F.size(own) - size))
        places = F.coalesce(places, F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.xxhash64(F.slice(own, i + 1, size)))

    return once(words, hashes)


def covered(hits: Column) -> Column:
    """Words under any of the hits: a fold over their spans by start."""
    spans = F.array_sort(
        F.transform(hits, lambda h: F.struct(h["start"].alias("lo"), (h["start"] + F.size(h["words"])).alias("hi")))
    )
    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("until")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["hi"] - F.greatest(s["lo"], a["until"]), F.lit(0))).alias("n"),
            F.greatest(a["until"], s["hi"]).alias("until"),
        ),
        lambda a: a["n"],
    )


def benchmark_windows(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """(window, words, item_id): each distinct window has one number."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item_id"), words_of(F.col(text)).alias("all_words"))
    size = F.size("all_words")
    starts = F.sequence(F.lit(0), F.greatest(size - WINDOW_WORDS, F.lit(0)))
    rows = items.filter(size > 0).select("item_id", "all_words", F.explode(starts).alias("start"))
    words = F.slice("all_words", F.col("start") + 1, F.lit(WINDOW_WORDS))
    rows = rows.select("item_id", words.alias("words")).distinct()
    # Two hashes name a window; its words are compared in the end.
    return rows.withColumn("window", F.concat_ws(":", F.xxhash64("words"), F.hash("words")))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null, empty and wordless texts have no words and are clean; such items have no window. Items
    without an id cover words but are not counted. Repeated rows get equal answers; rows that share
    an id are taken as repeats of one text. A row without an id stands for itself, by its text.
    Empty tables give an empty result or clean documents. Other columns are ignored.
    """
    windows = staged(benchmark_windows(benchmark, item_id, item_text), "windows")
    distinct = windows.select("window", "words").distinct()
    grams = distinct.select(
        "window",
        "words",
        F.posexplode(shingles(F.col("words"), F.least(F.size("words"), F.lit(SHINGLE_WORDS)))).alias("at", "token"),
    )
    grams = staged(grams, "shingles")
    small = grams.count() <= BROADCAST_ROWS

    def sent(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    # Shingles are shorter than three words only where an item is: at most three lengths.
    lengths = [r[0] for r in distinct.select(F.least(F.size("words"), F.lit(SHINGLE_WORDS))).distinct().collect()]
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.expr(f"coalesce(cast(`{doc_id}` as bigint), xxhash64(`{text}`) | shiftleft(1L, 63))").alias("uid"),
        F.col(text).alias("text"),
    )
    split = rows.select(
        "uid", *[shingles(words_of(F.col("text")), F.lit(n)).alias(f"tokens_{n}") for n in lengths]
    )
    tokens = grams.select("token").distinct()
    matched = None
    for n in lengths:
        n_words = F.when(F.size(f"tokens_{n}") > 0, F.size(f"tokens_{n}") + (n - 1)).alias("n_words")
        places = split.select("uid", n_words, F.posexplode(f"tokens_{n}").alias("pos", "token"))
        found = places.join(sent(tokens), "token")
        matched = found if matched is None else matched.unionByName(found)
    if matched is None:
        matched = split.selectExpr("0L as token", "uid", "0 as n_words", "0 as pos").limit(0)
    matched = staged(matched, "matched")

    rarity = matched.groupBy("token").agg(F.count("*").alias("n"))
    ordered = Window.partitionBy("window").orderBy("n", "at")
    counted = grams.join(rarity, "token", "left").withColumn("rank", F.row_number().over(ordered))
    counted = counted.withColumn("least", F.min(F.coalesce("n", F.lit(0))).over(Window.partitionBy("window")))
    prefix = counted.filter("rank = 1 and least > 0").select("token", "window", "words", "at")
    prefix = staged(prefix, "prefix")

    places = matched.join(sent(prefix), "token").withColumn("start", F.col("pos") - F.col("at"))
    places = places.filter((F.col("start") >= 0) & (F.col("start") + F.size("words") <= F.col("n_words")))
    places = places.groupBy("uid").agg(F.collect_set(F.struct("start", "window", "words")).alias("places"))

    none = F.array().cast("array<struct<start:int,window:string,words:array<string>>>")

    def verified(words: Column) -> Column:
        """Number of words, words covered by hits, and the windows hit."""

        def holds(place: Column) -> Column:
            return F.slice(words, place["start"] + 1, F.size(place["words"])) == place["words"]

        def judged(hits: Column) -> Column:
            return F.struct(
                F.size(words).cast("bigint").alias("n_words"),
                covered(hits).cast("bigint").alias("n_hit"),
                F.array_distinct(F.transform(hits, lambda h: h["window"])).alias("windows"),
            )

        return once(F.filter(F.coalesce("places", none), holds), judged)

    read = rows.join(places, "uid", "left")
    judged = read.select("doc_id", "uid", once(words_of(F.col("text")), verified).alias("found"))
    judged = staged(judged.select("doc_id", "uid", "found.*"), "judged")

    hit = judged.filter("n_hit > 0").select("uid", F.explode("windows").alias("window")).distinct()
    named = hit.join(sent(windows.select("window", "item_id")), "window").groupBy("uid")
    named = named.agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return judged.join(named, "uid", "left").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
