"""Passages that recur across documents: confirmed, compiled into automata, located everywhere.

1. Each document is cut into zones. The anchor of a 35-word window is the smallest hash among its
   8-word runs, and a zone is a run of windows with one anchor, about 14 windows. Equal windows
   have equal anchors wherever they stand, so only zones whose anchor recurs can hold one.
2. A zone that occurs twice recurs as a whole. Where different zones share an anchor, at the edges
   of copied text, their windows are counted one by one.
3. The first document with a zone gives the phrase. Phrases of about a hundred such documents are
   one Aho-Corasick automaton over word numbers, and every document with one of its zones is
   streamed through it. The words that matches cover are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaint.llm.batches import Powers, Words, chunks, column, ngrams, per_batch, small_batches, staged

WINDOW_WORDS = 35
ANCHOR_WORDS = 8
ANCHORS = WINDOW_WORDS - ANCHOR_WORDS + 1
PLACE_BITS = 24
# Documents whose phrases make one automaton, and documents that one task streams through it.
REPS_PER_SHARD = 100
DOCS_PER_TASK = 2_000
NO_WORDS_SHA = hashlib.sha256(b"").hexdigest()

_ZONED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("uid", pa.int64()),
        ("text_key", pa.int64()),
        ("n_words", pa.int64()),
        ("text_a", pa.int64()),
        ("text_b", pa.int64()),
        ("sha256", pa.string()),
        ("zones", pa.list_(pa.struct([("g", pa.int64()), ("z", pa.int64()), ("n", pa.int32())]))),
    ]
)
ZONED_DDL = (
    "doc_id long, uid long, text_key long, n_words long, text_a long, text_b long, sha256 string, "
    "zones array<struct<g: long, z: long, n: int>>"
)
_PHRASES = pa.schema(
    [
        ("uid", pa.int64()),
        ("start", pa.int32()),
        ("windows", pa.int32()),
        ("n", pa.int64()),
        ("hashes_a", pa.list_(pa.int64())),
        ("hashes_b", pa.list_(pa.int64())),
    ]
)
PHRASES_DDL = "uid long, start int, windows int, n long, hashes_a array<long>, hashes_b array<long>"
SPANS_DDL = "uid long, spans array<int>"
_SPANS = pa.schema([("uid", pa.int64()), ("spans", pa.list_(pa.int32()))])


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the first smallest value of each full window, by the values' upper 40 bits.

    Value and position are one number, so a minimum gives both; a text too long for that keeps the
    positions beside.
    """
    if len(values) <= 1 << PLACE_BITS:
        mask = np.uint64((1 << PLACE_BITS) - 1)
        best, place = (values & ~mask) | np.arange(len(values), dtype=np.uint64), None
    else:
        best, place = values >> np.uint64(PLACE_BITS), np.arange(len(values))
    done = 1
    while done < width:
        step = min(done, width - done)
        left, right = best[: len(best) - step], best[step:]
        if place is not None:
            place = np.where(left <= right, place[: len(place) - step], place[step:])
        best = np.minimum(left, right)
        done += step
    return (best & mask).astype(np.int64) if place is None else place


class Zones:
    """Zones of a run of texts: row, anchor hash, content hash, first and last window."""

    def __init__(self, words: Words, powers: Powers) -> None:
        self.sums = powers.prefix(words.hashes)
        count = len(words.hashes) - WINDOW_WORDS + 1
        if count < 1:
            self.row = self.first = self.last = np.zeros(0, np.int64)
            self.g = self.z = np.zeros(0, np.uint64)
            return
        grams = ngrams(words.hashes, ANCHOR_WORDS)
        owner = sliding_argmin(grams, ANCHORS)[:count]
        row = np.searchsorted(words.rows, np.arange(count), side="right") - 1
        valid = np.arange(count) + WINDOW_WORDS <= words.rows[row + 1]
        change = np.ones(count, bool)
        change[1:] = (owner[1:] != owner[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(change & valid)
        ends = np.flatnonzero(np.append((change | ~valid)[1:], True) & valid)
        self.row, self.first, self.last = row[first], first, ends
        self.g = grams[owner[first]]
        self.z = powers.between(self.sums, first, ends + WINDOW_WORDS)


def _zone_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()

    def work(batch: pa.RecordBatch) -> dict:
        sizes, whole_a, whole_b, shas = [], [], [], []
        lists, g, z, n = [0], [], [], []
        for first, end, content, bounds in chunks(column(batch, "text")):
            words = Words(content, bounds, powers, lower=False)
            zones = Zones(words, powers)
            starts, stops = words.rows[:-1], words.rows[1:]
            sizes.extend((stops - starts).tolist())
            whole = powers.between(zones.sums, starts, stops)
            second = powers.prefix(whole_words(words))
            whole_a.append(whole.view(np.int64))
            whole_b.append(powers.between(second, starts, stops).view(np.int64))
            raw = content.tobytes()
            for row in range(end - first):
                text = raw[bounds[row] : bounds[row + 1]]
                shas.append(hashlib.sha256(b" ".join(text.split())).hexdigest())
            order = np.lexsort((zones.z, zones.g, zones.row))
            row, g_own, z_own = zones.row[order], zones.g[order], zones.z[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (g_own[1:] != g_own[:-1]) | (z_own[1:] != z_own[:-1])
            at = np.flatnonzero(new)
            g.append(g_own[at].view(np.int64))
            z.append(z_own[at].view(np.int64))
            n.append(np.diff(np.append(at, len(row))).astype(np.int32))
            counts = np.bincount(row[at], minlength=end - first)
            lists.extend((lists[-1] + np.cumsum(counts)).tolist())
        fields = [pa.array(np.concatenate(part)) for part in (g, z, n)]
        structs = pa.StructArray.from_arrays(fields, names=["g", "z", "n"])
        return {
            "doc_id": column(batch, "doc_id"),
            "uid": column(batch, "uid"),
            "text_key": column(batch, "text_key"),
            "n_words": sizes,
            "text_a": np.concatenate(whole_a),
            "text_b": np.concatenate(whole_b),
            "sha256": shas,
            "zones": pa.ListArray.from_arrays(pa.array(lists, pa.int32()), structs),
        }

    yield from per_batch(_ZONED, work)(batches)


def whole_words(words: Words) -> np.ndarray:
    """A second value per word, for a second hash of whole texts."""
    return words.hashes ^ (words.hashes >> np.uint64(29))


def _phrase_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wanted zones of each document; with window hashes where different zones share the anchor."""
    powers = Powers()
    for batch in batches:
        rows: list[tuple] = []
        uids, wanted = column(batch, "uid").to_pylist(), column(batch, "wanted").to_pylist()
        for first, end, content, bounds in chunks(column(batch, "text")):
            words = Words(content, bounds, powers, lower=False)
            zones = Zones(words, powers)
            cuts = np.searchsorted(zones.row, np.arange(end - first + 1))
            second = powers.prefix(whole_words(words))
            for row in range(end - first):
                base = words.rows[row]
                want = {(w["g"], w["z"]): w for w in wanted[first + row]}
                own = range(cuts[row], cuts[row + 1])
                g, z = zones.g.view(np.int64), zones.z.view(np.int64)
                for i in own:
                    found = want.pop((int(g[i]), int(z[i])), None)
                    if found is None:
                        continue
                    lo, hi = zones.first[i], zones.last[i]
                    a = b = None
                    if found["kinds"] > 1:
                        at = np.arange(lo, hi + 1)
                        a = powers.between(zones.sums, at, at + WINDOW_WORDS).view(np.int64)
                        b = powers.between(second, at, at + WINDOW_WORDS).view(np.int64)
                    rows.append((uids[first + row], int(lo - base), int(hi - lo + 1), found["n"], a, b))
        if rows:
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows), _PHRASES)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_PHRASES)


def word_numbers(text: bytes, powers: Powers) -> tuple[int, ...]:
    content = np.frombuffer(text, np.uint8)
    words = Words(content, np.array([0, len(content)]), powers, lower=False)
    return tuple((words.hashes >> np.uint64(33)).tolist())


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by shard, phrases before documents: compile the automaton, then stream."""
    powers = Powers()
    shard, automaton, ready = None, None, False
    for batch in batches:
        out: list[tuple[int, list[int]]] = []
        for row in batch.to_pylist():
            if (row["shard"], row["salt"]) != shard:
                shard, ready = (row["shard"], row["salt"]), False
                automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            numbers = word_numbers((row["text"] or "").encode(), powers)
            if row["kind"] == 0:
                for start, size in row["phrases"]:
                    phrase = numbers[start : start + size]
                    automaton.add_word(phrase, size)
                continue
            if not ready and len(automaton):
                automaton.make_automaton()
            ready = True
            if not len(automaton):
                continue
            spans: list[int] = []
            for last, size in automaton.iter(numbers):
                lo, hi = last + 1 - size, last + 1
                while spans and lo <= spans[-1]:
                    hi = max(hi, spans.pop())
                    lo = min(lo, spans.pop())
                spans += [lo, hi]
            if spans:
                out.append((row["uid"], spans))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SPANS)], schema=_SPANS)


_KEPT = pa.schema([("uid", pa.int64()), ("n_removed", pa.int64()), ("sha256", pa.string()), ("kept", pa.string())])
KEPT_DDL = "uid long, n_removed long, sha256 string, kept string"


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def work(batch: pa.RecordBatch) -> dict:
        out: dict = {"uid": column(batch, "uid"), "n_removed": [], "sha256": [], "kept": []}
        for text, found in zip(column(batch, "text"), column(batch, "spans").to_pylist()):
            words = (text.as_py() or "").encode().split()
            keep = np.ones(len(words), bool)
            for spans in found:
                for lo, hi in zip(spans[::2], spans[1::2]):
                    keep[lo:hi] = False
            left = b" ".join([words[i] for i in np.flatnonzero(keep)])
            out["n_removed"].append(int(len(words) - keep.sum()))
            out["sha256"].append(hashlib.sha256(left).hexdigest())
            out["kept"].append(left.decode())
        return out

    yield from per_batch(_KEPT, work)(batches)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256; with_text adds kept_text,
    the words that are left, joined by a space (NULL where nothing was removed), and text_key, the
    xxhash64 of the text.

    A word goes when a 35-word window over it starts anywhere else too, in the same document or in
    another. Null, empty and short texts lose nothing. Equal texts are one node: each copy of a
    text of 35 words or more loses all its words. A row without an id stands for itself, by its
    text, and so does each text of an id that has several. Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.selectExpr(
        f"cast(`{doc_id}` as bigint) as doc_id", f"xxhash64(`{text}`) as text_key", f"`{text}` as text"
    )
    ids = rows.filter("doc_id is not null").groupBy(F.col("doc_id").alias("several"))
    several = ids.agg(F.min("text_key").alias("low"), F.max("text_key").alias("high")).filter("low != high")
    several = staged(several.select("several"), "several")
    rows = rows.join(several, F.col("doc_id") == F.col("several"), "left").selectExpr(
        "doc_id",
        "case when doc_id is null then text_key | shiftleft(1L, 63)"
        " when several is not null then xxhash64(doc_id, text) | shiftleft(1L, 63) else doc_id end as uid",
        "text_key",
        "text",
    )
    zoned = staged(rows.mapInArrow(_zone_batches, ZONED_DDL), "zones")
    same = ["n_words", "text_a", "text_b"]
    classes = zoned.filter(F.col("n_words") >= WINDOW_WORDS).groupBy(*same)
    classes = staged(classes.agg(F.min("uid").alias("uid"), F.count("*").alias("copies")), "texts")
    nodes = zoned.join(classes, [*same, "uid"]).dropDuplicates([*same, "uid"])
    zones = nodes.select("uid", F.inline("zones"))

    kinds = zones.groupBy("g", "z").agg(F.sum("n").alias("n"), F.min("uid").alias("rep"))
    anchors = kinds.groupBy("g").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    anchors = anchors.filter("total > 1").drop("total")
    recurring = staged(kinds.join(anchors, "g"), "recurring")

    routes = zones.join(recurring.select("g", "z", "rep"), ["g", "z"]).select("uid", "rep").distinct()
    routes = staged(routes, "routes")
    unique_rows = rows.select("uid", "text").join(routes.select("uid").distinct(), "uid", "left_semi").dropDuplicates(["uid"])
    texts = staged(unique_rows, "texts")

    wanted = recurring.groupBy(F.col("rep").alias("uid")).agg(
        F.collect_list(F.struct("g", "z", "n", "kinds")).alias("wanted")
    )
    small_batches(spark)
    found = texts.join(wanted, "uid").select("uid", "text", "wanted").mapInArrow(_phrase_batches, PHRASES_DDL)
    found = staged(found, "phrases")
    phrases = _confirmed(found)

    shards = max(1, -(-phrases.select("uid").distinct().count() // REPS_PER_SHARD))
    own_shard = F.pmod(F.xxhash64("rep"), F.lit(shards)).alias("shard")
    streamed = routes.select("uid", own_shard).distinct()
    sizes = streamed.groupBy("shard").agg(F.expr(f"(count(*) + {DOCS_PER_TASK - 1}) div {DOCS_PER_TASK}").alias("salts"))
    sizes = staged(sizes, "shards")
    salt = F.pmod(F.xxhash64("uid", F.lit(7)), F.col("salts")).alias("salt")
    streamed = streamed.join(sizes, "shard").select("uid", "shard", salt).join(texts, "uid")
    streamed = streamed.select(
        "shard", "salt", F.lit(1).alias("kind"), "uid", "text", F.lit(None).cast("array<array<int>>").alias("phrases")
    )
    compiled = phrases.withColumn("rep", F.col("uid")).select("uid", own_shard, "phrases").join(sizes, "shard")
    compiled = compiled.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)))
    compiled = compiled.join(texts, "uid").select("shard", "salt", F.lit(0).alias("kind"), "uid", "text", "phrases")
    both = compiled.unionByName(streamed).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind", "uid")
    spans = both.mapInArrow(_locate, SPANS_DDL)
    spans = staged(spans.groupBy("uid").agg(F.collect_list("spans").alias("spans")), "spans")

    cut = texts.join(spans, "uid").select("uid", "text", "spans").mapInArrow(_remove, KEPT_DDL)
    cut = cut.withColumnRenamed("sha256", "cut_sha256")
    if not with_text:
        cut = cut.withColumn("kept", F.lit(None).cast("string"))
    answers = nodes.select("uid", *same).join(classes, [*same, "uid"]).join(cut, "uid", "left").drop("uid")
    placed = zoned.drop("zones").join(staged(answers, "answers"), same, "left")
    copied = F.coalesce(F.col("copies") > 1, F.lit(False))
    lost = F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    answer = placed.select(
        "doc_id",
        "text_key",
        "n_words",
        lost.cast("bigint").alias("n_removed"),
        F.when(copied, F.lit(NO_WORDS_SHA)).otherwise(F.coalesce("cut_sha256", "sha256")).alias("kept_sha256"),
        F.when(copied, F.lit("")).when(F.col("n_removed") > 0, F.col("kept")).alias("kept_text"),
    )
    return answer if with_text else answer.drop("text_key", "kept_text")


def _confirmed(found: DataFrame) -> DataFrame:
    """(uid, phrases): start and length in words of the recurring passages of each document."""
    length = F.col("windows") + F.lit(WINDOW_WORDS - 1)
    whole = found.filter("hashes_a is null").select("uid", F.array("start", length).alias("phrase"))
    edges = found.filter("hashes_a is not null").select(
        "uid", "start", "n", F.posexplode(F.arrays_zip("hashes_a", "hashes_b")).alias("at", "hash")
    )
    edges = edges.select("uid", "start", "n", "at", "hash.hashes_a", "hash.hashes_b")
    counted = edges.groupBy("hashes_a", "hashes_b").agg(F.sum("n").alias("total")).filter("total > 1")
    edges = edges.join(counted, ["hashes_a", "hashes_b"])
    # Windows of a zone in a row: position less rank is the same along a run.
    runs = edges.groupBy("uid", "start").agg(F.array_sort(F.collect_set("at")).alias("at"))
    runs = runs.select("uid", "start", F.posexplode("at").alias("rank", "at"))
    runs = runs.groupBy("uid", "start", (F.col("at") - F.col("rank")).alias("run")).agg(
        F.min("at").alias("low"), F.max("at").alias("high")
    )
    part = F.array(F.col("start") + F.col("low"), F.col("high") - F.col("low") + WINDOW_WORDS)
    phrases = whole.unionByName(runs.select("uid", part.alias("phrase")))
    return staged(phrases.groupBy("uid").agg(F.collect_set("phrase").alias("phrases")), "automata")
