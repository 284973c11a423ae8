"""Near duplicates: MinHash bands propose pairs, Odd sketches weed them out, full sets confirm.

A document is the set of its distinct five-word shingles. Documents with equal sets are one class
and one node from then on, so a text copied a million times takes part once. Within a bucket the
members are first compared with its hub only, the member that shares most buckets with others: that
joins a group of edited copies after one linear pass. Members of a bucket that are still apart are
compared with each other: with the members of a large group by blocks of full sets, and else pair
by pair where their sketches allow it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaint.llm.batches import (
    Powers,
    Words,
    chunks,
    column,
    mix,
    ngrams,
    per_batch,
    small_batches,
    staged,
)

SHINGLE_WORDS = 5
# Linked when 100 * intersection >= 75 * union.
THRESHOLD_PERCENT = 75
# 32 bands of 4 minima: a pair at 0.75 shares no band with probability (1 - 0.75**4)**32 = 5e-6.
BANDS = 32
BAND_ROWS = 4
SAMPLES = BANDS * BAND_ROWS
SKETCH_BITS = 512
# Two Odd sketches at 0.75 differ in 57 bits on average, with a deviation of 9. More than 110 mean
# 72 differing samples of 128 where 32 are expected: 8 deviations, a similarity of about 0.44.
MOST_DIFFERENT = 110
# Buckets larger than this are cut into blocks of about so many members before these are paired.
LARGE_BUCKET = 256
# Groups larger than this are compared with outsiders by blocks of so many sets.
LARGE_GROUP = 64
QUERY_BLOCK = 512
MEMBER_BLOCK = 1_024

SIGNATURE_DDL = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>"
_SIGNATURE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("set_a", pa.int64()),
        ("set_b", pa.int64()),
        ("bands", pa.list_(pa.int64())),
        ("sketch", pa.list_(pa.int64())),
    ]
)
_SETS = pa.schema([("id", pa.int64()), ("items", pa.binary())])


def shingle_sets(texts: pa.Array, powers: Powers) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row; fewer words than a shingle are one item."""
    for first, end, content, bounds in chunks(texts):
        words = Words(content, bounds, powers, lower=True)
        grams = ngrams(words.hashes, SHINGLE_WORDS)
        for row in range(end - first):
            start, stop = words.rows[row], words.rows[row + 1]
            if stop - start >= SHINGLE_WORDS:
                yield np.unique(grams[start : stop - SHINGLE_WORDS + 1])
            elif stop > start:
                yield ngrams(words.hashes[start:stop], stop - start)
            else:
                yield np.zeros(0, np.uint64)


class MinHash:
    """Minima of the shingles under fixed permutations, their bands, and their Odd sketch."""

    def __init__(self) -> None:
        random = mix(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64))
        self.scale = (random[:SAMPLES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        self.shift = (random[SAMPLES:] >> np.uint64(32)).astype(np.uint32)
        self.index = np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)
        self.band = np.arange(BANDS, dtype=np.uint64)[:, None]

    def minima(self, items: np.ndarray) -> np.ndarray:
        short = (items >> np.uint64(32)).astype(np.uint32)
        best = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(short), 1024):
            block = self.scale[:, None] * short[None, at : at + 1024]
            block += self.shift[:, None]
            np.minimum(best, block.min(axis=1), out=best)
        return best

    def bands(self, minima: np.ndarray) -> np.ndarray:
        rows = minima.astype(np.uint64).reshape(BANDS, BAND_ROWS)
        keys = self.band[:, 0]
        for j in range(BAND_ROWS):
            keys = mix(keys + rows[:, j] * np.uint64(0x9E3779B97F4A7C15))
        return keys.view(np.int64)

    def sketch(self, minima: np.ndarray) -> np.ndarray:
        """Each (position, minimum) flips one bit: bits tell whether they were hit an odd time."""
        places = mix(self.index + minima.astype(np.uint64)) % np.uint64(SKETCH_BITS)
        odd = np.bincount(places.astype(np.int64), minlength=SKETCH_BITS) & 1
        return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sign_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers, hashes = Powers(), MinHash()

    def work(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {name: [] for name in _SIGNATURE.names}
        out["doc_id"] = column(batch, "doc_id")
        for items in shingle_sets(column(batch, "text"), powers):
            out["n_shingles"].append(len(items))
            if not len(items):
                for name in ("set_a", "set_b", "bands", "sketch"):
                    out[name].append(None)
                continue
            out["set_a"].append(int(items.sum(dtype=np.uint64).astype(np.int64)))
            out["set_b"].append(int(mix(items).sum(dtype=np.uint64).astype(np.int64)))
            minima = hashes.minima(items)
            out["bands"].append(hashes.bands(minima))
            out["sketch"].append(hashes.sketch(minima))
        return out

    yield from per_batch(_SIGNATURE, work)(batches)


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()

    def work(batch: pa.RecordBatch) -> dict:
        items = [found.tobytes() for found in shingle_sets(column(batch, "text"), powers)]
        return {"id": column(batch, "id"), "items": items}

    yield from per_batch(_SETS, work)(batches)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets are similar enough."""
    for batch in batches:
        keep = []
        for left, right in zip(column(batch, "items_a"), column(batch, "items_b")):
            a, b = (np.frombuffer(side.as_buffer(), np.uint64) for side in (left, right))
            both = len(a) + len(b) - len(np.union1d(a, b))
            keep.append(100 * both >= THRESHOLD_PERCENT * (len(a) + len(b) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def different_bits(left: str, right: str) -> Column:
    """Population count of the exclusive or of two sketches."""
    words = SKETCH_BITS // 64
    counts = [F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i])) for i in range(words)]
    total = counts[0]
    for count in counts[1:]:
        total = total + count
    return total


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each id of the links (a, b).

    Each round takes the smallest label among the neighbours and then the label of that label. The
    labels are written to the shared folder each round; the driver sees one number per round.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct()
    both = staged(both, "links")
    lowest = both.groupBy("a").agg(F.min("b").alias("b"))
    labels = staged(lowest.select(F.col("a").alias("id"), F.least("a", "b").alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b")
        near = near.groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "id").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("own")
        )
        jump = lower.select(F.col("id").alias("own"), F.col("own").alias("far"))
        lower = lower.join(jump, "own", "left").select(
            "id", "old", F.least("own", F.coalesce("far", "own")).alias("component")
        )
        lower = staged(lower, "labels")
        changed = lower.filter("component != old").limit(1).count()
        labels = lower.select("id", "component")
        if not changed:
            return labels


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    small_batches(docs.sparkSession)
    rows = docs.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"`{text}` as text")
    return staged(rows.mapInArrow(_sign_batches, SIGNATURE_DDL), "signatures")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Null, empty and wordless texts have no shingle and are linked with nothing. A row without an id
    is linked with nothing, has no component and is kept. Rows that share an id are one node, and
    repeated rows all get the same answer. An empty table gives an empty result. Other columns are
    ignored.
    """
    signed = signatures(docs, doc_id, text)
    linkable = signed.filter("n_shingles > 0 and doc_id is not null")
    key = ["n_shingles", "set_a", "set_b"]
    classes = linkable.groupBy(*key).agg(F.min("doc_id").alias("rep"))
    members = staged(
        signed.select("doc_id", *key).join(classes, key, "left").select("doc_id", "n_shingles", "rep"), "members"
    )
    # Signature rows of the representatives only; an id with several texts has several.
    chosen = classes.withColumnRenamed("rep", "doc_id")
    reps = linkable.join(chosen, [*key, "doc_id"]).dropDuplicates([*key, "doc_id"])
    reps = staged(reps.withColumnRenamed("doc_id", "rep"), "representatives")

    # A key holds its band's number, so keys of different bands do not meet.
    buckets = reps.select("rep", F.explode("bands").alias("key"))
    sizes = buckets.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    shared = staged(buckets.join(sizes, "key"), "buckets")
    degrees = staged(shared.groupBy("rep").agg(F.sum("size").alias("degree")), "degrees")
    ranked = shared.join(degrees, "rep")
    # Largest degree first, then the smallest id.
    best = F.max(F.struct("degree", (-F.col("rep")).alias("minus"))).alias("best")
    hubs = ranked.groupBy("key").agg(best).select("key", "best.degree", (-F.col("best.minus")).alias("hub"))
    sketches = reps.select("rep", "n_shingles", "sketch", "bands")

    stars = shared.select("key", "rep").join(hubs, "key").filter("rep != hub")
    stars = stars.groupBy(F.col("hub").alias("a"), F.col("rep").alias("b")).agg(F.max("degree").alias("degree"))
    for side in ("a", "b"):
        stars = stars.join(_sketched(sketches, "rep", side), side)
    stars = staged(stars.filter(_alike("a", "b")).select("a", "b", "degree"), "stars")
    sets = _sets(docs, shared.select(F.col("rep").alias("id")).distinct(), doc_id, text)

    def confirmed(pairs: DataFrame) -> DataFrame:
        small_batches(pairs.sparkSession)
        both = pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("items_a")), "a")
        both = both.join(sets.select(F.col("id").alias("b"), F.col("items").alias("items_b")), "b")
        return staged(both.select("a", "b", "items_a", "items_b").mapInArrow(_confirm, "a long, b long"), "links")

    # First each member with one hub; then the pairs with other hubs that are still apart.
    first = stars.groupBy("b").agg(F.max_by("a", F.struct("degree", "a")).alias("a"))
    first = confirmed(first.select("a", "b"))
    labels = components(first)
    later = confirmed(_apart(stars.select("a", "b").join(first, ["a", "b"], "left_anti"), labels))
    links = first.union(later)
    labels = components(links)

    # What is left: members of one bucket in different groups.
    open_rows = _open_buckets(shared, labels)
    links = links.union(confirmed(_pairs(open_rows, sketches)))
    links = links.union(_by_blocks(open_rows, labels, sets))
    labels = components(links)

    named = labels.select(F.col("id").alias("rep"), "component")
    placed = members.join(named, "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return placed.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are not yet in one component."""
    for side in ("a", "b"):
        own = labels.select(F.col("id").alias(side), F.col("component").alias(f"own_{side}"))
        pairs = pairs.join(own, side, "left").withColumn(f"own_{side}", F.coalesce(f"own_{side}", side))
    return pairs.filter("own_a != own_b").select("a", "b")


def _sketched(sketches: DataFrame, key: str, side: str) -> DataFrame:
    return sketches.select(
        F.col(key).alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")
    )


def _alike(a: str, b: str) -> Column:
    """Whether sizes and sketches allow a link."""
    small, large = F.least(f"n_{a}", f"n_{b}"), F.greatest(f"n_{a}", f"n_{b}")
    sizes = 100 * small >= THRESHOLD_PERCENT * large
    return sizes & (different_bits(f"sketch_{a}", f"sketch_{b}") <= MOST_DIFFERENT)


def _open_buckets(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the buckets whose members are in different groups, with group and group size, and
    with the number of members and the largest group size of their bucket."""
    groups = labels.groupBy("component").agg(F.count("*").alias("group_size"))
    grouped = labels.join(groups, "component").select(F.col("id").alias("rep"), "component", "group_size")
    own = shared.join(grouped, "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component"), F.coalesce("group_size", F.lit(1)).alias("group_size")
    )
    split = own.groupBy("key").agg(
        F.count("*").alias("members"),
        F.max("group_size").alias("largest"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    )
    return staged(own.join(split.filter("low != high").drop("low", "high"), "key"), "open")


def _pairs(open_rows: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs of one bucket in different groups, where sizes and sketches allow a link. Buckets that
    a large group has members in are left to the blocks.

    Large buckets are cut into blocks, and each block meets each block of its bucket under a join
    key of its own, so the size of a bucket changes the plan and not the pairs. However many
    buckets a pair shares, it is emitted in the one with the smallest key.
    """
    blocks = F.expr(f"(members + {LARGE_BUCKET - 1}) div {LARGE_BUCKET}")
    rows = open_rows.filter(F.col("largest") <= LARGE_GROUP)
    rows = rows.select("key", "rep", "component", blocks.alias("blocks")).join(sketches, "rep")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    names = ("rep", "component", "n_shingles", "sketch", "bands")
    sides = [
        rows.withColumn(f"block_{side}", own)
        .withColumn(f"block_{other}", each)
        .select("key", "block_a", "block_b", *[F.col(c).alias(f"{c}_{side}") for c in names])
        .withColumnsRenamed({f"rep_{side}": side, f"n_shingles_{side}": f"n_{side}"})
        for side, other in (("a", "b"), ("b", "a"))
    ]
    left, right = (side.alias(name) for side, name in zip(sides, ("l", "r")))
    same = F.col("l.key") == F.col("r.key")
    for block in ("block_a", "block_b"):
        same = same & (F.col(f"l.{block}") == F.col(f"r.{block}"))
    apart = (F.col("a") < F.col("b")) & (F.col("component_a") != F.col("component_b"))
    once = F.array_min(F.array_intersect("bands_a", "bands_b")) == F.col("l.key")
    return left.join(right, same & apart & _alike("a", "b") & once).select("a", "b").distinct()


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the queries (kind 0) and members (kind 1) of each block, which come together."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    current, sides = None, ([], [])
    for batch in batches:
        rows = zip(*(column(batch, n).to_pylist() for n in ("group", "q", "m", "kind", "id", "items")))
        for group, q, m, kind, key, items in rows:
            if (group, q, m) != current:
                yield from _block_links(sides, schema)
                current, sides = (group, q, m), ([], [])
            sides[kind].append((key, np.frombuffer(items, np.uint64)))
    yield from _block_links(sides, schema)


def _block_links(sides: tuple[list, list], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Exact intersections of all queries with all members: members' items are numbered by the
    queries' vocabulary once, and each query then counts its flags under them."""
    queries, members = sides
    if not queries or not members:
        return
    vocabulary = np.unique(np.concatenate([items for _, items in queries]))
    sizes = np.array([len(items) for _, items in members])
    joined = np.concatenate([items for _, items in members])
    place = np.minimum(np.searchsorted(vocabulary, joined), len(vocabulary) - 1)
    known = vocabulary[place] == joined
    place, owner = place[known], np.repeat(np.arange(len(members)), sizes)[known]
    a, b = [], []
    for key, items in queries:
        flags = np.zeros(len(vocabulary), bool)
        flags[np.searchsorted(vocabulary, items)] = True
        both = np.bincount(owner[flags[place]], minlength=len(members))
        for i in np.flatnonzero(100 * both >= THRESHOLD_PERCENT * (len(items) + sizes - both)):
            a.append(key)
            b.append(members[i][0])
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)


def _by_blocks(open_rows: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between large groups and the documents of other, smaller groups in their buckets, and
    among these documents.

    Such a document is compared with the whole group and with the others of its kind, once, however
    many buckets they share. Both sides are cut into blocks, and each block of one side meets each
    block of the other in a task of its own, so nothing but links is emitted and no task holds
    more than two blocks.
    """
    large = open_rows.filter(F.col("group_size") > LARGE_GROUP)
    large = large.select("key", F.col("component").alias("group"), F.col("group_size").alias("size")).distinct()
    queries = open_rows.join(large, "key").filter(
        (F.col("component") != F.col("group"))
        & (F.struct("group_size", "component") < F.struct(F.col("size").alias("group_size"), F.col("group").alias("component")))
    )
    queries = staged(queries.select("group", "size", F.col("rep").alias("id")).distinct(), "queries")
    counts = queries.groupBy("group", "size").agg(
        F.expr(f"(count(*) + {QUERY_BLOCK - 1}) div {QUERY_BLOCK}").alias("q_blocks"),
        F.expr(f"(size + count(*) + {MEMBER_BLOCK - 1}) div {MEMBER_BLOCK}").alias("m_blocks"),
    ).drop("size")

    def block(blocks: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.col(blocks))

    def each(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(blocks) - 1))

    asked = queries.drop("size").join(counts, "group").withColumn("q", block("q_blocks")).withColumn("m", each("m_blocks"))
    members = labels.select(F.col("component").alias("group"), "id").unionByName(queries.select("group", "id"))
    members = members.join(counts, "group")
    members = members.withColumn("m", block("m_blocks")).withColumn("q", each("q_blocks"))
    names = ["group", "q", "m", "kind", "id"]
    rows = asked.withColumn("kind", F.lit(0)).select(*names).union(members.withColumn("kind", F.lit(1)).select(*names))
    rows = rows.join(sets, "id").select(*names, "items")
    rows = rows.repartition("group", "q", "m").sortWithinPartitions("group", "q", "m", "kind", "id")
    small_batches(sets.sparkSession)
    return staged(rows.mapInArrow(_compare_blocks, "a long, b long"), "links")


def _sets(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Full shingle sets of the wanted ids."""
    small_batches(docs.sparkSession)
    rows = docs.selectExpr(f"cast(`{doc_id}` as bigint) as id", f"`{text}` as text").join(wanted, "id", "left_semi")
    return staged(rows.mapInArrow(_set_batches, "id long, items binary").filter("octet_length(items) > 0"), "sets")
