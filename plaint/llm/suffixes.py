"""Removal of bytes that an earlier document holds too, by sorting suffixes deep and shallow.

Sorting every suffix of a corpus is not needed to find its 50-byte repeats:

1. The anchor of a 50-byte string is the smallest hash among its 20-byte runs, and a zone is a run
   of such strings of one document with one anchor. Equal strings have equal anchors.
2. Zones meet by anchor. Where a whole zone occurs in several documents, all but the first lose it.
3. Where one anchor stands in different zones, at the edges of copies, the suffixes at all starts of
   the zones' strings are sorted: multikey steps of eight bytes to a shallow depth, then a blind
   trie for each group that still shares its prefix. Neighbours that share 50 bytes are one string,
   and the smallest document keeps it.

Hashes only decide which zones meet within a task or are copies of each other; zones that differ
are compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaint.llm.batches import CHUNK_BYTES, Powers, chunks, column, mix, per_batch, small_batches, staged
from plaint.llm.phrases import sliding_argmin

MATCH = 50
GRAM = 20
GRAMS = MATCH - GRAM + 1
SHALLOW = 24
# Anchors that a task gathers before it sends them on: what one document of them repeats from
# another is settled there, so a passage that everyone has is sent once per so many anchors.
FLUSH_ANCHORS = 400_000
FLUSH_DOCS = 60_000
# Text bytes per bucket of anchors or documents: what a task holds at once follows this, and the
# number of packed rows between buckets follows the data and not the number of partitions.
BUCKET_BYTES = 4 << 20

ANCHORS, MATCHES, REQUESTS, TEXT = 0, 1, 2, 3
_BLOBS = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("blob", pa.binary())])
BLOBS_DDL = "kind int, bucket int, blob binary"
_PACKED = pa.schema(
    [("kind", pa.int32()), ("bucket", pa.int32()), ("blob", pa.binary()), ("uid", pa.int64()), ("doc_id", pa.int64())]
)
PACKED_DDL = BLOBS_DDL + ", uid long, doc_id long"
_PARSED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("uid", pa.int64()),
        ("n_bytes", pa.int64()),
        ("spans", pa.list_(pa.int64())),
        ("sha256", pa.string()),
        ("content", pa.binary()),
        ("bucket", pa.int32()),
        ("anchor", pa.int64()),
        ("key", pa.int64()),
    ]
)
PARSED_DDL = (
    "doc_id long, uid long, n_bytes long, spans array<long>, sha256 string, content binary, "
    "bucket int, anchor long, key long"
)
_EDGES = pa.schema([("uid", pa.int64()), ("key", pa.int64()), ("low", pa.int32()), ("high", pa.int32())])
EDGES_DDL = "uid long, key long, low int, high int"
_CUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
    ]
)
CUT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


class ByteZones:
    """Zones of a run of texts: row, anchor and content hash of 48 bits each, first and last start."""

    def __init__(self, content: np.ndarray, rows: np.ndarray, powers: Powers) -> None:
        count = len(content) - MATCH + 1
        if count < 1:
            self.row = self.first = self.last = np.zeros(0, np.int64)
            self.g = self.z = self.key = np.zeros(0, np.uint64)
            return
        sums = powers.prefix(content)
        at = np.arange(len(content) - GRAM + 1)
        grams = powers.between(sums, at, at + GRAM)
        owner = sliding_argmin(grams, GRAMS)[:count]
        sizes = np.diff(rows)
        row = np.repeat(np.arange(len(sizes)), sizes)[:count]
        valid = at[:count] + MATCH <= rows[row + 1]
        change = np.ones(count, bool)
        change[1:] = (owner[1:] != owner[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(change & valid)
        ends = np.flatnonzero(np.append((change | ~valid)[1:], True) & valid)
        self.row, self.first, self.last = row[first], first, ends
        self.g = grams[owner[first]] >> np.uint64(16)
        self.z = powers.between(sums, first, ends + MATCH) >> np.uint64(16)
        self.key = mix(mix(self.g) + self.z)


def zones_of(texts: list[bytes], powers: Powers) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """First and last starts, anchors and keys of the zones of each text, worked on together."""
    first = 0
    while first < len(texts):
        end, size = first, 0
        while end < len(texts) and (end == first or size + len(texts[end]) <= CHUNK_BYTES):
            size += len(texts[end])
            end += 1
        rows = np.cumsum([0, *map(len, texts[first:end])])
        zones = ByteZones(np.frombuffer(b"".join(texts[first:end]), np.uint8), rows, powers)
        cuts = np.searchsorted(zones.row, np.arange(end - first + 1))
        for r in range(end - first):
            own = slice(cuts[r], cuts[r + 1])
            yield zones.first[own] - rows[r], zones.last[own] - rows[r], zones.g[own], zones.key[own]
        first = end


def bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(values.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)


def _pack48(values: np.ndarray) -> bytes:
    return (values >> np.uint64(16)).astype(np.uint32).tobytes() + values.astype(np.uint16).tobytes()


def _unpack48(blob: bytes, at: int, count: int) -> tuple[np.ndarray, int]:
    high = np.frombuffer(blob, np.uint32, count, at).astype(np.uint64)
    low = np.frombuffer(blob, np.uint16, count, at + 4 * count)
    return (high << np.uint64(16)) | low, at + 6 * count


def pack_anchors(g: np.ndarray, z: np.ndarray, uids: np.ndarray) -> bytes:
    names, places = np.unique(uids, return_inverse=True)
    head = np.array([len(g), len(names)], np.int64).tobytes()
    return head + names.tobytes() + _pack48(g) + _pack48(z) + places.astype(np.uint16).tobytes()


def unpack_anchors(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    count, names = (int(x) for x in np.frombuffer(blob, np.int64, 2))
    uids = np.frombuffer(blob, np.int64, names, 16)
    g, at = _unpack48(blob, 16 + 8 * names, count)
    z, at = _unpack48(blob, at, count)
    return g, z, uids[np.frombuffer(blob, np.uint16, count, at)]


def first_holders(g: np.ndarray, z: np.ndarray, uids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by anchor, zone and document; which of these are first in their zone; which repeat a
    zone of an earlier document."""
    order = np.lexsort((uids, z, g))
    g, z, uids = g[order], z[order], uids[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (z[1:] != z[:-1])
    holder = uids[np.flatnonzero(new)][np.cumsum(new) - 1] if len(g) else uids
    later = uids != holder
    later[1:] &= ~((uids[1:] == uids[:-1]) & ~new[1:])
    return order, new, later


def dealt(kind: int, buckets: np.ndarray, *columns: np.ndarray, pack) -> Iterator[tuple[int, int, bytes]]:
    """One packed row per bucket."""
    order = np.argsort(buckets, kind="stable")
    buckets, columns = buckets[order], tuple(c[order] for c in columns)
    starts = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])) if len(buckets) else []
    for lo, hi in zip(starts, [*starts[1:], len(buckets)]):
        yield kind, int(buckets[lo]), pack(*(c[lo:hi] for c in columns))


def pack_pairs(uids: np.ndarray, keys: np.ndarray) -> bytes:
    return np.stack([uids.view(np.int64), keys.view(np.int64)]).tobytes()


def unpack_pairs(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.int64).reshape(2, -1)


def _blob_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kinds, buckets, blobs = zip(*rows)
    arrays = [pa.array(kinds, pa.int32()), pa.array(buckets, pa.int32()), pa.array(blobs, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, schema=_BLOBS)


def zone_key(g: np.ndarray, z: np.ndarray) -> np.ndarray:
    return mix(mix(g) + z)


def _anchor_rows(buckets: int):
    """Anchors of all documents by bucket; repeats among the gathered documents are settled."""

    def flush(g: list, z: list, uids: list) -> Iterator[pa.RecordBatch]:
        if not g:
            return
        g, z, uids = np.concatenate(g), np.concatenate(z), np.concatenate(uids)
        order, new, later = first_holders(g, z, uids)
        g, z, uids = g[order], z[order], uids[order]
        rows = [
            *dealt(ANCHORS, (g[new] % np.uint64(buckets)).astype(np.int32), g[new], z[new], uids[new], pack=pack_anchors),
            *dealt(MATCHES, bucket_of(uids[later], buckets), uids[later], zone_key(g[later], z[later]), pack=pack_pairs),
        ]
        if rows:
            yield _blob_batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        g, z, uids, anchors, docs = [], [], [], 0, 0
        for batch in batches:
            own = column(batch, "uid").to_numpy()
            for first, end, content, rows in chunks(column(batch, "text")):
                zones = ByteZones(content, rows, powers)
                g.append(zones.g)
                z.append(zones.z)
                uids.append(own[first:end][zones.row])
                anchors += len(zones.g)
                docs += end - first
                if anchors >= FLUSH_ANCHORS or docs >= FLUSH_DOCS:
                    yield from flush(g, z, uids)
                    g, z, uids, anchors, docs = [], [], [], 0, 0
        yield from flush(g, z, uids)

    return run


def _settle(buckets: int):
    """Per bucket of anchors: later holders of a zone, and first holders where zones differ."""

    def settle(blobs: list[bytes]) -> list[tuple[int, int, bytes]]:
        parts = [unpack_anchors(b) for b in blobs]
        g, z, uids = (np.concatenate(c) for c in zip(*parts))
        order, new, later = first_holders(g, z, uids)
        g, z, uids = g[order], z[order], uids[order]
        rows = list(
            dealt(MATCHES, bucket_of(uids[later], buckets), uids[later], zone_key(g[later], z[later]), pack=pack_pairs)
        )
        g, z, uids = g[new], z[new], uids[new]
        start = np.append(True, g[1:] != g[:-1])
        group = np.cumsum(start) - 1
        at = np.flatnonzero(start)
        several = np.maximum.reduceat(uids, at) != np.minimum.reduceat(uids, at)
        wanted = several[group]
        rows.extend(
            dealt(REQUESTS, bucket_of(uids[wanted], buckets), uids[wanted], zone_key(g[wanted], z[wanted]), pack=pack_pairs)
        )
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, blobs = None, []
        for batch in batches:
            out: list[tuple[int, int, bytes]] = []
            for kind, bucket, blob in zip(*(column(batch, n).to_pylist() for n in _BLOBS.names)):
                if kind == MATCHES:
                    out.append((kind, bucket, blob))
                    continue
                if bucket != current and blobs:
                    out.extend(settle(blobs))
                    blobs = []
                current = bucket
                blobs.append(blob)
            if out:
                yield _blob_batch(out)
        if blobs and (out := settle(blobs)):
            yield _blob_batch(out)

    return run


def _pack_texts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)

        def work(batch: pa.RecordBatch) -> dict:
            uids = column(batch, "uid")
            return {
                "kind": np.full(batch.num_rows, TEXT, np.int32),
                "bucket": bucket_of(uids.to_numpy(), buckets),
                "blob": [pack.compress((t.as_py() or "").encode()) for t in column(batch, "text")],
                "uid": uids,
                "doc_id": column(batch, "doc_id"),
            }

        yield from per_batch(_PACKED, work)(batches)

    return run


def named(uids: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """One number for a zone of a document."""
    return mix(mix(uids.view(np.uint64)) + keys.view(np.uint64))


class Known:
    """The pairs of one bucket, for lookups."""

    def __init__(self, blobs: list[bytes]) -> None:
        pairs = [unpack_pairs(b) for b in blobs]
        names = [named(np.ascontiguousarray(p[0]), np.ascontiguousarray(p[1])) for p in pairs]
        self.names = np.unique(np.concatenate(names)) if names else np.zeros(0, np.uint64)

    def holds(self, names: np.ndarray) -> np.ndarray:
        if not len(self.names):
            return np.zeros(len(names), bool)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        return self.names[at] == names


def merged(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Flat maximal runs of intervals in order of their starts; touching ones are one."""
    if not len(low):
        return np.zeros(0, np.int64)
    reach = np.maximum.accumulate(high)
    start = np.append(True, low[1:] > reach[:-1])
    at = np.flatnonzero(start)
    return np.stack([low[at], reach[np.append(at[1:], len(low)) - 1]], axis=1).ravel()


def _parse(buckets: int):
    """Documents beside their matches and requests: matched runs, and the zones that were asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, unpack = Powers(), zstandard.ZstdDecompressor()
        current, blobs, known = None, {MATCHES: [], REQUESTS: []}, None
        for batch in batches:
            out: list[tuple] = []
            kinds, places = column(batch, "kind").to_pylist(), column(batch, "bucket").to_pylist()
            packed = column(batch, "blob").to_pylist()
            uids, ids = column(batch, "uid").to_pylist(), column(batch, "doc_id").to_pylist()
            raws = [unpack.decompress(p) if k == TEXT else b"" for p, k in zip(packed, kinds)]
            found = zones_of(raws, powers)
            for i, (kind, raw, (first, last, g, keys)) in enumerate(zip(kinds, raws, found)):
                if places[i] != current:
                    current, blobs, known = places[i], {MATCHES: [], REQUESTS: []}, None
                if kind != TEXT:
                    blobs[kind].append(packed[i])
                    continue
                if known is None:
                    known = {k: Known(v) for k, v in blobs.items()}
                    blobs = {MATCHES: [], REQUESTS: []}
                names = named(np.full(len(keys), uids[i], np.int64), keys)
                gone = known[MATCHES].holds(names)
                spans = merged(first[gone], last[gone] + MATCH)
                asked = np.flatnonzero(known[REQUESTS].holds(names))
                open_text = len(spans) or len(asked)
                digest = None if open_text else hashlib.sha256(raw).hexdigest()
                out.append((ids[i], uids[i], len(raw), spans, digest, packed[i] if open_text else None, None, None, None))
                _, once = np.unique(keys[asked], return_index=True)
                for j in asked[once]:
                    content, anchor = raw[first[j] : last[j] + MATCH], int(g[j])
                    out.append((None, uids[i], None, None, None, content, anchor % buckets, anchor, int(keys[j].view(np.int64))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PARSED)], schema=_PARSED)

    return run


class BlindTrie:
    """Strings of one length by the places where they differ; equal strings share a leaf.

    An inner node is [depth, {byte: node}] and a leaf is [string, members]. A search looks only at
    the bytes where nodes branch; one comparison with the leaf it ends at finds the true place.
    """

    def __init__(self) -> None:
        self.root: list | None = None

    def insert(self, string: bytes, member: int) -> None:
        if self.root is None:
            self.root = [string, [member]]
            return
        node = self.root
        while isinstance(node[1], dict):
            node = node[1].get(string[node[0]]) or next(iter(node[1].values()))
        if node[0] == string:
            node[1].append(member)
            return
        other, depth = node[0], 0
        while string[depth] == other[depth]:
            depth += 1
        above, node = None, self.root
        while isinstance(node[1], dict) and node[0] < depth:
            above, node = node, node[1][string[node[0]]]
        leaf = [string, [member]]
        if isinstance(node[1], dict) and node[0] == depth:
            node[1][string[depth]] = leaf
            return
        inner = [depth, {string[depth]: leaf, other[depth]: node}]
        if above is None:
            self.root = inner
        else:
            above[1][string[above[0]]] = inner

    def leaves(self) -> Iterator[list[int]]:
        """Members of each leaf, in the order of their strings."""
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if isinstance(node[1], dict):
                stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
            else:
                yield node[1]


def eight_bytes(buffer: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The next eight bytes of each suffix as one character that sorts alike."""
    out = np.zeros(len(starts), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | buffer[starts + (depth + i)]
    return out


def deep_shallow_sort(buffer: np.ndarray, starts: np.ndarray, length: int = MATCH) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by their first `length` bytes, and for each place in that order
    whether its string differs from the one before."""
    order = np.arange(len(starts))
    new = np.zeros(len(starts), bool)
    new[:1] = True
    # Shallow: a multikey step orders each group by its next character and cuts it where that
    # changes. Groups of one are done.
    for depth in range(0, SHALLOW, 8):
        group = np.cumsum(new)
        alone = new & np.append(new[1:], True)
        places = np.flatnonzero(~alone)
        if not len(places):
            return order, new
        character = eight_bytes(buffer, starts[order[places]], depth)
        inner = np.lexsort((character, group[places]))
        order[places] = order[places][inner]
        character, own = character[inner], group[places]
        cut = np.append(True, (character[1:] != character[:-1]) | (own[1:] != own[:-1]))
        new[places] = cut
    # Deep: what shares the shallow prefix goes through a blind trie.
    edges = np.flatnonzero(new)
    sizes = np.diff(np.append(edges, len(order)))
    raw = buffer.tobytes()
    for lo, size in zip(edges[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        trie = BlindTrie()
        for member in order[lo : lo + size].tolist():
            at = int(starts[member])
            trie.insert(raw[at + SHALLOW : at + length], member)
        at = lo
        for members in trie.leaves():
            order[at : at + len(members)] = members
            new[at] = True
            new[at + 1 : at + len(members)] = False
            at += len(members)
    return order, new


def later_strings(contents: list[bytes], uids: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs (zone, first string, last string) of strings that a smaller document among them has."""
    buffer = np.frombuffer(b"".join(contents), np.uint8)
    sizes = np.array([len(c) for c in contents])
    counts = sizes - MATCH + 1
    zone = np.repeat(np.arange(len(contents)), counts)
    number = np.arange(len(zone)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.repeat(np.cumsum(sizes) - sizes, counts) + number
    order, new = deep_shallow_sort(buffer, starts)
    edges = np.flatnonzero(new)
    owner = uids[zone[order]]
    first = np.repeat(np.minimum.reduceat(owner, edges), np.diff(np.append(edges, len(order))))
    late = np.zeros(len(zone), bool)
    late[order] = owner > first
    places = np.flatnonzero(late)
    if len(places):
        start = np.append(True, (np.diff(places) > 1) | (zone[places][1:] != zone[places][:-1]))
        at = np.flatnonzero(start)
        last = places[np.append(at[1:], len(places)) - 1]
        yield from zip(zone[places[at]].tolist(), number[places[at]].tolist(), number[last].tolist())


def _sort_zones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket: the strings of a bucket's zones are sorted together."""

    def settle(contents: list[bytes], uids: list[int], keys: list[int]) -> pa.RecordBatch:
        found = [(uids[z], keys[z], lo, hi) for z, lo, hi in later_strings(contents, np.array(uids, np.int64))]
        columns = zip(*found) if found else [[] for _ in _EDGES]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _EDGES)], schema=_EDGES)

    current, contents, uids, keys = None, [], [], []
    for batch in batches:
        rows = zip(*(column(batch, n).to_pylist() for n in ("bucket", "content", "uid", "key")))
        for bucket, content, uid, key in rows:
            if bucket != current and contents:
                yield settle(contents, uids, keys)
                contents, uids, keys = [], [], []
            current = bucket
            contents.append(content)
            uids.append(uid)
            keys.append(key)
    if contents:
        yield settle(contents, uids, keys)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers, unpack = Powers(), zstandard.ZstdDecompressor()

    def work(batch: pa.RecordBatch) -> dict:
        out: dict = {name: [] for name in _CUT.names}
        out["doc_id"], out["n_bytes"] = column(batch, "doc_id"), column(batch, "n_bytes")
        raws = [unpack.decompress(p) for p in column(batch, "content").to_pylist()]
        asked = column(batch, "edges").to_pylist()
        found_zones = zones_of([raw if edges else b"" for raw, edges in zip(raws, asked)], powers)
        rows = zip(raws, column(batch, "spans").to_pylist(), asked, found_zones)
        for raw, spans, edges, (first, _, _, keys) in rows:
            low, high = [np.array(spans[::2], np.int64)], [np.array(spans[1::2], np.int64)]
            if edges:
                # Edges of another text under this id have keys that this text may not have.
                places: dict[int, list[int]] = {}
                for at, key in zip(first.tolist(), keys.view(np.int64).tolist()):
                    places.setdefault(key, []).append(at)
                found = [(at + e["low"], at + e["high"] + MATCH) for e in edges for at in places.get(e["key"], ())]
                low.append(np.array([f[0] for f in found], np.int64))
                high.append(np.array([f[1] for f in found], np.int64))
            low_all, high_all = np.concatenate(low), np.concatenate(high)
            order = np.argsort(low_all, kind="stable")
            runs = merged(low_all[order], high_all[order]).tolist()
            kept = [raw[a:b] for a, b in zip([0, *runs[1::2]], [*runs[::2], len(raw)])]
            out["n_removed"].append(sum(runs[1::2]) - sum(runs[::2]))
            out["n_spans"].append(len(runs) // 2)
            out["kept_sha256"].append(hashlib.sha256(b"".join(kept)).hexdigest())
        return out

    yield from per_batch(_CUT, work)(batches)


def remove_earlier_bytes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes when a 50-byte string over it also starts in a document with a smaller id. Null
    texts are empty; texts under 50 bytes lose nothing. Rows without an id come after all others,
    in the order of their texts' hashes. Rows with one id do not count as smaller than each other.
    An empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    size = docs.selectExpr(f"coalesce(sum(octet_length(`{text}`)), 0) as size").first().size
    buckets = int(size) // BUCKET_BYTES + 1
    rows = docs.selectExpr(
        f"cast(`{doc_id}` as bigint) as doc_id",
        f"coalesce(cast(`{doc_id}` as bigint), shiftleft(1L, 62) | (xxhash64(`{text}`) & (shiftleft(1L, 62) - 1))) as uid",
        f"`{text}` as text",
    )
    small_batches(spark)
    anchors = rows.mapInArrow(_anchor_rows(buckets), BLOBS_DDL)
    anchors = anchors.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket")
    pairs = staged(anchors.mapInArrow(_settle(buckets), BLOBS_DDL), "zones")

    packed = rows.mapInArrow(_pack_texts(buckets), PACKED_DDL)
    beside = pairs.withColumns({"uid": F.lit(None).cast("bigint"), "doc_id": F.lit(None).cast("bigint")})
    both = beside.unionByName(packed).repartition("bucket").sortWithinPartitions("bucket", "kind")
    parsed = staged(both.mapInArrow(_parse(buckets), PARSED_DDL), "parsed")

    zones = parsed.filter("bucket is not null").select("bucket", "anchor", "uid", "key", "content")
    zones = zones.repartition("bucket").sortWithinPartitions("bucket", "anchor", "uid", "key")
    edges = zones.mapInArrow(_sort_zones, EDGES_DDL)
    edges = edges.groupBy("uid").agg(F.collect_list(F.struct("key", "low", "high")).alias("edges"))

    whole = parsed.filter("bucket is null")
    none = F.lit(0).cast("bigint")
    done = whole.filter("content is null").select(
        "doc_id",
        "n_bytes",
        none.alias("n_removed"),
        none.alias("n_spans"),
        F.col("sha256").alias("kept_sha256"),
    )
    open_texts = whole.filter("content is not null").select("doc_id", "uid", "n_bytes", "spans", "content")
    cut = open_texts.join(edges, "uid", "left").select("doc_id", "n_bytes", "spans", "content", "edges")
    return done.unionByName(cut.mapInArrow(_cut, CUT_DDL))
