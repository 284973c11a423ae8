"""Shards along a Hilbert curve over metadata, so that each file covers few values of each column.

Only DataFrame functions. Several metadata columns are quantised to a few bits each, their cell on
the curve is the sort key, and the sorted rows are cut into runs of equal row counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaint.llm.batches import staged

BITS = 5
SHARDS = 8
# monotonically_increasing_id keeps the row's number within its partition in the low 33 bits.
ROW_BITS = 33


def _number(value: Column, skip: int) -> Column:
    """The bytes of a text after the first `skip` as a number that sorts alike, as far as 7 bytes go."""
    digits = F.rpad(F.hex(F.substring(F.encode(value.cast("string"), "UTF-8"), skip + 1, 7)), 14, "0")
    return F.conv(digits, 16, 10).cast("bigint")


def category_bounds(rows: DataFrame, names: tuple[str, ...], bits: int = BITS) -> dict[str, tuple[int, list[int]]]:
    """Per category, the bytes that all values begin with, and the bounds of its cells: quantiles of
    the values, so that cells hold like shares of the rows and cover ranges of names.

    Two scans of these columns alone. The driver sees one row, whatever the number of values.
    """
    text = {name: F.col(name).cast("string") for name in names}
    ends = rows.agg(*[f(c).alias(f"{n}_{k}") for n, c in text.items() for k, f in (("low", F.min), ("high", F.max))]).first()
    skip = {}
    for name in names:
        low, high = ((ends[f"{name}_{k}"] or "").encode() for k in ("low", "high"))
        skip[name] = next((i for i, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))
    inner = (1 << bits) - 2
    ranks = F.array(*[F.lit((i + 1) / (inner + 1)) for i in range(inner)])
    quantiles = [
        F.when(F.count(name) > 0, F.kll_sketch_get_quantile_bigint(F.kll_sketch_agg_bigint(_number(c, skip[name])), ranks)).alias(name)
        for name, c in text.items()
    ]
    found = rows.agg(*quantiles).first() if names else {}
    return {name: (skip[name], list(found[name] or [])) for name in names}


def quantised(value: Column, skip: int, bounds: list[int]) -> Column:
    """A category as a cell number: equal values share a cell, cells follow the order of the values,
    and NULL has cell 0."""
    limits = F.array(*map(F.lit, bounds)).cast("array<bigint>")
    # In a one-element array, so that the number is made once and not for every bound.
    passed = F.transform(F.array(_number(value, skip)), lambda number: F.size(F.filter(limits, lambda b: b <= number)))
    return F.when(value.isNull(), 0).otherwise(F.element_at(passed, 1) + 1).cast("bigint")


def magnitude(value: Column, bits: int = BITS) -> Column:
    """A size as its number of bits, at most 2**bits - 1; NULL and values below 1 have cell 0."""
    binary = F.length(F.bin(F.greatest(F.coalesce(value, F.lit(0)), F.lit(0)).cast("bigint")))
    return F.when(F.coalesce(value, F.lit(0)) < 1, 0).otherwise(
        F.least(binary, F.lit((1 << bits) - 1))
    ).cast("bigint")


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Position of a cell on the Hilbert curve through a cube of 2**bits cells a side.

    The public transform from axes to the transposed index, as a fold over (bit, axis) steps with
    the array of axes as its state.
    """
    axes = F.array(*cells)
    count = len(cells)

    def flip(state: Column, step: Column) -> Column:
        bit, axis = step["bit"], step["axis"]
        low = bit - F.lit(1).cast("bigint")
        first, own = F.element_at(state, 1), F.element_at(state, axis + 1)
        swap = (first.bitwiseXOR(own)).bitwiseAND(low)
        inverted = F.transform(state, lambda v, j: F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))
        swapped = F.transform(
            state,
            lambda v, j: F.when(
                (axis != 0) & ((j == 0) | (j == axis)), v.bitwiseXOR(swap)
            ).otherwise(v),
        )
        return F.when(own.bitwiseAND(bit) != 0, inverted).otherwise(swapped)

    steps = [
        F.struct(F.lit(1 << b).cast("bigint").alias("bit"), F.lit(a).alias("axis"))
        for b in range(bits - 1, 0, -1)
        for a in range(count)
    ]
    turned = F.aggregate(F.array(*steps), axes, flip)
    # Gray code: each axis takes the exclusive or of all axes up to its own.
    gray = F.transform(
        F.sequence(F.lit(1), F.lit(count)),
        lambda n: F.aggregate(F.slice(turned, F.lit(1), n), F.lit(0).cast("bigint"), lambda a, v: a.bitwiseXOR(v)),
    )

    def finish(state: Column) -> Column:
        last = F.element_at(state, -1)
        masks = [
            F.when(last.bitwiseAND(F.lit(1 << b).cast("bigint")) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0))
            for b in range(1, bits)
        ]
        mask = reduce(lambda a, b: a.bitwiseXOR(b), masks).cast("bigint")
        return F.transform(state, lambda v: v.bitwiseXOR(mask))

    positions = [
        F.struct(F.lit(1 << b).cast("bigint").alias("bit"), F.lit(a).alias("axis"))
        for b in range(bits - 1, -1, -1)
        for a in range(count)
    ]

    def interleave(state: Column) -> Column:
        def append(index: Column, place: Column) -> Column:
            own = F.element_at(state, place["axis"] + 1).bitwiseAND(place["bit"])
            return F.shiftleft(index, 1) + F.when(own != 0, F.lit(1)).otherwise(F.lit(0))

        return F.aggregate(F.array(*positions), F.lit(0).cast("bigint"), append)

    # transform over a one-element array gives a name to a value that is used several times.
    done = F.transform(F.array(gray), finish)
    return F.element_at(F.transform(done, interleave), 1)


def hilbert_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    doc_id: str = "doc_id",
    text: str = "text",
    categories: tuple[str, ...] = ("source", "lang"),
    keep: bool = False,
) -> DataFrame:
    """One row per input row: its place on the curve, its shard and its slot there.

    Dimensions are the size of the text and the given categories. Row counts of shards are at most
    one apart (law ``rows``). Rows of one cell are ordered by text checksum and id, so equal texts
    with equal metadata are neighbours, and a cell with a third of all rows is cut like any other
    stretch. The place of a row is its partition's offset plus its number in the partition: no
    window over all rows. ``keep`` adds ``input_row``, all
    its columns.

    Null text: no bytes, size 1, checksum of no bytes. Null ids and metadata sort first. Repeated
    rows get slots of their own. An empty table gives an empty result. Other columns are ignored.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    size = (F.octet_length(content) + 1).cast("bigint")
    bounds = category_bounds(docs, categories)
    cells = [magnitude(size), *[quantised(F.col(c), *bounds[c]) for c in categories]]
    kept = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("input_row")] if keep else []
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        size.alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        hilbert_index(cells).alias("curve"),
        F.monotonically_increasing_id().alias("seen"),
        *kept,
    )
    order = ["curve", "text_crc32", "doc_id", "seen"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("seen")
    number = F.monotonically_increasing_id()
    ranked = ranked.withColumn("part", F.shiftright(number, ROW_BITS)).withColumn(
        "row", number.bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    )
    ranked = staged(ranked, "hilbert")
    # One row per partition: the window is as long as the number of partitions.
    running = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = ranked.groupBy("part").agg(F.count("*").alias("n"))
    counts = counts.withColumn("total", F.sum("n").over(running))
    all_rows = counts.agg(F.max("total").alias("all_rows"))
    offsets = counts.select("part", (F.col("total") - F.col("n")).alias("offset"))
    placed = ranked.join(offsets, "part").join(all_rows)
    rank = F.col("offset") + F.col("row")
    # The first `longer` shards hold one row more than the others.
    short = F.expr(f"all_rows div {shards}")
    longer = F.expr(f"all_rows % {shards}")
    cut = longer * (short + 1)
    placed = placed.withColumn("rank", rank).withColumn("short", short).withColumn("cut", cut)
    placed = placed.withColumn(
        "shard",
        F.when(F.col("rank") < F.col("cut"), F.expr("rank div (short + 1)")).otherwise(
            longer + F.expr("(rank - cut) div greatest(short, 1)")
        ),
    )
    start = F.col("shard") * F.col("short") + F.least(F.col("shard"), longer)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("rank") - start).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
        *["input_row"] * keep,
    )


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write documents as one folder per shard, in curve order, for pruning by file statistics.

    Rows are written from where they were ranked, so repeated rows and ids stay as they are. The
    folders' column is ``shard``, with underscores before it where documents have one themselves.
    """
    placed = hilbert_shards(docs, keep=True, **options)
    folder = "shard"
    while folder in {name.lower() for name in docs.columns}:
        folder = f"_{folder}"
    runs = placed.select(F.col("shard").alias("_at"), "slot", F.expr("slot div 100000").alias("_run"), "input_row")
    ordered = runs.repartition("_at", "_run").sortWithinPartitions("_at", "slot")
    # A column of the documents may have any name: they are taken out of the row at the end.
    ordered.select(F.col("_at").alias(folder), "input_row.*").write.partitionBy(folder).parquet(path)
