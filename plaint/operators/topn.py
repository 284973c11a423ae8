"""Ordered limits and exact-size samples.

A small limit is Spark's own top-k: every task keeps its best n rows and one task merges them.
With n in the hundred thousands and as many tasks as a large table has, that merge would pull
tasks x n rows into one task. So a large n is narrowed first: counts per bucket of the sort key
(one scan of the key alone, combined before the shuffle) tell in which bucket the n-th row lies,
and only rows up to that bucket are read in full and sorted. Where one hour of times holds too many
rows, a quantile sketch of its times gives a bound near the n-th row in one scan, and the next one
counts exactly: what lies before the bound, and by draw what lies on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaint.functions.sampling import draw, sketch_size

DIRECT = 10_000  # up to here, Spark's top-k alone
ENOUGH = 4  # stop narrowing once at most this many times n rows are left

RANK_ERROR = 0.001  # of a sketched bound, as a share of the rows

HOUR = 3_600  # seconds
LAST = 2**62  # time bucket of rows without a time: behind all others


def _boundary(df: DataFrame, bucket: Column, n: int) -> Row | None:
    """Bucket of the n-th row, with the rows up to its end and the rows in it.

    ``None`` when there are fewer than n rows. One row reaches the driver. The window runs over
    the counts, one row per bucket.
    """
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
    running = F.sum("rows").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    reached = counts.withColumn("upto", running).filter(F.col("upto") >= n)
    return reached.orderBy("bucket").limit(1).first()


def _by_rank(df: DataFrame, rows: int, n: int, key: Column, drawn: Column) -> tuple[int, Row]:
    """A key near that of the n-th of so many rows, and the boundary among the rows up to it: '' for
    those before the key, and the draws of those on it.

    A sketch that is off by more than its error gives a bound with fewer than n rows, and is made
    again further out; one over very many rows may leave too many, and is made again over these.
    """
    slack, size = 2 * RANK_ERROR, F.lit(sketch_size(RANK_ERROR))
    while True:
        share = F.lit(min(1.0, n / rows + slack))
        sketch = F.kll_sketch_agg_bigint(key, size)
        bound = df.agg(F.kll_sketch_get_quantile_bigint(sketch, share).alias("key")).first().key
        hit = _boundary(df.filter(key <= bound), F.when(key < bound, F.lit("")).otherwise(drawn), n)
        if hit is None:
            slack *= 4
        elif hit.bucket == "" and hit.rows > ENOUGH * n:
            df, rows = df.filter(key < bound), hit.rows
        else:
            return bound, hit


def _narrow(
    df: DataFrame, n: int, buckets: Sequence[Column], rank: tuple[Column, Column] | None = None
) -> tuple[DataFrame, list]:
    """Drop rows that cannot be among the first n, and give the boundary of each bucket used.

    ``buckets`` sort ascending; each one splits the ties of those before it. The next one is used
    only where too many rows share a bucket, as after a bulk change of all tickets at one instant.
    Given ``rank``, the rows of the first bucket are split by its key, and ties of that by its draw.
    """
    group, before, used, waiting = df, 0, [], list(buckets)
    while waiting:
        bucket = waiting.pop(0)
        hit = _boundary(group, bucket, n - before)
        if hit is None:
            break
        used.append((bucket, hit.bucket))
        before += hit.upto - hit.rows
        if hit.rows <= ENOUGH * n:
            break
        group = group.filter(bucket == hit.bucket)
        if rank:
            (key, drawn), rank = rank, None
            bound, hit = _by_rank(group, hit.rows, n - before, key, drawn)
            if hit.bucket == "":
                used.append((key, bound - 1))
                break
            used.extend([(key, bound), (drawn, hit.bucket)])
            before += hit.upto - hit.rows
            if hit.rows <= ENOUGH * n:
                break
            group = group.filter((key == bound) & (drawn == hit.bucket))
    keep = None
    for bucket, bound in reversed(used):
        inside = bucket <= bound if keep is None else (bucket < bound) | ((bucket == bound) & keep)
        keep = inside
    return (df if keep is None else df.filter(keep)), [bound for _, bound in used]


def _row_hash(df: DataFrame) -> Column:
    """Orders rows that tie in all else, so that a retry or another partitioning keeps the same."""
    return F.xxhash64(*df.columns)


def _draws(drawn: Column, row: Column) -> list[Column]:
    """Buckets of a drawn order: 65,536 by the draw, 65,536 in each of these, and as many again
    of the row's own hash, for rows that share one draw."""
    return [*[F.substring(drawn, 1, length) for length in (4, 8, 32)], F.shiftright(row, 48)]


def _hour(moment: str) -> Column:
    """The hour of a time, in seconds."""
    seconds = F.unix_seconds(moment)
    return seconds - F.pmod(seconds, F.lit(HOUR))


def _first(df: DataFrame, n: int, drawn: Column, before: Sequence[Column] = ()) -> DataFrame:
    """The first n rows by ``before``, then as drawn. The draw is computed once per row."""
    ordered = df.withColumn("_drawn", drawn).orderBy(*before, "_drawn", _row_hash(df))
    return ordered.limit(n).drop("_drawn")


def newest(
    df: DataFrame,
    n: int,
    moment: str = "last_activity",
    ties: Sequence[str] = ("ticket_id",),
    direct: int = DIRECT,
) -> DataFrame:
    """The n newest rows, newest first; rows without a time come last.

    Rows of one instant are ordered by a hash of ``ties``.
    """
    tie = draw("tie", list(ties))
    if n > direct:
        hour, key = (F.coalesce(-age, F.lit(LAST)) for age in (_hour(moment), F.unix_micros(moment)))
        first, *finer = _draws(tie, _row_hash(df))
        df, bounds = _narrow(df, n, [hour, *finer], (key, first))
        if bounds and bounds[0] != LAST:
            # The same bound on the bare column, which the scan can use to skip row groups.
            df = df.filter(F.col(moment) >= F.timestamp_seconds(F.lit(-bounds[0])))
    return _first(df, n, tie, [F.desc_nulls_last(moment)])


def cap_rows(
    df: DataFrame,
    n: int | None,
    order: Sequence[str] = ("timestamp", "ticket_id"),
    direct: int = DIRECT,
) -> DataFrame:
    """The first n rows in ``order``; all rows when n is None.

    A large n is narrowed by the first column of the order when that is a time.
    """
    if n is None:
        return df
    if n > direct and isinstance(df.schema[order[0]].dataType, T.TimestampType):
        hour, key = (F.coalesce(age, F.lit(LAST)) for age in (_hour(order[0]), F.unix_micros(order[0])))
        # Rows of one instant go by the rest of the order: none of them can be left out by a draw.
        df, _ = _narrow(df, n, [hour], (key, F.lit("tie")))
    return df.orderBy(*[F.asc_nulls_last(name) for name in order], _row_hash(df)).limit(n)


def order_counts(counts: DataFrame, key: str = "cluster") -> DataFrame:
    """Largest count first; equal counts by key."""
    return counts.orderBy(F.desc("count"), F.asc_nulls_last(key))


def sample_n(
    df: DataFrame,
    n: int,
    seed: int = 42,
    identity: Sequence[str] = ("ticket_id",),
    direct: int = DIRECT,
) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, drawn without replacement, the same in every run.

    ``identity`` tells rows apart. A sample of n rows begins every sample of more rows.
    """
    drawn = draw(seed, list(identity))
    if n > direct:
        df, _ = _narrow(df, n, _draws(drawn, _row_hash(df)))
    return _first(df, n, drawn)


def sample_per_group(
    df: DataFrame,
    key: str,
    n: int,
    seed: int = 42,
    identity: Sequence[str] = ("ticket_id",),
    position: str = "position",
) -> DataFrame:
    """Exactly ``min(n, rows)`` rows of each group, numbered from 1 in ``position``.

    Every task keeps at most n rows of a group before the shuffle, so a group that holds a third
    of the table does not reach one task. Catalyst does this for n up to a threshold; above it,
    the group is first cut into 256 parts by its hash.
    """
    drawn = draw(seed, list(identity))
    order = [drawn, _row_hash(df)]
    groups = df.filter(F.col(key).isNotNull())
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n > threshold:
        parts = Window.partitionBy(key, F.substring(drawn, 1, 2)).orderBy(*order)
        groups = groups.withColumn(position, F.row_number().over(parts))
        groups = groups.filter(F.col(position) <= n).drop(position)
    ranked = groups.withColumn(
        position, F.row_number().over(Window.partitionBy(key).orderBy(*order))
    )
    return ranked.filter(F.col(position) <= n)
