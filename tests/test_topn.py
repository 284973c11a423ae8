"""Limits, samples and medians against plain Python, with skew."""

from __future__ import annotations

import datetime as dt
import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from plaint.operators import aggregates, topn

START = dt.datetime(2024, 1, 1)


def key_of(row, seed, names):
    return hashlib.md5(":".join([str(seed), *["" if row[n] is None else str(row[n]) for n in names]]).encode()).hexdigest()


@pytest.fixture(scope="module")
def skewed():
    """2,000 rows: a third at one instant, a third without a time, blank ids among them."""
    draw = random.Random(5)
    made = []
    for i in range(2_000):
        moment = [START, None, START + dt.timedelta(seconds=draw.randrange(10**6))][i % 3]
        ticket = ["", None, f"T{i}", f"T{i % 50}"][draw.randrange(4)]
        group = "hot" if i % 3 else f"g{draw.randrange(5)}"
        made.append({"n": i, "ticket_id": ticket, "last_activity": moment, "cluster": group})
    return made


@pytest.fixture(scope="module")
def frame(spark, skewed):
    schema = "n int, ticket_id string, last_activity timestamp, cluster string"
    made = spark.createDataFrame([tuple(r.values()) for r in skewed], schema)
    return made.repartition(13).persist()


@pytest.mark.parametrize("n", [1, 40, 700, 900, 1_400, 1_990, 2_000, 5_000])
def test_newest_equals_sorting_everything(frame, skewed, n):
    names = ("ticket_id", "n")

    def order(row):
        moment = row["last_activity"]
        return (
            (moment is None, -(moment - START).total_seconds() if moment else 0),
            key_of(row, "tie", names),
        )

    expected = [row["n"] for row in sorted(skewed, key=order)[:n]]
    for direct in (0, 10**9):
        found = topn.newest(frame, n, ties=names, direct=direct)
        assert [row.n for row in found.collect()] == expected


@pytest.mark.parametrize("n", [1, 10, 333, 1_999, 2_000, 3_000])
def test_sample_is_exact_and_a_beginning_of_larger_ones(frame, skewed, n):
    expected = [r["n"] for r in sorted(skewed, key=lambda r: key_of(r, 42, ["n"]))]
    for direct in (0, 10**9):
        found = topn.sample_n(frame, n, identity=["n"], direct=direct)
        assert [row.n for row in found.collect()] == expected[:n]


def test_sample_of_rows_that_share_an_identity_keeps_its_size(frame):
    assert topn.sample_n(frame, 500, identity=["cluster"], direct=0).count() == 500


def test_sample_does_not_depend_on_partitions(frame):
    found = [
        {r.n for r in topn.sample_n(frame.repartition(p), 100, identity=["n"], direct=0).collect()}
        for p in (1, 5, 40)
    ]
    assert found[0] == found[1] == found[2]


def test_another_seed_gives_another_sample(frame):
    first, second = (
        {r.n for r in topn.sample_n(frame, 100, seed, identity=["n"]).collect()} for seed in (1, 2)
    )
    assert len(first & second) < 60


@pytest.mark.parametrize("threshold", [1_000, 5])
@pytest.mark.parametrize("n", [3, 10, 5_000])
def test_sample_per_group(spark, frame, skewed, n, threshold):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
    try:
        found = topn.sample_per_group(frame, "cluster", n, identity=["n"]).collect()
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    groups = {}
    for row in sorted(skewed, key=lambda r: key_of(r, 42, ["n"])):
        groups.setdefault(row["cluster"], []).append(row["n"])
    expected = {(g, i + 1, m) for g, members in groups.items() for i, m in enumerate(members[:n])}
    assert {(r.cluster, r.position, r.n) for r in found} == expected


def test_small_group_samples_are_cut_before_the_shuffle(frame):
    plan = topn.sample_per_group(frame, "cluster", 10, identity=["n"])._jdf.queryExecution().toString()
    assert "Partial" in plan.split("Physical Plan")[1] and "WindowGroupLimit" in plan


def test_cap_rows_without_a_number_keeps_all(frame):
    assert topn.cap_rows(frame, None).count() == 2_000
    assert topn.cap_rows(frame, 20, ["last_activity", "n"]).count() == 20


@pytest.mark.parametrize("spread", ["within one hour", "over years"])
def test_many_rows_are_narrowed_in_small_steps(spark, spread, monkeypatch):
    step = "id" if spread == "within one hour" else "id * 7200000000"
    frame = spark.range(30_000).selectExpr(
        f"timestamp_micros(1704067200000000 + {step}) as timestamp", "timestamp_micros(1704067200000000 + id) as last_activity", "cast(id as string) as ticket_id"
    )
    sizes = []
    plain = topn._boundary

    def counted(df, bucket, n):
        sizes.append(df.select(bucket.alias("b")).distinct().count())
        return plain(df, bucket, n)

    monkeypatch.setattr(topn, "_boundary", counted)
    newest = [r.ticket_id for r in topn.newest(frame, 50, direct=0).collect()]
    assert newest == [str(i) for i in range(29_999, 29_949, -1)] and max(sizes) <= 3_600
    capped = [r.ticket_id for r in topn.cap_rows(frame, 50, direct=0).collect()]
    assert capped == [str(i) for i in range(50)]


def test_limits_of_nothing(spark, frame):
    empty = frame.limit(0)
    assert topn.newest(empty, 5, direct=0).collect() == []
    assert topn.sample_n(empty, 5, direct=0).collect() == []
    assert topn.sample_per_group(empty, "cluster", 5).collect() == []
    assert aggregates.exact_medians(empty, ["n"]).first()[0] is None


def medians(spark, values, **options):
    made = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    return aggregates.exact_medians(made, ["v"], **options).first()[0]


@pytest.mark.parametrize("few", [1_000_000, 10])
@pytest.mark.parametrize("size", [1, 2, 3, 10, 999, 1_000])
def test_median(spark, size, few):
    draw = random.Random(size)
    values = [draw.choice([13.7, draw.gauss(0, 1e6), draw.random() * 1e-9]) for _ in range(size)]
    assert medians(spark, values, few=few, cells=16) == statistics.median(values)


def test_median_skips_null_and_nan(spark):
    values = [1.0, None, float("nan"), 3.0, 2.0, None]
    assert medians(spark, values) == 2.0
    assert medians(spark, [None, float("nan")]) is None


def test_median_of_a_hot_value_and_far_outliers(spark):
    values = [13.7] * 700 + [1e300, -1e300] * 150 + [13.7 + i * 1e-9 for i in range(1, 600)]
    assert medians(spark, values, few=5, cells=8) == statistics.median(values)


def test_medians_beside_infinities_and_overflowing_ranges(spark):
    far = [float("inf"), float("-inf"), 1e308, -1e308, 1e308, -1e308]
    for values in ([float(i) for i in range(101)] + far, far, [float("inf")] * 3, [-1.5, float("inf")]):
        frame = spark.createDataFrame([(v,) for v in values], "x double")
        found = aggregates.exact_medians(frame, ["x"], few=4, cells=8).first().x
        ordered = sorted(values)
        expected = (ordered[(len(values) - 1) // 2] + ordered[len(values) // 2]) / 2
        assert found == expected, values


def test_medians_of_several_columns(spark):
    frame = spark.createDataFrame([(1.0, None), (2.0, 7.0), (9.0, 8.0)], "a double, b double")
    row = aggregates.exact_medians(frame, ["a", "b"], few=1, cells=4).first()
    assert (row.a, row.b) == (2.0, 7.5)


def test_newest_reaches_the_scan(spark, frame, tmp_path):
    frame.filter(F.col("last_activity").isNotNull()).write.parquet(str(tmp_path / "t"))
    found = topn.newest(spark.read.parquet(str(tmp_path / "t")), 50, ties=("n",), direct=0)
    assert "GreaterThanOrEqual(last_activity" in found._jdf.queryExecution().toString()


@pytest.mark.parametrize("ties", ["one instant", "two instants", "a third at once", "no time"])
def test_a_rank_bound_gives_the_same_rows(spark, ties, monkeypatch):
    """Bulk changes within one hour: the bound and one count, whatever the ties."""
    moment = {
        "one instant": "timestamp_micros(1704067200000000)",
        "two instants": "timestamp_micros(1704067200000000 + id % 2)",
        "a third at once": "timestamp_micros(1704067200000000 + if(id % 3 = 0, 5000, id))",
        "no time": "cast(null as timestamp)",
    }[ties]
    frame = spark.range(12_000).selectExpr(f"{moment} as last_activity", "cast(id as string) as ticket_id")
    frame = frame.withColumn("timestamp", F.col("last_activity"))
    calls, plain = [], topn._boundary

    def counted(df, bucket, n):
        calls.append(n)
        return plain(df, bucket, n)

    monkeypatch.setattr(topn, "_boundary", counted)
    few = [r.ticket_id for r in topn.newest(frame, 300, direct=0).collect()]
    assert len(calls) == 2
    assert few == [r.ticket_id for r in topn.newest(frame, 300, direct=10_000).collect()]
    capped = [r.ticket_id for r in topn.cap_rows(frame, 300, direct=0).collect()]
    assert capped == [r.ticket_id for r in topn.cap_rows(frame, 300, direct=10_000).collect()]


def test_a_sketch_that_misses_is_made_again(spark, monkeypatch):
    monkeypatch.setattr(topn, "RANK_ERROR", 0.0005)
    frame = spark.range(20_000).selectExpr("timestamp_micros(1704067200000000 + id) as last_activity", "cast(id as string) as ticket_id")
    monkeypatch.setattr(topn, "sketch_size", lambda error: 8)
    found = [r.ticket_id for r in topn.newest(frame, 40, direct=0).collect()]
    assert found == [str(i) for i in range(19_999, 19_959, -1)]


@pytest.mark.parametrize("error", [0.05, 0.005])
def test_sketched_medians_are_within_their_rank_error(spark, error):
    draw = random.Random(4)
    skewed = [draw.lognormvariate(0, 6) for _ in range(20_000)]
    infinite = [float("inf")] * 300 + [float("-inf")] * 300 + [draw.random() for _ in range(9_400)]
    hot = [13.7] * 6_000 + [draw.gauss(0, 1e9) for _ in range(4_000)]
    for values in (skewed, infinite, hot):
        frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(7)
        found = aggregates.sketched_medians(frame, ["x"], error).first().x
        below, upto = sum(v < found for v in values), sum(v <= found for v in values)
        slack = error * len(values) + 1
        assert found in values and below - slack <= len(values) / 2 <= upto + slack


def test_sketched_medians_of_little(spark):
    frame = spark.createDataFrame([(None, 1.0, 2), (float("nan"), 3.0, 2)], "a double, b double, c int")
    row = aggregates.sketched_medians(frame, ["a", "b", "c"]).first()
    assert row.a is None and row.b in (1.0, 3.0) and row.c == 2.0
    assert aggregates.map_center(frame.selectExpr("b as latitude", "b as longitude"), rank_error=0.1).count() == 1
    assert aggregates.sketched_medians(frame.limit(0), ["b"]).first().b is None
    with pytest.raises(ValueError, match="share"):
        aggregates.sketched_medians(frame, ["b"], 0)
