from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plaint.checks import queries
from plaint.plans import reports
from plaint.schemas import COMPONENTS, DASHBOARD_COLUMNS

START = dt.datetime(2024, 1, 1)
SCHEMA = (
    "ticket_id string, comment string, address string, photo string, latitude double, longitude double,"
    " last_activity timestamp, cluster string, PC1 double, PC2 double, PC3 double, vector array<double>"
)


@pytest.fixture(scope="module")
def clustered(spark):
    rows = []
    for i in range(60):
        cluster = None if i % 10 == 9 else str(1 + i % 12)
        point = (None, None, None) if cluster is None else (float(i), float(i % 7), 1.0)
        rows.append(
            (f"t{i}", None if i == 3 else f"comment {i}", f"a{i}", "p", 13.0 + i / 100, 100.0 + i,
             START + dt.timedelta(minutes=i) if i % 6 else None, cluster, *point, [1.0])
        )
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def dashboard(clustered):
    return reports.load_dashboard(clustered)


def test_dashboard_is_newest_first_and_without_vectors(clustered, dashboard):
    assert dashboard.columns == DASHBOARD_COLUMNS
    moments = [r.last_activity for r in dashboard.collect()]
    known = [m for m in moments if m]
    assert known == sorted(known, reverse=True) and moments[: len(known)] == known and len(moments) == 60
    assert [r.id for r in reports.dashboard_scan(clustered, 2).collect()] == ["t59", "t58"]


def test_cluster_report(dashboard):
    report = reports.cluster_report(dashboard, lambda prompt: str(len(prompt.splitlines())))
    bars = report.bars.collect()
    counts = [r["count"] for r in bars]
    assert counts == sorted(counts, reverse=True) and sum(counts) == 54 and None not in [r.cluster for r in bars]
    assert {r.cluster: r.bar_color for r in bars}["1"] == "#1f77b4"
    scatter = report.scatter
    assert scatter.columns == ["id", "cluster", *COMPONENTS, "color"] and scatter.count() == 60
    gray = {r.color for r in scatter.filter("cluster is null").collect()}
    assert gray == {"rgba(128,128,128,1.0)"}
    samples = {r.cluster: r for r in report.samples.collect()}
    assert len(samples) == 12
    for row in samples.values():
        assert row.color.startswith("rgba(") and ", " in row.color
        assert 1 <= len(row.comments) <= 3 and all(c.startswith("- ") for c in row.comments)


def test_shown_comments_begin_the_summarised_ones(dashboard):
    found = reports.cluster_samples(dashboard, lambda prompt: prompt).collect()
    for row in found:
        lines = row.summary.splitlines()
        assert lines[-len(row.comments) :] == row.comments or lines[2 : 2 + len(row.comments)] == row.comments


def test_map_report(dashboard):
    report = reports.map_report(dashboard, [1, 2], n=5)
    points = report.points.collect()
    assert report.points.columns == ["id", "latitude", "longitude", "cluster", "color", "short_comment", "photo", "address"]
    assert len(points) == 5 and {r.cluster for r in points} <= {"1", "2"}
    assert all(r.short_comment.endswith("…") for r in points)
    assert tuple(report.counts.first()) == (5, 60, 2, 12)
    chosen = sorted(r.latitude for r in dashboard.filter("cluster in ('1', '2')").collect())
    middle = len(chosen) // 2
    expected = chosen[middle] if len(chosen) % 2 else (chosen[middle - 1] + chosen[middle]) / 2
    assert report.center.first().latitude == pytest.approx(expected)


def test_map_without_a_selection_shows_all(dashboard):
    report = reports.map_report(dashboard, [])
    assert report.points.count() == 60
    assert report.center.first().latitude == pytest.approx(13.295)
    assert {r.short_comment for r in report.points.filter("id = 't3'").collect()} == {"…"}


def test_reports_of_an_empty_table(clustered):
    empty = reports.load_dashboard(clustered.limit(0))
    report = reports.cluster_report(empty)
    assert report.bars.collect() == report.scatter.collect() == report.samples.collect() == []
    assert reports.map_report(empty, [1]).points.collect() == []


def test_report_queries_take_all_rows(spark, monkeypatch):
    monkeypatch.setattr(reports.load_dashboard, "__defaults__", (5,))
    monkeypatch.setattr(queries, "_DASHBOARDS", {})
    sf_dir = "/root/testdata/sf0.001"
    assert queries.QUERIES["map_report_counts"](spark, sf_dir).first().total_points == 200
    assert queries.QUERIES["cluster_report_scatter"](spark, sf_dir).count() == 200


def test_whole_dashboard(clustered):
    assert reports.load_dashboard(clustered, n=None).count() == 60


def test_a_named_ticket_comes_before_an_equal_one_without_id(dashboard):
    one = dashboard.filter("id = 't7'")
    both = one.withColumn("id", F.lit(None).cast("string")).withColumn("comment", F.lit("no id")).union(one)
    assert reports.cluster_samples(both).first().summary == "comment 7"
