from __future__ import annotations

import sys

import pytest
from pyspark import cloudpickle

from plaint.__main__ import parser, run
from plaint.operators import embed
from test_sources import photo_frame, root  # noqa: F401

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_all_jobs(spark, root, tmp_path):  # noqa: F811
    paths = {n: str(tmp_path / n) for n in ("tickets", "photos", "vectors", "published", "models", "streamed", "progress")}
    photo_frame(spark, ["u1", "u2"]).write.parquet(paths["photos"])
    day = ["--root", root, "--ds", "2024-01-05"]
    assert run(spark, ["ingest", *day, "--table", paths["tickets"]]) == "3 tickets written"
    assert run(spark, ["export", *day]).endswith("processed/2024-01-05/transformed_data")
    stream = ["--landing", f"{root}/raw/*/*", "--table", paths["streamed"], "--checkpoint", paths["progress"]]
    assert run(spark, ["stream", *stream]) == "all landed files processed"
    vectors = ["--tickets", paths["tickets"], "--photos", paths["photos"], "--table", paths["vectors"]]
    found = run(spark, ["vectorize", *vectors, "--ds", "2024-01-05", "--by-date", "--text-factory", f"{__name__}:words"])
    assert found == "1 tickets taken, 1 vectors written"
    found = run(spark, ["backfill", *vectors, "--since", "2024-01-01", "--text-factory", f"{__name__}:words"])
    assert found == "1 tickets taken, 1 vectors written"
    refresh = ["--vectors", paths["vectors"], "--published", paths["published"], "--models", paths["models"]]
    assert run(spark, ["refresh", *refresh, "--version", "7", "--clusters", "2"]) == "version 7 published"
    assert spark.table("tickets_clustered").count() == 2
    out = str(tmp_path / "reports")
    assert run(spark, ["report", "--published", paths["published"], "--out", out]) == f"reports written to {out}"
    assert spark.read.parquet(f"{out}/cluster_scatter").count() == 2
    assert spark.read.parquet(f"{out}/map_points").count() == 2

    again = ["--published", paths["published"], "--out", f"{out}-2", "--rank-error", "0.01"]
    assert run(spark, ["report", *again]) == f"reports written to {out}-2"
    assert spark.read.parquet(f"{out}-2/map_center").count() == 1
    assert run(spark, ["vectorize", *vectors, "--ds", "2024-01-09"]) == "0 tickets taken, 0 vectors written"


def test_news_of_saved_pages(spark, tmp_path):
    page = "<ul id=latest_traffic_list><li><h4>10:05<p>ถนน é<li><span>x</span><li><p>b</ul>"
    (tmp_path / "one.html").write_text(page, encoding="utf-8")
    (tmp_path / "two.html").write_bytes(page.encode() + b"\xff")
    out = str(tmp_path / "news")
    assert run(spark, ["news", "--pages", f"{tmp_path}/*.html", "--out", out]) == f"news written to {out}"
    found = sorted((r.page.rsplit("/", 1)[1], r.position, r.time, r.description) for r in spark.read.parquet(out).collect())
    first = [(0, "10:05ถนน éxb", "ถนน éxb"), (1, "", "b"), (2, "", "b")]
    assert found == [(name, *row) for name in ("one.html", "two.html") for row in first]


def words():
    return embed.trigram_embedder(16)()


def test_a_job_must_be_named():
    with pytest.raises(SystemExit):
        parser().parse_args([])
