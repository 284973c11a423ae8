"""What the vector jobs read, fetch and embed: only what is left to do."""

from __future__ import annotations

import datetime as dt
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plaint.operators import embed
from plaint.operators.transform import transform_tickets
from plaint.plans import jobs
from plaint.schemas import RAW_COLUMNS, VECTOR_SCHEMA
from plaint.sources import tables
from plaint.streaming.ingest import export_of, incremental_ingest
from test_streaming import land


def tickets(spark, rows):
    """Tickets from (id, day, photo); the photo's url is its number."""
    full = [
        {"ticket_id": i, "timestamp": day and f"{day} 10:00:00+00", "photo": photo, "comment": f"c {i}"}
        for i, day, photo in rows
    ]
    ddl = ", ".join(f"{name} string" for name in RAW_COLUMNS)
    return transform_tickets(spark.createDataFrame([[r.get(n) for n in RAW_COLUMNS] for r in full], ddl))


def shown(spark, urls):
    return spark.createDataFrame([(u, u.encode()) for u in urls], "url string, content binary")


def counting_factory(folder):
    """An embedder that leaves one file per photo it was given."""

    def factory():
        def model(values):
            for value in values:
                (Path(folder) / f"{value.decode()}-{uuid.uuid4().hex}").touch()
            return [[float(len(v)), 1.0] for v in values]

        return model

    return factory


def names(folder):
    return sorted(p.name.rsplit("-", 1)[0] for p in Path(folder).iterdir())


@pytest.mark.parametrize("most", [embed.BROADCAST_URLS, 1])
def test_only_photos_of_the_tickets_are_embedded(spark, tmp_path, most, monkeypatch):
    monkeypatch.setattr(embed.photos_of, "__defaults__", (most,))
    todo = tickets(spark, [("a", "2024-01-01", "u7"), ("b", "2024-01-01", "u9"), ("c", "2024-01-01", "u9"), ("d", "2024-01-01", None)])
    found = embed.vectorize_tickets(todo, shown(spark, [f"u{n}" for n in range(50)]), image_factory=counting_factory(tmp_path))
    reasons = {r.ticket_id: r.reject_reason for r in found.collect()}
    assert names(tmp_path) == ["u7", "u9"]
    assert reasons == {"a": None, "b": None, "c": None, "d": "missing photo"}


def test_overlapping_backfills_fetch_and_embed_once(spark, tmp_path):
    table, vectors = str(tmp_path / "tickets"), str(tmp_path / "vectors")
    fetched, embedded = tmp_path / "fetched", tmp_path / "embedded"
    fetched.mkdir()
    embedded.mkdir()
    rows = [(f"t{n}", f"2024-01-{1 + n % 4:02d}", f"u{n // 2}") for n in range(40)]
    tables.append_tickets(tickets(spark, rows), table, "x")

    def fetcher(url):
        (fetched / f"{url}-{uuid.uuid4().hex}").touch()
        return url.encode()

    starts = ["2024-01-03", "2024-01-02", "2024-01-01", "2024-01-02 06:00:00"]
    runs = [
        jobs.backfill_vectors(spark, table, None, vectors, start, fetcher, image_factory=counting_factory(embedded))
        for start in starts
    ]
    assert [r.written for r in runs] == [20, 10, 10, 0]
    assert tables.read_vectors(spark, vectors).count() == 40
    # A url is fetched again only for a ticket that another run has to do.
    by_day = [{u for _, day, u in rows if day in days} for days in (("2024-01-03", "2024-01-04"), ("2024-01-02",), ("2024-01-01",))]
    assert names(fetched) == names(embedded) == sorted(u for urls in by_day for u in urls)


def test_known_vectors_are_sought_on_the_days_of_the_tickets(spark, tmp_path):
    table = str(tmp_path / "vectors")
    every = [(f"t{n}", f"2024-01-{1 + n % 9:02d}", "u") for n in range(27)]
    with_vectors = tickets(spark, every).withColumn("vector", F.array(F.lit(1.0)))
    for landed in ("one", "two"):
        tables.append_vectors(with_vectors, table, landed)
    todo = tickets(spark, [*every[:2], ("new", "2024-01-01", "u"), ("blank", None, "u")])
    left = tables.not_in_table(todo, table, "two")
    assert sorted(r.ticket_id for r in left.collect()) == ["blank", "new"]
    files = left.inputFiles()
    assert files and all("landed=one/" in f and ("day=2024-01-01/" in f or "day=2024-01-02/" in f) for f in files)


def scanned_folders(frame):
    return {f.split("landed=")[1].rsplit("/", 1)[0] for f in frame.inputFiles()}


def test_reads_by_date_list_their_folders_only(spark, tmp_path):
    table = str(tmp_path / "tickets")
    for n in range(1, 6):
        days = [f"2024-01-{n:02d}", f"2024-01-{n + 1:02d}"]
        tables.append_tickets(tickets(spark, [(f"{n}-{d}", d, "u") for d in days] + [(f"{n}-none", None, "u")]), table, f"e{n}")
    found = tables.read_tickets(spark, table, "2024-01-03")
    assert sorted(r.ticket_id for r in found.collect()) == ["2-2024-01-03", "3-2024-01-03"]
    assert scanned_folders(found) == {"e2/day=2024-01-03", "e3/day=2024-01-03"}
    later = tables.read_tickets_since(spark, table, "2024-01-05 00:00:00")
    assert scanned_folders(later) == {"e4/day=2024-01-05", "e5/day=2024-01-05", "e5/day=2024-01-06"}
    assert later.count() == 3
    blank = tables.read_days(spark, table, [None])
    assert blank.count() == 5 and "day=__HIVE" in blank.inputFiles()[0]
    assert tables.read_tickets(spark, table, dt.date(2030, 1, 1)).count() == 0
    assert tables.read_table(spark, table).count() == 15


def test_a_repeated_run_that_has_no_row_of_a_day_any_more(spark, tmp_path):
    table = str(tmp_path / "tickets")
    tables.append_tickets(tickets(spark, [("a", "2024-01-01", "u"), ("b", "2024-01-02", "u")]), table, "e")
    tables.append_tickets(tickets(spark, [("c", "2024-01-02", "u")]), table, "e")
    assert tables.read_tickets(spark, table, "2024-01-01").count() == 0
    assert [r.ticket_id for r in tables.read_tickets_since(spark, table, "2024-01-01").collect()] == ["c"]


def test_very_many_dates(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "tickets")
    for landed in ("one", "two"):
        tables.append_tickets(tickets(spark, [("a", "2024-01-01", "u"), ("b", "2024-01-02", "u"), ("c", None, "u")]), table, landed)
    asked = [dt.date(2024, 1, 2), None]
    few = sorted(r.ticket_id for r in tables.read_days(spark, table, asked).collect())
    monkeypatch.setattr(tables, "MANY_DAYS", 1)
    assert few == sorted(r.ticket_id for r in tables.read_days(spark, table, asked).collect()) == ["b", "b", "c", "c"]
    other = tables.read_days(spark, table, asked, holds=lambda landed: landed == "two")
    assert sorted(r.ticket_id for r in other.collect()) == ["b", "c"]


def test_a_table_without_notes_is_read_as_a_whole(spark, tmp_path):
    table = str(tmp_path / "tickets")
    rows = [("a", "2024-01-01", "u"), ("b", "2024-01-02", "u"), ("c", None, "u")]
    for landed in ("one", "two"):
        dated = tickets(spark, rows).withColumn("vector", F.array(F.lit(1.0))).withColumn("day", F.to_date("timestamp"))
        dated.write.partitionBy("day").parquet(f"{table}/landed={landed}")
    assert tables.read_tickets(spark, table, "2024-01-02").count() == 2
    assert tables.read_tickets_since(spark, table, "2024-01-02").count() == 2
    held = tables.read_days(spark, table, [dt.date(2024, 1, 1), None], VECTOR_SCHEMA, lambda landed: landed != "one")
    assert sorted(r.ticket_id for r in held.collect()) == ["a", "c"]


def test_the_daily_job_takes_streamed_tickets(spark, tmp_path):
    root, table, vectors = (str(tmp_path / n) for n in ("root", "tickets", "vectors"))
    progress = str(tmp_path / "progress")

    def stream():
        incremental_ingest(spark, f"{root}/raw/*/*", table, progress).awaitTermination()

    def landed(ds):
        return sorted(r.ticket_id for r in tables.read_landed(spark, table, ds).collect())

    # Two exports in one batch, and each with a ticket of the other's date.
    for ds, ids in (("2024-01-01", ["a", "b"]), ("2024-01-02", ["c"])):
        land(spark, root, ds, ids)
    stream()
    assert (landed("2024-01-01"), landed("2024-01-02"), landed("2024-01-03")) == (["a", "b"], ["c"], [])
    # The batch was written but the run failed before it was noted; then a late file of the first day.
    for note in (tmp_path / "progress" / "commits").iterdir():
        note.unlink()
    stream()
    late = Path(root) / "raw" / "2024-01-01" / "late.csv"
    source = next((Path(root) / "raw" / "2024-01-01").rglob("part-*.txt"))
    late.write_text(source.read_text().replace('"a"', '"late"').replace('"b"', '"later"'))
    stream()
    first = landed("2024-01-01")
    assert landed("2024-01-02") == ["c"] and len(first) == 4
    assert [r.ticket_id for r in tables.read_tickets(spark, table, "2024-01-02").collect()] == ["c"]
    done = jobs.daily_vectorize(spark, table, None, vectors, "2024-01-01", fetcher=str.encode)
    assert done.fetched == len([r for r in tables.read_landed(spark, table, "2024-01-01").collect() if r.photo])


def test_export_of_a_path(rows):
    paths = ["s3://b/raw/2024-01-01/x_data.csv", "/2024-01-01/2024-01-02/f", "/raw/day/2024-01-01.csv", None]
    assert rows(export_of(F.col("x")), paths) == ["2024-01-01", "2024-01-02", None, None]
    assert rows(export_of(F.col("x"), r"/raw/([^/]+)/"), ["/raw/a b/2024-01-01/f"]) == ["a b"]


def test_a_job_copies_only_what_is_costly(spark, tmp_path, monkeypatch):
    table, vectors, staged = str(tmp_path / "tickets"), str(tmp_path / "vectors"), []
    rows = [("a", "2024-01-01", "u1"), ("b", "2024-01-02", "u2"), ("c", "2024-01-02", "none")]
    tables.append_tickets(tickets(spark, rows), table, "x")
    write = jobs._staged

    def noted(frame, purpose, *by):
        found, path = write(frame, purpose, *by)
        staged.append((purpose, Path(path)))
        return found, path

    monkeypatch.setattr(jobs, "_staged", noted)
    photos = shown(spark, ["u1", "u2"])
    for _ in range(2):
        done = jobs.backfill_vectors(spark, table, photos, vectors, "2024-01-01")
        assert (done.fetched, done.written) == (3, 2)
        assert [r.ticket_id for r in done.rejects.collect()] == ["c"]
    assert [purpose for purpose, _ in staged] == ["vectors", "vectors"]
    assert [p.name for p in staged[0][1].glob("accepted=*")] == ["accepted=false"]
    # Another run over the same days has to leave tickets out: what is left is staged.
    assert jobs.daily_vectorize(spark, table, photos, vectors, "2024-01-02", by_date=True).written == 0
    assert [purpose for purpose, _ in staged[2:]] == ["todo", "vectors"]


@pytest.mark.parametrize("most", [tables.BROADCAST_HELD, 1])
def test_few_held_rows_are_broadcast(spark, tmp_path, most, monkeypatch):
    monkeypatch.setattr(tables, "BROADCAST_HELD", most)
    table = str(tmp_path / "vectors")
    every = [(f"t{n}", "2024-01-01", "u") for n in range(9)]
    with_vectors = tickets(spark, every).withColumn("vector", F.array(F.lit(1.0)))
    tables.append_vectors(with_vectors, table, "one")
    todo = tickets(spark, [*every[:5], ("new", "2024-01-01", "u")])
    assert tables.not_in_table(todo, table, "one") is todo
    left = tables.not_in_table(todo, table, "two")
    assert [r.ticket_id for r in left.collect()] == ["new"]
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (most > 1)


def test_tickets_are_hashed_to_their_photos_without_a_sort(spark):
    found = embed.vectorize_tickets(tickets(spark, [("a", "2024-01-01", "u1")]), shown(spark, ["u1"]))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("most", [embed.BROADCAST_URLS, 1])
def test_tickets_are_split_by_the_urls_of_the_photo_table(spark, most):
    rows = [("a", "u1"), ("a", "u1"), ("b", "u2"), ("c", "gone"), ("d", None), ("e", ""), (None, "u1"), (None, "gone"), ("", None)]
    todo = tickets(spark, [(i, "2024-01-01", photo) for i, photo in rows])
    photos = shown(spark, ["u1", "u2", "u3", "u2"])
    whole = embed.vectorize_tickets(todo, photos)
    named, others = embed.split_by_photo(todo, photos, most)
    assert (others is None) == (most == 1)
    parts = embed.vectorize_tickets(named, photos)
    if others is not None:
        assert sorted(r.photo for r in named.collect()) == ["u1", "u1", "u1", "u2"]
        parts = parts.unionByName(embed.without_vector(others))
    assert parts.schema.simpleString() == whole.schema.simpleString()
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))


def test_only_tickets_with_a_listed_photo_are_shuffled(spark, tmp_path, monkeypatch):
    """The others, here most of them and without any photo, keep their place and get their reason."""
    table, vectors = str(tmp_path / "tickets"), str(tmp_path / "vectors")
    rows = [(f"t{n}", "2024-01-01", f"u{n}") for n in range(50)]
    tables.append_tickets(tickets(spark, rows), table, "2024-01-01")
    given = []
    whole = embed.vectorize_tickets

    def watched(todo, photos, **options):
        given.extend(r.ticket_id for r in todo.collect())
        return whole(todo, photos, **options)

    monkeypatch.setattr(embed, "vectorize_tickets", watched)
    done = jobs.daily_vectorize(spark, table, shown(spark, ["u7", "u8", "x"]), vectors, "2024-01-01")
    assert sorted(given) == ["t7", "t8"]
    assert (done.fetched, done.written) == (50, 2)
    assert {r.reject_reason for r in done.rejects.collect()} == {"photo not available"}
    assert sorted(r.ticket_id for r in tables.read_vectors(spark, vectors).collect()) == ["t7", "t8"]


def test_tables_are_compressed_with_zstd(spark, tmp_path):
    tables.append_tickets(tickets(spark, [("a", "2024-01-01", "u")]), str(tmp_path / "t"), "x")
    assert [p for p in (tmp_path / "t").rglob("*.parquet")] == [p for p in (tmp_path / "t").rglob("*.zstd.parquet")]
