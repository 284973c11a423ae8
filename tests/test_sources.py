from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plaint.operators.transform import transform_tickets
from plaint.plans import jobs
from plaint.schemas import RAW_COLUMNS, RAW_SCHEMA, TICKET_COLUMNS, TICKET_SCHEMA, VECTOR_SCHEMA
from plaint.sources import exports, outlines, pages, photos, tables

HEADER = ",".join(RAW_COLUMNS)


def raw_row(**given):
    return tuple(given.get(name) for name in RAW_COLUMNS)


def csv_line(**given):
    return ",".join('"{}"'.format(given.get(n, "").replace('"', '""')) for n in RAW_COLUMNS)


DAY_CSV = "\n".join(
    [
        HEADER,
        csv_line(ticket_id="t1", comment='two\r\nlines, "quoted"', coords="100.5,13.7", star="4", count_reopen="0",
                 photo="u1", timestamp="2024-01-05 10:00:00.123+00", last_activity="2024-01-06 00:00:00+00"),
        csv_line(ticket_id="t2", comment="ท่อ  ", coords="n/a,13.7", star="abc", photo="u2",
                 timestamp="2024-01-04 20:00:00+00"),
        csv_line(ticket_id="", comment="", coords="100.5", timestamp="not a time"),
    ]
)


@pytest.fixture
def root(spark, tmp_path):
    text = spark.createDataFrame([(0, DAY_CSV)], "part int, value string")
    exports.land_raw(text, str(tmp_path), "2024-01-05")
    return str(tmp_path)


def test_raw_export(spark, root):
    rows = exports.read_day(spark, root, "2024-01-05").collect()
    assert len(rows) == 3 and rows[0].comment == 'two\r\nlines, "quoted"' and rows[1].comment == "ท่อ  "
    # An empty field has no sign for '' beside NULL.
    assert rows[2].ticket_id is None and rows[2].comment is None


def test_landing_replaces_the_day(spark, root):
    text = spark.createDataFrame(
        [("a", HEADER + "\n" + csv_line(ticket_id="x")), ("b", HEADER + "\n" + csv_line(ticket_id="y"))],
        "part string, value string",
    )
    exports.land_raw(text, root, "2024-01-05")
    found = exports.read_day(spark, root, "2024-01-05")
    assert found.columns == RAW_COLUMNS
    assert sorted(r.ticket_id for r in found.collect()) == ["x", "y"]


def test_transform(spark, root):
    found = transform_tickets(exports.read_day(spark, root, "2024-01-05"))
    assert found.columns == TICKET_COLUMNS
    assert [f.dataType for f in found.schema] == [f.dataType for f in TICKET_SCHEMA]
    first, second, third = found.collect()
    assert first.comment == "two lines, quoted" and (first.longitude, first.latitude) == (100.5, 13.7)
    assert (first.star, first.count_reopen) == (4, 0)
    assert (second.longitude, second.latitude, second.star) == (None, 13.7, None)
    assert (third.longitude, third.latitude, third.timestamp) == (100.5, None, None)


def test_transform_is_one_projection(spark):
    plan = transform_tickets(spark.createDataFrame([], RAW_SCHEMA))._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("Project") <= 1


NASTY = [
    ("t1", 'say "hi"', "", "line\nbreak", "\\N in text", "back\\slash", " blanks "),
    ("", None, "a,b", "\r\n", '""', "\\", "ก"),
]


def test_csv_round_trip_keeps_null_apart_from_blank(spark, tmp_path):
    names = ["ticket_id", "type", "comment", "address", "state", "photo", "province"]
    rows = spark.createDataFrame(NASTY, ", ".join(f"{n} string" for n in names))
    moment = F.lit("2024-01-05 10:00:00.123456").cast("timestamp")
    extra = {
        "timestamp": moment, "last_activity": F.lit(None).cast("timestamp"), "star": F.lit(3),
        "count_reopen": F.lit(None).cast("int"), "longitude": F.lit(100.123456789), "latitude": F.lit(None).cast("double"),
    }
    rows = rows.withColumns(extra)
    missing = [n for n in TICKET_COLUMNS if n not in rows.columns]
    rows = rows.withColumns({n: F.lit(None).cast("string") for n in missing}).select(*TICKET_COLUMNS)
    exports.export_csv(rows, str(tmp_path / "out"))
    found = exports.load_processed_csv(spark, str(tmp_path / "out" / "*.csv"))
    assert found.schema == TICKET_SCHEMA
    key = lambda r: str(r)
    assert sorted(found.collect(), key=key) == sorted(rows.collect(), key=key)


def test_malformed_processed_values_become_null(spark, tmp_path):
    (tmp_path / "p.csv").write_text(",".join(TICKET_COLUMNS) + "\n" + ",".join(["x"] * 17) + "\n")
    row = exports.load_processed_csv(spark, str(tmp_path / "*.csv")).first()
    assert row.ticket_id == "x" and row.star is None and row.timestamp is None and row.latitude is None


def ticket_rows(spark, rows):
    """Tickets from ``(id, timestamp text)``."""
    raw = [raw_row(ticket_id=i, timestamp=t, photo=f"u{i}") for i, t in rows]
    return transform_tickets(spark.createDataFrame(raw, RAW_SCHEMA))


def test_repeated_ingest_replaces_and_append_adds(spark, root, tmp_path):
    table = str(tmp_path / "tickets")
    for _ in range(2):
        assert jobs.daily_ingest(spark, root, table, "2024-01-05") == 3
    assert tables.read_table(spark, table).count() == 3
    assert jobs.daily_ingest(spark, root, table, "2024-01-05", replace=False) == 3
    assert tables.read_table(spark, table).count() == 6


def test_one_days_export_leaves_other_exports_alone(spark, root, tmp_path):
    table = str(tmp_path / "tickets")
    # Both exports hold tickets of 2024-01-04.
    tables.append_tickets(ticket_rows(spark, [("a", "2024-01-04 01:00:00+00")]), table, "2024-01-04")
    jobs.daily_ingest(spark, root, table, "2024-01-05")
    jobs.daily_ingest(spark, root, table, "2024-01-05")
    found = tables.read_tickets(spark, table, "2024-01-04")
    assert found.columns == TICKET_COLUMNS
    assert sorted(r.ticket_id for r in found.collect()) == ["a", "t2"]


def test_reads_by_date_prune_partitions(spark, tmp_path):
    table = str(tmp_path / "tickets")
    rows = [(str(i), f"2024-01-{i:02d} 12:00:00+00") for i in range(1, 21)]
    tables.append_tickets(ticket_rows(spark, rows), table, "x")
    one = tables.read_tickets(spark, table, dt.date(2024, 1, 7))
    assert [r.ticket_id for r in one.collect()] == ["7"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(timestamp" in plan
    later = tables.read_tickets_since(spark, table, "2024-01-18 12:00:00")
    assert sorted(int(r.ticket_id) for r in later.collect()) == [18, 19, 20]


def test_rows_without_a_time_are_kept(spark, tmp_path):
    table = str(tmp_path / "tickets")
    tables.append_tickets(ticket_rows(spark, [("a", "x"), ("b", None)]), table, "x")
    assert tables.read_table(spark, table).count() == 2
    assert tables.read_tickets(spark, table, "2024-01-01").count() == 0


def photo_frame(spark, urls):
    return spark.createDataFrame([(u, b"abc" + u.encode()) for u in urls], "url string, content binary")


def test_daily_vectorize(spark, root, tmp_path):
    tickets, vectors = str(tmp_path / "tickets"), str(tmp_path / "vectors")
    jobs.daily_ingest(spark, root, tickets, "2024-01-05")
    for _ in range(2):
        done = jobs.daily_vectorize(spark, tickets, photo_frame(spark, ["u1"]), vectors, "2024-01-05", by_date=True)
        assert (done.fetched, done.written, done.rejects.count()) == (1, 1, 0)
    found = tables.read_vectors(spark, vectors)
    assert found.columns == VECTOR_SCHEMA.fieldNames()
    row = found.collect()
    assert len(row) == 1 and len(row[0].vector) == 128
    assert abs(sum(v * v for v in row[0].vector) - 1) < 1e-9


def test_nothing_is_written_without_rows_or_vectors(spark, root, tmp_path):
    tickets, vectors = str(tmp_path / "tickets"), tmp_path / "vectors"
    jobs.daily_ingest(spark, root, tickets, "2024-01-05")
    none = jobs.daily_vectorize(spark, tickets, photo_frame(spark, ["u1"]), str(vectors), "2023-01-01", by_date=True)
    assert (none.fetched, none.written, none.rejects) == (0, 0, None)
    failed = jobs.daily_vectorize(spark, tickets, photo_frame(spark, ["zz"]), str(vectors), "2024-01-05", by_date=True)
    assert (failed.fetched, failed.written, failed.rejects.count()) == (1, 0, 1)
    assert failed.rejects.first().reject_reason == "photo not available"
    assert not vectors.exists()


def test_row_cap(spark, tmp_path):
    tickets, vectors = str(tmp_path / "tickets"), str(tmp_path / "vectors")
    rows = [(str(i), f"2024-01-05 12:00:{i:02d}+00") for i in range(30)]
    tables.append_tickets(ticket_rows(spark, rows), tickets, "x")
    done = jobs.daily_vectorize(
        spark, tickets, photo_frame(spark, [f"u{i}" for i in range(30)]), vectors, "2024-01-05", max_rows=20, by_date=True
    )
    assert done.written == 20
    assert {int(r.ticket_id) for r in tables.read_vectors(spark, vectors).collect()} == set(range(20))


def test_an_export_is_vectorized_whole(spark, tmp_path):
    """Tickets of two UTC dates land with one export."""
    tickets, vectors = str(tmp_path / "tickets"), str(tmp_path / "vectors")
    rows = [("1", "2024-01-04 20:00:00+00"), ("2", "2024-01-05 12:00:00+00")]
    tables.append_tickets(ticket_rows(spark, rows), tickets, "2024-01-05")
    done = jobs.daily_vectorize(spark, tickets, photo_frame(spark, ["u1", "u2"]), vectors, "2024-01-05")
    assert done.written == 2
    by_date = jobs.daily_vectorize(spark, tickets, photo_frame(spark, ["u1", "u2"]), vectors + "2", "2024-01-05", by_date=True)
    assert by_date.written == 1


def test_a_repeat_without_vectors_empties_its_partition(spark, tmp_path):
    tickets, vectors = str(tmp_path / "tickets"), str(tmp_path / "vectors")
    tables.append_tickets(ticket_rows(spark, [("1", "2024-01-05 12:00:00+00")]), tickets, "2024-01-05")
    for urls, written in ((["u1"], 1), (["u9"], 0), (["u1"], 1)):
        done = jobs.daily_vectorize(spark, tickets, photo_frame(spark, urls), vectors, "2024-01-05")
        assert done.written == written == tables.read_vectors(spark, vectors).count()


def test_backfills_and_days_hold_each_ticket_once(spark, tmp_path):
    tickets, vectors = str(tmp_path / "tickets"), str(tmp_path / "vectors")
    rows = [(str(i), f"2024-01-05 {6 + i:02d}:00:00+00") for i in range(8)]
    tables.append_tickets(ticket_rows(spark, rows), tickets, "2024-01-05")
    photos = photo_frame(spark, [f"u{i}" for i in range(8)])

    def held():
        return sorted(int(r.ticket_id) for r in tables.read_vectors(spark, vectors).collect())

    jobs.backfill_vectors(spark, tickets, photos, vectors, "2024-01-05 12:00:00")
    assert held() == [6, 7]
    jobs.backfill_vectors(spark, tickets, photos, vectors, "2024-01-05 09:00:00")
    assert held() == [3, 4, 5, 6, 7]
    for _ in range(2):
        jobs.daily_vectorize(spark, tickets, photos, vectors, "2024-01-05")
        assert held() == list(range(8))
    jobs.backfill_vectors(spark, tickets, photos, vectors, "2024-01-01")
    assert held() == list(range(8))


def test_photos_are_fetched_by_the_job(spark, tmp_path):
    tickets, vectors = str(tmp_path / "tickets"), str(tmp_path / "vectors")
    tables.append_tickets(ticket_rows(spark, [("1", "2024-01-05 12:00:00+00")]), tickets, "2024-01-05")
    done = jobs.daily_vectorize(spark, tickets, None, vectors, "2024-01-05", fetcher=lambda url: url.encode())
    assert done.written == 1
    with pytest.raises(ValueError, match="fetcher"):
        jobs.daily_vectorize(spark, tickets, None, vectors, "2024-01-05")


def test_published_versions_are_read_by_any_session(spark, tmp_path):
    path = str(tmp_path / "published")
    with pytest.raises(Exception):
        tables.read_clustered(spark, path)
    first = tables.publish_clustered(spark.range(3).toDF("n"), path, "1", "seen")
    tables.publish_clustered(spark.range(5).toDF("n"), path, "1", "seen")
    other = spark.newSession()
    assert tables.read_clustered(other, path).count() == 5 and first.count() == 3
    tables.publish_clustered(spark.range(1).toDF("n"), path, "2", "seen")
    assert tables.read_clustered(other, path).count() == 1
    assert tables.read_clustered(other, path, "1").count() == 5


def test_backfill_and_refresh(spark, tmp_path):
    tickets, vectors = str(tmp_path / "tickets"), str(tmp_path / "vectors")
    rows = [(str(i), f"2024-01-{1 + i % 9:02d} 12:00:00+00") for i in range(40)] + [(None, "2024-01-09 12:00:00+00")]
    tables.append_tickets(ticket_rows(spark, rows), tickets, "x")
    photo_rows = photo_frame(spark, [f"u{i}" for i in range(40)])
    done = jobs.backfill_vectors(spark, tickets, photo_rows, vectors, "2024-01-05")
    assert done.fetched == 21 and done.written == 20
    assert [r.reject_reason for r in done.rejects.collect()] == ["missing ticket_id"]
    for version in ("1", "2"):
        published = jobs.refresh_clusters(
            spark, vectors, str(tmp_path / "published"), version, model_root=str(tmp_path / "models"), k=3
        )
        assert published.count() == spark.table("tickets_clustered").count() == 20
    assert published.columns == [*TICKET_COLUMNS, "vector", "cluster", "PC1", "PC2", "PC3"]
    assert {r.cluster for r in published.collect()} <= {"1", "2", "3"}
    assert spark.table("tickets_clustered").inputFiles()[0].count("version=2") == 1


def test_photo_files(spark, tmp_path):
    (tmp_path / "1.jpg").write_bytes(b"abc")
    row = photos.read_photos(spark, f"{tmp_path}/*.jpg", "http://h/").first()
    assert (row.url, bytes(row.content)) == ("http://h/1.jpg", b"abc")


def test_fetched_photos(spark):
    tickets = spark.createDataFrame([("a",), ("a",), ("bad",), ("",), (None,)], "photo string")

    def fetcher(url):
        if url == "bad":
            raise OSError("no")
        return url.encode() * 2

    many = spark.createDataFrame([(f"m{i}",) for i in range(300)], "photo string").coalesce(1)
    assert photos.fetch_photos(many, fetcher).count() == 300
    for parallelism in (None, 3):
        found = photos.fetch_photos(tickets, fetcher, parallelism=parallelism)
        assert {r.url: bytes(r.content) for r in found.collect()} == {"a": b"aa", "bad": b""}


KML = """<?xml version="1.0" encoding="UTF-8"?>
<kml xmlns="http://www.opengis.net/kml/2.2"><Document><Folder>
<Placemark><name>A</name><Polygon>
<outerBoundaryIs><LinearRing><coordinates>
  100.1,13.1,0 100.2,13.1,0
  100.2,13.2,0 100.1,13.1,0
</coordinates></LinearRing></outerBoundaryIs>
<innerBoundaryIs><LinearRing><coordinates>1,1 2,2 3,3 1,1</coordinates></LinearRing></innerBoundaryIs>
</Polygon></Placemark>
<Placemark><name>B</name><MultiGeometry>
<Polygon><outerBoundaryIs><LinearRing><coordinates>5,6 7,8</coordinates></LinearRing></outerBoundaryIs></Polygon>
<Polygon><outerBoundaryIs><LinearRing><coordinates>9,10</coordinates></LinearRing></outerBoundaryIs></Polygon>
</MultiGeometry></Placemark>
<Placemark><name>C</name><Point><coordinates>1,2</coordinates></Point></Placemark>
</Folder></Document></kml>"""


def test_outlines(spark, tmp_path):
    (tmp_path / "d.kml").write_text(KML)
    found = outlines.read_outlines(spark, str(tmp_path / "d.kml")).collect()
    assert sorted((r.name, [tuple(p) for p in r.location]) for r in found) == [
        ("A", [(100.1, 13.1), (100.2, 13.1), (100.2, 13.2), (100.1, 13.1)]),
        ("B", [(5.0, 6.0), (7.0, 8.0)]),
        ("B", [(9.0, 10.0)]),
    ]
    assert all(len(r.color) == 4 and min(r.color) >= 150 for r in found)


PAGE = """<html><ul class="x"><li><h4>menu</h4></li></ul>
<UL class='a' id="latest_traffic_list" data-x="1">
<li class="i"><h4> 10:05 </h4><p>Road <b>closed</b> &amp; flooded</p><p>second</p></li>
<li><h4>10:06</h4></li>
<li><p>only text</p></li>
<li><span>neither</span></li>
<li><h4> </h4><pre>not a p</pre></li>
</UL><ul><li><h4>after</h4></li></ul></html>"""


def test_list_items(spark):
    frame = spark.createDataFrame(
        [(1, PAGE), (2, "<ul><li><h4>x</h4></li></ul>"), (3, None), (4, "<ul id=latest_traffic_list><li><p>a</p></li></ul>")],
        "page_id int, html string",
    )
    found = pages.extract_list_items(frame).orderBy("page_id", "position").collect()
    assert [(r.page_id, r.position, r.time, r.description) for r in found] == [
        (1, 0, "10:05", "Roadclosed& flooded"),
        (1, 1, "10:06", ""),
        (1, 2, "", "only text"),
        (1, 3, "", ""),
        (1, 4, "", ""),
        (4, 0, "", "a"),
    ]
    assert pages.either_field(pages.extract_list_items(frame)).count() == 4


def items_of(page, list_id="latest_traffic_list"):
    found = pages.ListReader(list_id, ("h4", "p")).read(page)
    return [(i["time"], i["description"]) for i in found]


def listed(inside):
    return f"<ul id=latest_traffic_list>{inside}</ul><ul><li><h4>after</h4></li></ul>"


@pytest.mark.parametrize(
    "inside, expected",
    [
        # A nested list: its items count, and the outer item takes its first elements from it.
        ("<li><ul><li><h4>a</h4><p>b</p></li></ul><h4>c</h4></li>", [("a", "b"), ("a", "b")]),
        ("<li><h4>c</h4><ol><li><h4>a</h4></ol><p>b</p></li><li>x", [("c", "b"), ("a", ""), ("", "")]),
        # Items that are not closed hold those after them.
        ("<li><h4>1</h4><li><p>2</p><li><h4>3</h4>", [("1", "2"), ("3", "2"), ("3", "")]),
        ("<li><p>1<p>2</p> 3</p><li>", [("", "123"), ("", "")]),
        # End tags: without a start they are passed over, others close what is open inside.
        ("</li></p><li></b><h4>a</p></h4></li>", [("a", "")]),
        ("<li><h4><b>a</h4> b</b></li>", [("a", "")]),
        # Elements without an inside, closed in their start tag, or in capitals.
        ("<LI><H4>a<br>b<img src='<li>'></H4><p/>c</LI>", [("ab", "")]),
        ("<li/><h4>a</h4>", [("", "")]),
        # Each piece of text is trimmed; comments and tags end one, references do not.
        ("<li><h4> a <!-- <li> --> b &amp; c&nbsp;<i> d </i></h4></li>", [("ab & cd", "")]),
        ("<li><p><script>x = '<li>'</script><style>p {}</style>y<template>z</template></p></li>", [("", "y")]),
        ("<li><p>&#3585;&zz; &lt;li&gt;</p></li>", [("", "ก&zz; <li>")]),
        ("", []),
    ],
)
def test_items_of_real_markup(inside, expected):
    assert items_of(listed(inside)) == expected


def test_items_of_odd_pages():
    assert items_of("<ul id='latest_traffic_list'><li><h4>open to the end") == [("open to the end", "")]
    assert items_of("<ul id=other><li><ul id=latest_traffic_list><li><p>a</ul><li><p>b</p>") == [("", "a")]
    assert items_of("<ol id=latest_traffic_list><li><p>a</p></ol>") == []
    assert items_of("<ul id=a><li><p>1</p></ul><ul id=a><li><p>2</p></ul>", "a") == [("", "1")]
    assert items_of("<li><p>1</p></li><ul><li><p>2</p></ul>", None) == [("", "1"), ("", "2")]
    assert items_of("<li><p>1</p></li><![unknown[ <li>", None) == [("", "1")]
    assert items_of("<a <b> </ <!x> <li>< p>&", None) == [("", "")]
    many = 20_000
    assert items_of(listed("<li><h4>t</h4>" * many)) == [("t", "")] * many
