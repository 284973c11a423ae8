from __future__ import annotations

from plaint.plans import jobs
from plaint.schemas import TICKET_COLUMNS
from plaint.sources import exports, tables
from plaint.streaming.ingest import incremental_ingest
from test_sources import HEADER, csv_line


def land(spark, root, ds, ids):
    lines = [csv_line(ticket_id=i, comment="a\nb", timestamp=f"{ds} 10:00:00+00") for i in ids]
    text = spark.createDataFrame([(0, "\n".join([HEADER, *lines]))], "part int, value string")
    exports.land_raw(text, root, ds)


def test_only_new_files_are_ingested(spark, tmp_path):
    root, table, progress = (str(tmp_path / name) for name in ("root", "tickets", "progress"))

    def run(**options):
        incremental_ingest(spark, f"{root}/raw/*/*", table, progress, **options).awaitTermination()
        return sorted(r.ticket_id for r in tables.read_table(spark, table).collect())

    land(spark, root, "2024-01-01", ["a", "b"])
    assert run() == ["a", "b"]
    assert run() == ["a", "b"]
    land(spark, root, "2024-01-02", ["c"])
    land(spark, root, "2024-01-03", ["d", "e"])
    assert run(files_per_batch=1) == ["a", "b", "c", "d", "e"]
    assert run() == ["a", "b", "c", "d", "e"]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    root, table, progress = (str(tmp_path / name) for name in ("root", "tickets", "progress"))
    land(spark, root, "2024-01-01", ["a", "b"])
    for _ in range(2):
        incremental_ingest(spark, f"{root}/raw/*/*", table, progress).awaitTermination()
        # The batch was written but the run failed before it was noted.
        for note in (tmp_path / "progress" / "commits").iterdir():
            note.unlink()
    assert tables.read_table(spark, table).count() == 2


def test_two_streams_into_one_table(spark, tmp_path):
    table = str(tmp_path / "tickets")
    for name in ("one", "two"):
        root = str(tmp_path / name)
        land(spark, root, "2024-01-01", [name])
        incremental_ingest(spark, f"{root}/raw/*/*", table, f"{root}-progress").awaitTermination()
    assert sorted(r.ticket_id for r in tables.read_table(spark, table).collect()) == ["one", "two"]


def test_stream_and_batch_give_the_same_rows(spark, tmp_path):
    root = str(tmp_path / "root")
    land(spark, root, "2024-01-01", ["a", "b", ""])
    stream, batch = str(tmp_path / "stream"), str(tmp_path / "batch")
    incremental_ingest(spark, f"{root}/raw/*/*", stream, str(tmp_path / "p")).awaitTermination()
    jobs.daily_ingest(spark, root, batch, "2024-01-01")
    first, second = (
        sorted(map(str, tables.read_table(spark, t).select(*TICKET_COLUMNS).collect())) for t in (stream, batch)
    )
    assert first == second
