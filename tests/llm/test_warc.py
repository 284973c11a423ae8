"""Archives written and read back."""

from __future__ import annotations

import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from plaint.llm import warc


@pytest.fixture
def pages(spark):
    def make(rows):
        frame = spark.createDataFrame(rows, "page_id long, url string, html string")
        return frame.selectExpr("*", "'x' as first", "'y' as digest", "1 as content").repartition(3)

    return make


def expected(rows):
    smallest = {}
    for page, _, html in rows:
        if page is not None:
            smallest[html or ""] = min(page, smallest.get(html or "", page))
    out = []
    for page, _, html in rows:
        raw, first = (html or "").encode(), smallest.get(html or "")
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((str(page), len(raw), digest, *(("response", None) if page == first else ("revisit", first))))
    return sorted(map(str, out))


def found(frame):
    return sorted(str((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in frame.collect())


ROWS = [
    (3, "http://a.example/x y\r\nz", "<p>é \r\n\r\n WARC/1.1</p>"),
    (1, None, "<p>é \r\n\r\n WARC/1.1</p>"),
    (2, "", None),
    (9, "http://a.example/", ""),
    (-4, "http://b.example/", "long " * 40_000),
    (None, "u", "long " * 40_000),
    (None, None, "only without an id"),
    (7, "u", "\x00 ￿"),
    (7, "u", "\x00 ￿"),
] + [(100 + i, "h", "same") for i in range(50)]


def test_round_trip(pages):
    assert found(warc.archived(pages(ROWS))) == expected(ROWS)


def test_small_files_and_small_reads(pages, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 2)
    monkeypatch.setattr(warc, "READ_BYTES", 7)
    assert found(warc.archived(pages(ROWS[:8]))) == expected(ROWS[:8])


def test_very_long_record(pages):
    rows = [(1, "u", "a" * (warc.SHORT + 5)), (2, "u", "b")]
    assert found(warc.archived(pages(rows))) == expected(rows)


def test_files_are_closed_by_bytes(pages, tmp_path, monkeypatch):
    """Many long pages in one task: no file holds more than the bound, or one page."""
    monkeypatch.setattr(warc, "SHORT_PAGE", 100)
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 10)
    monkeypatch.setattr(warc, "LONGER", ((1_000, 3), (1 << 62, 1)))
    rows = [(i, "u", f"{i} " + "x" * (i % 3) * 600 + "y" * (i % 7)) for i in range(90)]
    path = str(tmp_path / "archives")
    warc.write_archives(pages(rows).coalesce(1), path)
    sizes = []
    for file in Path(path).glob("part-*"):
        kept = [len(warc.page_row(*warc.parse(m))["payload"]) for m in warc.decompressed(file.read_bytes())]
        sizes.append(kept)
        assert len(kept) == 1 or sum(kept) <= 3_000
    assert sum(map(len, sizes)) == 90 and max(map(len, sizes)) > 3
    assert found(warc.read_archives(pages(rows).sparkSession, path)) == expected(rows)


def test_empty_table(pages):
    assert found(warc.archived(pages(ROWS).limit(0))) == []


def test_files_are_gzip_members_of_records(pages, tmp_path):
    path = str(tmp_path / "archives")
    warc.write_archives(pages(ROWS), path)
    text = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(path).glob("part-*")))
    assert text.startswith(warc.VERSION) and text.count(b"\r\nWARC-Type: re") == len(ROWS)


def test_damage_is_found(spark, pages, tmp_path):
    good = warc.page_record(1, "u", b"payload", None, False)
    assert [warc.page_row(*warc.parse(m))["payload"] for m in warc.decompressed(good + good)] == [b"payload"] * 2
    with pytest.raises(ValueError, match="ends within"):
        list(warc.decompressed(good[:-3]))
    member = next(warc.decompressed(good))
    with pytest.raises(ValueError, match="block digest"):
        warc.parse(member.replace(b"payload\r\n", b"payl0ad\r\n"))
    with pytest.raises(ValueError, match="content length"):
        warc.parse(member[:-1])
    with pytest.raises(ValueError, match="not a WARC"):
        warc.parse(b"x" + member)
