import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import warc
from corpusmill.llm.queries import op11_warc

SCHEMA = "page_id long, url string, html binary, record string, digest string, first int, offset int"


@pytest.fixture
def make_pages(spark):
    return lambda rows: spark.createDataFrame([(*r, "r", "d", 1, 2) for r in rows], SCHEMA).repartition(3)


@pytest.fixture
def small_ranges(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda size: spark.conf.set(key, size)
    spark.conf.set(key, before)


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plain(rows, least=0):
    rows = [(i, p or b"") for i, _, p in rows]
    out = []
    for i, p in rows:
        ids = [j for j, q in rows if q == p and j is not None]
        revisit = len(p) >= least and ids and i != min(ids)
        out.append((i, len(p), digest(p), "revisit" if revisit else "response", min(ids) if revisit else None))
    return sorted(out, key=str)


def fake(payload=b"x", tail=b""):
    """Text that looks like a record, with a successor that may look like one as well."""
    return b"WARC/1.1\r\nWARC-Type: response\r\nPage: 999\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(payload), payload) + tail


def hard_rows():
    rng = random.Random(4)
    rows = [(i, f"http://h/{i} a", bytes(rng.choice(b"abc<> \r\n") for _ in range(rng.choice([0, 5, 300, 3000])))) for i in range(60)]
    rows += [(100 + k, None, fake(tail=fake(b"y" * k, fake()))) for k in range(40)]
    rows += [(200, "u", fake() * 300), (201, "u", b"WARC/1." * 500), (202, "u", b"WARC/1.1\r\n\r\n" * 40), (203, "u", b"\xff\xfe\x00 WARC/1.0\r\n")]
    rows += [(300 + k, "u\r\nv", fake() * 300) for k in range(3)]  # copies
    rows += [(400, "u", None), (401, "u", b""), (None, "u", b""), (None, "u", b"only without id"), (5, "again", rows[5][2]), (5, "again", b"other")]
    rows += [(500, "u", b"long " * 50_000 + fake() + b" end" * 50_000)]
    return rows


@pytest.mark.parametrize("size", ["128m", "20k", "1k"])
def test_what_was_written_is_read(spark, make_pages, tmp_path, small_ranges, size):
    rows = hard_rows()
    path = str(tmp_path / "a.warc")
    warc.write_warc(warc.records(make_pages(rows)), path)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    small_ranges(size)
    found = warc.archived_pages(spark, path)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows)
    read = warc.read_warc(spark, path)
    assert read.groupBy("path", "offset").count().where("count > 1").count() == 0
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_small_payloads_may_be_left_out(spark, make_pages, tmp_path):
    rows = hard_rows()
    path = str(tmp_path / "a.warc")
    warc.write_warc(warc.records(make_pages(rows), least=10), path)
    assert sorted(map(tuple, warc.archived_pages(spark, path).collect()), key=str) == plain(rows, 10)


def test_records_follow_the_format(spark, make_pages, tmp_path):
    path = str(tmp_path / "a.warc")
    warc.write_warc(warc.records(make_pages([(1, "http://h/", b"<p>"), (2, "http://h/2", b"<p>")])).coalesce(1), path)
    data = b"".join(f.read_bytes() for f in sorted((tmp_path / "a.warc").glob("part-*")))
    first = data.split(b"\r\n\r\nWARC/1.1")[0]
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: ") and data.endswith(b"\r\n\r\n")
    assert data.count(b"WARC/1.1\r\n") == 2 and b"WARC-Date: 1970-01-01T00:00:00Z\r\n" in first
    assert data.count(b"WARC-Refers-To: <urn:uuid:") == 1 and f"sha1:{digest(b'<p>')}\r\n".encode() in first


def test_files_of_others_and_broken_chains(spark, tmp_path):
    whole = b"WARC/1.0\r\nWARC-Type: warcinfo\r\ncontent-length:  5 \r\n\r\nhello\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(whole * 3)
    (tmp_path / "b.warc").write_bytes(b"")
    rows = warc.read_warc(spark, str(tmp_path)).orderBy("offset").collect()
    assert [(r["offset"], bytes(r["block"]), r["fields"]["warc-type"]) for r in rows] == [(len(whole) * k, b"hello", "warcinfo") for k in range(3)]
    (tmp_path / "c.warc").write_bytes(whole + whole[:-7])
    with pytest.raises(ValueError, match="c.warc"):
        warc.read_warc(spark, str(tmp_path)).collect()
    assert warc.read_warc(spark, str(tmp_path), strict=False).count() >= 4


def test_no_pages(spark, make_pages, tmp_path):
    path = str(tmp_path / "none")
    warc.write_warc(warc.records(make_pages([])), path)
    assert warc.archived_pages(spark, path).collect() == []


def test_more_ranges_than_a_small_table_holds(spark, make_pages, tmp_path, small_ranges, monkeypatch):
    from corpusmill.operators import lookup

    rows = hard_rows()
    path = str(tmp_path / "a.warc")
    monkeypatch.setattr(lookup, "MAX_SMALL_ROWS", 3)
    monkeypatch.setattr(warc, "NAMED_FILES", 0)
    warc.write_warc(warc.records(make_pages(rows)), path)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    small_ranges("50k")
    assert sorted(map(tuple, warc.archived_pages(spark, path).collect()), key=str) == plain(rows)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_query_covers_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [(r["page_id"], r["url"], (r["html"] or "").encode()) for r in pages.collect()]
    assert sorted(map(tuple, op11_warc(spark, "/root/testdata/sf0.001").collect()), key=str) == plain(rows)
