import base64
import glob
import gzip
import os
from hashlib import sha1

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierline.llm import warc
from tierline.llm.queries import QUERIES

PAGES = "page_id long, url string, payload binary"


@pytest.fixture(scope="module")
def pages(spark):
    rng = np.random.default_rng(4)
    rows = [(i, f"http://h.example/{i}", bytes(rng.integers(0, 256, int(rng.integers(0, 3000)), dtype=np.uint8))) for i in range(120)]
    rows += [(200 + i, "http://copy.example/", b"the same page") for i in range(60)]
    rows += [(7, "http://a.example/\r\nx: y", rows[3][2]), (None, None, None), (301, None, b""), (None, "http://n.example/", b"only null ids"),
             (302, "http://b.example/é", "café 世界".encode()), (7, "http://h.example/7", rows[7][2]),
             (400, "http://long.example/", b"<p>long</p>" * 200_000)]
    # Magic bytes inside payloads, as stored archives have them.
    rows += [(500 + i, "http://gz.example/", gzip.compress(f"inner {i}".encode()) + warc.MAGIC * 3) for i in range(20)]
    return spark.createDataFrame(rows, PAGES)


def expected(pages):
    rows = [(r.page_id, bytes(r.payload or b"")) for r in pages.collect()]
    first = {}
    for page_id, payload in rows:
        known = first.get(payload)
        first[payload] = page_id if known is None else known if page_id is None else min(known, page_id)
    out = []
    for page_id, payload in rows:
        copy = page_id != first[payload]
        digest = base64.b32encode(sha1(payload).digest()).decode()
        out.append((page_id, len(payload), digest, "revisit" if copy else "response", first[payload] if copy else None))
    return sorted(out, key=repr)


def found(records):
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to_page_id")
    return sorted((tuple(r[c] for c in cols) for r in records.collect()), key=repr)


def test_ranges_of_any_size_read_every_record_once(spark, pages, workdir):
    path = f"{workdir}/warc"
    warc.write_warc(pages, path, file_bytes=20_000)
    want = expected(pages)
    for size in (1, 997, 20_000, 1 << 25):
        if size == 1:  # every byte is a range of its own: on a small archive
            small = f"{workdir}/small"
            warc.write_warc(pages.filter("page_id between 200 and 203"), small)
            assert found(warc.read_warc(spark, small, 1)) == expected(pages.filter("page_id between 200 and 203"))
        else:
            assert found(warc.read_warc(spark, path, size)) == want
    assert found(warc.read_warc(spark, path, whole_files=True)) == want


def test_records_hold_whole_pages(spark, pages, workdir):
    warc.write_warc(pages, f"{workdir}/warc")
    records = warc.read_warc(spark, f"{workdir}/warc").collect()
    payloads = {r.page_id: bytes(r.payload or b"") for r in pages.collect()}
    ids = {r.record_id: r.page_id for r in records if r.record_type == "response"}
    for r in records:
        assert r.declared_digest == r.payload_digest and r.date == "2024-01-01T00:00:00Z"
        if r.record_type == "response" and r.page_id is not None:
            assert bytes(r.payload) == payloads[r.page_id]
        if r.record_type == "revisit":
            assert r.payload is None and ids[r.refers_to] == r.refers_to_page_id
    assert {r.target_uri for r in records if r.page_id == 7 and r.record_type == "revisit"} == {"http://a.example/%0D%0Ax: y"}
    assert [r.target_uri for r in records if r.page_id == 302] == ["http://b.example/é"]


def test_files_are_plain_gzip_archives(spark, pages, workdir):
    warc.write_warc(pages, f"{workdir}/warc", file_bytes=50_000)
    files = glob.glob(f"{workdir}/warc/part-*")
    assert len(files) > 1 and all(os.path.getsize(f) < 300_000 for f in files)
    whole = [gzip.open(f).read() for f in files]
    assert sum(t.count(b"WARC-Type: ") for t in whole) == pages.count()
    assert all(open(f, "rb").read().endswith(warc.END_MEMBER) for f in files)


def test_damage_and_strange_bytes_are_skipped(spark, workdir):
    def member(i, date="d"):
        return warc._member(i, "http://x.example/", b"page %d" % i, i, False, date)

    broken = bytearray(member(3))
    broken[len(broken) // 2] ^= 0xFF
    os.makedirs(f"{workdir}/mixed")
    with open(f"{workdir}/mixed/a.warc.gz", "wb") as fh:
        fh.write(member(1) + b"garbage\x1f\x8b\x08\x00" + member(2) + bytes(broken) + gzip.compress(b"no record") + member(4)
                 + warc.END_MEMBER + member(5)[:-9])
    with open(f"{workdir}/mixed/empty.warc.gz", "wb"):
        pass
    for size in (13, 100, 10_000):
        assert sorted(r.page_id for r in warc.read_warc(spark, f"{workdir}/mixed", size).collect()) == [1, 2, 4]


def test_hot_payloads_through_the_shuffled_join(spark, pages, workdir, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    warc.write_warc(pages.withColumn("digest", F.lit("x")).withColumn("first_id", F.lit(0)), f"{workdir}/warc")
    assert found(warc.read_warc(spark, f"{workdir}/warc")) == expected(pages)


def test_no_rows(spark, workdir):
    warc.write_warc(spark.createDataFrame([], PAGES), f"{workdir}/none")
    assert warc.read_warc(spark, f"{workdir}/none").count() == 0


def test_query_reports_every_page(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", F.col("html").cast("binary").alias("payload"))
    got = sorted((tuple(r) for r in QUERIES["op12_warc"](spark, sf).collect()), key=repr)
    assert got == expected(pages)
