"""WARC: exact round trip through archives, byte ranges of any size, revisits."""

import gzip
import hashlib
import time

import numpy as np
import pytest

import __spark_entry__ as contract
from siftline.llm import warc
from tests.oracle import connect, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.01"


def test_query_matches_sql(spark):
    df = contract.queries()["op2_warc"](spark, SF_DIR)
    names, expected = sql_rows(connect(SF_DIR), contract.oracle_sql()["op2_warc"])
    assert sorted(df.columns) == names and spark_rows(df) == expected


@pytest.mark.parametrize("split", [97, 1000, 40_000, 1 << 25])
def test_every_record_is_read_once_whatever_the_ranges(spark, split):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = warc.read(warc.write(pages), split).collect()
    expected = {r.page_id: r for r in pages.collect()}
    assert sorted(r.page_id for r in rows) == sorted(expected)
    for r in rows:
        assert bytes(r.payload) == expected[r.page_id].html.encode() and r.url == expected[r.page_id].url


def test_revisits_and_edge_rows(spark):
    big = "x" * 200
    pages = spark.createDataFrame(
        [
            (5, "http://a/", big, 0), (3, "http://b/ \n", big, 0), (9, None, big, 0), (1, "u", "short", 0), (2, "u", "short", 0),
            (4, "u", None, 0), (6, "u", "", 0), (None, "u", big, 0), (7, "é", "ü" * 50, 0), (8, "é", "ü" * 50, 0), (8, "é", "ü" * 50, 0),
            (11, "u", "\x1f\x8b\x08" * 60, 0),
        ],
        "page_id long, url string, html string, digest int",
    )
    rows = warc.read(warc.write(pages), 64).collect()
    found = sorted((r.page_id if r.page_id is not None else -1, r.record_type, r.refers_to) for r in rows)
    assert found == [
        (-1, "response", None), (1, "response", None), (2, "response", None), (3, "response", None), (4, "response", None),
        (5, "revisit", 3), (6, "response", None), (7, "response", None), (8, "revisit", 7), (8, "revisit", 7), (9, "revisit", 3),
        (11, "response", None),
    ]
    for r in rows:
        if r.page_id in (3, 5, 9):
            assert (r.payload_bytes, r.payload_digest) == (200, hashlib.sha256(big.encode()).hexdigest())
    assert warc.read(warc.write(pages.limit(0))).count() == 0


class Memory:
    def __init__(self, data):
        self.data = data

    def read_at(self, size, at):
        return self.data[at : at + size]


def test_members_inside_a_payload_are_not_records():
    inner = warc.record(1, "u", b"inner", "0", None)
    stored = gzip.compress(warc.VERSION + b"WARC-Type: response\r\nWARC-Record-ID: <urn:siftline:page:2>\r\n\r\n" + inner, 0)
    data = stored + warc.record(3, "u", b"last", "0", None)
    at = data.index(inner)
    assert data[at : at + 3] == warc.MAGIC
    found = list(warc.records_in(warc._Range(Memory(data), len(data)), at, len(data)))
    assert [warc.parse(r)["page_id"] for r in found] == [3]


def test_a_large_payload_takes_linear_time():
    payload = np.random.default_rng(1).integers(0, 256, 96 << 20, np.uint8).tobytes()
    data = warc.record(1, "u", payload, "0", None)
    begin = time.perf_counter()
    (found,) = warc.records_in(warc._Range(Memory(data), len(data)), 0, len(data))
    took = time.perf_counter() - begin
    assert warc.parse(found)["payload"] == payload and took < 3


def test_an_archive_that_is_cut_short_is_an_error():
    data = b"".join(warc.record(i, "u", b"payload %d" % i, "0", None) for i in range(3))[:-5]
    records = warc.records_in(warc._Range(Memory(data), len(data)), 0, len(data))
    assert [warc.parse(next(records))["page_id"] for _ in range(2)] == [0, 1]
    with pytest.raises(ValueError, match="ends inside a record"):
        next(records)


def test_missing_records_are_told(spark, tmp_path):
    members = [warc.record(i, "u", b"x" * 50, "0", None) for i in range(6)]
    for name, part in (("whole", members), ("short", members[:4])):
        (tmp_path / name).write_bytes(b"".join(part))
    rows = [(f"file://{tmp_path}/{n}", (tmp_path / n).stat().st_size, 6) for n in ("whole", "short")]
    archives = spark.createDataFrame(rows, "path string, bytes long, records long")
    (found,) = warc.short_reads(archives, 100).collect()
    assert found.path.endswith("short") and (found.records, found.found) == (6, 4)


def test_foreign_headers():
    lines = b"warc-type:  response\r\nno header here\r\nWARC-Record-ID: <urn:uuid:1>\r\ncontent-length: 24\r\n"
    found = warc.parse(warc.VERSION + lines + b"\r\nHTTP/1.1 200 OK\r\n\r\nhello\r\n\r\n")
    assert (found["page_id"], found["record_type"], found["payload"], found["url"]) == (None, "response", b"hello", None)
    bare = warc.parse(warc.VERSION + b"WARC-Type: revisit\r\n\r\nHTTP/1.1 200 OK\r\n\r\n\r\n\r\n")
    assert (bare["payload"], bare["payload_bytes"], bare["payload_digest"]) == (None, None, None)
