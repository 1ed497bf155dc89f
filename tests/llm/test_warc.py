"""WARC archives: dedup, normalised members, reads by offset."""

import gzip
import hashlib
import os

import pytest

from millrace.llm import warc
from millrace.session import shared_path

LONG = "<p>long enough to be a payload that is worth a revisit</p>" * 3
PAGES = [(5, "http://a/", LONG), (2, "http://b b\r\nX: y", LONG), (9, None, LONG), (3, "http://c", "short"),
         (4, "http://d", "short"), (7, "http://e", None), (8, "http://f", ""), (10, "http://g", "é" * 60),
         (11, "http://h", "WARC/1.1\r\n\r\n\r\n\r\n" * 20), (12, "http://i", "\x00\r\n" * 90), (None, "http://j", LONG),
         (13, "http://k", "x" * 3_000_000)]


def _archive(spark, pages):
    whole, members = shared_path(spark, "test-warc"), shared_path(spark, "test-warc")
    warc.write_archives(warc.deduplicate(pages), whole)
    return whole, members, warc.normalise(spark, whole, members)


def test_round_trip(spark):
    pages = spark.createDataFrame([(*p, "clash", 1) for p in PAGES],
                                  "page_id long, url string, html string, digest string, size int").repartition(3)
    whole, members, index = _archive(spark, pages)
    rows = {r.page_id: r for r in warc.read_records(index, members, with_payload=True, read_bytes=2000).collect()}
    assert len(rows) == len(PAGES)
    for page, _, html in PAGES:
        data, r = (html or "").encode(), rows[page]
        twin = html == LONG and page != 2
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", 2) if twin else ("response", None))
        assert bytes(r.payload) == (b"" if twin else data)
    assert rows[2].url == "http://b%20b%20%20X:%20y"
    # one stream before, one member per record after, the same bytes in all
    assert index.count() == len(PAGES)
    local = members.removeprefix("file:")
    for row in index.collect():
        with open(os.path.join(local, row.archive), "rb") as f:
            f.seek(row.offset)
            record = gzip.decompress(f.read(row.length))
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert row.record_id.encode() in record


def test_repeated_smallest_ids_are_responses_and_empty_tables_work(spark):
    schema = "page_id long, url string, html string"
    _, members, index = _archive(spark, spark.createDataFrame([(1, "u", LONG), (1, "u", LONG), (2, "u", LONG)], schema))
    kinds = sorted((r.page_id, r.record_type) for r in warc.read_records(index, members).collect())
    assert kinds == [(1, "response"), (1, "response"), (2, "revisit")]
    _, members, index = _archive(spark, spark.createDataFrame([], schema))
    assert warc.read_records(index, members).count() == 0


class _Source:
    def __init__(self, data, step):
        self.data, self.step = data, step

    def read(self, n):
        piece, self.data = self.data[:min(n, self.step)], self.data[min(n, self.step):]
        return piece


@pytest.mark.parametrize("step", [1, 7, 1 << 20])
def test_stream_over_members_and_chunks(step):
    data = gzip.compress(b"WARC/1.1\r\nA: 1\r\n\r\nbody") + gzip.compress(b"\r\n\r\n") + gzip.compress(b"WARC/1.1\r\n\r\n")
    stream = warc.InflatedStream(_Source(data, step))
    assert warc.headers(stream.head()) == {"a": "1"}
    assert b"".join(stream.body(8)) == b"body\r\n\r\n"
    assert stream.head() == b"WARC/1.1\r\n\r\n" and stream.head() is None


def test_cut_streams_and_changed_payloads_raise(spark):
    whole = gzip.compress(b"WARC/1.1\r\nContent-Length: 100\r\n\r\nabc" * 50)
    stream = warc.InflatedStream(_Source(whole[:-20], 1 << 20))
    stream.head()
    with pytest.raises(EOFError):
        b"".join(stream.body(10 ** 6))
    schema = "page_id long, url string, html string"
    _, members, index = _archive(spark, spark.createDataFrame([(1, "u", LONG)], schema))
    row = index.first()
    path = os.path.join(members.removeprefix("file:"), row.archive)
    record = gzip.decompress(open(path, "rb").read()).replace(b"worth", b"wortx")
    forged = gzip.compress(record)
    with open(path, "wb") as f:
        f.write(forged)
    with pytest.raises(Exception, match="digest"):
        warc.read_records(spark.createDataFrame([(row.archive, 0, len(forged), row.record_id)], warc.MEMBER_SCHEMA),
                          members).collect()
