import gzip
import io

import pytest
from trackspark.llm import warc


def captures(spark, tmp_path, rows):
    path = str(tmp_path / "archives")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string, type string"), path)
    return warc.resolved(warc.assemble(warc.read_records(spark, path))), path


def test_round_trip(spark, tmp_path):
    big = "WARC/1.1\r\n\r\nx\n" * 100  # a payload that looks like records
    rows = [(1, "http://a b\r\n", big, "z"), (2, None, big, "z"), (2, None, big, "z"), (None, "u", big, "z"), (3, "u", None, "z"),
            (4, "u", "", "z"), (None, "u", "é" * 600, "z"), (None, "u", "é" * 600, "z"), (5, "u", "small", None), (6, "u", "small", None)]
    got, path = captures(spark, tmp_path, rows)
    got = got.collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.page_id, r.payload_bytes, r.capture["type"], r.refers_to) for r in got), key=key) == sorted([
        (None, 1200, "response", None), (None, 1200, "response", None), (None, 1400, "revisit", 2), (1, 1400, "revisit", 2),
        (2, 1400, "response", None), (2, 1400, "revisit", 2), (3, 0, "response", None), (4, 0, "response", None),
        (5, 5, "response", None), (6, 5, "response", None)], key=key)
    assert all(len(r.requests) == len(r.metadata) == 1 for r in got)
    assert sorted(bytes(r.capture.payload).decode() for r in got if r.capture["type"] == "response" and r.page_id) == sorted(
        [big, "", "", "small", "small"])
    files = [p for p in (tmp_path / "archives").iterdir() if p.name.endswith(".gz")]
    assert sum(gzip.decompress(p.read_bytes()).count(b"WARC-Record-ID") for p in files) == 3 * len(rows)


def test_empty_table(spark, tmp_path):
    assert captures(spark, tmp_path, [])[0].collect() == []


@pytest.mark.parametrize("text", [b"HTTP/1.1 200\r\n", b"WARC/1.1\r\nWARC-Type: response\r\n\r\n", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nab"])
def test_damaged_records_raise_with_the_name(text):
    with pytest.raises(ValueError, match="some.warc"):
        list(warc.parse(io.BytesIO(text), "some.warc", True))


def test_orphans_and_wrong_digests():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:" + b"0" * 40 + b"\r\nContent-Length: 5\r\n\r\na\r\n\r\n\r\n\r\n"
    with pytest.raises(ValueError, match="digest"):
        list(warc.parse(io.BytesIO(record), "x", True))
