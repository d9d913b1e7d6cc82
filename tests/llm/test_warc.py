import hashlib

import pytest

from gavelcast.llm import warc
from gavelcast.runtime import scratch_path

X = "a" * 150
INNER = "WARC/1.1\r\nWARC-Type: response\r\nX-Page-ID: 77\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
ROWS = [
    (1, "u\r\nX: y", X), (5, "u", X), (3, None, X), (3, None, X), (4, "u", None), (6, "u", ""), (7, "u", "short"), (8, "u", "short"),
    (9, "u", "WARC/1.1\r\n"), (10, "u", INNER), (11, "u", "x" + INNER + INNER + "y" * 300), (12, "u", INNER * 40),
    (13, "ü", "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"), (None, "u", X), (None, "u", "qq"),
    (14, "u", "WARC/1.1\r\nContent-Length: 99999999999999999999\r\n\r\n"), (15, "u", "WARC/1.1"), (16, "u", "\r\nWARC/1.1\r\nContent-Length: -4\r\n\r\n"),
    (17, "u", "z" * 300000), (18, "u", INNER * 40)]


def expected():
    for key, _, html in ROWS:
        body = (html or "").encode()
        same = [k for k, _, h in ROWS if k is not None and (h or "").encode() == body]
        original = min(same, default=None) if len(body) >= 100 else None
        revisit = original is not None and original != key
        yield (None if key is None else str(key), len(body), hashlib.sha256(body).hexdigest(),
               "revisit" if revisit else "response", str(original) if revisit else None)


@pytest.mark.parametrize("files,split,limit", [(1, "1k", 100), (3, "100", 0), (2, "128m", 100)])
def test_round_trip(spark, files, split, limit):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(files)
        path = scratch_path(spark, "archives")
        warc.write(pages, path, broadcast_digests=limit)
        got = warc.payloads(warc.read(spark, path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected()))


def test_foreign_archive_with_a_torn_end(spark, tmp_path):
    """Bytes that this library did not write: a record cut short at the end, and magic in a payload."""
    def record(page, body):
        return f"WARC/1.1\r\nWARC-Type: response\r\nX-Page-ID: {page}\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"

    data = record(1, "one") + record(2, "x" + record(9, "no") + "y") + record(3, "") + record(4, "lost" * 10)[:-9]
    (tmp_path / "a.warc").write_bytes(data.encode())
    got = {r["page"]: r["payload_digest"] for r in warc.read(spark, str(tmp_path)).collect()}
    bodies = {"1": "one", "2": "x" + record(9, "no") + "y", "3": ""}
    assert got == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in bodies.items()}


def test_urls_of_any_length(spark):
    """Records after a long header are read too."""
    rows = [(1, "u", "one"), (2, "data:text/plain," + "x" * 70_000, "two"), (3, "u", "three"), (4, "https://h/" + "é" * 500_000, X), (5, "u", X)]
    path = scratch_path(spark, "archives")
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    records = warc.read(spark, path)
    assert {r["page"]: r["url"] for r in records.collect()} == {str(i): url for i, url, _ in rows}
    got = {r["page"]: r["payload_digest"] for r in warc.payloads(records).collect()}
    assert got == {str(i): hashlib.sha256(body.encode()).hexdigest() for i, _, body in rows}


def test_no_pages(spark):
    path = scratch_path(spark, "archives")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read(spark, path).count() == 0
