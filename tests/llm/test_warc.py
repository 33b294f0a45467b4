import base64
import hashlib
import random

from siltstone.llm import warc


def expected(rows):
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(last.get(h or "", i), i)
    return sorted((i, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(), "response" if i == last[h or ""] else "revisit", None if i == last[h or ""] else last[h or ""]) for i, _, h in rows)


def pages(spark, rows, parts=1):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string").repartition(parts)


def test_round_trip_with_magic_inside(spark):
    random.seed(5)
    fake = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    texts = ["", None, "plain", "é" * 50, fake, "a" + fake * 3 + "z", "WARC/1.0\r\n", "x\r\n\r\nWARC/1.0\r\nContent-Length: 9999999999999999999999\r\n\r\n", "x\r\n\r\nWARC/1.0\r\nContent-Length: " + "7" * 5_000 + "\r\n\r\n", "WARC/1.0\r\ncontent-length:" + "0" * 4_400 + "5\r\n\r\nhello", "line\nline\r\n" * 300, fake + "WARC/1.0\r\nContent-Length: 100000\r\n\r\n"]
    rows = [(i, f"http://h/{i}\r\nX: 1" if i % 3 else None, random.choice(texts) if i > 14 else texts[i % len(texts)] if i < 12 else f"page {i} " * i) for i in range(50)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "1500b", "301b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "100")
            got = warc.round_trip(pages(spark, rows, 3))
            assert sorted(map(tuple, got.collect())) == expected(rows), size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_empty_and_repeated(spark):
    assert warc.round_trip(pages(spark, [])).count() == 0
    rows = [(1, "u", "same"), (1, "u", "same"), (2, "u", "x")]
    assert sorted(map(tuple, warc.round_trip(pages(spark, rows)).collect())) == expected(rows)


def test_shuffled_revisits(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    rows = [(i, "u", "same" if i % 2 else f"own {i}") for i in range(30)]
    assert sorted(map(tuple, warc.round_trip(pages(spark, rows)).collect())) == expected(rows)
