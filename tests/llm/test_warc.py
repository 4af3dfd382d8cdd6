"""WARC archives: exact round trip, against a byte-by-byte reading of the files."""

import glob
import hashlib
import random

from tickloom.llm import warc


def rows_of(spark, pages, **conf):
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, record_type string").repartition(3)
    return sorted((tuple(r) for r in warc.archived_pages(df).collect()), key=str)


def brute(pages):
    body = {}
    for page, _, html in pages:
        if len((html or "").encode()) >= 1000 and page is not None:
            body[html] = max(page, body.get(html, page))
    out = []
    for page, _, html in pages:
        raw = (html or "").encode()
        first = body.get(html)
        revisit = first is not None and page != first
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None, True))
    return sorted(out, key=str)


def fake(n):
    return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: {n}\r\n\r\n" + "z" * n


def pages():
    rng = random.Random(2)
    big = ["é" * 700, "b" * 1000, "WARC/1.1\r\n" * 200, fake(1500), fake(2000) + warc.END + fake(3) + warc.END, "c" * 999]
    out = [(i, f"http://h/{i}", rng.choice([*big, f"<p>{i}</p>", fake(5), "x" + fake(3) + warc.END, "a\r\n\r\nWARC/1.1\r\nb"])) for i in range(120)]
    return out + [(500, None, None), (501, "", ""), (502, "a b\r\nContent-Length: 4", "q"), (None, "u", "b" * 1000), (503, "u", "y" * 300_000), (504, "u", "WARC/1.1"), (505, "u", "\r\n\r\n"), (3, "u", "same id")]


def test_round_trip(spark):
    data = pages()
    assert rows_of(spark, data) == brute(data)


def test_small_splits_and_shuffled_join(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        data = pages()[:60]
        assert rows_of(spark, data) == brute(data)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_are_plain_warc(spark, tmp_path):
    data = [(i, "http://h", "t" * i) for i in range(5)]
    warc.write_warc(spark.createDataFrame(data, "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"))
    raw = b"".join(open(f, "rb").read() for f in glob.glob(str(tmp_path / "w/part-*")))
    at = seen = 0
    while at < len(raw):
        assert raw[at : at + 10] == b"WARC/1.1\r\n"
        end = raw.index(b"\r\n\r\n", at)
        n = int(raw[at:end].split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert raw[end + 4 : end + 4 + n] == b"t" * n
        at, seen = end + 4 + n + 4, seen + 1
    assert seen == 5


def test_empty(spark):
    assert rows_of(spark, []) == []
