import hashlib

import pytest

from stratum.llm import warc
from stratum.session import scratch_path

FORGED = ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:999>\r\nContent-Length: 3\r\n\r\n"
          "abc\r\n\r\n")
PAGES = [
    (5, "http://a", "x" * 200), (3, "u", "x" * 200), (None, None, "x" * 200), (7, "v", None), (8, "w", ""),
    (9, "w", "s" * 99), (10, "w", "s" * 99), (11, "m", "pre " + FORGED + " mid WARC/1.0\r\n" + FORGED * 50),
    (12, "m", "WARC/1."), (13, "é\r\nContent-Length: 5", "é€" * 300), (13, "é", "é€" * 300),
    (14, "q", "\r\n\r\n" * 20 + "WARC/1.1\r\n\r\n"), (15, "q", "é€" * 300), (16, "long", "long text " * 30000),
]


def brute(pages):
    last = 1 << 63
    key = [last if p is None else p for p, _, _ in pages]
    for i, (page_id, _, html) in enumerate(pages):
        raw = (html or "").encode()
        first = min(k for k, (_, _, h) in zip(key, pages) if (h or "").encode() == raw)
        again = len(raw) >= 100 and key[i] > first
        yield (page_id, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response",
               first if again else None)


@pytest.fixture()
def small_splits(spark):
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("split,chunk", [("134217728", 4 << 20), ("1000", 500), ("300", 100_000)])
def test_round_trip(spark, small_splits, split, chunk):
    small_splits(split)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string") \
        .selectExpr("*", "1 AS _key", "2 AS refers_to").repartition(3)
    got = sorted(map(tuple, warc.round_trip(pages, chunk_bytes=chunk).collect()), key=str)
    assert got == sorted(brute(PAGES), key=str)


def test_offsets_and_chain(spark, small_splits):
    small_splits("700")
    pages = spark.createDataFrame(PAGES[:-1], "page_id long, url string, html string").coalesce(1)
    path = scratch_path(spark, "warc_test")
    warc.write(pages, path)
    data = b"".join(r.content for r in spark.read.format("binaryFile").load(path).where("length > 0").collect())
    assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
    want, at = [], 0                    # a plain reader that trusts Content-Length
    while at < len(data):
        want.append(at)
        head, _, rest = data[at:].partition(b"\r\n\r\n")
        length = int(head.rsplit(b"Content-Length: ", 1)[1])
        at += len(head) + 4 + length + 4
    assert len(want) == len(PAGES) - 1
    found = warc.candidates(spark, path)
    assert found.where("valid").count() > len(want)             # magic inside payloads
    for chunk in (1 << 20, 1000, 64):
        assert sorted(r.offset for r in warc.chain(found, chunk).collect()) == want


def test_damage_ends_the_chain(spark):
    path = scratch_path(spark, "warc_damaged")
    record = FORGED[:-4]
    spark.createDataFrame([(record,), (record.replace("Length: 3", "Length: 4"),), (record,)], "value string") \
        .coalesce(1).write.option("lineSep", "\r\n\r\n").text(path)
    found = warc.candidates(spark, path)
    assert warc.chain(found, 64).count() == 2


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_split_changed_between_the_reads(spark, small_splits, monkeypatch):
    """A lost or added executor changes how the files are split for the second read."""
    pages = [(i, "u", f"page {i} " + "filler " * (i % 7) + ("WARC/1.1\r\n" + FORGED) * (i % 3)) for i in range(400)]
    small_splits("100000")
    rejoined = warc._rejoined

    def later(*args):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        return rejoined(*args)
    monkeypatch.setattr(warc, "_rejoined", later)
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    got = sorted(map(tuple, warc.round_trip(df).collect()), key=str)
    assert got == sorted(brute(pages), key=str)


@pytest.mark.parametrize("filler", [" ", "\r\n", "a", "WARC/1."])
def test_long_runs(spark, filler):
    pages = [(1, "u", filler * 300_000), (2, "u", "x" * 150)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert sorted(map(tuple, warc.round_trip(df).collect()), key=str) == sorted(brute(pages), key=str)
