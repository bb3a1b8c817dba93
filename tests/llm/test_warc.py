from __future__ import annotations

import gzip
import hashlib
import random

from pyspark.sql import functions as F

from texloom.llm import warc as X

from .helpers import written


def _plain(rows):
    data = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, d in data:
        if len(d) >= 100 and i is not None:
            first[d] = min(first.get(d, i), i)
    out = []
    for i, d in data:
        refers = first.get(d) if first.get(d) != i else None
        out.append((i, len(d), hashlib.sha256(d).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


ODD = [(1, "http://a/", "x" * 100), (2, "http://b/\r\nX-Page-ID: 9", "x" * 100), (3, None, "x" * 99), (4, "", "x" * 99), (5, "http://c/", None), (6, "u", ""),
       (7, "100%\n", "WARC/1.1\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\n" * 5), (8, "é", "é" * 50), (9, "é", "é" * 50), (9, "é", "é" * 50),
       (None, "n", "x" * 100), (None, "n", "only here, without an id, " * 9), (None, "n", "only here, without an id, " * 9), (10, "z", "q" * 3_000_000), (0, "z", "q" * 3_000_000)]


def test_odd_rows(spark, scratch):
    sf = written(spark, scratch, {"pages": _pages(spark, ODD).withColumn("digest", F.lit(1))})
    assert sorted(map(tuple, X.op10_warc(spark, sf).collect()), key=repr) == _plain(ODD)


def test_empty_table(spark, scratch):
    sf = written(spark, scratch, {"pages": _pages(spark, [])})
    assert X.op10_warc(spark, sf).collect() == []


def test_archives_are_readable_and_ranges_coalesce(spark, scratch):
    r = random.Random(3)
    rows = [(k, f"http://h/{k}", "".join(r.choice("abc") for _ in range(r.randint(0, 400)))) for k in range(300)]
    index = X.write_archives(_pages(spark, rows), f"{scratch}/arc", file_bytes=4000)
    where = {}
    for e in index.collect():
        where.setdefault(e.file, []).append((e.offset, e.length, e.id, e.url))
    assert len(where) > 5
    for uri, records in where.items():
        fs, path = X._open(uri)
        with fs.open_input_file(path) as f:
            data = f.read()
        at = 0
        for offset, length, i, url in sorted(records):  # the records tile the file
            assert offset == at
            at += length
            assert X.parse_record(gzip.decompress(data[offset:offset + length]))["id"] == i
        assert at == len(data) and gzip.decompress(data).count(b"WARC-Type") == len(records)
    some = index.filter("id % 7 = 3")
    got = X.read_archives(some, most=700, gap=50)
    assert {x.id: (x.url, bytes(x.payload).decode()) for x in got.collect()} == {i: (u, h) for i, u, h in rows if i % 7 == 3}


def test_runs_of_ranges():
    from collections import namedtuple
    R = namedtuple("R", "file offset length")
    rows = [R("a", 0, 10), R("a", 10, 10), R("a", 25, 10), R("a", 100, 10), R("b", 0, 500), R("b", 500, 1)]
    assert [[x.offset for x in run] for run in X._ranges(rows, 60, 5)] == [[0, 10, 25], [100], [0], [500]]


def test_record_round_trip():
    data = X.record_bytes(3, "http://x/%0A\n", b"p\r\n\r\nq", "d" * 64, None)
    got = X.parse_record(data)
    assert got["url"] == "http://x/%0A\n" and got["payload"] == b"p\r\n\r\nq" and got["payload_bytes"] == 6
    again = X.parse_record(X.record_bytes(None, None, b"1234", "d" * 64, 3))
    assert (again["id"], again["refers_to"], again["payload"], again["payload_bytes"], again["record_type"]) == (None, 3, None, 4, "revisit")


def test_reading_tasks_go_by_the_bytes_in_the_archives(spark):
    index = spark.range(1000).select(F.lit("f").alias("file"), (F.col("id") * 1000).alias("offset"), F.lit(1000).cast("long").alias("length"))
    assert X.read_tasks(index, most=10_000, task_bytes=5_000) == 200
    few = X.read_tasks(index, most=500_000, task_bytes=1 << 30)
    assert few == min(2, spark.sparkContext.defaultParallelism)
    assert X.read_tasks(index.limit(0), most=10, task_bytes=10) == 1
