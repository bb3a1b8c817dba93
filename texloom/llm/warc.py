"""WARC archives: written with an index, read back by coalesced byte ranges.

``write_archives`` writes one record per page into ``.warc.gz`` files (a gzip member per record, so that a
record can be read alone) and returns the index: file, offset, length, url and payload digest per record,
stored as Parquet beside the archives. Of records with equal payloads of at least ``min_revisit`` bytes the one
with the smallest id is a ``response``, the others are ``revisit`` records without payload that refer to it.
``read_archives`` takes the index rows of the selected records, sorts them by file and offset, joins
neighbours into ranges of bounded size, reads each range once and parses its records.

A file name holds a random part, and index rows leave a task only after their file is closed. A task that
is lost and run again writes other files; the index names only the files of the tasks that were committed.

Defined results: a null html is an empty payload; a null url is an empty target; a null id is kept (a page
without id is a revisit where another page with an id has its payload; pages that all have no id are
responses). Rows that repeat an id and a payload are all responses. An empty table gives an empty index.
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._catalog import register
from ._cluster import new_folder, read_table

INDEX = "file string, offset long, length long, url string, digest string, id long, record_type string, refers_to long"
RECORD = "id long, url string, record_type string, refers_to long, payload_bytes long, digest string, payload binary"
CRLF = b"\r\n"
DATE = "1970-01-01T00:00:00Z"


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


def _value(text: str) -> str:
    """A header value in one line."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unvalue(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record_bytes(page: int | None, url: str | None, payload: bytes, digest: str, refers: int | None) -> bytes:
    """One WARC record, not compressed; ``refers``: the id that a revisit refers to."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers is not None else http + payload
    lines = ["WARC/1.1", "WARC-Type: " + ("response" if refers is None else "revisit"),
             f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {url} {digest}')}>", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {_value(url or '')}", f"WARC-Payload-Digest: sha256:{digest}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page is not None:
        lines.append(f"X-Page-ID: {page}")
    if refers is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"X-Refers-To-Page-ID: {refers}"]
    return "\r\n".join(lines).encode() + CRLF * 2 + block + CRLF * 2


def parse_record(data: bytes) -> dict:
    """Fields of a record that ``record_bytes`` made; the payload's size is the HTTP content length."""
    head, _, rest = data.partition(CRLF * 2)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(CRLF * 2)
    size = next(int(x.split(b":")[1]) for x in http.split(CRLF) if x.lower().startswith(b"content-length"))
    kind = fields["WARC-Type"]
    if kind == "response" and len(payload) != size:
        raise ValueError(f"record of page {fields.get('X-Page-ID')}: {len(payload)} bytes of payload, not {size}")
    number = lambda name: int(fields[name]) if name in fields else None
    return {"id": number("X-Page-ID"), "url": _unvalue(fields["WARC-Target-URI"]), "record_type": kind,
            "refers_to": number("X-Refers-To-Page-ID"), "payload_bytes": size,
            "digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"), "payload": payload if kind == "response" else None}


def _writer(folder: str, file_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        names = [x.split()[0] for x in INDEX.split(", ")]
        out, at, rows, name = None, 0, [], ""

        def close():
            out.close()
            columns = zip(*rows)
            return pa.RecordBatch.from_pydict(
                {n: pa.array(c, pa.string() if n in ("file", "url", "digest", "record_type") else pa.int64())
                 for n, c in zip(names, map(list, columns))})

        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                for r in batch.slice(start, 64).to_pylist():
                    if out is None:
                        fs.create_dir(root, recursive=True)
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out, at, rows = fs.open_output_stream(f"{root}/{name}", compression=None), 0, []
                    data = gzip.compress(record_bytes(r["id"], r["url"], r["payload"], r["digest"], r["refers_to"]), 6, mtime=0)
                    out.write(data)
                    rows.append((f"{folder}/{name}", at, len(data), r["url"], r["digest"], r["id"],
                                 "response" if r["refers_to"] is None else "revisit", r["refers_to"]))
                    at += len(data)
                    if at >= file_bytes:
                        yield close()
                        out = None
        if out is not None:
            yield close()

    return write


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_revisit: int = 100, file_bytes: int = 64 << 20) -> DataFrame:
    """Write the archives to ``folder`` and their index to ``folder``/index; the index as a DataFrame."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    base = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"),
                        F.sha2(payload, 256).alias("digest"))
    groups = (base.filter(F.octet_length("payload") >= min_revisit).groupBy("digest")
              .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    # Only payloads that occur again are on the right; a digest with many pages is split by the skew join.
    records = (base.join(groups, "digest", "left")
               .withColumn("refers_to", F.when(F.col("id").eqNullSafe(F.col("first")), None).otherwise(F.col("first")))
               .select("id", "url", "payload", "digest", "refers_to"))
    records.mapInArrow(_writer(folder, file_bytes), INDEX).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def _ranges(rows, most: int, gap: int) -> Iterator[list]:
    """Runs of rows (file, offset, length), sorted: neighbours within ``gap`` bytes, ``most`` bytes together."""
    run: list = []
    for r in rows:
        if run and (r.file != run[0].file or r.offset > run[-1].offset + run[-1].length + gap
                    or r.offset + r.length - run[0].offset > most):
            yield run
            run = []
        run.append(r)
    if run:
        yield run


def read_tasks(selected: DataFrame, most: int, task_bytes: int) -> int:
    """Tasks that read the selected records: by the bytes in the archives, not by the size of the index rows."""
    total = selected.agg(F.sum("length")).first()[0] or 0
    return max(1, -(-total // task_bytes), min(selected.sparkSession.sparkContext.defaultParallelism, -(-total // most)))


def read_archives(selected: DataFrame, most: int = 8 << 20, gap: int = 64 << 10, task_bytes: int = 64 << 20) -> DataFrame:
    """The records of the selected index rows, read back from the archives by tasks of some ``task_bytes`` each."""
    cut_at = (F.col("offset") / F.lit(most)).cast("long")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in RECORD.split(", ")]
        for frame in frames:
            for run in _ranges(frame.itertuples(), most, gap):
                fs, path = _open(run[0].file)
                with fs.open_input_file(path) as f:
                    f.seek(run[0].offset)
                    data = f.read(run[-1].offset + run[-1].length - run[0].offset)
                for s in range(0, len(run), 256):
                    parsed = [parse_record(gzip.decompress(data[r.offset - run[0].offset:r.offset - run[0].offset + r.length])) for r in run[s:s + 256]]
                    yield pd.DataFrame({n: pd.Series([p[n] for p in parsed], dtype=object if n in ("url", "record_type", "digest", "payload")
                                                     else "Int64" if n != "payload_bytes" else "int64") for n in names})

    return (selected.select("file", "offset", "length")
            .repartition(read_tasks(selected, most, task_bytes), "file", cut_at).sortWithinPartitions("file", "offset").mapInPandas(read, RECORD))


SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), k AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM k
"""


@register("op10_warc", SQL)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_archives(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"), new_folder(spark, "warc"))
    read = read_archives(index)
    size, digest = F.octet_length("payload"), F.sha2(F.col("payload"), 256)
    return read.select(
        F.col("id").alias("page_id"),
        F.coalesce(F.when(F.col("record_type") == "response", size), F.col("payload_bytes")).cast("long").alias("payload_bytes"),
        F.when(F.col("record_type") == "response", digest).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type", "refers_to")
