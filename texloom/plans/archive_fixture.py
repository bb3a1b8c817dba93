"""Paper archives packed from the LaTeX view, for the archive queries and tests.

One ``.tar.gz`` per document, holding its ``.tex`` file (in some archives two of that name) and the figure
files that exist for it (bytes ``IMG:<path>``). Two rules make broken inputs:
``doc_id % 50 = 7`` is a plain gzip of the ``.tex`` (no tar: cannot be
expanded) and ``doc_id % 50 = 13`` has a byte ``E9`` appended to the ``.tex``
(not valid UTF-8). Packing is a narrow ``mapInPandas`` over document rows.
"""

from __future__ import annotations

import gzip
import io
import os
import tarfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.archives import BINARY_FILE_SCHEMA
from ..session import ensure_checkpoint_dir
from . import fixtures as fx

BROKEN_TAR = "doc_id % 50 = 7"
BAD_UTF8 = "doc_id % 50 = 13"
# The .tex file of these archives is stored twice; extraction keeps the last one.
TWICE = "doc_id % 9 = 4"
DOC_FILES = fx.MEMBER_CANDIDATES[1:]


# Packed archives that a task holds before it hands them on (rows, bytes).
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows, size = [], 0
        for r in pdf.itertuples(index=False):
            tex = r.content.encode("utf-8") + (b"\xe9" if r.bad_utf8 else b"")
            if r.broken:
                data = gzip.compress(tex, compresslevel=6, mtime=0)
            else:
                buf = io.BytesIO()
                with tarfile.open(fileobj=buf, mode="w:gz", format=tarfile.PAX_FORMAT, compresslevel=6) as tar:
                    first = [(r.member, b"an older file")] if r.twice else []
                    for name, body in first + [(r.member, tex)] + [(f, b"IMG:" + f.encode()) for f in r.files]:
                        info = tarfile.TarInfo(name)
                        info.size = len(body)
                        tar.addfile(info, io.BytesIO(body))
                data = buf.getvalue()
            rows.append(dict(path=r.path, modificationTime=pd.Timestamp(0), length=len(data), content=data))
            size += len(data)
            if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                yield pd.DataFrame(rows)
                rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows)


def packed_archives(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """The LaTeX view as archives, in the ``binaryFile`` schema. ``where``: a condition on the archive's ``path``; the others are not packed.

    The documents are spread first: packing and expanding are the work, and a file of one row group is one task."""
    files = F.filter(F.array(*[F.expr(f"CASE WHEN {c} THEN {p} END") for c, p in DOC_FILES]), lambda x: x.isNotNull())
    docs = fx.tex_docs(spark, sf_dir, spread=True)
    if where is not None:
        docs = docs.withColumn("path", F.col("archive")).where(where)
    docs = docs.select(
        F.col("archive").alias("path"), F.expr(fx.MEMBER_CANDIDATES[0][1]).alias("member"), "content", files.alias("files"),
        F.expr(TWICE).alias("twice"), F.expr(BROKEN_TAR).alias("broken"), F.expr(BAD_UTF8).alias("bad_utf8"))
    return docs.mapInPandas(_pack, BINARY_FILE_SCHEMA)


def _write_files(batches: Iterator[pd.DataFrame], root: str) -> Iterator[pd.DataFrame]:
    from pyarrow import fs as pafs
    filesystem, base = pafs.FileSystem.from_uri(root)
    there: set[str] = set()
    for pdf in batches:
        for r in pdf.itertuples(index=False):
            target = f"{base}/{r.path}"
            if (folder := os.path.dirname(target)) not in there:
                filesystem.create_dir(folder, recursive=True)
                there.add(folder)
            with filesystem.open_output_stream(target, compression=None) as f:
                f.write(r.content)
        yield pd.DataFrame({"path": pdf["path"]})


def write_archive_files(archives: DataFrame, root: str) -> int:
    """Write each archive row as a file under ``root`` (any pyarrow filesystem URI); returns the count."""
    return archives.mapInPandas(lambda it: _write_files(it, root), "path string").count()


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the session's checkpoint folder (the shared folder on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    if base is None:
        raise RuntimeError("spark.checkpoint.dir is not set; it names the shared folder for job scratch data")
    if base.startswith("file:") and not base.startswith("file://"):
        base = "file://" + base[len("file:"):]
    elif "://" not in base:
        base = "file://" + base
    return f"{base.rstrip('/')}/texloom-{name}-{uuid.uuid4().hex[:12]}"
