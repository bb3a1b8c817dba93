"""Available-now ingestion: a rerun takes only files added since the last run."""

from __future__ import annotations

from pyspark.sql import functions as F

from texloom.plans import archive_fixture as AF
from texloom.plans import variants as V
from texloom.streaming.ingest import ingest_incremental

from .conftest import SF_SMALL


def test_second_run_sees_only_new_files(spark, scratch):
    src, out, ckpt = scratch + "/in", scratch + "/out", scratch + "/ckpt"
    packed = AF.packed_archives(spark, SF_SMALL)
    seen = []

    def process(batch):
        seen.append(batch.count())
        return V.figure_caption_records(V.expand_members(batch, checkpoint=False)).select(
            "archive", "paper_id", "tex_path", "pos", "image_filename")

    AF.write_archive_files(packed.where(F.col("path").contains("v1")), src)
    assert ingest_incremental(spark, src, out, ckpt, process) == 1
    first = spark.read.parquet(out).count()
    assert ingest_incremental(spark, src, out, ckpt, process) == 0  # nothing new
    AF.write_archive_files(packed.where(F.col("path").contains("v2")), src)
    assert ingest_incremental(spark, src, out, ckpt, process) == 1
    total = spark.read.parquet(out)
    assert seen == [100, 100]
    assert total.count() > first
    assert total.count() == total.dropDuplicates(["archive", "tex_path", "pos"]).count()


def test_stream_and_batch_share_a_ledger(spark, scratch):
    """A replaced archive and a new one are taken, the others not; a batch run afterwards finds nothing to do."""
    import os
    import time

    from texloom.streaming.ingest import ingest_archives

    from .conftest import local_path
    from .test_variants import _figure, _put, _rows, _tar
    src, out, ckpt = scratch + "/in", scratch + "/out", scratch + "/ckpt"

    def archive(caption):
        return _tar([("m.tex", _figure("r.png", caption).encode()), ("r.png", b"R")])

    def process(members):
        figures = V.document_figures(members).drop("body")
        return {"figures": V.figure_caption_records(members, figures=figures).select("archive", "paper_id", "tex_path", "pos", "image_filename", "caption"),
                "errors": V.errors_table(members, figures)}

    _put(src, {"2301.00001.tar.gz": archive("one"), "2301.00002.tar.gz": archive("two"), "2301.00009.tar.gz": b"broken"})
    assert ingest_archives(spark, src, out, ckpt, process, n_buckets=2) == 3
    assert ingest_archives(spark, src, out, ckpt, process, n_buckets=2) == 0
    _put(src, {"2301.00001.tar.gz": archive("one again"), "2301.00003.tar.gz": archive("three")})
    os.utime(local_path(src) + "/2301.00001.tar.gz", (time.time() + 60,) * 2)
    assert ingest_archives(spark, src, out, ckpt, process, n_buckets=2) == 2
    assert [r[0] for r in _rows(spark, out, "figures", "caption")] == ["one again", "three", "two"]
    assert _rows(spark, out, "errors", "paper_id", "stage") == [("2301.00009", "expand")]
    before = spark.read.parquet(out + "/done").count()
    V.run_figure_captions(spark, src, out, n_buckets=2)
    assert spark.read.parquet(out + "/done").count() == before
    _put(src, {"2301.00004.tar.gz": archive("four")})
    V.run_figure_captions(spark, src, out, n_buckets=2)
    assert ingest_archives(spark, src, out, ckpt, process, n_buckets=2) == 0  # the stream finds it in the ledger
    assert [r[0] for r in _rows(spark, out, "figures", "caption")] == ["four", "one again", "three", "two"]


def test_a_stream_lists_its_files_in_few_tasks(spark, scratch):
    """A micro-batch is listed in some tasks per core instead of one per file; the session keeps its own setting."""
    from texloom.streaming import ingest as I
    before, seen = spark.conf.get(I.LISTING_TASKS), []

    def process(batch):
        seen.append(int(spark.conf.get(I.LISTING_TASKS)))  # the session whose setting the listing takes
        return batch.select("path")

    AF.write_archive_files(AF.packed_archives(spark, SF_SMALL), scratch + "/in")
    assert ingest_incremental(spark, scratch + "/in", scratch + "/out", scratch + "/ckpt", process) == 1
    assert seen == [min(int(before), 4 * spark.sparkContext.defaultParallelism)] and seen[0] < 200
    assert spark.conf.get(I.LISTING_TASKS) == before


def test_a_run_deals_archives_to_tasks_by_number_and_bytes(spark, scratch, monkeypatch):
    """Also after the join with a ledger, where the names alone would come in a partition or two."""
    from texloom.sources import archives as S
    monkeypatch.setattr(V, "TASK_ARCHIVES", 10)
    AF.write_archive_files(AF.packed_archives(spark, SF_SMALL, F.col("path").contains("v1")), scratch + "/in")
    first = V.Run.over(spark, scratch + "/in", scratch + "/out", "*.gz", 2)
    first.commit(V.errors_table(first.members))
    AF.write_archive_files(AF.packed_archives(spark, SF_SMALL, F.col("path").contains("v2")), scratch + "/in")
    run = V.Run.over(spark, scratch + "/in", scratch + "/out", "*.gz", 2)
    assert run.todo.count() == 100 and run.members.rdd.getNumPartitions() == 10
    assert run.members.select("archive").distinct().count() == 100
    big = spark.createDataFrame([("a", 1 << 20), ("b", 5 * V.TASK_BYTES - (1 << 20))], "path string, length long")
    assert V.spread_archives(big).rdd.getNumPartitions() == 5
    assert S.list_tree(spark, scratch + "/in", "*.gz").count() == 200
