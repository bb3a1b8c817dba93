"""Incremental ingestion: process only archives not seen before.

A file-source stream over the archive folder with ``trigger(availableNow=True)``
runs every new file once and stops; the stream checkpoint remembers which files
were taken, so a rerun sees only files added since. Each micro-batch calls the
batch plan and writes its own output folder ``batch=<id>`` in overwrite mode, so
a retried batch replaces its partial output instead of duplicating it. No
aggregation state is kept, so no watermark is needed.

``ingest_archives`` is the form for archives of any size and number: its stream carries names of archives (no bytes) from a listing that tasks
make, the archives are opened by path, and its batches commit to the ledger that the batch runs use, keyed by path and modification time. What one of them has done the other
does not do again, and an archive that was replaced, or whose storage failed, is taken once more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from ..sources.archives import list_tree

BINARY_FILE_STRUCT = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


# A micro-batch of a file stream is given as paths, and Spark lists them again in a job: a task per path, up to this setting.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Streams that run within list their files in some tasks per core, not in a task per file. (A file stream lists with its session's
    settings as they are then.) The session's setting is as before afterwards."""
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, min(int(before), 4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


def ingest_incremental(spark: SparkSession, source_dir: str, output_dir: str, checkpoint_dir: str,
                       process: Callable[[DataFrame], DataFrame | dict[str, DataFrame]], glob: str = "*.gz",
                       max_files_per_batch: int = 10000, fmt: str = "parquet") -> int:
    """Run ``process`` over archives in ``source_dir`` that earlier runs did not take.

    ``process`` returns one table, or several by name (figures, errors, ...), each under its own folder.
    Returns the number of micro-batches run.
    """
    stream = (spark.readStream.format("binaryFile").schema(BINARY_FILE_STRUCT)
              .option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", max_files_per_batch)
              .load(source_dir))
    batches: list[int] = []

    def run_batch(df: DataFrame, batch_id: int) -> None:
        out = process(df)
        for name, table in (out.items() if isinstance(out, dict) else [("", out)]):
            folder = "/".join(x for x in (output_dir.rstrip("/"), name, f"batch={batch_id}") if x)
            table.write.mode("overwrite").format(fmt).save(folder)
        batches.append(batch_id)

    with few_listing_tasks(spark):
        q = (stream.writeStream.foreachBatch(run_batch)
             .option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    return len(batches)


# A row per archive of a listing that the stream is to take.
PENDING = "path string, modificationTime timestamp, length long, attempts int"


def _write_pending(spark: SparkSession, pending: DataFrame, folder: str, per_file: int) -> None:
    """The listing as files of at most ``per_file`` archives, hardly more of them than that makes."""
    pending = materialize(pending)
    n = pending.count()
    if n:
        spare = pending.rdd.getNumPartitions()  # dealt round-robin, a file gets at most one archive of each over its share
        files = -(-n // (per_file - spare if 2 * spare < per_file else per_file))
        pending.repartition(files).write.mode("append").option("maxRecordsPerFile", per_file).parquet(folder)


def ingest_archives(spark: SparkSession, source_dir: str, output_dir: str, checkpoint_dir: str,
                    process: Callable[[DataFrame], dict[str, DataFrame]], glob: str = "*.gz",
                    max_files_per_batch: int = 10000, n_buckets: int = 64) -> int:
    """Run ``process`` over the members of archives that no run has committed as they are now. Returns the archives taken.

    ``process``: members -> tables by name, ``errors`` among them; read them with ``plans.variants.read_output``. Tasks list the folder,
    and the listing is compared with the ledger once, so new, replaced and pending archives are found alike. What is to be taken is written
    under ``<checkpoint_dir>/pending`` in files of at most ``max_files_per_batch`` archives, and these are what the stream streams, one a
    micro-batch: it keeps a name per file of names, not one per archive, and a batch costs the same whatever the folder and the ledger hold.

    Files that a stopped call has left there are streamed first, and held against the ledger batch by batch: a micro-batch that is
    repeated after its commit finds its archives there and does nothing."""
    from ..plans import variants as V
    taken, pending = [0], f"{checkpoint_dir.rstrip('/')}/pending"

    def take(todo: DataFrame) -> None:
        run = V.Run(spark, todo, output_dir, n_buckets)
        if run.n:
            tables = process(run.members)
            for name, table in tables.items():
                if name != "errors":
                    run.write(table, name)
            run.commit(tables["errors"])
            taken[0] += run.n

    def left(batch: DataFrame) -> DataFrame:
        return V.pending_archives(batch, V.ledger(spark, output_dir))

    def stream(of: Callable[[DataFrame], DataFrame]) -> None:
        q = (spark.readStream.schema(PENDING).option("maxFilesPerTrigger", 1).parquet(pending)
             .writeStream.foreachBatch(lambda batch, _: take(of(batch)))
             .option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}/stream")
             .trigger(availableNow=True).start())
        q.awaitTermination()

    if V._read(spark, pending) is not None:
        stream(left)
    _write_pending(spark, left(list_tree(spark, source_dir, glob)), pending, max_files_per_batch)
    if V._read(spark, pending) is not None:
        stream(lambda batch: batch)
    return taken[0]
