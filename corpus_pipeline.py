"""The corpus pipeline: from ``documents`` to a training mix.

1. toxicity: documents that the classifier chain rejects go.
2. n-gram Jaccard join: of each group of near copies the document with the smallest id stays.
3. suffix-array dedup: bytes covered by a repeated string of 200 bytes go; a document of which nothing is left goes.
4. benchmark decontamination: documents that hold a benchmark item, also a re-parameterised one, go.
5. source mix: how many words the mix takes from each document that is left.

Each stage works on what the stage before it kept, written as Parquet to the shared folder and read again. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from texloom.llm import toxicity
from texloom.llm._cluster import new_folder, read_table
from texloom.llm.decontaminate import decontaminate
from texloom.llm.jaccard_join import jaccard_groups
from texloom.llm.source_mix import mixed_documents
from texloom.llm.suffix_dedup import remove_repeats


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not rejected. The chain is fitted on labelled rows of ``docs``."""
    chain = toxicity.trained(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, chain, toxicity.CATEGORIES, keep_only=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents: the smallest id (null last); all documents without words.

    Rows that are equal in all columns are one document of a group like others; one of them stays."""
    keyed = docs.withColumn("_row", F.xxhash64(*docs.columns))
    groups = jaccard_groups(keyed.select("doc_id", "text", "_row"), "_row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row"))
    chosen = groups.filter("component is not null").groupBy("component").agg(first.alias("f")).select(F.col("f._row").alias("_row"))
    wordless = groups.filter("component is null").select("_row").distinct()
    kept = chosen.withColumn("_one", F.lit(True)).unionByName(wordless.withColumn("_one", F.lit(False)))
    nth = F.row_number().over(Window.partitionBy("_row").orderBy("_row"))
    return keyed.join(kept, "_row").withColumn("_nth", nth).filter("not _one or _nth = 1").select(*docs.columns)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of repeated passages; a character that loses some of its bytes goes whole."""
    done = remove_repeats(docs, as_text=True)
    cut = F.size("spans") > 0
    left = done.filter(~(cut & (F.trim(F.regexp_replace("kept", r"\s+", " ")) == "")))
    return left.select(*[F.when(cut, F.col("kept")).otherwise(F.col("text")).alias("text") if c == "text"
                         else F.when(cut, F.length("kept").cast("long")).otherwise(F.col(c)).alias(c) if c == "n_chars"
                         else F.col(c) for c in docs.columns])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"), keep_only=True)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("suffix_dedup", drop_repeats),
    ("decontaminate", drop_leaks),
    ("source_mix", mix),
]

#: A chain of learned and iterative stages has no SQL form; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
