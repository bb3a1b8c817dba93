"""Plan properties that the performance work depends on."""

from __future__ import annotations

import re

from .conftest import SF_SMALL


def plans(spark, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF_SMALL)
    qe = df._jdf.queryExecution()
    return qe.optimizedPlan().toString(), qe.executedPlan().toString()


def test_each_regex_pass_runs_once(spark):
    opt, _ = plans(spark, "interleaved_items")
    assert opt.count("regexp_extract_all") == 1                  # one tokenizer pass per document
    opt, _ = plans(spark, "figure_caption_pairs")
    assert opt.count("regexp_extract_all") == 1                  # figures extracted once
    opt, _ = plans(spark, "interleaved_list")
    assert opt.count("regexp_extract_all") == 1


def test_scans_read_only_needed_columns(spark):
    for name in ("figure_caption_pairs", "clean_text_full", "interleaved_items", "paper_ids"):
        _, phys = plans(spark, name)
        schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", phys))
        assert schemas and all("lang" not in s and "source" not in s and "n_chars" not in s for s in schemas), schemas


def test_document_level_queries_do_not_hash_shuffle(spark):
    for name in ("figure_caption_pairs", "clean_text_full", "interleaved_items", "interleaved_list",
                 "tokenize_tex"):
        _, phys = plans(spark, name)
        assert "Exchange hashpartitioning" not in phys or "hashpartitioning(doc_id" in phys, name
        assert phys.count("Exchange hashpartitioning") <= 1, name   # only the small-input spread on doc_id


def test_no_static_broadcast_of_unbounded_sides(spark):
    _, phys = plans(spark, "figure_records_resolved")
    assert "BroadcastHashJoin" not in phys   # decided by AQE on measured sizes, not by estimates


def test_documents_are_read_as_scanned(spark):
    from texloom.plans import fixtures as fx
    plan = fx.documents(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "FileScan" in plan


def test_whole_texts_reach_the_view(spark):
    """Every character of every document is in its LaTeX file."""
    from texloom.plans import fixtures as fx
    from pyspark.sql import functions as F
    tex = fx.tex_docs(spark, SF_SMALL).join(fx.documents(spark, SF_SMALL), "doc_id")
    half = F.floor(F.length("text") / 2).cast("int")
    whole = (F.contains("content", F.col("text").substr(F.lit(1), half)) & F.contains("content", F.col("text").substr(half + 1, F.length("text"))))
    assert tex.where(~whole).count() == 0
