"""Cleaning chain and scalar text functions: edge cases and a property test
against a plain-Python fold written from the rules."""

from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from texloom.functions import text as T


def py_clean(s: str, chain: str = "full") -> str:
    """The rules applied with Python's ``re``, one after another."""
    rules = T.CLEAN_RULES_FULL if chain == "full" else T.CLEAN_RULES_SHORT
    for pattern, repl in rules:
        if pattern == "SQUEEZE":
            s = re.sub(r"\s+", " ", s).strip()
        elif pattern.startswith("(?i)"):
            s = re.sub(pattern[4:], repl, s, flags=re.IGNORECASE)
        else:
            s = re.sub(pattern, repl, s)
    return s


def spark_clean(spark, values, chain="full"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", T.clean_text("v", chain).alias("c")).orderBy("i").collect()
    return [r.c for r in rows]


def test_edge_cases(spark):
    cases = {
        "{x{y}z}": "z}",                       # brace step is not nested
        "v1.0inference": "vference",           # lengths have no word boundary
        "50\\% ok": "50 ok",                   # escaped percent loses both characters
        "a $x+y$ b % comment\nc": "a b c",
        "\\textbf{Bold} text \\\\ more": "text more",
        "see fig.PDF and a/b.png here": "see and here",
        "  - leading dash": "leading dash",
        "width=0.5 12pt 3in 2.5em done": "done",
    }
    got = spark_clean(spark, list(cases))
    assert got == list(cases.values())
    assert got == [py_clean(k) for k in cases]


LATEXISH = st.text(alphabet=list("ab é1.2 \\{}$%-_/\n\tptinemPDF,=trimclipfigures[]Ü٣"), max_size=80)


@settings(max_examples=60, deadline=None)
@given(st.lists(LATEXISH, min_size=1, max_size=20))
def test_clean_matches_python(spark, values):
    assert spark_clean(spark, values, "full") == [py_clean(v, "full") for v in values]
    assert spark_clean(spark, values, "short") == [py_clean(v, "short") for v in values]


def test_scalar_functions(spark):
    df = spark.createDataFrame([
        ("dir/2301.00001.tar.gz", "x.pdf.d/y.pdf", "  {figs/a.png}\n"),
        ("arXiv-2301.00001v1.tar.gz", "a.PDF", "{b}"),
        ("hep-th9901001.gz", None, "c"),
    ], "name string, link string, arg string")
    rows = df.select(
        T.paper_id_stem("name").alias("stem"),
        T.paper_id_regex("name", "stem").alias("pid"),
        T.paper_id_regex("name", "unknown").alias("pid_c"),
        T.paper_id_normalize(T.paper_id_regex("name")).alias("key"),
        T.rewrite_extension("link").alias("link"),
        T.strip_braces("arg").alias("arg"),
        T.path_basename("name").alias("base"),
        T.asset_kind("link").alias("kind"),
    ).collect()
    assert [r.stem for r in rows] == ["2301.00001.tar", "arXiv-2301.00001v1.tar", "hep-th9901001"]
    assert [r.pid for r in rows] == ["2301.00001", "2301.00001", "hep-th9901001"]
    assert [r.pid_c for r in rows] == ["2301.00001", "2301.00001", "unknown"]
    assert [r.key for r in rows] == ["2301_00001", "2301_00001", "hep-th9901001"]
    assert [r.link for r in rows] == ["x.png.d/y.png", "a.PDF", None]
    assert [r.arg for r in rows] == ["figs/a.png", "b", "c"]
    assert [r.base for r in rows] == ["2301.00001.tar.gz", "arXiv-2301.00001v1.tar.gz", "hep-th9901001.gz"]
    assert [r.kind for r in rows] == ["pdf", "pdf", "raster"]


def test_decode_and_body(spark):
    df = spark.createDataFrame([(b"a\r\nb\rc",), (b"bad \xe9",), (b"pre\\begin{document}body",)], "b binary")
    rows = df.select(T.decode_text("b").alias("t")).collect()
    assert [r.t for r in rows] == ["a\nb\nc", None, "pre\\begin{document}body"]
    body = df.select(T.document_body(T.decode_text("b")).alias("x")).collect()
    assert body[2].x == "\\begin{document}body" and body[0].x == "a\nb\nc"


def test_relative_key(spark):
    df = spark.createDataFrame([("s3a://bk/out/a/b.json",), ("s3a://other/x",)], "p string")
    assert [r.k for r in df.select(T.relative_key("p", "s3a://bk/out").alias("k")).collect()] == ["a/b.json", None]


def test_strip_is_unicode(spark):
    df = spark.createDataFrame([("\u00a0 x \t\n",)], "s string")
    assert df.select(T.strip_ws("s").alias("s")).first().s == "x"
    assert df.select(F.trim("s").alias("s")).first().s != "x"


def test_long_tokens_are_read_once(spark):
    """Doubling an unbroken token does not take four times as long."""
    import time

    def seconds(text):
        df = spark.createDataFrame([(text,)], "t string").select(T.clean_text("t", "full").alias("c"))
        df.collect()
        t0 = time.perf_counter()
        df.collect()
        return time.perf_counter() - t0

    for token in ("a./" * 60_000, "1." * 90_000, "{" * 150_000, "x" + " " * 150_000 + "y"):
        one, two = seconds(token), seconds(token * 2)
        assert two < 3 * one + 0.5, (token[:5], one, two)


def test_run_start_guards_change_nothing(spark):
    """The guarded rules against the plain ones, on random strings of the characters that matter."""
    import random
    import re
    r = random.Random(3)
    texts = ["".join(r.choice("1.2pt inem/a_.pdf.PNG{}é٣") for _ in range(r.randint(0, 40))) for _ in range(3000)]
    plain = [(p, repl) for p, repl in T.CLEAN_RULES_FULL if T._from_run_start(p) != p or p == T.BRACE_GROUP]
    assert len(plain) == 5
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", *[F.coalesce(T._drop_brace_groups(F.col("t")) if p == T.BRACE_GROUP else
                                      F.regexp_replace("t", T._FLAGS + T._from_run_start(p), "")).alias(f"c{k}") for k, (p, _) in enumerate(plain)])
    for row in out.collect():
        for k, (p, _) in enumerate(plain):
            assert row[f"c{k}"] == re.sub(p, "", row.t), (p, row.t)
