from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from texloom.llm import spelling_variants as K

from .helpers import LOWER, UPPER, docs_table, written


def _words(rows):
    """Counts of the contract's words, occurrence by occurrence."""
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(UPPER, LOWER))
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def _apart(a, b):
    """Exactly one letter inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def _plain(words):
    near = {w: sorted((-n, x) for x, n in words.items() if _apart(w, x)) for w in words}
    form = {w: near[w][0][1] if near[w] and -near[w][0][0] >= 10 * words[w] else None for w in words}
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w] or "", root, n, len(near[w]), words[form[w]] if form[w] else -1))
    return sorted(out)


def _rows(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


def test_query_matches_brute_force(spark, scratch):
    r = random.Random(4)
    base = ["balloons", "ballooon", "aaaaaaaa", "hôtelsÿx", "Straßens", "seventy"]
    texts = []
    for k in range(60):
        words = []
        for _ in range(60):
            w = r.choice(base)
            if r.random() < 0.2:
                at = r.randrange(len(w))
                w = r.choice([w[:at] + w[at + 1:], w[:at] + r.choice("abzé") + w[at:], w[:at] + r.choice("abzé") + w[at + 1:]])
            words.append(w.upper() if r.random() < 0.1 and w.isascii() else w)
        texts.append((k if k % 9 else None, r.choice([" ", ", ", "—", "1"]).join(words)))
    rows = texts + [texts[0], (100, None), (101, ""), (102, "Āballoonsā ÀÀÀÀÀÀÀ à" + "à" * 7)]
    docs = docs_table(spark, rows).withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    assert _rows(K.op13_spelling_variants(spark, written(spark, scratch, {"documents": docs}))) == _plain(_words(rows))


def test_random_vocabularies(spark):
    r = random.Random(8)
    for size in (2, 3):
        words = {"".join(r.choice("abéz"[:size]) for _ in range(r.randint(1, 6))): r.choice([1, 5, 5, 10, 60, 700]) for _ in range(150)}
        df = spark.createDataFrame(list(words.items()), "word string, n long")
        assert _rows(K.spelling_variants(df)) == _plain(words)


def test_chains_of_forms(spark):
    words = {"aaaaaaaa"[:7] + "bcdefgh"[:k]: 10**k for k in range(8)}  # each is the next one's prefix
    assert _rows(K.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long"))) == _plain(words)


def test_empty_table(spark, scratch):
    assert K.op13_spelling_variants(spark, written(spark, scratch, {"documents": docs_table(spark, [])})).collect() == []


def test_long_texts_are_read_in_pieces():
    r = random.Random(1)
    text = "".join(r.choice("abcdefghijé .") for _ in range(20000))
    whole = [x for x in re.findall("[A-Za-zÀ-ÿ]+", text) if len(x) >= 7]
    assert list(K.runs(text, 7, piece=50)) == whole
    assert list(K.runs("a" * 1000, 7, piece=10)) == ["a" * 1000]


def test_words_are_handed_on_when_many_are_held(spark):
    rows = [(k, f"variant{chr(97 + k % 26)} another{chr(97 + k % 7)}") for k in range(300)]
    found = {r.word: r.n for r in K.count_words(docs_table(spark, rows), held=3).collect()}
    assert found == _words(rows)


def test_a_hot_word_emits_one_fact_per_group(spark):
    """A word with very many neighbours: groups stay as small as the alphabet, and facts grow with the entries."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {"mmmmmmmm": 10000} | {"mmmmmmmm"[:k] + c + "mmmmmmmm"[k + 1:]: 2 for k in range(8) for c in letters if c != "m"}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    entries = K.rotations(df)
    assert entries.groupBy("prefix").count().agg(F.max("count")).first()[0] <= len(letters) + 1
    assert _rows(K.spelling_variants(df)) == _plain(words)
