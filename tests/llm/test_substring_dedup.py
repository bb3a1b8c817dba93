from __future__ import annotations

import hashlib
import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from texloom.llm import substring_dedup as K

from .helpers import docs_table, written


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _plain(rows, window=13):
    words = [_words(t) for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if i is not None:
                least[key] = min(i, least.get(key, i))
    out = []
    for (i, _), w in zip(rows, words):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and least[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        out.append((repr(i), len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out)


def _rows(df):
    return sorted((repr(r.doc_id), r.n_words, r.n_removed, r.kept) for r in df.collect())


def _corpus(r, n, letters, most, passages=6):
    shared = [[r.choice(letters) for _ in range(r.randint(5, 40))] for _ in range(passages)]
    rows = []
    for k in range(n):
        words = []
        while len(words) < r.randint(0, most):
            words += r.choice(shared)[r.randint(0, 4):] if r.random() < 0.4 else [r.choice(letters) for _ in range(r.randint(1, 12))]
        rows.append((k * 3 % n, r.choice([" ", "  ", "\n", " \t\x0b"]).join(words)))
    return rows


def test_brute_force_on_small_alphabets(spark):
    """Few words: branching nodes, circles and texts that repeat themselves."""
    r = random.Random(6)
    for letters, window in (("ab", 5), ("abc", 4), (["xx", "Xx", "é", "—"], 6)):
        rows = _corpus(r, 60, letters, 80)
        rows += [rows[3], rows[3], (None, rows[5][1]), (None, None), (5, None), (6, ""), (7, " \n "), (1000, rows[9][1]), (2000, rows[9][1])]
        rows += [(3000, "z " * 50), (3001, "z " * 60)]
        docs = docs_table(spark, rows).withColumn("piece", F.lit("x")).withColumn("kept", F.lit(1)).withColumn("place", F.lit(2)).repartition(5)
        for chunk, piece in ((1 << 20, 1 << 20), (64, 200)):
            assert _rows(K.remove_repeated_words(docs, window, chunk, piece)) == _plain(rows, window)


def test_query(spark, scratch):
    r = random.Random(2)
    rows = _corpus(r, 80, [f"w{k}" for k in range(300)], 200)
    rows += [(k + 200, " ".join(_words(rows[4][1]) * 2)) for k in range(40)]  # copies
    found = K.op12_substring_dedup(spark, written(spark, scratch, {"documents": docs_table(spark, rows)})).collect()
    want = [(i, n, m, hashlib.sha256(t.encode()).hexdigest()) for i, n, m, t in _plain(rows)]
    assert sorted((repr(x.doc_id), x.n_words, x.n_removed, x.kept_sha256) for x in found) == sorted(want)


def test_empty_table(spark, scratch):
    assert K.op12_substring_dedup(spark, written(spark, scratch, {"documents": docs_table(spark, [])})).collect() == []


def test_long_texts_in_segments_equal_one_pass(spark):
    r = random.Random(9)
    long = " ".join(r.choice(["alpha", "beta", "gamma", "δ"]) + str(r.randint(0, 50)) for _ in range(6000))
    w = long.split(" ")
    rows = [(1, long), (2, " ".join(w[1000:1300])), (3, " ".join(w[2000:])), (4, long), (5, "x" * 5000 + " " + " ".join(w[:40])), (0, " ".join(w[5000:5030]))]
    assert _rows(K.remove_repeated_words(docs_table(spark, rows), 13, 500, 4000)) == _plain(rows)


def test_segments_cover_every_window_once():
    r = random.Random(3)
    for _ in range(50):
        text = "".join(r.choice("ab é\n ") for _ in range(r.randint(0, 300))).encode()
        whole = re.findall(rb"[^\x20\x09-\x0D]+", text)
        found = []
        for c in K.chunks(pa.array([text.decode()]), 20, 4):
            w = [c.data[a:b].tobytes() for a, b in zip(c.starts, c.ends)]
            for at, first in zip(c.at, c.first):
                assert whole[first:first + 4] == w[at:at + 4]
                found.append(int(first))
        assert found == list(range(max(0, len(whole) - 3)))


def test_kept_words_over_pieces():
    import numpy as np
    r = random.Random(5)
    for _ in range(100):
        words = [r.choice(["a", "bcd", "é"]) for _ in range(r.randint(0, 60))]
        first = np.array(sorted(r.randint(0, 60) for _ in range(3)))
        first = first[first < len(words)]
        end = np.minimum(first + r.randint(1, 9), len(words))
        gone = {k for a, b in zip(first, end) for k in range(a, b)}
        got = K.keep_words(" \n".join(words).encode(), first, end, 7)
        assert got == (" ".join(x for k, x in enumerate(words) if k not in gone), len(words), len(gone))


def test_one_row_per_path_and_piece(spark):
    """A passage that every document holds: rows of paths grow with the pieces, not with documents or windows."""
    words = " ".join(f"p{k}" for k in range(200))
    rows = [(k, f"own{k} {words} end{k}") for k in range(500)]
    table = K.write_pieces(docs_table(spark, rows).coalesce(1))
    assert table.count() == 1
    chunk = next(K.chunks(pa.array([t for _, t in rows[:2]]), 1 << 20, 13))
    import numpy as np
    shared = np.isin(chunk.edges, chunk.edges[chunk.doc == 0][1:-1])
    first, length = K.paths(chunk, np.where(shared, K.REPEATED | K.ON | K.FROM, 0).astype(np.uint8))
    assert len(first) == 2 and length.tolist() == [188, 188]
    done = K.remove_repeated_words(docs_table(spark, rows))
    assert {r.n_removed for r in done.filter("doc_id > 0").collect()} == {200}


def test_texts_are_not_shuffled(spark):
    """Steps that read texts join on the bucketed piece: no exchange carries the column ``texts``."""
    rows = [(k, " ".join(f"w{(k + j) % 40}" for j in range(50))) for k in range(50)]
    plan = K.remove_repeated_words(docs_table(spark, rows))._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "Exchange" in line]
    assert "SelectedBucketsCount" in plan or "Bucketed: true" in plan
    assert plan.count("texts") > 0 and not any("texts" in line for line in exchanged)


def test_a_reply_meets_one_row(spark):
    """A piece is one row: what comes back to it is not repeated beside other rows of texts."""
    words = " ".join(f"p{k}" for k in range(200))
    rows = [(k, f"own{k} {words} end{k}") for k in range(50)]
    table = K.write_pieces(docs_table(spark, rows).coalesce(1), 4000).select("piece", F.size("ids").alias("n"), F.size("texts").alias("m")).collect()
    assert len(table) > 10 and len({r.piece for r in table}) == len(table) and all(r.n == r.m for r in table) and sum(r.n for r in table) == 50
    assert _rows(K.remove_repeated_words(docs_table(spark, rows).coalesce(1), 13, 1000, 4000)) == _plain(rows)
