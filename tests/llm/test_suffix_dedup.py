from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from texloom.llm import suffix_dedup as X

from .helpers import docs_table, repeats, written


@pytest.mark.parametrize("seed", range(8))
def test_contexts_and_arrays_match_brute_force(seed):
    """Small strings: every start is in one context, and the arrays find just the repeated ones."""
    for trial in range(40):
        r = random.Random(seed * 1000 + trial)
        size, gram = r.choice([6, 8, 12]), r.choice([2, 3, 4])
        alphabet = r.choice([b"ab", b"abc", b"abcdefgh", b"a", b"a-", bytes(range(256))])
        texts = []
        for _ in range(r.randint(1, 6)):
            t = bytes(r.choice(alphabet) for _ in range(r.randint(0, 40))) + bytes([r.choice(alphabet)]) * r.choice([0, 0, 30])
            if texts and r.random() < 0.5:
                o = r.choice(texts)
                a = r.randint(0, len(o))
                t = t[:r.randint(0, len(t))] + o[a:a + r.randint(0, 30)] + t[:5]
            texts.append(t)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        anchor, content, text, _, first, last = X.contexts(np.frombuffer(b"".join(texts), np.uint8), offsets, size, gram)
        members = defaultdict(list)
        for k in range(len(anchor)):
            members[int(anchor[k]), int(content[k])].append(k)
        keys = sorted(members)
        pieces = [texts[text[members[k][0]]][first[members[k][0]]:last[members[k][0]] + size] for k in keys]
        got = [[False] * len(t) for t in texts]
        seen = [[0] * max(0, len(t) - size + 1) for t in texts]
        if pieces:
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
            starts = np.diff(bounds) - (size - 1)
            flags = X.repeated(np.frombuffer(b"".join(pieces), np.uint8), bounds, starts, np.array([k[0] for k in keys]), size)
            for q, k in enumerate(keys):
                for m in members[k]:
                    for j in range(starts[q]):
                        at = first[m] + j
                        seen[text[m]][at] += 1
                        if len(members[k]) > 1 or flags[bounds[q] + j]:
                            got[text[m]][at:at + size] = [True] * size
        assert all(n == 1 for s in seen for n in s)
        assert got == repeats(texts, size)


def test_suffix_order_is_sorted():
    r = random.Random(4)
    for _ in range(100):
        pieces = [bytes(r.choice(b"abc") for _ in range(r.randint(8, 30))) for _ in range(r.randint(1, 5))]
        text = np.frombuffer(b"".join(pieces), np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        starts = np.diff(bounds) - 7
        order, odd = X.suffix_order(text, bounds, starts, 8)
        strings = [text[p:p + 8].tobytes() for p in order]
        assert strings == sorted(strings)
        want = sorted(p for k in range(len(pieces)) if not odd[k] for p in range(bounds[k], bounds[k] + starts[k]))
        assert sorted(order.tolist()) == want
        got = X.common_prefixes(text, order, 8).tolist()
        assert got == [next((k for k in range(8) if a[k] != b[k]), 8) for a, b in zip(strings, strings[1:])]


def _plain(rows):
    data = [(t or "").encode() for _, t in rows]
    out = []
    for (i, _), d, gone in zip(rows, data, repeats(data, X.SIZE)):
        kept = bytes(b for b, g in zip(d, gone) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _run(spark, scratch, rows):
    sf = written(spark, scratch, {"documents": docs_table(spark, rows)})
    return sorted(map(tuple, X.op5_suffix_dedup(spark, sf).collect()), key=repr)


@pytest.mark.parametrize("piece,crowd", [(4 << 20, 1 << 14), (700, 1 << 14), (4 << 20, 1), (700, 3)])
def test_matches_brute_force(spark, scratch, piece, crowd, monkeypatch):
    """Also in small pieces, and with anchors that are too crowded for an array."""
    monkeypatch.setattr(X, "PIECE_BYTES", piece)
    monkeypatch.setattr(X, "CROWD", crowd)
    r = random.Random(9)
    text = lambda n: "".join(r.choice("abcdeé \n") for _ in range(n))
    passage, license_ = text(300), text(210)
    rows = [(k, text(r.randint(0, 500))) for k in range(30)]
    rows += [(40 + k, text(50) + passage + text(60)) for k in range(4)]  # shared by several
    rows += [(50 + k, text(20 * k) + license_[:190 + 5 * k]) for k in range(4)]  # around the bound of 200
    rows += [(60, passage + passage), (61, "-" * 1000), (62, "x" + "-" * 600 + "y"), (63, "ab" * 400), (64, text(199)), (65, text(200))]
    rows += [(66, rows[3][1]), (67, rows[-1][1]), (70, None), (71, ""), (None, passage), (66, rows[3][1]), (80, "\x00" * 250 + "a")]
    assert _run(spark, scratch, rows) == _plain(rows)


def test_repeated_rows_and_empty_table(spark, scratch):
    a = "".join(chr(97 + k % 26) for k in range(200)) + "!"
    rows = [(1, a), (1, a), (None, None), (None, None)]
    assert _run(spark, f"{scratch}/a", rows) == _plain(rows)
    assert _run(spark, f"{scratch}/b", []) == []


def test_long_text(spark, scratch):
    r = random.Random(5)
    long = "".join(r.choice("abcdefghij") for _ in range(400_000))
    rows = [(1, long), (2, "start" + long[1000:300_000]), (3, "unrelated")]
    got = {x[0]: x for x in _run(spark, scratch, rows)}
    assert got[1][2:4] == (299_000, 1) and got[2][2:4] == (299_000, 1) and got[3][2] == 0


def test_text_is_cut_at_characters_and_columns_stay(spark):
    from pyspark.sql import functions as F
    body = "é" * 150 + "".join(chr(0x100 + k) for k in range(60))
    docs = docs_table(spark, [(1, "aé" + body + "z"), (2, "bé" + body + "ü")]).withColumn("Spans", F.lit(1)).withColumn("key", F.lit("k"))
    out = X.remove_repeats(docs, as_text=True)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "spans", "kept"]
    assert {r.doc_id: r.kept for r in out.collect()} == {1: "az", 2: "bü"}


def test_many_equal_rows_match_brute_force(spark, scratch):
    r = random.Random(7)
    text = "".join(r.choice("abcd ") for _ in range(900))
    rows = [(1, text)] * 50 + [(2, text[100:500] + "x")] * 3 + [(3, "y" * 250)] * 2 + [(4, "".join(r.choice("efg ") for _ in range(700)))]
    assert _run(spark, scratch, rows) == _plain(rows)


def test_equal_rows_are_members_once(spark):
    """What goes to an anchor and comes back does not grow with the number of equal rows."""
    r = random.Random(8)
    text = "".join(r.choice("abcdefgh ") for _ in range(3000)).encode()
    sizes = []
    for n in (10, 500):
        batch = pa.RecordBatch.from_arrays([pa.array([5] * n), pa.array([text.decode()] * n)], ["key", "text"])
        (found,) = X._find(iter([batch]))
        assert set(found.column(2).to_pylist()) == {n}
        sizes.append((found.num_rows, len(found.column(3).values)))
        wanted = pa.array([[{"anchor": 1, "content": 2, "copies": 3, "place": 4 << 8, "crowded": False}]] * n)
        given = list(X._cut_contexts(iter([pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), wanted], ["key", "text", "wanted"])])))
        assert sum(b.num_rows for b in given) == 1
    assert sizes[0] == sizes[1]
