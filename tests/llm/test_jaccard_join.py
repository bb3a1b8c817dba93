from __future__ import annotations

import random

import numpy as np
import pytest

from texloom.llm import _words as W
from texloom.llm import jaccard_join as J

from .helpers import docs_table, jaccard_components, shingles


def _texts(seed, n=60):
    r = random.Random(seed)
    vocab = [f"W{k}" for k in range(300)] + ["é", "the", "The"]
    rows = []
    for k in range(n):
        if rows and r.random() < 0.7:
            w = (r.choice(rows)[1] or "").split()
            for _ in range(r.randint(0, 4)):
                if w:
                    w[r.randrange(len(w))] = r.choice(vocab)
            w += [r.choice(vocab) for _ in range(r.randint(0, 6))]
        else:
            w = [r.choice(vocab) for _ in range(r.choice([0, 1, 3, 4, 5, 6, 20, 60, 200]))]
        rows.append((k * 7 % 61, r.choice([" ", "\t", "  ", "\n"]).join(w)))
    return rows


def _run(spark, rows):
    return sorted(map(tuple, J.jaccard_join(docs_table(spark, rows)).collect()), key=repr)


@pytest.mark.parametrize("block,often,piece", [(1 << 15, 8, 4 << 20), (64, 2, 3000), (300, 3, 900)])
def test_matches_all_pairs(spark, block, often, piece, monkeypatch):
    """Also with clusters in many blocks, most shared shingles frequent in their piece, and several pieces a task."""
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "OFTEN", often)
    monkeypatch.setattr(W, "CHUNK_BYTES", piece)
    rows = _texts(3) + [(100, None), (101, ""), (102, " \n"), (103, None)]
    assert _run(spark, rows) == sorted(jaccard_components(rows), key=repr)


@pytest.mark.parametrize("block", [64, 700, 1500])
def test_links_with_empty_blocks(spark, block, monkeypatch):
    """Sets that are large against a block leave blocks of their range and of the next one empty; links still count once."""
    monkeypatch.setattr(J, "BLOCK", block)
    r = random.Random(9)
    rows = []
    for c in range(4):
        w = [f"c{c}w{k}" for k in range(1000)]
        for k in range(3 + 3 * (c % 2)):
            near = w[:r.choice([1000, 1000, 880, 800])]
            for _ in range(r.randint(0, 6)):
                near[r.randrange(len(near))] = f"x{r.random()}"
            rows.append((len(rows), " ".join(near)))
    assert _run(spark, rows) == sorted(jaccard_components(rows), key=repr)


def test_repeated_rows_ids_and_nulls(spark):
    a, b = "one two three four five six seven eight nine ten", "a b"
    rows = [(5, a), (5, a), (3, a), (None, a), (9, b), (9, b), (None, b), (None, "only me here"), (9, None), (1, a.upper())]
    assert _run(spark, rows) == sorted(jaccard_components(rows), key=repr)


def test_equal_partitions(spark):
    """Partitions that hold the same texts: each counts for itself."""
    w = [f"w{k}" for k in range(200)]
    texts = [" ".join(w[:100]), " ".join(w[:78] + w[100:122]), " ".join(w[:90] + w[150:160])]
    rows = [(10 * p + k, t) for p in range(4) for k, t in enumerate(texts)]
    parts = [docs_table(spark, rows[3 * p:3 * p + 3]).coalesce(1) for p in range(4)]
    df = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    assert sorted(map(tuple, J.jaccard_join(df).collect())) == sorted(jaccard_components(rows))


def test_threshold_is_exact(spark):
    base = [f"w{k}" for k in range(11)]  # 7 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:10])), (3, " ".join(base[:9])), (4, " ".join(base[:10] + ["x"])), (5, " ".join(base + ["y", "z"]))]
    assert _run(spark, rows) == sorted(jaccard_components(rows), key=repr)


def test_empty_table_and_other_columns(spark):
    empty = docs_table(spark, [])
    assert J.jaccard_join(empty).collect() == []
    from pyspark.sql import functions as F
    df = docs_table(spark, [(1, "a b c d e f"), (2, "a b c d e f")]).withColumn("n_links", F.lit("x")).withColumn("component_id", F.lit(0.5))
    assert sorted(map(tuple, J.jaccard_join(df).collect())) == [(1, 2, 1, 1), (2, 2, 1, 1)]


def test_long_text(spark):
    long = " ".join(f"t{k}" for k in range(150_000))
    rows = [(1, long), (2, long + " more"), (3, "x" * 3_000_000), (4, "x" * 3_000_000)]
    got = _run(spark, rows)
    assert [(r[0], r[2], r[3]) for r in got] == [(1, 1, 1), (2, 1, 1), (3, 3, 1), (4, 3, 1)]


def test_trie_gives_all_links():
    r = random.Random(1)
    for _ in range(200):
        sets = []
        for _ in range(r.randint(1, 12)):
            s = set(r.choice(sets)) if sets and r.random() < 0.7 else set(r.sample(range(40), r.randint(1, 20)))
            for _ in range(r.randint(0, 3)):
                s ^= {r.randrange(40)}
            sets.append(sorted(s) or [0])
        sizes = [len(s) + r.randint(0, 3) for s in sets]
        trie = J.Trie([np.array(s, np.int32) for s in sets], sizes)
        present = np.zeros(50, bool)
        for s, n in zip(sets, sizes):
            want = [k for k, t in enumerate(sets) if J.linked(len(set(s) & set(t)), n, sizes[k])]
            assert sorted(trie.links(np.array(s, np.int32), n, present)) == want
            assert not present.any()


def test_shingle_sets_of_pieces():
    import pyarrow as pa
    texts = ["", None, "A b", "a B", "one two three four five one two three four five", "x\x0by\x0cz\r\n", "é È ß"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    for limit in (1, 20, 1 << 20):
        sizes, rows = [], 0
        for first, data, offsets in W.texts(batch, "text", limit):
            assert first == rows
            items, before = W.shingle_sets(*W.words(data, offsets))
            sizes += np.diff(before).tolist()
            rows += len(offsets) - 1
        assert sizes == [len(shingles(t)) for t in texts]


def _windows(n, width, step=1):
    """Excerpts of one long text: each shares shingles with its neighbours only, and all are tied."""
    r = random.Random(4)
    words = [f"w{r.randrange(5000)}x{k}" for k in range(n * step + width)]
    return [" ".join(words[k * step:k * step + width]) for k in range(n)]


@pytest.mark.parametrize("block", [16, 200])
def test_chains(spark, block, monkeypatch):
    """Chains with links (12 words: 7 of 9 shingles) and without (8 words), cut by their shingles."""
    monkeypatch.setattr(J, "BLOCK", block)
    texts = _windows(150, 8) + [t.replace("w", "v") for t in _windows(150, 12)] + [t.replace("w", "u") for t in _windows(40, 40, 3)]
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(1000 + k, t) for k, t in enumerate(texts[140:170])]
    assert _run(spark, rows) == sorted(jaccard_components(rows), key=repr)


def test_tasks_of_a_chain_grow_in_proportion(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(J, "BLOCK", 64)

    def sent(n):
        df = docs_table(spark, list(enumerate(_windows(n, 8))))
        sets = J.cut(J.possible_sets(df).withColumn("copies", F.lit(1).cast("long")))
        tied = J.cut(J.clusters(sets.select("class", "n", "tokens")))
        assert tied.select("cluster").distinct().count() == 1
        return J._tasks(sets, tied).count(), sets.count()

    (few, _), (many, sets) = sent(500), sent(2000)
    assert few * 3.5 < many < few * 4.5 and many <= 3 * sets


def test_packed_hashes():
    r = np.random.default_rng(5)
    for n in (0, 1, 3, 1000):
        for x in (r.integers(0, 1 << 64, n, np.uint64), np.full(n, (1 << 64) - 1, np.uint64), r.integers(0, 1 << 20, n, np.uint64) << np.uint64(32)):
            assert np.array_equal(J.unpacked(J.packed(np.sort(x))), np.sort(x))


def test_shingles_of_equal_lower_halves(monkeypatch):
    """Hashes that differ in their upper halves only are different shingles."""
    import types
    monkeypatch.setattr(J, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    real = W.shingle_sets

    def lower_halves(*args):
        items, before = real(*args)
        return items & np.uint64(0xFFFFFFFF00000000), before
    monkeypatch.setattr(W, "shingle_sets", lower_halves)
    batches = [b for b in J._deal(3)(iter([_batch_of([" ".join(f"w{k}" for k in range(400))] * 2 + [" ".join(f"w{k}" for k in range(390))])]))]
    dealt = {}
    for b in batches:
        for row in b.to_pylist():
            dealt.setdefault(row["part"], []).append(row)
    import pyarrow as pa
    numbers = []
    for rows in dealt.values():
        for b in J._count(3)(iter([pa.RecordBatch.from_pylist(rows, batches[0].schema)])):
            numbers += [np.frombuffer(r["items"], np.uint64) for r in b.to_pylist() if r["kind"] == J.ENTRIES]
    assert len(np.unique(np.concatenate(numbers))) == 386


def _batch_of(texts):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
