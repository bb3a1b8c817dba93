from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from texloom.llm import _words as W
from texloom.llm import toxicity as X

from .helpers import docs_table, written


def _corpus(n=900, seed=5):
    r = random.Random(seed)
    clean = [f"{a}{b}" for a in ("ba", "de", "gi", "lo", "mu") for b in ("ran", "tel", "sim", "dor", "pun", "kev")]
    rows, labels = [], []
    for k in range(n):
        toxic = r.random() < 0.3
        w = [r.choice(clean) for _ in range(r.randint(5, 80))]
        if toxic:
            bad = r.choice([["idiot"], ["zorgh" + r.choice(clean)], ["moron", "scum"]])
            w[r.randrange(len(w)):0] = bad
        rows.append((k, " ".join(w)))
        labels.append((k, int(r.random() < 0.8), int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, scratch):
    rows, labels = _corpus()
    shown = spark.createDataFrame(labels[:700], "doc_id long, quality int, toxic int")
    sf = written(spark, scratch, {"documents": docs_table(spark, rows), "labels": shown})
    got = {r.doc_id: r for r in X.op3_toxicity(spark, sf).collect()}
    assert len(got) == len(rows)
    tests = labels[700:]
    right = sum(got[i].rejected == bool(t) for i, _, t in tests)
    assert right >= 0.97 * len(tests)
    again = {r.doc_id: r for r in X.op3_toxicity(spark, sf).collect()}
    assert got == again


def test_odd_tables(spark, scratch):
    from pyspark.sql import functions as F
    rows, labels = _corpus(300)
    odd = [(None, None), (9001, None), (9002, ""), (9003, "idiot " * 200_000), (9003, "idiot " * 200_000), (0, rows[0][1])]
    docs = docs_table(spark, rows + odd).withColumn("toxic", F.lit("mine")).withColumn("Rejected", F.lit(1)).withColumn("x y", F.lit(2))
    odd_labels = [(None, 1, 1), (1, None, None), (9001, 1, 0), (77777, 0, 1)]
    lab = spark.createDataFrame(labels + odd_labels, "doc_id long, quality int, toxic int")
    out = X.score(docs, X.trained(docs, lab), X.CATEGORIES)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "x y", *X.CATEGORIES, "rejected"]
    found = out.collect()
    assert len(found) == len(rows) + len(odd)
    long = [r for r in found if r.doc_id == 9003]
    assert all(r.rejected for r in long) and long[0].toxic == long[1].toxic
    assert all(not r.rejected and 0 <= r.toxic <= 1 for r in found if not r.text)


def test_no_labels_and_no_documents(spark):
    docs, none = docs_table(spark, [(1, "idiot"), (2, None)]), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = X.score(docs, X.trained(docs, none), X.CATEGORIES).collect()
    assert [(r.toxic, r.rejected) for r in out] == [(0.0, False)] * 2
    one = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert X.score(docs_table(spark, []), X.trained(docs, one), X.CATEGORIES).collect() == []


def test_keep_only_returns_the_columns(spark):
    rows, labels = _corpus(300)
    docs = docs_table(spark, rows)
    chain = X.trained(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    kept = X.score(docs, chain, X.CATEGORIES, keep_only=True)
    assert kept.schema == docs.schema
    scored = {r.doc_id: r.rejected for r in X.score(docs, chain, X.CATEGORIES).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, gone in scored.items() if not gone}


def test_later_models_see_out_of_fold_probabilities():
    draw = np.random.default_rng(3)
    n = 400
    noise = draw.integers(0, 1 << X.BITS, (n, 30)) & ~1
    numbers, owners = noise.ravel().astype(np.int64), np.repeat(np.arange(n), 30)
    y = (draw.random(n) < 0.5).astype(int)
    labels = np.stack([y, y], axis=1)
    chain = X.fit_chain(numbers, owners, labels, np.arange(n) % X.FOLDS)
    # the first category cannot be learned from noise: out of fold its probability tells the second model nothing
    assert abs(float(chain[1]["extra"][0])) < 3


def test_features_do_not_depend_on_pieces():
    texts = ["Idiot, idiot!", "", None, "ab abcd abcdefg", "été l'été"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    found = []
    for limit in (1, 1 << 20):
        rows = [set() for _ in texts]
        for first, data, offsets in W.texts(batch, "text", limit):
            for f, t in zip(*X._distinct(*X.features(data, offsets))):
                rows[first + t].add(int(f))
        found.append(rows)
    assert found[0] == found[1]
    assert found[0][1] == found[0][2] == set()


def test_fitting_holds_a_feature_and_its_owner_in_4_bytes_each():
    """The fit's arrays, one task's largest: memory per entry stays small and the models stay what wide arrays give."""
    import tracemalloc

    r = np.random.default_rng(3)
    y = (np.arange(4000) % 5 == 0).astype(float)
    packed = [np.unique(np.concatenate([r.integers(0, 1 << X.BITS, 300), [2, 4, 6][k % 3:] if y[k] else [8]])).astype(np.uint32).tobytes() for k in range(4000)]
    tracemalloc.start()
    numbers, owners = X.entries(packed), X.owners_of(packed)
    assert numbers.itemsize == owners.itemsize == 4
    X.fit(numbers, owners, np.zeros((4000, 0)), y, np.arange(4000))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 36 * len(numbers)
    labels = np.stack([y, 1 - y], axis=1)
    a = X.fit_chain(numbers, owners, labels, np.arange(4000) % X.FOLDS)
    b = X.fit_chain(numbers.astype(np.int64), owners.astype(np.int64), labels, np.arange(4000) % X.FOLDS)
    assert all(np.array_equal(m[k], n[k]) for m, n in zip(a, b) for k in m)
