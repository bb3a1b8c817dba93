from __future__ import annotations

import math
import random

import numpy as np

from texloom.llm import topk_search as K

from .helpers import written


def _plain(rows, k=5, every=50):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in ok:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q and len(w) == len(v))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def _table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def _run(spark, scratch, rows):
    sf = written(spark, scratch, {"embeddings": _table(spark, rows)})
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in K.op2_topk_search(spark, sf).collect())


def test_matches_brute_force(spark, scratch):
    r = random.Random(2)
    rows = [(k, [float(np.float32(r.gauss(0, 0.2))) for _ in range(8)]) for k in range(400)]
    rows += [(k + 400, list(rows[k][1])) for k in range(100)]  # ties
    assert _run(spark, scratch, rows) == _plain(rows)


def test_nulls_and_odd_vectors(spark, scratch):
    rows = [(0, [1.0, 2.0]), (50, None), (100, [1.0, None]), (150, [float("nan"), 1.0]), (200, [float("inf"), 1.0]), (None, [9.0, 9.0]),
            (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [-1.0, -3.0]), (250, [1.0, 1.0, 1.0]), (4, [])]
    assert _run(spark, scratch, rows) == _plain(rows)


def test_empty_table(spark, scratch):
    assert _run(spark, scratch, []) == []


def test_small_shards_and_groups(spark):
    from pyspark.sql import functions as F
    r = random.Random(4)
    rows = [(k, [r.randint(-5, 5) for _ in range(4)]) for k in range(300)]
    v = spark.createDataFrame(rows, "id long, v array<long>").withColumn("score", F.lit("x"))
    got = sorted((x.query_id, x.rank, x.vec_id, x.score) for x in K.top_k(v, v.filter("id % 10 = 0"), 3, shard=16, group=4).collect())
    want = sorted((q, n + 1, i, -s) for q, a in rows if q % 10 == 0
                  for n, (s, i) in enumerate(sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in rows if i != q)[:3]))
    assert got == want


def test_bounds_leave_blocks():
    draw = np.random.default_rng(1)
    v = np.concatenate([draw.integers(-3, 3, (1000, 4)), draw.integers(90, 100, (64, 4))])
    found, scored = K.search_blocks(v[-1:], np.array([1063]), v, np.arange(1064), 5)
    assert len(found) == 5 and scored < 4  # of 17 blocks


def test_large_numbers_stay_exact():
    a = np.array([[2**40, 1]]), np.array([2**20, 3])
    assert K.products(a[0], a[1]).tolist() == [2**60 + 3]
