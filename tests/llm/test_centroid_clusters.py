from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from texloom.llm import centroid_clusters as K

from .helpers import written


def _plain(rows):
    """The contract by loops over plain integers."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) and abs(x) < K.LARGEST for x in v)]
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:16]
    centroids = [v for _, v in first]
    if not centroids:
        return []
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))
    for _ in range(3):
        own = [[v for _, v in kept if near(v)[1] == k] for k in range(len(centroids))]
        centroids = [[sum(x) // len(vs) for x in zip(*vs)] if vs else c for vs, c in zip(own, centroids)]
    out = [(i, *near(v)) for i, v in kept]
    each = {k: sum(d for _, d, c in out if c == k) for k in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((repr(i), c, d, each[c], sum(each.values()), digest[c]) for i, d, c in out)


def _run(spark, scratch, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("x")).withColumn("id", F.lit(1))
    sf = written(spark, scratch, {"embeddings": table})
    found = K.op11_centroid_clusters(spark, sf).collect()
    return sorted((repr(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in found)


def test_brute_force_with_ties_and_copies(spark, scratch):
    r = random.Random(3)
    rows = [(k, [r.gauss(k % 5, 0.3) for _ in range(64)]) for k in range(150)]
    rows += [(k + 150, [float(r.randint(-1, 1)) for _ in range(64)]) for k in range(60)]
    rows += [(k + 300, list(rows[7][1])) for k in range(120)]  # a hot vector
    rows += [rows[3]] * 3  # rows that repeat
    assert _run(spark, scratch, rows) == _plain(rows)


def test_odd_rows(spark, scratch):
    ok = [0.5] * 64
    rows = [(1, ok), (2, None), (3, ok[:-1]), (4, ok + [1.0]), (5, ok[:-1] + [None]), (6, ok[:-1] + [float("nan")]), (7, ok[:-1] + [float("-inf")]),
            (None, [0.25] * 64), (8, [-0.01] * 64), (9, ok[:-1] + [2.0**22]), (10, [-2.0**20] * 64), (10, [2.0**20] * 64), (11, [])]
    assert _run(spark, scratch, rows) == _plain(rows)


def test_no_centroid_to_start_with(spark, scratch):
    assert _run(spark, scratch, []) == []


def test_ids_all_null(spark, scratch):
    assert _run(spark, scratch, [(None, [1.0] * 64)]) == []


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (5, 2)])
def test_curve_visits_every_cell_next_to_the_last(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    keys = [k.tobytes() for k in K.hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    walk = cells[np.argsort(np.array(keys, object), kind="stable")]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_box_bounds_keep_the_nearest():
    draw = np.random.default_rng(1)
    for _ in range(200):
        v = draw.integers(-20, 20, (16, 4)) + draw.integers(-40, 40, 4)
        c = draw.integers(-60, 60, (9, 4))
        near = K.candidates(v.min(axis=0), v.max(axis=0), c)
        full = K.distances(v, c)
        assert set(full.argmin(axis=1)) <= set(near)
        assert (near[K.distances(v, c[near]).argmin(axis=1)] == full.argmin(axis=1)).all()


def test_distances_beyond_doubles_are_exact():
    v, c = np.array([[2**27, -2**27] * 32]), np.array([[-2**27 + 1, 2**27] * 32, [2**27 - 1, 3] * 32])
    assert K.distances(v, c).tolist() == [[sum((a - b) ** 2 for a, b in zip(v[0].tolist(), x)) for x in c.tolist()]]


def test_blocks_go_whole_where_clusters_are_apart(spark):
    r = random.Random(5)
    rows = [(k, [1000 * (k % 4) + r.randint(0, 20) for _ in range(8)]) for k in range(2000)]
    vectors = spark.createDataFrame(rows, "id long, v array<long>")
    n, low, high, order = K.spread(vectors, 8)
    blocks = K.write_blocks(vectors, 8, low, high, order, 32)
    counts, sums, compared = K.cluster_sums(blocks, np.array([[1000 * k] * 8 for k in range(4)]))
    assert n == 2000 and counts.tolist() == [500] * 4
    assert sums == [[sum(v[d] for i, v in rows if i % 4 == k) for d in range(8)] for k in range(4)]
    assert compared <= 8 * 32 * 3  # only blocks at a border between clusters
    assert sorted(x for b in blocks.select("ids").collect() for x in b.ids) == list(range(2000))
