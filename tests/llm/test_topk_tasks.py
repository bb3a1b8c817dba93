"""Top-k search: tasks by bytes, thresholds carried on, nothing sampled for the driver."""

from __future__ import annotations

import numpy as np

from texloom.llm import topk_search as K


def _brute(q, q_ids, v, ids, k):
    out = []
    for n in range(len(q)):
        best = sorted((-int(s), int(i)) for s, i in zip(v @ q[n], ids) if i != q_ids[n])[:k]
        out += [(n, i, -s) for s, i in best]
    return out


def test_groups_of_queries_against_brute_force():
    """Ties, repeated ids, few vectors, odd last blocks; numbers that are exact in 32 and in 64 bits of floating point, and in neither."""
    draw = np.random.default_rng(2)
    for big in (3, 300, 2**22, 2**29):
        for n, d, nq, k in ((1, 1, 1, 1), (5, 2, 3, 7), (63, 4, 9, 5), (200, 3, 40, 2), (700, 8, 30, 5)):
            v, ids = draw.integers(-big, big, (n, d)), np.sort(draw.integers(0, 2 * n, n))
            at = draw.integers(0, n, nq)
            found, _ = K.search_blocks(v[at], ids[at], v, ids, k)
            assert found == _brute(v[at], ids[at], v, ids, k), (big, n)


def test_what_a_shard_has_reached_prunes_the_next():
    draw = np.random.default_rng(3)
    near, far = draw.integers(90, 100, (64, 4)), draw.integers(-3, 3, (1000, 4))
    q, q_ids = near[:2], np.array([-1, -2])
    found, _ = K._search(q, q_ids, near, np.arange(64), 5)
    least = found[2].reshape(2, 5)[:, -1]
    assert K._search(q, q_ids, far, np.arange(1000), 5)[1] > 0
    more, scored = K._search(q, q_ids, far, np.arange(1000), 5, least=least)
    assert scored == 0 and not len(more[0])


def test_tasks_do_not_grow_with_shards_and_nothing_is_sampled(spark):
    """A range partition per shard samples rows of each for the driver, and sends every group to every shard."""
    rows = [(k, [k % 7, -k % 5]) for k in range(600)]
    v = spark.createDataFrame(rows, "id long, v array<long>")
    found = K.top_k(v, v.filter("id % 10 = 0"), 3, shard=2, group=2)
    plan = found._jdf.queryExecution().toString().lower()
    assert "rangepartition" not in plan and "explode" not in plan
    assert "broadcastnestedloopjoin" not in plan and "cartesianproduct" in plan
    tasks = 2 * spark.sparkContext.defaultParallelism
    shards, n = K._pack(v, 600 * 24, 2, min(tasks, 300), K.SHARDS_BYTES)
    assert n == tasks and shards.rdd.getNumPartitions() == tasks and shards.count() >= 300
    ids, m = np.array([k for k, _ in rows]), np.array([x for _, x in rows])
    want = [(int(ids[10 * n]), i, s) for n, i, s in _brute(m[::10], ids[::10], m, ids, 3)]
    assert sorted((r.query_id, r.vec_id, r.score) for r in found.collect()) == sorted(want)


def test_queries_of_several_tasks(spark, monkeypatch):
    """The shards are packed once and read by each task of queries."""
    monkeypatch.setattr(K, "GROUPS_BYTES", 200)
    draw = np.random.default_rng(4)
    m = draw.integers(-9, 9, (120, 3))
    v = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(m)], "id long, v array<long>")
    found = K.top_k(v, v.filter("id % 4 = 0"), 2, shard=16, group=4)
    want = [(4 * n, i, s) for n, i, s in _brute(m[::4], np.arange(0, 120, 4), m, np.arange(120), 2)]
    assert sorted((r.query_id, r.vec_id, r.score) for r in found.collect()) == sorted(want)
