"""Connected components: the result, and the files of its checkpoints."""
from __future__ import annotations

import random

from texloom.llm import _components as C


def _plain(edges):
    up = {}

    def root(a):
        while up.setdefault(a, a) != a:
            a = up[a]
        return a

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {a: root(a) for a in list(up)}


def test_rounds_write_few_files(spark, monkeypatch):
    """A round of few edges is not checkpointed in a file per shuffle partition, each with its check sum and its permissions."""
    r = random.Random(4)
    edges = [(k, k + 1) for k in range(60)] + [(r.randint(100, 400), r.randint(100, 400)) for _ in range(200)] + [(7, 7), (None, 3), (900, 901), (901, 900)]
    parts, cut = [], C.cut

    def counted(df):
        out = cut(df)
        parts.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(C, "cut", counted)
    cores = spark.sparkContext.defaultParallelism
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(3 * cores))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = {x.node: x.root for x in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert C.components(spark.createDataFrame([], "a long, b long")).collect() == []
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert found == _plain(edges)
    assert len(parts) > 3 and sorted(parts)[-3] <= cores  # all but the first of each call
