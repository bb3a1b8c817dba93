"""Exact top-k search by block-at-a-time pruning.

Vectors are cut into blocks of ``BLOCK`` documents. A component is a term; a
block keeps a forward index (its vectors as one matrix) and per term the largest and smallest value. For a
query the bound of a block is the sum over the terms of the larger of ``q * max`` and ``q * min``. Each query scores the block of its
largest bound first; of the others only those are scored through their forward index whose bound reaches the k-th score
found (a block whose bound equals it is scored: ties go to the smaller id), for a group of queries as one product of matrices.

Spread: vectors are dealt to tasks and packed there into shards of some dozens of blocks; queries are packed into groups. Each task
takes some shards and some groups, both of bounded bytes, pair by pair, and carries the k best of each query from shard to shard; they are
its rows. The k best of a query are then the best of its tasks' rows. Nothing is sampled, broadcast or sent through the driver, and the number of
tasks grows with the bytes of the table, not with its shards.

Defined results: vectors that are null, or hold a null or non-finite component, take no part, as query or
candidate; an empty vector scores 0 with every other empty one. Only vectors of equal length are
compared. A query is never its own candidate: rows with the query's id are left out. Repeated ids give
repeated candidates, and a query whose id repeats gets the k best over its rows. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._catalog import register
from ._cluster import cut, read_table

BLOCK = 64


def usable(vector: Column) -> Column:
    """Not null, without null, NaN or infinite components."""
    big = float("inf")
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (x != F.lit(big)) & (x != F.lit(-big))
    return F.coalesce(F.forall(F.transform(vector, lambda x: x.cast("double")), ok), F.lit(False))


def quantized(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component, as long."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def products(block: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products; by floating point only where every partial sum is exact."""
    if block.size and query.size:
        most = float(np.abs(block).max()) * float(np.abs(query).max()) * block.shape[1]
        if most >= 2.0**53:
            return block @ query
    return np.rint(block.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)


def _factors(queries: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the smallest type in which every partial sum of a product is exact; as they are where no floating point is."""
    if not (queries.size and vectors.size):
        return queries, vectors
    most = float(np.abs(vectors).max()) * float(np.abs(queries).max()) * vectors.shape[1]
    kind = np.float32 if most < 2.0**24 else np.float64 if most < 2.0**53 else np.int64
    return queries.astype(kind), vectors.astype(kind)


# Blocks scored by one product.
SLAB = 16


def search_blocks(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int,
                  block: int = BLOCK) -> tuple[list[tuple[int, int, int]], int]:
    """(query position, id, score) of the k best of each query, and how many blocks were scored."""
    found, scored = _search(queries, query_ids, vectors, ids, k, block)
    return list(zip(*(x.tolist() for x in found))), scored


def _search(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, block: int = BLOCK,
            least: np.ndarray | None = None) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], int]:
    """(query positions, ids, scores) of the k best of each query, best first, and how many blocks were scored.

    ``least``: scores that a query's k best have reached elsewhere; lower ones are left out."""
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.arange(0, len(ids), block)
    if not len(starts) or not len(queries):
        return none, 0
    low, high = np.minimum.reduceat(vectors, starts, axis=0), np.maximum.reduceat(vectors, starts, axis=0)
    # Bounds as doubles; widened by far more than their rounding so that no block is lost to it.
    q = queries.astype(np.float64)
    bounds = np.maximum(q, 0) @ high.T.astype(np.float64) + np.minimum(q, 0) @ low.T.astype(np.float64)
    bounds += np.abs(bounds) * 1e-9 + 1
    q, v = _factors(queries, vectors)
    lowest = np.iinfo(np.int64).min if q.dtype == np.int64 else -np.inf
    reached = np.full(len(q), lowest, q.dtype) if least is None else np.maximum(least, lowest).astype(q.dtype)
    done, scored, found = np.zeros(bounds.shape, bool), 0, []

    def score(at: np.ndarray, blocks: np.ndarray) -> None:
        """Scores some queries against some blocks, and raises what their k best have reached. Its own id and blocks that a query
        has had are no candidates."""
        nonlocal scored
        scored += len(at) * len(blocks)
        cols = np.concatenate([np.arange(starts[b], min(starts[b] + block, len(ids))) for b in blocks])
        s = q[at] @ v[cols].T
        own = np.flatnonzero(np.isin(ids[cols], query_ids[at]))
        rows, there = np.nonzero(ids[cols[own]] == query_ids[at][:, None])
        s[rows, own[there]] = lowest
        again = done[np.ix_(at, blocks)]
        for x in np.flatnonzero(again.any(axis=0)):
            s[np.ix_(again[:, x], cols // block == blocks[x])] = lowest
        keep = (s >= reached[at][:, None]) & (s > lowest)
        if s.shape[1] >= k and keep.sum() > 4 * k * len(at):
            reached[at] = np.maximum(reached[at], np.partition(s, -k, axis=1)[:, -k])
            keep &= s >= reached[at][:, None]
        n, c = np.nonzero(keep)
        found.append((at[n], ids[cols[c]], s[n, c]))
        done[np.ix_(at, blocks)] = True

    first = bounds.argmax(axis=1)
    for b in np.unique(first):
        at = np.flatnonzero(first == b)
        score(at[bounds[at, b] >= reached[at]], np.array([b]))
    order = np.argsort(-bounds.max(axis=0), kind="stable")
    while len(order):
        open_ = ~done[:, order] & (bounds[:, order] >= reached[:, None])
        order, open_ = order[open_.any(axis=0)], open_[:, open_.any(axis=0)]
        if len(order):
            score(np.flatnonzero(open_[:, :SLAB].any(axis=1)), order[:SLAB])
            order = order[SLAB:]
    return _best(*(np.concatenate(x) for x in zip(*found)), k) if found else none, scored


def _best(n: np.ndarray, i: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query: by score, then the smaller id."""
    s = s.astype(np.int64)
    order = np.lexsort((i, -s, n))
    n, i, s = n[order].astype(np.int64), i[order], s[order]
    rank = np.arange(len(n)) - np.searchsorted(n, n)
    return n[rank < k], i[rank < k], s[rank < k]


def _packed(it, size: int):
    """Batches (id, v) -> rows (dim, ids, m): matrices of at most ``size`` vectors of a length, ids ascending."""
    held: dict[int, list[tuple]] = {}

    def row(dim: int) -> pd.DataFrame:
        ids, vs = zip(*sorted(held.pop(dim), key=lambda x: x[0]))
        m = np.array([np.asarray(v, np.int64) for v in vs], np.int64).reshape(len(ids), dim)
        return pd.DataFrame({"dim": [dim], "ids": [np.array(ids, np.int64).tobytes()], "m": [m.tobytes()]})

    for frame in it:
        for pair in zip(frame["id"], frame["v"]):
            dim = len(pair[1])
            held.setdefault(dim, []).append(pair)
            if len(held[dim]) >= size:
                yield row(dim)
        while sum(map(len, held.values())) >= 2 * size:  # of many lengths
            yield row(max(held, key=lambda d: len(held[d])))
    for dim in sorted(held):
        yield row(dim)


PACKED = "dim int, ids binary, m binary"
# Bytes of shards, and of groups of queries, that meet in a task.
SHARDS_BYTES, GROUPS_BYTES = 64 << 20, 16 << 20


def _pack(rows: DataFrame, held: int, size: int, least: int, task_bytes: int) -> tuple[DataFrame, int]:
    """Vectors (``held``: bytes of them) dealt evenly and packed as matrices of at most ``size`` rows; the number of tasks, ``least`` if
    there is work for them."""
    tasks = max(1, least, -(-held // task_bytes))
    return rows.repartition(tasks).mapInPandas(lambda it: _packed(it, size), PACKED), tasks


def _measured(rows: DataFrame) -> tuple[int, int]:
    """Number and bytes of vectors."""
    return tuple(map(int, rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(8 + 8 * F.size("v")), F.lit(0))).first()))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard: int = 4096, group: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score. Both inputs: id long, v array<long>; rows with a null take no part.

    Every task of shards meets every task of queries, as a product of their partitions: a row of it holds one packed shard
    and one packed group, so a task's memory does not grow with the tables.
    """
    vectors, queries = (x.select("id", "v").filter("id is not null and v is not null") for x in (vectors, queries))
    queries = queries.dropDuplicates(["id", "v"])
    (n, held), (_, asked_bytes) = _measured(vectors), _measured(queries)
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    shards, _ = _pack(vectors, held, shard, min(2 * cores, -(-n // shard)), SHARDS_BYTES)
    asked, asked_tasks = _pack(queries, asked_bytes, group, 1, GROUPS_BYTES)
    if asked_tasks > 1:
        shards = cut(shards)  # read by each task of queries: packed once
    asked = cut(asked).select(F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("m").alias("q_m"),
                              F.monotonically_increasing_id().alias("part"))
    pairs = shards.crossJoin(asked.hint("shuffle_replicate_nl"))

    def search(it):
        best: dict[int, tuple] = {}  # group -> positions, ids and scores of the k best so far; its queries' ids
        for frame in it:
            for r in frame.itertuples():
                if r.dim != r.q_dim:
                    continue
                ids, q_ids = np.frombuffer(r.ids, np.int64), np.frombuffer(r.q_ids, np.int64)
                m, q_m = (np.frombuffer(x, np.int64).reshape(n, r.dim) for x, n in ((r.m, len(ids)), (r.q_m, len(q_ids))))
                had, least = best.get(r.part, (None, None))[0], None
                if had is not None:
                    last = np.flatnonzero(np.append(had[0][1:] != had[0][:-1], True)) if len(had[0]) else np.empty(0, np.int64)
                    full = np.bincount(had[0], minlength=len(q_ids))[had[0][last]] == k
                    least = np.full(len(q_ids), np.iinfo(np.int64).min)
                    least[had[0][last[full]]] = had[2][last[full]]
                found, _ = _search(q_m, q_ids, m, ids, k, least=least)
                best[r.part] = (found if had is None else _best(*(np.concatenate(x) for x in zip(had, found)), k)), q_ids
        for (n, i, s), q_ids in best.values():
            yield pd.DataFrame({"query_id": q_ids[n], "vec_id": i, "score": s})

    found = pairs.mapInPandas(search, "query_id long, vec_id long, score long")
    # Rows of a query: k from each task at most. The k best by partial top lists, then a rank.
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, e.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, e.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM e AS q JOIN e ON q.vec_id % 50 = 0 AND q.vec_id <> e.vec_id AND len(q.v) = len(e.v)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""


@register("op2_topk_search", SQL)
def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (read_table(spark, sf_dir, "embeddings").filter(usable(F.col("embedding")))
            .select(F.col("vec_id").alias("id"), quantized(F.col("embedding")).alias("v")))
    return top_k(rows, rows.filter("id % 50 = 0"), 5)
