"""Centroid clustering over zone maps of a space-filling curve.

1. Kept vectors become integers and get a Hilbert key: components in the order of their variance, each cut into
   ``2 ** BITS`` ranges between its least and largest value. Range shuffle and sort by the key give neighbouring
   vectors neighbouring places, and ``BLOCK`` vectors in a row make a block with its min/max box, its sum and its matrix.
   The blocks are written once to the shared folder and read by every round.
2. A centroid cannot be nearest to a vector of a block if the least distance from it to the box is more than the
   largest distance from some other centroid to the box. The remaining centroids are the block's candidates. With one
   candidate the whole block goes to it by its stored sum; otherwise its vectors are compared with the candidates, in
   integers, as one matrix.
3. A task gives per cluster one count and one sum per component. They are added by an aggregation, and only
   ``centroids x components`` numbers come to the driver, however many vectors there are.

Equal vectors share a key; a second sort key spreads them over ranges, so a vector that a third of all rows repeat makes
many blocks (of one point each) in many tasks.

Defined results: kept are vectors of exactly ``DIMS`` components, each present, finite and under ``2 ** 21`` in absolute
value (beyond that a distance need not fit a long); others give no row. Rows that repeat are vectors of
their own. A row without an id is clustered but starts no centroid; its id stays null. Starting rows with equal hashes (one id)
count in the order of their components. Fewer kept vectors with an id than centroids: as many centroids as there are; none: no rows
come back. Distances that tie go to the smaller number. A sum of distances that does not fit a long is null. Other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._catalog import register
from ._cluster import cut, new_folder, read_table

DIMS, CENTROIDS, ROUNDS, SCALE = 64, 16, 3, 64
#: Vectors of a block, and bits of a component in the Hilbert key.
BLOCK, BITS = 64, 3
#: Components of a larger absolute value would give distances beyond a long.
LARGEST = 1 << 21


# 1. curve and blocks -----------------------------------------------------------------------------------------

def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of cell numbers (each under ``2 ** bits``), as byte strings of equal length
    whose order is the curve's.

    The rotations and reflections of the curve are undone from the highest bit down (the transposed form of the
    index), for all rows at once, component by component."""
    x = cells.astype(np.uint32).T.copy()  # a row per component
    dims = len(x)
    for bit in range(bits - 1, 0, -1):
        low = np.uint32((1 << bit) - 1)
        for d in range(dims):
            flip = (x[d] >> np.uint32(bit)) & np.uint32(1) == 1
            swap = np.where(flip, 0, (x[0] ^ x[d]) & low).astype(np.uint32)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint32(bit)) & np.uint32(1) == 1, np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= turn
    planes = [(x >> np.uint32(bit)) & np.uint32(1) for bit in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def _matrix(batch: pa.RecordBatch, name: str, dims: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def spread(vectors: DataFrame, dims: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(vectors, least and largest value of each component, components by falling variance). Vectors: v array<long>."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = total = squares = None
        n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch, "v", dims)
            now = m.min(axis=0), m.max(axis=0), m.sum(axis=0, dtype=np.float64), (m.astype(np.float64) ** 2).sum(axis=0)
            low, high, total, squares = now if low is None else (
                np.minimum(low, now[0]), np.maximum(high, now[1]), total + now[2], squares + now[3])
            n += len(m)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), pa.array(low), pa.array(high), pa.array(total),
                                              pa.array(squares), pa.array(np.full(dims, n))], ["d", "low", "high", "total", "squares", "n"])

    rows = (vectors.select("v").mapInArrow(sums, "d int, low long, high long, total double, squares double, n long").groupBy("d")
            .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total"),
                 F.sum("squares").alias("squares"), F.sum("n").alias("n")).orderBy("d").collect())
    if not rows:
        return 0, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    n = rows[0]["n"]
    variance = np.array([r["squares"] / n - (r["total"] / n) ** 2 for r in rows])
    return n, np.array([r["low"] for r in rows]), np.array([r["high"] for r in rows]), np.argsort(-variance, kind="stable")


BLOCKS = "ids array<long>, vectors binary, width int, low array<long>, high array<long>, sums array<long>"


def write_blocks(vectors: DataFrame, dims: int, low: np.ndarray, high: np.ndarray, order: np.ndarray, block: int = BLOCK) -> DataFrame:
    """Blocks along the curve, written once to the shared folder: ids, matrix, box and sum of each. Vectors: id, v."""
    spark = vectors.sparkSession
    reach = np.maximum(high - low + 1, 1)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = ((_matrix(batch, "v", dims) - low) * (1 << BITS)) // reach
                keys = hilbert_keys(cells[:, order], BITS)
                packed = pa.array([k.tobytes() for k in keys], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], ["id", "v", "key"])

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(table: pa.Table) -> pa.RecordBatch:
            out = []
            for a in range(0, len(table), block):
                part = table.slice(a, block).combine_chunks().to_batches()[0]
                m = _matrix(part, "v", dims)
                wide = np.int32 if -2**31 <= m.min() and m.max() < 2**31 else np.int64
                out.append((part.column(0).to_pylist(), m.astype(wide).tobytes(), np.dtype(wide).itemsize, m.min(axis=0), m.max(axis=0), m.sum(axis=0)))
            longs = pa.list_(pa.int64())
            ids, data, width, least, most, sums = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(ids, longs), pa.array(data, pa.binary()), pa.array(width, pa.int32()), pa.array(least, longs),
                                               pa.array(most, longs), pa.array(sums, longs)], ["ids", "vectors", "width", "low", "high", "sums"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            whole = len(table) // block * block
            if whole:
                yield rows(table.slice(0, whole))
            held = table.slice(whole).to_batches()
        if held and (rest := pa.Table.from_batches(held)).num_rows:
            yield rows(rest)

    folder = new_folder(spark, "zones")
    (vectors.select("id", "v").mapInArrow(keyed, "id long, v array<long>, key binary")
     .withColumn("spread", F.monotonically_increasing_id())  # equal keys fall into several ranges
     .repartitionByRange("key", "spread").sortWithinPartitions("key", "spread").select("id", "v")
     .mapInArrow(cut_up, BLOCKS).write.parquet(folder))
    return spark.read.parquet(folder)


# 2. assignment -----------------------------------------------------------------------------------------------

def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a vector of the box. Exact: integers, ties stay."""
    below, above = low - centroids, centroids - high
    least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=1)
    most = (np.maximum(high - centroids, centroids - low) ** 2).sum(axis=1)
    return np.flatnonzero(least <= most.min())


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, exact. As a matrix product in doubles where every number in it is exact there."""
    vectors, centroids = vectors.astype(np.int64), centroids.astype(np.int64)
    most = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if 4 * vectors.shape[1] * most * most < 2**53:
        a, b = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    return np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def _blocks(batches: Iterator[pa.RecordBatch], centroids: np.ndarray):
    """Per block: its row, its candidates, and (lazily) its matrix."""
    dims = centroids.shape[1]
    for batch in batches:
        boxes = [_matrix(batch, n, dims) for n in ("low", "high", "sums")]
        for k in range(batch.num_rows):
            data, width = batch.column(1)[k], batch.column(2)[k].as_py()
            yield (batch.column(0)[k], boxes[2][k], candidates(boxes[0][k], boxes[1][k], centroids),
                   lambda: np.frombuffer(data.as_buffer(), np.int32 if width == 4 else np.int64).reshape(-1, dims))


def cluster_sums(blocks: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, list[list[int]], int]:
    """(vectors of each cluster, sum of each component of each cluster, vectors that were compared one by one)."""
    k, dims = centroids.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums, compared = np.zeros(k, np.int64), np.zeros((k, dims), np.int64), 0
        for ids, total, near, matrix in _blocks(batches, centroids):
            if len(near) == 1:
                counts[near[0]] += len(ids)
                sums[near[0]] += total
                continue
            m = matrix()
            compared += len(m)
            best = near[distances(m, centroids[near]).argmin(axis=1)]
            counts += np.bincount(best, minlength=k)
            for c in np.unique(best):
                sums[c] += m[best == c].sum(axis=0, dtype=np.int64)
        if counts.any():
            some = np.flatnonzero(counts)
            # one row per component, and one (-1) for the cluster's number of vectors
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(some, dims + 1).astype(np.int32)), pa.array(np.tile(np.arange(-1, dims, dtype=np.int32), len(some))),
                 pa.array(np.concatenate([counts[some, None], sums[some]], axis=1).ravel()),
                 pa.array(np.where(np.arange(len(some) * (dims + 1)) == 0, compared, 0))], ["cluster", "d", "total", "compared"])

    rows = (blocks.mapInArrow(assign, "cluster int, d int, total long, compared long").groupBy("cluster", "d")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("compared").alias("compared")).collect())
    counts, sums = np.zeros(k, np.int64), [[0] * dims for _ in range(k)]
    for r in rows:
        if r["d"] < 0:
            counts[r["cluster"]] = int(r["total"])
        else:
            sums[r["cluster"]][r["d"]] = int(r["total"])
    return counts, sums, sum(r["compared"] for r in rows)


def assigned(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """id, cluster, distance of every vector."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, near, matrix in _blocks(batches, centroids):
            found = distances(matrix(), centroids[near])
            best = found.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([ids.values, pa.array(near[best].astype(np.int32)), pa.array(found[np.arange(len(best)), best])],
                                             ["id", "cluster", "distance"])

    return blocks.mapInArrow(assign, "id long, cluster int, distance long")


def cluster_vectors(vectors: DataFrame, start: np.ndarray, rounds: int = ROUNDS, block: int = BLOCK) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance of every vector; final centroids). Vectors: id long, v array<long> of as many components as
    the starting centroids (at least one). Each round moves every non-empty centroid to the floor of its vectors' mean."""
    dims = start.shape[1]
    _, low, high, order = spread(vectors, dims)
    blocks = write_blocks(vectors, dims, low, high, order, block)
    centroids = start.astype(np.int64)
    for _ in range(rounds):
        counts, sums, _ = cluster_sums(blocks, centroids)
        centroids = np.array([[s // int(n) for s in row] if n else list(old) for n, row, old in zip(counts, sums, centroids)], np.int64)
    return assigned(blocks, centroids), centroids


# query -------------------------------------------------------------------------------------------------------

def fit_for_long(vector: Column, dims: int = DIMS) -> Column:
    """Exactly ``dims`` components, none null, NaN, infinite or out of range."""
    return (F.size(vector) == dims) & F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < LARGEST, F.lit(False)))


def first_vectors(vectors: DataFrame, n: int, seed: str = "1") -> np.ndarray:
    """The n vectors with the least sha256 of ``<seed>:<id>``, in its order (a top-n of each task, then of those)."""
    rows = (vectors.filter("id is not null").select(F.sha2(F.concat(F.lit(seed + ":"), F.col("id").cast("string")), 256).alias("h"), "v")
            .orderBy("h", "v").limit(n).collect())
    return np.array([r["v"] for r in rows], np.int64)


def _sql() -> str:
    parts = [f"""kept AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {DIMS}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs(CAST(x AS DOUBLE)) >= {LARGEST})) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (
    SELECT sha256('1:' || vec_id) AS h, v FROM kept WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {CENTROIDS})
)"""]
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} AS (
  SELECT rid, vec_id, v, c, distance FROM (
    SELECT *, row_number() OVER (PARTITION BY rid ORDER BY distance, c) AS place FROM (
      SELECT rid, vec_id, kept.v AS v, c{r}.c AS c,
             CAST(list_sum(list_transform(list_zip(kept.v, c{r}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
      FROM kept CROSS JOIN c{r})) WHERE place = 1
)""")
        if r < ROUNDS:
            parts.append(f"""m{r} AS (
  SELECT c, list(mean ORDER BY d) AS v FROM (
    SELECT c, d, CAST((sum(x) - (((sum(x) % count(*)) + count(*)) % count(*))) // count(*) AS BIGINT) AS mean
    FROM (SELECT c, unnest(v) AS x, unnest(range({DIMS})) AS d FROM a{r}) GROUP BY c, d) GROUP BY c
), c{r + 1} AS (
  SELECT c{r}.c AS c, coalesce(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} ON c{r}.c = m{r}.c
)""")
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(f.v, ',')) AS centroid_sha256
FROM a{ROUNDS} AS a JOIN c{ROUNDS} AS f ON a.c = f.c
"""


SQL = _sql()


@register("op11_centroid_clusters", SQL)
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = F.col("embedding")
    vectors = (read_table(spark, sf_dir, "embeddings").filter(fit_for_long(vector))
               .select(F.col("vec_id").cast("long").alias("id"), F.transform(vector, lambda x: F.floor(SCALE * x.cast("double"))).alias("v")))
    start = first_vectors(vectors, CENTROIDS)
    if not len(start):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    found, centroids = cluster_vectors(vectors, start)
    found = cut(found)
    # one row per centroid: as few as there are centroids
    sums = found.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia")).collect()
    each = {r["cluster"]: r["cluster_inertia"] for r in sums}
    whole = sum(each.values()) if all(x is not None for x in each.values()) else None
    rows = [(c, n, whole if whole is None or whole < 2**63 else None, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
            for c, n in each.items()]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (found.join(F.broadcast(facts), "cluster")
            .select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
