"""N-gram Jaccard self-join of documents by prefix trees.

A document's set holds its distinct 5-word shingles (as 64-bit hashes); two documents link when
``100 * |A and B| >= 75 * |A or B|``. The steps, all over all documents:

1. Documents with equal sets form a class; from here on a class is one set, with its number of documents.
2. Shingles are dealt by hash and counted (those that many documents of a piece of the input hold, once per piece with
   their count). The global order of shingles is by how many sets hold them (in
   powers of two), then by hash; shingles of one set come first and match nothing. A set links with another
   only if at least three quarters of its shingles are shared at all; others leave here.
3. A linked pair shares a shingle among the first quarter (plus one) of each set in the global order. Sets that
   meet there in the same or neighbouring length ranges are tied; the connected components are the clusters of possible links.
4. A cluster is cut into blocks of bounded size (by length range, then by hash), and every two blocks
   of fitting lengths make a task. Where a cluster is a long chain of sets that have little to do with each other, the sets with
   one shingle in their prefixes are cut into blocks instead (whatever sends the tasks less), and a link counts at the first
   shingle of the two sets. A task stores one block's ordered sets in a trie with compressed edges and
   walks it with each set of the other block: the overlap with an edge is counted once for all sets below, and
   a subtree is left when the overlap so far plus what can still follow is under what its lengths need.
5. A task gives per set its number of links and one tie to the other sets that it found linked, not the pairs.
   Links are summed, and the ties' connected components are the result's classes.

Sets and shingles are known by 64-bit hashes. Nothing is capped or sampled. The number of pairs within one cluster of different sets is not bounded by the
input's size, and its tasks are as many as its pairs of blocks; equal sets never make pairs.

Defined results: null or empty texts have no shingles, no link and their own id as component. Rows that repeat
are documents of their own, linked with each other. A null id stays null and does not name a component; a
component of null ids has a null id. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import _packed as P
from . import _words as W
from ._catalog import register
from ._cluster import cut, new_folder, read_table
from ._components import components

#: Similarity as a fraction: at least 75 of 100.
NEED, OF = 75, 100
N_WORDS = 5
#: Shingles of a block at most (one set at least).
BLOCK = 1 << 15
#: Factor between neighbouring length ranges: linked sets lie in one range or in neighbours.
STEP = OF / NEED


def least_overlap(n: int | np.ndarray):
    """Least shared shingles of a set of n shingles with any set that it links with."""
    return -(-n * NEED // OF)


def linked(overlap: int, n: int, m: int) -> bool:
    return OF * overlap >= NEED * (n + m - overlap)


# 1. classes --------------------------------------------------------------------------------------------------

def document_sets(docs: DataFrame, row: str = "doc_id") -> DataFrame:
    """doc_id, a key of the row, n_shingles, class (hash of the set, 0 if empty) for rows doc_id, text and the key."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0), batch.column(1)
            for first, data, offsets in W.texts(batch, "text"):
                items, before = W.shingle_sets(*W.words(data, offsets), N_WORDS)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(offsets) - 1), rows.slice(first, len(offsets) - 1), pa.array(np.diff(before).astype(np.int64)),
                     pa.array(W.set_hashes(items, before).view(np.int64))], ["doc_id", "row", "n_shingles", "class"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(row).cast("long").alias("row"), "text")
            .mapInArrow(sets, "doc_id long, row long, n_shingles long, class long"))


# 2. shared shingles ------------------------------------------------------------------------------------------

PACKED = "part int, chunk long, kind int, docs binary, items binary, more binary"


def _batch(part, chunk, kind, docs, items, more) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(chunk, pa.int64()), pa.array(kind, pa.int32()), pa.array(docs, pa.binary()),
         pa.array(items, pa.binary()), pa.array(more, pa.binary())], ["part", "chunk", "kind", "docs", "items", "more"])


#: Rows of a packed shuffle: entries (document, shingle), the classes and sizes of a piece's documents, shingles
#: that are frequent in a piece with their counts, and the documents that hold these.
ENTRIES, HEAD, FREQUENT, HOLDERS = range(4)
#: A shingle of so many documents of one piece travels once, with its count.
OFTEN = 8


def packed(hashes: np.ndarray) -> bytes:
    """Ascending 64-bit hashes as bytes: the lower halves, then the steps of the upper halves byte by byte, of which the
    higher ones are mostly zero and compress."""
    steps = np.diff(hashes >> np.uint64(32), prepend=np.uint64(0)).astype("<u4")
    return hashes.astype("<u4").tobytes() + steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    n = len(data) // 8
    steps = np.frombuffer(data, np.uint8, offset=4 * n).reshape(4, n).T.copy().view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint64) << np.uint64(32) | np.frombuffer(data, "<u4", count=n)


def _deal(parts: int):
    """Texts -> per piece and part: the entries of its shingles, and its frequent shingles with their counts; and per
    piece, to its home, the classes and set sizes of its documents and who holds the frequent shingles. So what a shingle
    sends to its part is at most ``OFTEN`` entries a piece, however many documents hold it."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for _, data, offsets in W.texts(batch, "text"):
                chunk, number = (TaskContext.get().partitionId() << 32) | number, number + 1
                items, before = W.shingle_sets(*W.words(data, offsets), N_WORDS)
                classes, sizes = W.set_hashes(items, before), np.diff(before)
                _, once = np.unique(classes, return_index=True)  # equal sets of a piece count once
                once = np.sort(once[sizes[once] > 0])
                if not len(once):
                    continue
                held = np.zeros(len(classes), bool)
                held[once] = True
                number_of = np.cumsum(held) - 1
                owner = np.repeat(np.arange(len(classes)), sizes)
                keep = held[owner]
                items, owner = items[keep], number_of[owner[keep]].astype(np.uint32 if len(once) > 1 << 16 else np.uint16)
                classes, sizes = classes[once], sizes[once]
                order = np.argsort(items, kind="stable")
                items, owner = items[order], owner[order]
                opens = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1]]))
                runs = np.diff(np.append(opens, len(items)))
                common = runs >= OFTEN
                rare = np.repeat(~common, runs)
                few, few_owner, many, counts = items[rare], owner[rare], items[opens[common]], runs[common].astype(np.uint32)
                home, out = P.home(chunk, parts), []
                # items ascend, and so do their parts
                for kind, these in ((ENTRIES, few), (FREQUENT, many)):
                    at = np.searchsorted(P.part_of(these, parts), np.arange(parts + 1))
                    out += [(k, chunk, kind, few_owner[a:b].tobytes() if kind == ENTRIES else b"", packed(these[a:b]),
                             b"" if kind == ENTRIES else counts[a:b].tobytes())
                            for k, (a, b) in enumerate(zip(at[:-1], at[1:])) if a < b]
                out.append((home, chunk, HEAD, b"", classes.tobytes(), sizes.astype(np.int64).tobytes()))
                if len(many):
                    out.append((home, chunk, HOLDERS, owner[~rare].astype(np.uint32).tobytes(), b"", counts.tobytes()))
                yield _batch(*zip(*out))

    return deal


def _numbers(docs: bytes, n: int) -> np.ndarray:
    return np.frombuffer(docs, np.uint16 if len(docs) == 2 * n else np.uint32).astype(np.int64)


def _count(parts: int):
    """One part's shingles -> those of two sets at least, back to their pieces. A shingle becomes a 64-bit number
    whose order is the global order: 6 bits of its count's magnitude, its part, its place among the part's hashes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, hashes, weights = [], [], []
        mine = None
        for batch in batches:
            passed = [k for k, kind in enumerate(batch.column(2).to_pylist()) if kind in (HEAD, HOLDERS)]
            if passed:
                yield batch.take(pa.array(passed))
            for part, chunk, kind, docs, items, more in zip(*(c.to_pylist() for c in batch.columns)):
                if kind in (ENTRIES, FREQUENT):
                    mine = part
                    these = unpacked(items)
                    rows.append((chunk, kind, _numbers(docs, len(these)).astype(np.uint32) if kind == ENTRIES else None))
                    hashes.append(these)
                    weights.append(np.frombuffer(more, np.uint32) if kind == FREQUENT else np.ones(len(these), np.uint32))
        if not rows:
            return
        sizes = np.array([len(x) for x in hashes])
        every, weight = np.concatenate(hashes), np.concatenate(weights)
        del hashes, weights
        order = np.argsort(every, kind="stable")
        every = every[order]
        opens = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        runs = np.diff(np.append(opens, len(every)))
        del every
        count_of = np.add.reduceat(weight[order].astype(np.int64), opens)
        number = (np.floor(np.log2(count_of)).astype(np.uint64) << np.uint64(58)) | (np.uint64(mine) << np.uint64(32)) | np.arange(len(opens), dtype=np.uint64)
        token = np.empty(len(weight), np.uint64)
        token[order] = np.repeat(number, runs)
        many = np.empty(len(weight), bool)
        many[order] = np.repeat(count_of > 1, runs)
        del order, weight
        at = np.concatenate([[0], np.cumsum(sizes)])
        for k, (chunk, kind, docs) in enumerate(rows):
            s = slice(at[k], at[k + 1])
            home = P.home(chunk, parts)
            if kind == FREQUENT:
                yield _batch([home], [chunk], [FREQUENT], [b""], [token[s].tobytes()], [int(mine).to_bytes(4, "little")])
            elif (keep := many[s]).any():
                yield _batch([home], [chunk], [ENTRIES], [docs[keep].tobytes()], [token[s][keep].tobytes()], [b""])

    return count


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of one part -> sets that can have a link: class, size, ordered shared shingles."""
    heads: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    frequent: dict[int, dict[int, np.ndarray]] = {}
    holders: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for _, chunk, kind, docs, items, more in zip(*(c.to_pylist() for c in batch.columns)):
            if kind == HEAD:
                heads[chunk] = np.frombuffer(items, np.uint64), np.frombuffer(more, np.int64)
            elif kind == ENTRIES:
                found.setdefault(chunk, []).append((np.frombuffer(docs, np.uint32), np.frombuffer(items, np.uint64)))
            elif kind == FREQUENT:
                frequent.setdefault(chunk, {})[int.from_bytes(more, "little")] = np.frombuffer(items, np.uint64)
            else:
                holders[chunk] = np.frombuffer(docs, np.uint32), np.frombuffer(more, np.uint32)
    for chunk, (docs, counts) in holders.items():
        tokens = np.concatenate([t for _, t in sorted(frequent[chunk].items())])  # by part, as the counts are
        found.setdefault(chunk, []).append((docs, np.repeat(tokens, counts)))
    for chunk, pieces in found.items():
        classes, sizes = heads[chunk]
        docs, tokens = (np.concatenate(x) for x in zip(*pieces))
        order = np.lexsort((tokens, docs))
        docs, tokens = docs[order], tokens[order]
        at = np.searchsorted(docs, np.arange(len(classes) + 1))
        chosen = np.flatnonzero(np.diff(at) >= np.maximum(1, least_overlap(sizes)))
        for some in np.array_split(chosen, max(1, len(chosen) // 256)):
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(classes[some].view(np.int64)), pa.array(sizes[some]),
                     pa.array([tokens[at[k]:at[k + 1]].tobytes() for k in some], pa.binary())], ["class", "n", "tokens"])


def possible_sets(docs: DataFrame) -> DataFrame:
    """class, n, tokens: each set once whose shared shingles are enough for a link."""
    parts = P.parts_of(docs.sparkSession)
    dealt = P.by_part(docs.select("text").mapInArrow(_deal(parts), PACKED), parts)
    back = P.by_part(dealt.mapInArrow(_count(parts), PACKED), parts)
    sets = back.mapInArrow(_gather, "class long, n long, tokens binary")
    # Equal sets of different pieces: the class decides, any copy will do (their shingles are the same).
    return sets.groupBy("class").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))


# 3. clusters -------------------------------------------------------------------------------------------------

class Ties:
    """Union-find over numbers 0..n-1; a group is named by its smallest number."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, a: int) -> int:
        up = self.up
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    def tie(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def length_range(n):
    """Ranges of set sizes by the factor ``STEP``: linked sets lie in one range or in neighbours."""
    return np.floor(np.log(n) / math.log(STEP) + 1e-7).astype(np.int32)


TIES = "part int, tokens binary, classes binary, ranges binary"


def prefix_sizes(n: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """How many of its ``lens`` shared shingles are among the first of a set of ``n`` of which a link must share one."""
    return np.maximum(1, n - least_overlap(n) + 1 - (n - lens))


def _prefixes(parts: int):
    """Sets -> the first shingles of each in the global order, dealt by shingle.

    Sets of one batch that share such a shingle in one length range are tied here, and one of them goes on for all: a
    shingle of very many sets sends a few rows a batch to its part. (A tie too many only makes a cluster larger.)
    Ties are rows without shingles."""
    def prefixes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            tokens = [np.frombuffer(t, np.uint64) for t in frame["tokens"]]
            n, cls = frame["n"].to_numpy(), frame["class"].to_numpy()
            if not len(n):
                continue
            lens = np.array([len(t) for t in tokens])
            first = prefix_sizes(n, lens)
            token = np.concatenate([t[:k] for t, k in zip(tokens, first)])
            owner = np.repeat(np.arange(len(frame)), first)
            ranges = length_range(n)[owner]
            order = np.lexsort((ranges, token))
            token, owner, ranges = token[order], owner[order], ranges[order]
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (ranges[1:] != ranges[:-1])
            lead = owner[np.flatnonzero(new)[np.cumsum(new) - 1]]
            pairs = np.unique(np.stack([owner, lead], axis=1)[owner != lead], axis=0)
            token, owner, ranges = token[new], owner[new], ranges[new]
            order, at = P.split_by(P.part_of(W.mixed(token), parts), parts)
            rows = [(k, order[at[k]:at[k + 1]]) for k in range(parts) if at[k] < at[k + 1]]
            out = [(k, token[s].tobytes(), cls[owner[s]].tobytes(), ranges[s].tobytes()) for k, s in rows]
            if len(pairs):
                out.append((P.home(int(pairs[0, 0]), parts), b"", cls[pairs].tobytes(), b""))
            yield pd.DataFrame(out, columns=["part", "tokens", "classes", "ranges"])

    return prefixes


def _tie(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One part's shingles -> ties of the sets that hold the same one in the same or neighbouring length ranges."""
    tokens, classes, ranges, ready = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int32)], [np.empty((0, 2), np.int64)]
    for frame in frames:
        for t, c, r in zip(frame["tokens"], frame["classes"], frame["ranges"]):
            if len(t):
                tokens.append(np.frombuffer(t, np.uint64))
                classes.append(np.frombuffer(c, np.int64))
                ranges.append(np.frombuffer(r, np.int32))
            else:
                ready.append(np.frombuffer(c, np.int64).reshape(-1, 2))
    token, cls, length = np.concatenate(tokens), np.concatenate(classes), np.concatenate(ranges)
    order = np.lexsort((length, token))
    token, cls, length = token[order], cls[order], length[order]
    near = np.flatnonzero((token[1:] == token[:-1]) & (length[1:] - length[:-1] <= 1))
    pairs = np.unique(np.concatenate([np.stack([cls[near], cls[near + 1]], axis=1), *ready]), axis=0)
    names, number = np.unique(pairs, return_inverse=True)
    ties = Ties(len(names))
    for a, b in number.reshape(-1, 2).tolist():
        ties.tie(a, b)
    roots = np.array([ties.root(k) for k in range(len(names))], np.int64)
    some = np.flatnonzero(roots != np.arange(len(names)))
    yield pd.DataFrame({"a": names[some], "b": names[roots[some]]})


def clusters(sets: DataFrame) -> DataFrame:
    """(class, cluster) of the sets that share a shingle of their prefixes with another set of fitting length."""
    parts = P.parts_of(sets.sparkSession)
    dealt = P.by_part(sets.mapInPandas(_prefixes(parts), TIES), parts)
    ties = dealt.mapInPandas(_tie, "a long, b long")
    return components(ties).select(F.col("node").alias("class"), F.col("root").alias("cluster"))


# 4. tries ----------------------------------------------------------------------------------------------------

class Trie:
    """Ordered sets in a trie with compressed edges, nodes in the order of a walk (parents first).

    ``sets``: ascending arrays of shingle numbers; ``sizes``: sizes of the whole sets, shingles that no other set
    holds included (these come first in the global order and never match, so they are not stored)."""

    def __init__(self, sets: list[np.ndarray], sizes: list[int]):
        self.sizes = sizes
        order = sorted(range(len(sets)), key=lambda k: sets[k].astype(">i4").tobytes())
        nodes: list[list] = []  # [depth above, depth below, a set that runs through, parent, sets that end here]
        path: list[int] = []
        last = None
        for k in order:
            s = sets[k]
            shared = 0
            if last is not None:
                m = min(len(s), len(last))
                differ = np.flatnonzero(s[:m] != last[:m])
                shared = int(differ[0]) if len(differ) else m
            while path and nodes[path[-1]][0] >= shared:
                path.pop()
            if path and nodes[path[-1]][1] > shared:  # an edge forks: its upper part becomes a node of its own
                low = path[-1]
                top, _, through, above, _ = nodes[low]
                nodes.append([top, shared, through, above, []])
                nodes[low][0], nodes[low][3] = shared, len(nodes) - 1
                path[-1] = len(nodes) - 1
            if len(s) > shared or not path:
                nodes.append([shared, len(s), k, path[-1] if path else -1, [k]])
                path.append(len(nodes) - 1)
            else:
                nodes[path[-1]][4].append(k)
            last = s
        below: list[list[int]] = [[] for _ in nodes]
        roots = []
        for i, node in enumerate(nodes):
            (below[node[3]] if node[3] >= 0 else roots).append(i)
        #: Per node: shingles of its edge, sets ending, children, least and most set size below, most shingles that follow.
        self.edge = [sets[n[2]][n[0]:n[1]] for n in nodes]
        self.ends = [n[4] for n in nodes]
        self.below, self.roots = below, roots
        self.low, self.high, self.rest = [0] * len(nodes), [0] * len(nodes), [0] * len(nodes)
        stack = [(r, False) for r in roots]
        while stack:
            i, done = stack.pop()
            if not done:
                stack.append((i, True))
                stack += [(c, False) for c in below[i]]
                continue
            under = [sizes[k] for k in self.ends[i]]
            self.low[i] = min([*under, *(self.low[c] for c in below[i])])
            self.high[i] = max([*under, *(self.high[c] for c in below[i])])
            self.rest[i] = max([0, *(len(self.edge[c]) + self.rest[c] for c in below[i])])

    def links(self, probe: np.ndarray, size: int, present: np.ndarray) -> list[int]:
        """The sets that link with a probe. ``present``: per shingle number, False; is left so."""
        present[probe] = True
        found = []
        stack = [(r, 0) for r in self.roots]
        while stack:
            i, overlap = stack.pop()
            low = self.low[i]
            if NEED * low > OF * size or NEED * size > OF * self.high[i]:
                continue  # no fitting length below
            edge = self.edge[i]
            if len(edge):
                overlap += int(np.count_nonzero(present[edge]))
                left = len(probe) - int(np.searchsorted(probe, edge[-1], "right"))
            else:
                left = len(probe)
            # OF * o >= NEED * (size + n - o) for the smallest n and the largest o that can still come
            if (OF + NEED) * (overlap + min(self.rest[i], left)) < NEED * (size + max(low, -(-size * NEED // OF))):
                continue
            found += [k for k in self.ends[i] if linked(overlap, size, self.sizes[k])]
            stack += [(c, overlap) for c in self.below[i]]
        present[probe] = False
        return found


def _volumes(sets: DataFrame, group: list[str]) -> DataFrame:
    """Per group and length range: ``v`` (shingles of its sets), ``blocks``, blocks of the range ``above`` and ``under``, and of the
    whole group its shingles ``whole`` and ``members``. A group has a row per length range, some 70 at most."""
    ranges = Window.partitionBy(*group)
    along = ranges.orderBy("rng")

    def beside(row, step):
        return F.when(row("rng").over(along) == F.col("rng") + step, row("blocks").over(along)).otherwise(F.lit(0))

    return (sets.groupBy(*group, "rng").agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("_n"))
            .withColumn("whole", F.sum("v").over(ranges)).withColumn("members", F.sum("_n").over(ranges)).drop("_n")
            .withColumn("blocks", F.when(F.col("whole") <= BLOCK, F.lit(1)).otherwise(F.ceil(F.col("v") / BLOCK)).cast("int"))
            .withColumn("above", beside(F.lead, 1)).withColumn("under", beside(F.lag, -1)))


def _sent(volumes: DataFrame, name: str) -> DataFrame:
    """Shingles that a cluster's tasks are sent."""
    times = F.when(F.col("whole") <= BLOCK, F.lit(1)).otherwise(F.col("blocks") + F.col("above") + F.col("under"))
    return volumes.groupBy("cluster").agg(F.sum(F.col("v") * times).alias(name))


def _leads(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sets -> a row per shingle of their prefixes."""
    for frame in frames:
        if len(frame):
            tokens = [np.frombuffer(t, np.uint64) for t in frame["tokens"]]
            first = prefix_sizes(frame["n"].to_numpy(), np.array([len(t) for t in tokens]))
            out = {c: np.repeat(frame[c].to_numpy(), first) for c in ("cluster", "class", "rng", "v")}
            yield pd.DataFrame({**out, "lead": np.concatenate([t[:k] for t, k in zip(tokens, first)]).view(np.int64)})


def _tasks(sets: DataFrame, clusters_: DataFrame) -> DataFrame:
    """task, cross, base, led, lead, class, n, copies, tokens: a set goes to each pair of blocks of its group that it is in. ``cross``:
    the pair's blocks differ (either may be empty); else the task is a block with itself.

    The groups are the clusters, or within a cluster the sets with one shingle in their prefixes (``lead``; ``led``): of the two, what sends
    its tasks less. So a set never goes to more blocks than its own prefixes' postings have, however long a chain of sets is tied."""
    sized = (sets.join(clusters_, "class").withColumn("rng", F.floor(F.log("n") / math.log(STEP) + 1e-7).cast("int"))
             .withColumn("v", (F.octet_length("tokens") / 8).cast("long")))
    whole = cut(_volumes(sized, ["cluster"]))
    large = whole.filter(F.col("whole") > BLOCK)
    leads = (sized.join(large.select("cluster").distinct(), "cluster", "left_semi")
             .select("cluster", "class", "rng", "v", "n", "tokens").mapInPandas(_leads, "cluster long, class long, rng int, v long, lead long"))
    postings = cut(_volumes(leads, ["cluster", "lead"]).filter("members > 1"))
    led = (_sent(large, "by_cluster").join(_sent(postings, "by_lead"), "cluster").filter("by_lead < by_cluster").select("cluster"))
    of_clusters = (sized.join(led, "cluster", "left_anti").join(whole, ["cluster", "rng"])
                   .select("class", "n", "copies", "tokens", F.explode(_to(F.lit(False), F.lit(0).cast("long"))).alias("to")))
    places = (leads.join(led, "cluster", "left_semi").join(postings.drop("v"), ["cluster", "lead", "rng"])
              .select("class", F.explode(_to(F.lit(True), F.col("lead"))).alias("to")))
    of_leads = places.join(sets, "class").select("class", "n", "copies", "tokens", "to")
    return of_clusters.unionByName(of_leads).select("to.*", "class", "n", "copies", "tokens")


def _to(led, lead):
    """The tasks of a set in its group: an array of (task, cross, base, led, lead)."""
    def name(*x):
        return F.xxhash64("cluster", led, lead, *[F.lit(v) if isinstance(v, int) else v for v in x])

    def to(task, cross, base):
        return F.struct(task.alias("task"), cross.alias("cross"), base.alias("base"), led.alias("led"), lead.alias("lead"))

    own, rng = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"), F.col("rng")
    # (range, block) pairs: (r, i) with (r, j), j >= i, and with every block of range r + 1
    same = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                       lambda j: to(name(rng, F.least(own, j), rng, F.greatest(own, j)), own != j, own <= j))
    upper = F.when(F.col("above") > 0, F.transform(F.sequence(F.lit(0), F.col("above") - 1),
                   lambda j: to(name(rng, own, rng + 1, j), F.lit(True), F.lit(True))))
    lower = F.when(F.col("under") > 0, F.transform(F.sequence(F.lit(0), F.col("under") - 1),
                   lambda j: to(name(rng - 1, j, rng, own), F.lit(True), F.lit(False))))
    none = F.filter(F.array(to(name(-1), F.lit(False), F.lit(True))), lambda _: F.lit(False))
    many = F.concat(same, F.coalesce(upper, none), F.coalesce(lower, none))
    single = F.array(to(name(-1), F.lit(False), F.lit(True)))
    return F.when(F.col("whole") <= BLOCK, single).otherwise(many)


def meets_before(a: np.ndarray, b: np.ndarray, item: int) -> bool:
    """Two ascending arrays share something less than ``item``."""
    a, b = a[:np.searchsorted(a, item)], b[:np.searchsorted(b, item)]
    return bool(len(a) and len(b) and len(np.intersect1d(a, b, assume_unique=True)))


def link_block(base: list[tuple], probes: list[tuple] | None, lead: np.uint64 | None = None) -> tuple[list[int], list[int]]:
    """(links, ties) of the sets (tokens, size, copies) of a block with another, or with itself (None). With a ``lead`` a link
    counts only where it is the first shingle that the two sets share: tasks of their other shingles leave it out.

    Links count documents: a link with a set counts its copies. Ties name the smallest tied position, over the
    base and then the probes."""
    every = base + (probes or [])
    known, number = np.unique(np.concatenate([t for t, _, _ in every]), return_inverse=True)
    number = number.astype(np.int32)
    first = None if lead is None else int(np.searchsorted(known, lead))
    at = np.concatenate([[0], np.cumsum([len(t) for t, _, _ in every])])
    ids = [number[at[k]:at[k + 1]] for k in range(len(every))]
    present = np.zeros(int(number.max()) + 1, bool)
    trie = Trie(ids[:len(base)], [n for _, n, _ in base])
    links, ties = [0] * len(every), Ties(len(every))
    for k in range(len(base) if probes is not None else 0, len(every)):
        for other in trie.links(ids[k], every[k][1], present):
            if first is not None and other != k and meets_before(ids[k], ids[other], first):
                continue
            if probes is None:
                if other != k:  # found again from the other side
                    links[k] += every[other][2]
                    ties.tie(k, other)
            else:
                links[k] += every[other][2]
                links[other] += every[k][2]
                ties.tie(k, other)
    return links, [ties.root(k) for k in range(len(every))]


def _link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for _, rows in P.groups(frames, "task"):
        rows = rows.sort_values(["base", "class"], ascending=[False, True])
        sets = [(np.frombuffer(t, np.uint64), int(n), int(c)) for t, n, c in zip(rows["tokens"], rows["n"], rows["copies"])]
        cross, split = bool(rows["cross"].iloc[0]), int(rows["base"].sum())
        if len(sets) < 2 or cross and split in (0, len(sets)):  # one of two blocks is empty: no pairs between them
            continue
        lead = rows["lead"].to_numpy()[:1].view(np.uint64)[0] if rows["led"].iloc[0] else None
        links, ties = link_block(sets[:split], sets[split:] if cross else None, lead)
        cls = rows["class"].to_numpy()
        out = pd.DataFrame({"class": cls, "links": links, "tie": cls[ties]})
        yield out[out["links"] > 0]


# 5. result ---------------------------------------------------------------------------------------------------

def _linked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """class, root, links of other classes' documents, copies, first (smallest id) of all classes."""
    spark = docs.sparkSession
    classes = (ids.filter("class <> 0").groupBy("class")
               .agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first")))
    folder = new_folder(spark, "sets")
    possible_sets(docs).join(classes.select("class", "copies"), "class").write.parquet(folder)
    sets = spark.read.parquet(folder)
    tasks = _tasks(sets, clusters(sets.select("class", "n", "tokens")))
    found = cut(tasks.repartition("task").sortWithinPartitions("task").mapInPandas(_link, "class long, links long, tie long"))
    roots = components(found.select(F.col("class").alias("a"), F.col("tie").alias("b")))
    summed = found.groupBy("class").agg(F.sum("links").alias("links"))
    return (classes.join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
            .withColumn("root", F.coalesce("root", "class")).join(summed, "class", "left"))


def jaccard_groups(docs: DataFrame, row: str) -> DataFrame:
    """doc_id, the key of the row, component (a number per group of linked rows, null without words) for rows doc_id,
    text and a key."""
    ids = cut(document_sets(docs, row))
    known = _linked(docs, ids).select("class", F.col("root").alias("component"))
    return ids.join(known, "class", "left").select("doc_id", F.col("row").alias(row), "component")


def jaccard_join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links for rows doc_id, text."""
    ids = cut(document_sets(docs))
    known = _linked(docs, ids)
    least = known.groupBy("root").agg(F.min("first").alias("least"))
    labels = (known.join(least, "root")
              .select("class", F.col("least").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    return (ids.join(labels, "class", "left")
            .select("doc_id", "n_shingles", F.when(F.col("class") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM w
), n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
g AS (
  SELECT s, list(doc_id ORDER BY doc_id) AS d FROM (SELECT doc_id, unnest(s) AS s FROM s) GROUP BY s HAVING count(*) > 1
), p AS (
  SELECT a, b, count(*) AS o
  FROM (SELECT a, unnest(d) AS b FROM (SELECT unnest(d) AS a, d FROM g)) WHERE a <> b GROUP BY a, b
), l AS (
  SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * o >= 75 * (x.n + y.n - o)
), c(doc_id, root) AS (
  SELECT doc_id, doc_id FROM n
  UNION
  SELECT l.b, c.root FROM c JOIN l ON l.a = c.doc_id WHERE c.root < l.b
), m AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT n.doc_id, n.n AS n_shingles, min(c.root) AS component_id, coalesce(max(m.n_links), 0) AS n_links
FROM n JOIN c USING (doc_id) LEFT JOIN m ON m.a = n.doc_id GROUP BY n.doc_id, n.n
"""


@register("op1_jaccard_join", SQL)
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
