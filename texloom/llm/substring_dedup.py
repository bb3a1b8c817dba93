"""Removal of long repeated word sequences by a compacted de Bruijn graph.

A window of ``WINDOW`` words is an edge of the graph; its first and its last ``WINDOW - 1`` words are the nodes that it
joins. A word goes if a window over it also starts in a document with a smaller id.

1. Texts are written once, packed into pieces (a piece is a row with some whole texts), bucketed by piece. Each later step reads the
   pieces and meets its small replies in a join on the piece, so texts are never shuffled, and a reply meets one row only.
2. Every piece sends the different edges of its texts to parts by hash, as 32-bit prints, and learns which of them another
   piece may have too (one bit each).
3. Those edges go to parts again, now with 64-bit hashes and the words that come before and after them, if these are the
   same throughout the piece. A part tells for each edge whether two documents have it, and whether all its occurrences
   go on with the same word and come from the same word. The node between two edges branches unless the first goes on, and the second comes,
   from one word only. Nodes where a text begins or ends branch as well.
4. A piece compacts its runs of repeated edges into paths without a branching node inside. Every occurrence of an edge of such a path
   is part of an occurrence of the whole path, so all texts are cut into the same paths, and one row stands for a path in a piece. It carries a
   128-bit digest (BLAKE2) of the words at its source coordinates: paths are equal only if their words are. Equal hashes of different
   edges cut a path into more pieces and cannot merge two.
5. The least document id of a path is an aggregation, and comes back to the pieces in a join. Paths with a smaller id elsewhere are
   taken out of the text.

A passage in a third of all rows is one row per piece and path, in partial aggregations and in joins whose large partitions can
be split. Long texts are worked through in overlapping segments of ``CHUNK`` bytes; the node at a border of
segments counts as branching.

Defined results: a null text has no words. A null id is never smaller nor larger than another: such rows keep everything and
take nothing from others. Rows that repeat (or share an id) take nothing from each other. Texts of fewer words than a window
stay whole. ``kept`` joins the kept words by one space. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _packed as P
from . import _words as W
from ._catalog import register
from ._cluster import new_folder, read_table

WINDOW = 13
#: Bytes of texts worked on at once, and of texts in a piece (one text at least).
CHUNK = PIECE = 2 << 20
SEPARATOR, WORD = re.compile(rb"[\x20\x09-\x0D]"), re.compile(rb"[^\x20\x09-\x0D]+")
#: No word comes after (before), or not always the same.
BRANCH = np.uint64(0)
NO_ID = np.iinfo(np.int64).max
REPEATED, ON, FROM = 1, 2, 4


# 1. pieces ---------------------------------------------------------------------------------------------------

PIECES = "piece long, ids array<long>, texts array<string>"


def _pieces(piece: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids: list[pa.Array] = []
        texts: list[pa.Array] = []
        size = 0

        def row() -> pa.RecordBatch:
            all_ids, all_texts = pa.concat_arrays(ids), pa.concat_arrays(texts)
            one = pa.array([0, len(all_ids)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) | number]), pa.ListArray.from_arrays(one, all_ids), pa.ListArray.from_arrays(one, all_texts)],
                ["piece", "ids", "texts"])

        for batch in batches:
            column = batch.column(1)
            if not pa.types.is_string(column.type):
                column = column.cast(pa.string())
            first = 0
            for at, _, offsets in W.texts(pa.RecordBatch.from_arrays([column], ["text"]), "text", piece):
                n = len(offsets) - 1
                if ids and size + int(offsets[-1]) > piece:
                    yield row()
                    number += 1
                    ids, texts, size = [], [], 0
                ids.append(batch.column(0).slice(at, n))
                texts.append(column.slice(at, n))
                size += int(offsets[-1])
                first += n
        if ids:
            yield row()

    return pack


def write_pieces(docs: DataFrame, piece: int = PIECE) -> DataFrame:
    """doc_id, text of all rows as a table of pieces, bucketed by piece."""
    spark = docs.sparkSession
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pieces(piece), PIECES)
    name = f"texloom_pieces_{uuid.uuid4().hex}"
    (packed.write.option("path", new_folder(spark, "pieces")).option("compression", "zstd").format("parquet")
     .bucketBy(P.parts_of(spark), "piece").saveAsTable(name))
    return spark.table(name)


def segments(text: bytes, size: int, window: int) -> Iterator[tuple[int, int, int]]:
    """(first byte, end of its own bytes, end with the ``window - 1`` words that follow) of the segments of a text."""
    at = 0
    while True:
        cut = SEPARATOR.search(text, at + size) if at + size < len(text) else None
        end = last = cut.end() if cut else len(text)
        for _, word in zip(range(window - 1), WORD.finditer(text, end)):
            last = word.end()
        if last == end:  # no word follows
            yield at, len(text), len(text)
            return
        yield at, end, last
        at = end


class Chunk:
    """Some whole texts, or a segment of one: hashes of the words and of the windows that start in its own bytes.

    ``doc``: the text of each window; ``first``: its number of words in the text before; ``starts``, ``ends``: bytes of the words."""

    def __init__(self, number: int, docs: np.ndarray, data: np.ndarray, offsets: np.ndarray, own: int, before: int, window: int):
        self.number, self.docs, self.data = number, docs, data
        self.starts, self.ends, at = W.word_spans(data, offsets, W.tables()[0][data])
        self.words = W.span_hashes(data, self.starts, self.ends, _values())
        counts = np.maximum(np.diff(at) - (window - 1), 0)
        if len(offsets) == 2:  # the last words of a segment only complete its windows
            counts[0] = min(counts[0], int(np.searchsorted(self.starts, own)))
        self.at = np.repeat(at[:-1], counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        self.doc = np.repeat(np.arange(len(counts)), counts)
        self.first = self.at - at[:-1][self.doc] + before
        sums = np.zeros(max(0, len(self.words) - window + 1), np.uint64)
        for k, odd in enumerate(_odd(window)):
            sums += self.words[k:k + len(sums)] * odd
        self.edges = W.mixed(sums)[self.at]
        fresh = np.ones(len(self.at), bool)
        fresh[1:] = self.doc[1:] != self.doc[:-1]
        self.opens = fresh
        closes = np.append(fresh[1:], True)[:len(self.at)]
        self.after, self.before = np.full(len(self.at), BRANCH), np.full(len(self.at), BRANCH)
        inner = ~closes
        self.after[inner] = self.words[self.at[inner] + window] | np.uint64(1)
        self.before[~fresh] = self.words[self.at[~fresh] - 1] | np.uint64(1)

    def canonical(self) -> tuple[bytes, np.ndarray]:
        """(the words, a space after each; where each word begins)."""
        keep = np.zeros(len(self.data) + 1, bool)
        spans = np.zeros(len(self.data) + 2, np.int8)
        spans[self.starts] += 1
        np.add.at(spans, self.ends, -1)
        keep = np.cumsum(spans[:-1], dtype=np.int8) > 0
        lens = self.ends - self.starts
        begins = np.concatenate([[0], np.cumsum(lens + 1)])
        out = np.full(int(begins[-1]), 0x20, np.uint8)
        inside = np.ones(len(out), bool)
        inside[begins[1:] - 1] = False
        out[inside] = self.data[keep[:len(self.data)]]
        return out.tobytes(), begins


_MADE: dict = {}  # made once in a worker


def _values() -> np.ndarray:
    """A number per byte; unlike in the other operators A-Z are not a-z."""
    if "values" not in _MADE:
        _MADE["values"] = np.random.default_rng(12).integers(1, 2**63, 256, dtype=np.uint64)
    return _MADE["values"]


def _odd(window: int) -> np.ndarray:
    return np.random.default_rng(13).integers(1, 2**63, window, dtype=np.uint64) | np.uint64(1)


def chunks(texts: pa.Array, size: int, window: int) -> Iterator[Chunk]:
    """The chunks of the texts of a row, numbered; always the same for the same row."""
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    number = 0
    for first, data, offsets in W.texts(batch, "text", size):
        n = len(offsets) - 1
        if n > 1 or len(data) <= size:
            yield Chunk(number, np.arange(first, first + n), data, offsets, len(data), 0, window)
            number += 1
            continue
        text, words = data.tobytes(), 0
        for a, b, c in segments(text, size, window):
            part = data[a:c]
            chunk = Chunk(number, np.array([first]), part, np.array([0, len(part)]), b - a, words, window)
            words += int(np.searchsorted(chunk.starts, b - a))
            yield chunk
            number += 1


# 2. edges that may repeat ------------------------------------------------------------------------------------

def distinct(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the windows by edge, where each different edge opens, the different edges, ascending)."""
    order = np.argsort(chunk.edges, kind="stable")
    ranked = chunk.edges[order]
    opens = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.empty(0, np.int64)
    return order, opens, ranked[opens]


def _several(chunk: Chunk, order: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Different edges that two texts of the chunk have."""
    docs = chunk.doc[order]
    return np.minimum.reduceat(docs, opens) != np.maximum.reduceat(docs, opens) if len(opens) else np.empty(0, bool)


PRINTS = "part int, piece long, chunk int, items binary"


def _rows(batches: Iterator[pa.RecordBatch]):
    """(piece, ids, texts, other columns) of rows of pieces."""
    for batch in batches:
        names = batch.schema.names
        for k in range(batch.num_rows):
            ids, texts = batch.column(1)[k].values, batch.column(2)[k].values
            yield batch.column(0)[k].as_py(), ids, texts, {n: batch.column(j)[k] for j, n in enumerate(names) if j > 2}


def _message(names: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in names.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*rows), fields)], [n for n, _ in fields])


def _prints(parts: int, size: int, window: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, _, texts, _ in _rows(batches):
            for chunk in chunks(texts, size, window):
                _, _, edges = distinct(chunk)
                at = np.searchsorted(P.part_of(edges, parts), np.arange(parts + 1))  # edges ascend, and so do their parts
                out = [(k, piece, chunk.number, edges[a:b].astype(np.uint32).tobytes()) for k, (a, b) in enumerate(zip(at[:-1], at[1:])) if a < b]
                if out:
                    yield _message(PRINTS, out)

    return send


def _collect(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held) if held else None


def _joined(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """(all elements of a column of packed arrays, elements before each row and after the last)."""
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column]
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


BITS = "piece long, chunk int, part int, items binary"


def _seen_twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prints of a part -> per piece, bits: another chunk has the print too."""
    table = _collect(batches)
    if table is None:
        return
    low, at = _joined(table.column("items"), np.uint32)
    ranked = np.sort(low)
    twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    del ranked
    for k, (part, piece, chunk) in enumerate(zip(*(table.column(n).to_pylist() for n in ("part", "piece", "chunk")))):
        mine = low[at[k]:at[k + 1]]
        hit = np.searchsorted(twice, mine)
        bits = (twice[np.minimum(hit, len(twice) - 1)] == mine) if len(twice) else np.zeros(len(mine), bool)
        yield _message(BITS, [(piece, chunk, part, np.packbits(bits).tobytes())])


# 3. edges with their neighbours ------------------------------------------------------------------------------

def _replies(rows: DataFrame) -> DataFrame:
    """One row per piece with all that comes back to it."""
    return rows.groupBy("piece").agg(F.collect_list(F.struct("chunk", "part", "items")).alias("replies"))


def _reply(packed: pa.Scalar) -> dict[int, dict[int, bytes]]:
    """The replies to a piece: by chunk and part."""
    out: dict[int, dict[int, bytes]] = {}
    if packed.is_valid:
        for chunk, part, items in zip(*(packed.values.field(n).to_pylist() for n in ("chunk", "part", "items"))):
            out.setdefault(chunk, {})[part] = items
    return out


def _maybe(chunk: Chunk, got: dict[int, bytes], parts: int):
    """(order, opens, edges, which of the different edges may repeat)."""
    order, opens, edges = distinct(chunk)
    at = np.searchsorted(P.part_of(edges, parts), np.arange(parts + 1))
    maybe = _several(chunk, order, opens)
    for k, bits in got.items():
        maybe[at[k]:at[k + 1]] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=at[k + 1] - at[k]).astype(bool)
    return order, opens, edges, maybe


EDGES = "part int, piece long, chunk int, items binary, after binary, before binary, several binary"


def _edges(parts: int, size: int, window: int):
    """Edges that may repeat, with the word after and before each if it is one only in the chunk."""
    def one(words: np.ndarray, opens: np.ndarray) -> np.ndarray:
        low, high = np.minimum.reduceat(words, opens), np.maximum.reduceat(words, opens)
        return np.where(low == high, low, BRANCH)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, _, texts, more in _rows(batches):
            replies = _reply(more["replies"])
            for chunk in chunks(texts, size, window):
                order, opens, edges, maybe = _maybe(chunk, replies.get(chunk.number, {}), parts)
                if not maybe.any():
                    continue
                several = _several(chunk, order, opens)[maybe]
                after, before = one(chunk.after[order], opens)[maybe], one(chunk.before[order], opens)[maybe]
                edges = edges[maybe]
                at = np.searchsorted(P.part_of(edges, parts), np.arange(parts + 1))
                yield _message(EDGES, [
                    (k, piece, chunk.number, edges[a:b].tobytes(), after[a:b].tobytes(), before[a:b].tobytes(), np.packbits(several[a:b]).tobytes())
                    for k, (a, b) in enumerate(zip(at[:-1], at[1:])) if a < b])

    return send


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a part -> per piece, a byte for each: two documents have it, one word comes after it, one before."""
    table = _collect(batches)
    if table is None:
        return
    edges, at = _joined(table.column("items"), np.uint64)
    after, before = _joined(table.column("after"), np.uint64)[0], _joined(table.column("before"), np.uint64)[0]
    several = np.concatenate([np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=n) for x, n in zip(table.column("several"), np.diff(at))])
    order = np.argsort(edges, kind="stable")
    ranked = edges[order]
    opens = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    runs = np.diff(np.append(opens, len(ranked)))
    kind = np.where((runs > 1) | (np.maximum.reduceat(several[order], opens) > 0), REPEATED, 0).astype(np.uint8)
    for words, flag in ((after, ON), (before, FROM)):
        low, high = np.minimum.reduceat(words[order], opens), np.maximum.reduceat(words[order], opens)
        kind |= np.where((low == high) & (low != BRANCH), flag, 0).astype(np.uint8)
    flags = np.empty(len(edges), np.uint8)
    flags[order] = np.repeat(kind, runs)
    for k, (part, piece, chunk) in enumerate(zip(*(table.column(n).to_pylist() for n in ("part", "piece", "chunk")))):
        yield _message(BITS, [(piece, chunk, part, flags[at[k]:at[k + 1]].tobytes())])


# 4. paths ----------------------------------------------------------------------------------------------------

def paths(chunk: Chunk, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first window, windows) of the runs of repeated edges, cut at branching nodes. Flags: of each window."""
    repeated = (flags & REPEATED) > 0
    joined = np.zeros(len(flags), bool)  # with the window before
    joined[1:] = repeated[1:] & repeated[:-1] & ((flags[:-1] & ON) > 0) & ((flags[1:] & FROM) > 0) & ~chunk.opens[1:]
    first = np.flatnonzero(repeated & ~joined)
    number = np.cumsum(repeated & ~joined)
    return first, np.bincount(number[repeated] - 1, minlength=len(first)) if len(first) else np.empty(0, np.int64)


#: ``where``: text of the row, first word and words of each occurrence, three numbers each.
PATHS = "high long, low long, least long, piece long, where binary"


def _paths(parts: int, size: int, window: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, ids, texts, more in _rows(batches):
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(NO_ID).to_numpy()
            first_reply, second_reply = _reply(more["replies"]), _reply(more["judged"])
            for chunk in chunks(texts, size, window):
                got = second_reply.get(chunk.number)
                if not got:
                    continue
                order, opens, edges, maybe = _maybe(chunk, first_reply.get(chunk.number, {}), parts)
                kind = np.zeros(len(edges), np.uint8)
                kind[maybe] = np.frombuffer(b"".join(got[k] for k in sorted(got)), np.uint8)
                flags = np.empty(len(order), np.uint8)
                flags[order] = np.repeat(kind, np.diff(np.append(opens, len(order))))
                first, length = paths(chunk, flags)
                if not len(first):
                    continue
                text, begins = chunk.canonical()
                words = chunk.at[first]
                digests = np.frombuffer(b"".join(hashlib.blake2b(text[a:b], digest_size=16).digest() for a, b in
                                                 zip(begins[words].tolist(), begins[words + length + window - 1].tolist())), np.int64).reshape(-1, 2)
                doc = chunk.docs[chunk.doc[first]]
                where = np.stack([doc, chunk.first[first], length + window - 1], axis=1).astype(np.int64)
                ranked = np.lexsort((digests[:, 1], digests[:, 0]))
                digests, where, doc = digests[ranked], where[ranked], doc[ranked]
                new = np.flatnonzero(np.concatenate([[True], (digests[1:] != digests[:-1]).any(axis=1)]))
                ends = np.append(new[1:], len(digests))
                least = np.minimum.reduceat(np.where(known[doc], ids[doc], NO_ID), new)
                n = len(new)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests[new, 0]), pa.array(digests[new, 1]), pa.array(least), pa.array(np.full(n, piece)),
                     pa.array([where[a:b].tobytes() for a, b in zip(new, ends)], pa.binary())],
                    ["high", "low", "least", "piece", "where"])

    return send


# 5. texts ----------------------------------------------------------------------------------------------------

DONE = "doc_id long, n_words long, n_removed long, kept string"


def _take_out(size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, texts, more in _rows(batches):
            owner = ids.fill_null(NO_ID).to_numpy()
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            spans = np.empty((0, 3), np.int64)
            if more["found"].is_valid:
                found = more["found"].values
                least = found.field("least").to_numpy()
                lists = [np.frombuffer(w.as_buffer(), np.int64).reshape(-1, 3) for w in found.field("where")]
                if lists:
                    spans = np.concatenate(lists)
                    spans = spans[known[spans[:, 0]] & (np.repeat(least, [len(x) for x in lists]) < owner[spans[:, 0]])]
                    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
            at = np.searchsorted(spans[:, 0], np.arange(len(texts) + 1))
            out, n_words, n_removed = [], [], []
            for k, text in enumerate(texts):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                first = spans[at[k]:at[k + 1], 1]
                kept, total, gone = keep_words(data, first, first + spans[at[k]:at[k + 1], 2], size)
                out.append(kept)
                n_words.append(total)
                n_removed.append(gone)
            yield pa.RecordBatch.from_arrays([ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(out, pa.string())],
                                             ["doc_id", "n_words", "n_removed", "kept"])

    return cut


def keep_words(text: bytes, first: np.ndarray, end: np.ndarray, size: int) -> tuple[str, int, int]:
    """(the words outside the ranges of word numbers, joined by a space; words; words taken out)."""
    kept, at, total, gone = [], 0, 0, 0
    while at < len(text):
        cut = SEPARATOR.search(text, at + size) if at + size < len(text) else None
        stop = cut.end() if cut else len(text)
        words = text[at:stop].split()  # at 20 and 09-0D
        a, b = np.clip(first - total, 0, len(words)), np.clip(end - total, 0, len(words))
        if (a < b).any():
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, a, 1)
            np.add.at(cover, b, -1)
            stay = np.cumsum(cover)[:-1] == 0
            total, gone = total + len(words), gone + int((~stay).sum())
            words = [words[k] for k in np.flatnonzero(stay)]
        else:
            total += len(words)
        if words:
            kept.append(b" ".join(words))
        at = stop
    return b" ".join(kept).decode(), total, gone


def remove_repeated_words(docs: DataFrame, window: int = WINDOW, chunk: int = CHUNK, piece: int = PIECE) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words joined by one space) of docs (doc_id, text)."""
    spark = docs.sparkSession
    parts = P.parts_of(spark)
    table = write_pieces(docs, piece)

    def stored(df: DataFrame, what: str) -> DataFrame:
        folder = new_folder(spark, what)
        df.write.parquet(folder)
        return spark.read.parquet(folder)

    prints = P.by_part(table.mapInArrow(_prints(parts, chunk, window), PRINTS), parts).mapInArrow(_seen_twice, BITS)
    replies = stored(_replies(prints), "prints")
    known = table.join(replies, "piece", "left")
    edges = P.by_part(known.mapInArrow(_edges(parts, chunk, window), EDGES), parts).mapInArrow(_judge, BITS)
    judged = stored(_replies(edges).withColumnRenamed("replies", "judged"), "edges")
    # pieces without an edge that repeats are through
    occurrences = stored(known.join(judged, "piece").mapInArrow(_paths(parts, chunk, window), PATHS), "paths")
    least = occurrences.groupBy("high", "low").agg(F.min("least").alias("source"))
    found = (occurrences.join(least, ["high", "low"]).filter(F.col("source") < NO_ID)
             .groupBy("piece").agg(F.collect_list(F.struct(F.col("source").alias("least"), "where")).alias("found")))
    return table.join(found, "piece", "left").mapInArrow(_take_out(chunk), DONE)


SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT rid, doc_id, k, array_to_string(words[k:k + 12], ' ') AS content FROM (SELECT *, unnest(range(1, len(words) - 11)) AS k FROM w)
), least AS (
  SELECT content, min(doc_id) AS source FROM windows GROUP BY content
), hits AS (
  SELECT rid, k FROM windows JOIN least USING (content) WHERE source < doc_id
), gone AS (
  SELECT DISTINCT rid, p FROM (SELECT rid, unnest(range(k, k + 13)) AS p FROM hits)
), each AS (
  SELECT w.rid, p, word FROM (SELECT rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w) AS w
), kept AS (
  SELECT each.rid, string_agg(word, ' ' ORDER BY each.p) AS text FROM each ANTI JOIN gone ON each.rid = gone.rid AND each.p = gone.p GROUP BY each.rid
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN (SELECT rid, count(*) AS n FROM gone GROUP BY rid) AS g ON g.rid = w.rid LEFT JOIN kept ON kept.rid = w.rid
"""


@register("op12_substring_dedup", SQL)
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeated_words(read_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
