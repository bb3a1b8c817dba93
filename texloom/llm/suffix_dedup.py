"""Removal of repeated passages by suffix arrays.

Every byte covered by a string of ``SIZE`` bytes that also starts elsewhere is removed, in the same text or in
another. Strings do not cross texts and are judged on the input.

1. Every string of ``SIZE`` bytes has an anchor: the gram of ``GRAM`` bytes in it with the least hash (the first of
   equal ones). It depends on the string alone, so equal strings have equal anchors at the same place. A run of
   neighbouring strings with one anchor is a context: its first and last start, and the bytes they span.
2. Contexts whose anchor occurs once hold no repeated string. The others are counted by anchor and content, first
   within each piece of texts; of contexts with equal content one goes on, with its number.
3. The different contexts of an anchor meet in a task. There a suffix array of their starts is built in two
   stages: suffixes that are smaller than their successors are sorted directly (by their first ``SIZE`` bytes), and the
   others are induced by one scan over the buckets of first bytes. Neighbours in the array whose common prefix
   has ``SIZE`` bytes are repeated strings.
4. The repeated starts go back to all members of their context, and with the text of each document to the bytes to
   remove.

Contexts that occur many times are counted by partial aggregation and meet their result in a join that splits
large partitions, so a passage of a third of all rows is not gathered. What meets in one task are the
*different* contexts of one anchor. An anchor of more than ``CROWD`` of them (a short line that very many texts hold in
different surroundings) has no array: its strings are counted by a 64-bit hash, in a partial aggregation and a join.

A context whose tail has no suffix smaller than its successor (long runs of one byte) gives no start for the
induction; the starts of its anchor are then all sorted directly.

Rows are known by a 64-bit hash of all their columns, and contexts by one of their bytes. Equal rows share it: their contexts are
counted per row, but are members once per piece of texts, go to their anchor once per task, and come back once.

Defined results: a null text is empty and keeps nothing. Texts shorter than ``SIZE`` bytes are kept whole. Rows that
repeat are texts of their own, so both go (if ``SIZE`` bytes long). Other columns stay, and those named like a column of
the result are replaced. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (used as pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _words as W
from ._catalog import register
from ._cluster import new_folder, read_table

SIZE, GRAM = 200, 32
#: Bytes of contexts in one suffix array, whole anchors.
ARRAY_BYTES = 2 << 20
#: Bytes of texts worked on at once; a byte takes some 80 bytes of arrays.
PIECE_BYTES = 2 << 20
#: An anchor of more different contexts is not gathered for one array.
CROWD = 1 << 14
FACTOR = 0x9E3779B97F4A7C15


# 1. contexts -------------------------------------------------------------------------------------------------

def gram_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums of byte numbers times powers of FACTOR, inverse powers): hashes of all spans in constant time."""
    n = len(data)
    value = W.tables()[1].copy()
    value[0x41:0x5B] = W.mixed(value[0x61:0x7B])  # here upper case differs
    powers, inverse = np.full(n + 1, FACTOR, np.uint64), np.full(n + 1, pow(FACTOR, -1, 1 << 64), np.uint64)
    powers[0] = inverse[0] = 1
    np.multiply.accumulate(powers, out=powers)
    np.multiply.accumulate(inverse, out=inverse)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(value[data] * powers[:n], out=sums[1:])
    return sums, inverse


def contexts(data: np.ndarray, offsets: np.ndarray, size: int = SIZE, gram: int = GRAM):
    """(anchor hash, content hash, text, anchor place, first start, last start) of all contexts of pieces of texts;
    places count from the start of the text."""
    n, w = len(data), size - gram + 1
    none = np.empty(0, np.int64)
    if n < size:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), none, none, none, none
    sums, inverse = gram_sums(data)
    hashes = W.mixed((sums[gram:] - sums[:-gram]) * inverse[:n - gram + 1])
    m = len(hashes)
    padded = np.full(-(-m // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:m] = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
    blocks = padded.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - size + 1
    anchor = (np.minimum(right[:starts], left[w - 1:w - 1 + starts]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # starts whose string ends within their text
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:starts]
    valid = np.arange(starts) + size <= offsets[1:][text]
    change = anchor[1:] != anchor[:-1]
    opens, closes = valid.copy(), valid.copy()
    opens[1:] &= change | ~valid[:-1]
    closes[:-1] &= change | ~valid[1:]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes)
    at, text = anchor[first], text[first]
    long = (last - first).astype(np.uint64)
    content = W.mixed((sums[last + size] - sums[first]) * inverse[first] + long * np.uint64(0xD1342543DE82EF95))
    base = offsets[:-1][text]
    return hashes[at], content, text, at - base, first - base, last - base


MEMBERS = pa.struct([("key", pa.int64()), ("place", pa.int64())])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> contexts by anchor and content, once per piece of texts with their members: (key of the text, first start
    and number of further starts)."""
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        for first, data, offsets in W.texts(batch, "text", PIECE_BYTES):
            anchor, content, text, _, start, last = contexts(data, offsets)
            key, place = keys[first + text], (start << np.int64(8)) | (last - start)
            order = np.lexsort((place, key, content, anchor))
            anchor, content, key, place = anchor[order], content[order], key[order], place[order]
            new, once = np.ones(len(order), bool), np.ones(len(order), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
            once[1:] = new[1:] | (key[1:] != key[:-1]) | (place[1:] != place[:-1])  # equal rows count, but are one member
            at = np.append(np.flatnonzero(new), len(order))
            members = pa.StructArray.from_arrays([pa.array(key[once]), pa.array(place[once])], fields=list(MEMBERS))
            upto = np.append(0, np.cumsum(once))[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[new].view(np.int64)), pa.array(content[new].view(np.int64)), pa.array(np.diff(at)),
                 pa.ListArray.from_arrays(pa.array(upto, pa.int32()), members)], ["anchor", "content", "n", "members"])


# 3. suffix arrays --------------------------------------------------------------------------------------------

def _next(at: np.ndarray) -> np.ndarray:
    """Per position the next one, itself included, where ``at`` holds; the length if there is none."""
    out = np.where(at, np.arange(len(at)), len(at))
    return np.minimum.accumulate(out[::-1])[::-1]


def _prefixes(rows: np.ndarray, at: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """The first ``size`` bytes of suffixes as one array of byte strings; zeros follow the end of a context."""
    out = rows[at]
    for k in np.flatnonzero(ends < at + size):
        out[k, ends[k] - at[k]:] = 0
    return out.view(f"S{size}").ravel()


def suffix_order(text: np.ndarray, bounds: np.ndarray, starts: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array of the starts of contexts, contexts that give the induction no start; those are left out).

    ``bounds``: context k is ``text[bounds[k]:bounds[k + 1]]``; its first ``starts[k]`` positions are its starts. The order
    is by the first ``size`` bytes."""
    n = len(text)
    rows = np.lib.stride_tricks.sliding_window_view(np.concatenate([text, np.zeros(size, np.uint8)]), size)
    step = np.empty(n, np.int16)
    step[:-1] = text[1:].astype(np.int16) - text[:-1]
    step[bounds[1:] - 1] = -1  # the end is smaller than any byte
    smaller = step[_next(step != 0)] > 0  # than its successor
    stop = np.append(_next(smaller), n)[bounds[:-1] + starts]
    odd = stop >= bounds[1:]
    wanted = np.zeros(n + 1, np.int32)
    np.add.at(wanted, bounds[:-1][~odd], 1)
    np.add.at(wanted, stop[~odd] + 1, -1)
    wanted = np.cumsum(wanted[:-1]) > 0
    # stage one: direct sort
    direct = np.flatnonzero(wanted & smaller)
    direct = direct[np.argsort(_prefixes(rows, direct, bounds[np.searchsorted(bounds, direct, "right")], size), kind="stable")]
    # stage two: induce the rest, bucket by bucket
    rest = np.zeros(n + 1, bool)
    rest[:-1] = wanted & ~smaller
    direct_byte = text[direct]
    from_ = np.searchsorted(direct_byte, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    order = []
    for byte in range(256):
        here = waiting[byte]
        k = 0
        while k < len(here):  # runs of the byte: each one gives the one before it
            before = here[k] - 1
            before = before[rest[before] & (text[before] == byte)]
            if len(before):
                here.append(before)
            k += 1
        bucket = np.concatenate([*here, direct[from_[byte]:from_[byte + 1]]]) if here else direct[from_[byte]:from_[byte + 1]]
        if not len(bucket):
            continue
        order.append(bucket)
        before = bucket - 1
        before = before[rest[before] & (text[before] > byte)]
        if len(before):
            into = text[before]
            sorted_ = np.argsort(into, kind="stable")
            cuts = np.flatnonzero(np.diff(into[sorted_])) + 1
            for part in np.split(before[sorted_], cuts):
                waiting[text[part[0]]].append(part)
    order = np.concatenate(order) if order else np.empty(0, np.int64)
    is_start = np.zeros(n, np.int32)
    np.add.at(is_start, bounds[:-1], 1)
    np.add.at(is_start, (bounds[:-1] + starts)[bounds[:-1] + starts < n], -1)
    is_start = np.cumsum(is_start) > 0
    return order[is_start[order]], odd


def common_prefixes(text: np.ndarray, order: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Length of the common prefix, up to ``size``, of each suffix with the next one of the array."""
    rows = np.lib.stride_tricks.sliding_window_view(np.concatenate([text, np.zeros(size, np.uint8)]), size)
    out = np.empty(max(0, len(order) - 1), np.int64)
    for a in range(0, len(out), 1 << 15):
        b = min(a + (1 << 15), len(out))
        differ = rows[order[a:b]] != rows[order[a + 1:b + 1]]
        first = differ.argmax(axis=1)
        out[a:b] = np.where(differ[np.arange(b - a), first], first, size)
    return out


def repeated(text: np.ndarray, bounds: np.ndarray, starts: np.ndarray, group: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Per position of the text: a start whose string of ``size`` bytes is another start's too. ``group``: the
    contexts' anchors; contexts that can share a string have the same one."""
    out = np.zeros(len(text), bool)

    def mark(order: np.ndarray) -> None:
        same = np.flatnonzero(common_prefixes(text, order, size) >= size)
        out[order[same]] = out[order[same + 1]] = True

    order, odd = suffix_order(text, bounds, starts, size)
    if odd.any():
        hard = np.isin(group, np.unique(group[odd]))
        owner = np.searchsorted(bounds, order, "right") - 1
        order = order[~hard[owner]]
        at = np.concatenate([np.arange(bounds[k], bounds[k] + starts[k]) for k in np.flatnonzero(hard)])
        rows = np.lib.stride_tricks.sliding_window_view(np.concatenate([text, np.zeros(size, np.uint8)]), size)
        mark(at[np.argsort(_prefixes(rows, at, np.full(len(at), len(text) + size), size), kind="stable")])
    mark(order)
    return out


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different contexts, sorted by anchor and content -> runs of repeated starts of each, as packed (first, length)."""
    def array(table: pa.Table) -> pa.RecordBatch:
        anchor, content, copies = (table.column(n).to_numpy() for n in ("anchor", "content", "copies"))
        once = np.ones(len(anchor), bool)  # equal rows of the table share a key and give their contexts each
        once[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
        anchor, content, copies = anchor[once], content[once], copies[once]
        data = pa.concat_arrays(table.column("bytes").filter(pa.array(once)).chunks)
        bounds = np.frombuffer(data.buffers()[1], np.int32)[data.offset:data.offset + len(data) + 1].astype(np.int64)
        text = np.frombuffer(data.buffers()[2], np.uint8)[bounds[0]:bounds[-1]]
        bounds -= bounds[0]
        starts = np.diff(bounds) - (SIZE - 1)
        flags = repeated(text, bounds, starts, anchor)
        often = np.zeros(len(text) + 1, np.int32)
        np.add.at(often, bounds[:-1][copies > 1], 1)
        np.add.at(often, (bounds[:-1] + starts)[copies > 1], -1)
        flags |= np.cumsum(often[:-1]) > 0
        # a context's last SIZE - 1 positions are no starts, so no run goes on into the next
        edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
        first, length = edges[::2], edges[1::2] - edges[::2]
        at = np.searchsorted(first, bounds)
        runs = np.stack([first - np.repeat(bounds[:-1], np.diff(at)), length], axis=1).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), len(anchor), [None, pa.py_buffer((at * 8).astype(np.int32)), pa.py_buffer(runs.tobytes())])
        some = pa.array(np.diff(at) > 0)
        return pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(content), packed], ["anchor", "content", "runs"]).filter(some)

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column(3).nbytes
        if size >= ARRAY_BYTES:
            table = pa.Table.from_batches(held)
            anchor = table.column("anchor").to_numpy()
            whole = int(np.searchsorted(anchor, anchor[-1]))  # rows before the last anchor, which may go on
            if whole:
                yield array(table.slice(0, whole))
                held = table.slice(whole).to_batches()
                size = sum(b.column(3).nbytes for b in held)
    if held:
        yield array(pa.Table.from_batches(held))


# 4. documents ------------------------------------------------------------------------------------------------

def _wanted(batches: Iterator[pa.RecordBatch], crowded: bool):
    """Pieces of texts with the contexts that they give: (bytes, first place of each, number of bytes, anchor, content, copies).
    Of equal rows the first one that the task meets gives them."""
    seen: set[int] = set()
    for batch in batches:
        keys = batch.column(batch.schema.get_field_index("key")).to_pylist()
        fresh = [not (k in seen or seen.add(k)) for k in keys]
        if not all(fresh):
            batch = batch.filter(pa.array(fresh))
        column = batch.schema.get_field_index("wanted")
        for first, data, offsets in W.texts(batch, "text", PIECE_BYTES):
            lists = batch.column(column).slice(first, len(offsets) - 1)
            wanted = lists.flatten()
            anchor, content, copies, place = (wanted.field(n).to_numpy() for n in ("anchor", "content", "copies", "place"))
            at = np.repeat(offsets[:-1], pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)) + (place >> 8)
            some = wanted.field("crowded").to_numpy(zero_copy_only=False).astype(bool) == crowded
            if some.any():
                yield data, at[some], (place[some] & 255) + SIZE, anchor[some], content[some], copies[some]


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the contexts that they give -> the contexts' bytes."""
    for data, at, lens, anchor, content, copies in _wanted(batches, False):
        bounds = np.concatenate([[0], np.cumsum(lens)])
        picked = data[np.repeat(at - bounds[:-1], lens) + np.arange(bounds[-1])]
        packed = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(picked.tobytes())])
        yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(content), pa.array(copies), packed],
                                         ["anchor", "content", "copies", "bytes"])


def _cut_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the contexts of crowded anchors -> the hashes of the strings of each context, in order."""
    for data, at, lens, anchor, content, copies in _wanted(batches, True):
        sums, inverse = gram_sums(data)
        starts = lens - (SIZE - 1)
        bounds = np.concatenate([[0], np.cumsum(starts)])
        first = np.repeat(at - bounds[:-1], starts) + np.arange(bounds[-1])
        strings = W.mixed((sums[first + SIZE] - sums[first]) * inverse[first])
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor), pa.array(content), pa.array(copies),
             pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(strings.view(np.int64)))],
            ["anchor", "content", "copies", "strings"])


def _pack_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ascending places -> runs, packed as ``_judge`` gives them."""
    for batch in batches:
        runs = []
        for places in batch.column(2).to_pylist():
            at = np.array(places)
            cuts = np.flatnonzero(np.diff(at) != 1) + 1
            first = at[np.concatenate([[0], cuts])]
            length = np.diff(np.concatenate([[0], cuts, [len(at)]]))
            runs.append(np.stack([first, length], axis=1).astype(np.int32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(runs, pa.binary())], ["anchor", "content", "runs"])


def _crowded_runs(contexts_: DataFrame) -> DataFrame:
    """anchor, content, runs of the contexts of crowded anchors: their strings are counted by hash, partial counts first,
    and meet the counts in a join; nothing of an anchor is gathered."""
    each = (contexts_.dropDuplicates(["anchor", "content"])
            .select("anchor", "content", "copies", F.posexplode("strings").alias("place", "string")))
    again = each.groupBy("anchor", "string").agg(F.sum("copies").alias("n")).filter("n > 1").select("anchor", "string")
    places = (each.join(again, ["anchor", "string"]).groupBy("anchor", "content")
              .agg(F.array_sort(F.collect_list("place")).alias("places")))  # at most SIZE places
    return places.mapInArrow(_pack_runs, "anchor long, content long, runs binary")


def _removal(batches: Iterator[pa.RecordBatch], names: list[str], as_text: bool) -> Iterator[pa.RecordBatch]:
    """Texts with their runs of repeated starts -> what is removed and kept."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            columns = dict(zip(part.schema.names, part.columns))
            spans, kept = [], []
            for text, places, runs in zip(columns["text"], columns["places"].to_pylist(), columns["runs"].to_pylist()):
                data = text.as_buffer() if text.is_valid else pa.py_buffer(b"")
                if not runs:
                    spans.append([])
                    kept.append(data.to_pybytes())
                    continue
                at = np.concatenate([np.frombuffer(r, np.int32).reshape(-1, 2) + [[p >> 8, SIZE - 1]] for p, r in zip(places, runs)])
                at = at[np.argsort(at[:, 0], kind="stable")]
                end = np.maximum.accumulate(at.sum(axis=1))
                new = np.concatenate([[True], at[1:, 0] > end[:-1]])
                first, last = at[new, 0], end[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
                spans.append([{"start": int(s), "length": int(e - s)} for s, e in zip(first, last)])
                whole = data.to_pybytes()
                kept.append(b"".join(whole[s:e] for s, e in zip([0, *last], [*first, len(whole)])))
            if as_text:  # a character that lost some of its bytes goes whole
                kept = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
            columns |= {"spans": pa.array(spans, kind), "kept": kept if as_text else pa.array(kept, pa.binary())}
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)


def remove_repeats(docs: DataFrame, as_text: bool = False) -> DataFrame:
    """Rows of ``docs`` with ``spans`` (start, length in bytes of the maximal removed runs) and ``kept`` (the remaining
    bytes, or the text they make). ``docs`` has ``text``."""
    spark = docs.sparkSession
    own = [c for c in docs.columns if c.lower() not in ("spans", "kept", "key", "wanted", "places", "runs")]
    keyed = docs.select(*[F.col(f"`{c}`") for c in own],
                        F.xxhash64(*[F.col(f"`{c}`") for c in own if not docs.schema[c].dataType.simpleString().startswith("map")]).alias("key"))
    found = keyed.select("key", "text").mapInArrow(_find, "anchor long, content long, n long, members array<struct<key:long,place:long>>")
    again = found.select("anchor", "n").groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor")
    folder = new_folder(spark, "contexts")
    found.join(again, "anchor", "left_semi").write.parquet(folder)
    members = spark.read.parquet(folder)
    different = (members.groupBy("anchor", "content").agg(F.sum("n").alias("copies"), F.min(F.col("members")[0]).alias("one")))
    crowd = different.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CROWD).select("anchor")
    crowds = not crowd.isEmpty()
    if crowds:
        different = different.join(crowd.withColumn("crowded", F.lit(True)), "anchor", "left").withColumn("crowded", F.coalesce("crowded", F.lit(False)))
    else:
        different = different.withColumn("crowded", F.lit(False))
    wanted = (different.select(F.col("one.key").alias("key"), F.struct("anchor", "content", "copies", F.col("one.place").alias("place"), "crowded").alias("w"))
              .groupBy("key").agg(F.collect_list("w").alias("wanted")))
    giving = keyed.join(wanted, "key")
    judged = (giving.mapInArrow(_cut_contexts, "anchor long, content long, copies long, bytes binary")
              .repartition("anchor").sortWithinPartitions("anchor", "content")
              .mapInArrow(_judge, "anchor long, content long, runs binary"))
    if crowds:
        judged = judged.unionByName(_crowded_runs(giving.mapInArrow(
            _cut_strings, "anchor long, content long, copies long, strings array<long>")))
    spans = (members.select("anchor", "content", "members").join(judged, ["anchor", "content"])
             .select("runs", F.explode("members").alias("m"))
             .groupBy("m.key").agg(F.collect_set(F.struct("m.place", "runs")).alias("r"))  # equal rows share a key
             .select("key", F.col("r.place").alias("places"), F.col("r.runs").alias("runs")))
    kinds = {f.name: f for f in docs.schema.fields}
    out = T.StructType([*(kinds[c] for c in own),
                        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))),
                        T.StructField("kept", T.StringType() if as_text else T.BinaryType())])
    names = out.fieldNames()
    return keyed.join(spans, "key", "left").mapInArrow(lambda it: _removal(it, names, as_text), out)


@register("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    done = remove_repeats(docs)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return done.select("doc_id", size.alias("n_bytes"), (size - F.octet_length("kept")).cast("long").alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
