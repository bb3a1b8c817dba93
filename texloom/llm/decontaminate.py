"""Benchmark decontamination by template canonicalisation.

Texts become sequences of tokens, and tokens that a re-parameterised copy would change become typed
placeholders: numbers, units after a number, and names (capitalised inside a sentence). Windows of ``WINDOW``
template tokens of the documents meet those of the benchmark items in a hash join on the tasks. Windows of
one document and one item that lie on the same diagonal (the same shift between document and item) make
a match; the slots below its placeholders must be consistent: the same value in the item is always the same value in
the document (two values may become one). A match counts as a leak if it covers ``COVER`` tokens of the item, or the whole
of a shorter one. Where slots conflict, the match is cut there and its runs are judged (``judged``). A leak is reported
as ``exact`` where all slot values are equal, else as re-parameterised.

All this is done with two templates, and what either finds counts. The plain one has a token per word and takes a capitalised word
at the start of a sentence literally. In the merged one such a word is a name too, and a run of names, or a number with its unit, is
one token ("Boston" -> "New York"). Lengths are counted in words of the item.

The benchmark is sent to the tasks in pieces of about ``PIECE_BYTES`` bytes of text, one Python step per piece, in one
pass over the documents and without a shuffle; so what is broadcast at once is bounded for a benchmark of any size.

Defined results: null or empty texts hold no leak. Items with fewer than ``LEAST`` template tokens, or only
placeholders, are too short to tell and match nothing. Items that repeat are all reported. Repeated rows get equal
results; other columns stay, and those named like a column of the result are replaced. An empty benchmark
gives no leak.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _words as W
from ._catalog import register
from ._cluster import read_table

WINDOW, COVER, LEAST = 8, 13, 5
#: Words of a run with exchanged values that are a leak beside slots that conflict.
TORN = 2 * COVER
PIECE_BYTES = 4 << 20
#: Units of measure, time, data and money that may follow a number.
UNITS = ("mm cm m km in ft yd mi mile miles metre metres meter meters inch inches foot feet mg g kg t lb lbs oz gram grams "
         "kilogram kilograms tonne tonnes pound pounds ml l litre litres liter liters gallon gallons ms s sec second seconds min "
         "minute minutes h hr hour hours day days week weeks month months year years k kb mb gb tb bytes bits hz khz mhz ghz "
         "w kw v a j kj cal kcal pa kpa n percent usd eur gbp dollar dollars euro euros cent cents yen rupees").split()
NUMBER, NAME, UNIT = (np.uint64(x) for x in (0x6E756D62, 0x6E616D65, 0x756E6974))
OUT = ("items", "leaked_tokens", "exact", "contaminated")


#: Per byte: may stand inside a run of names.
_JOINTS = np.isin(np.arange(256), [ord(c) for c in " \t-'"])


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per byte: part of a token; ends a sentence."""
    part = np.zeros(256, bool)
    for a, b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
        part[a:b] = True
    ends = np.zeros(256, bool)
    ends[[ord(c) for c in ".!?:;\n\r"]] = True
    return part, ends


def template(data: np.ndarray, offsets: np.ndarray, merged: bool = False) -> tuple[np.ndarray, ...]:
    """(template hash of each token, starts, ends, is a slot, tokens before each text and after the last, words of each).

    ``merged``: capitalised tokens are names also where a sentence starts, and a run of names, or a number and its unit,
    is one token. Tokens are runs of ASCII letters and digits and of other characters; a point or comma between two digits joins them,
    and a token ends between a digit and a letter."""
    part, stops = _tables()
    inside = part[data]
    digit = (data >= 0x30) & (data <= 0x39)
    if len(data) > 2:
        joins = ((data[1:-1] == 0x2E) | (data[1:-1] == 0x2C)) & digit[:-2] & digit[2:]
        inside[1:-1] |= joins
        digit[1:-1] |= joins
    n = len(data)
    opens, closes = np.empty(n, bool), np.empty(n, bool)
    opens[:1], closes[-1:] = True, True
    turn = ~inside[:-1] | ~inside[1:] | (digit[:-1] != digit[1:])
    opens[1:], closes[:-1] = turn, turn
    opens[offsets[:-1][offsets[:-1] < n]] = True
    closes[offsets[1:][offsets[1:] > 0] - 1] = True
    starts, ends = np.flatnonzero(inside & opens), np.flatnonzero(inside & closes) + 1
    before = np.searchsorted(starts, offsets)
    out = W.span_hashes(data, starts, ends)
    if not len(starts):
        return out, starts, ends, np.zeros(0, bool), before, np.zeros(0, np.int64)
    number = digit[starts]
    units = np.sort(W.span_hashes(*_spans(UNITS)))
    after = np.zeros(len(starts), bool)
    after[1:] = number[:-1]
    after[before[:-1][before[:-1] < len(starts)]] = False
    unit = after & (units[np.minimum(np.searchsorted(units, out), len(units) - 1)] == out)
    capital = (data[starts] >= 0x41) & (data[starts] <= 0x5A)
    # the start of a sentence: nothing, or a stop, between this token and the one before it
    stop_at = np.concatenate([[0], np.cumsum(stops[data] & ~inside)])
    fresh = np.ones(len(starts), bool)
    fresh[1:] = stop_at[starts[1:]] > stop_at[ends[:-1]]
    fresh[before[:-1][before[:-1] < len(starts)]] = True
    name = capital & ~unit if merged else capital & ~fresh
    out = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, out)))
    slot = number | unit | name
    if not merged:
        return out, starts, ends, slot, before, np.ones(len(starts), np.int64)
    apart_at = np.concatenate([[0], np.cumsum(~inside & ~_JOINTS[data])])
    glued = unit.copy()
    glued[1:] |= name[1:] & name[:-1] & ~fresh[1:] & (apart_at[starts[1:]] == apart_at[ends[:-1]])
    first = np.flatnonzero(~glued)
    last = np.append(first[1:], len(starts)) - 1
    return out[first], starts[first], ends[last], slot[first], np.searchsorted(first, before), last - first + 1


def _spans(words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in data])
    return np.frombuffer(b"".join(data), np.uint8), ends - [len(w) for w in data], ends


def windows(tokens: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` tokens, texts run together."""
    odd = np.random.default_rng(8).integers(1, 2**63, size, dtype=np.uint64) | np.uint64(1)
    out = np.zeros(max(0, len(tokens) - size + 1), np.uint64)
    for k in range(size):
        out += tokens[k:k + len(out)] * odd[k]
    return W.mixed(out)


class Benchmark:
    """One piece of the benchmark, by its plain and its merged templates."""

    def __init__(self, items: list[tuple[int, str]]):
        self.views = [View(items, merged) for merged in (False, True)]

    def leaks(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, bool]]]:
        """text -> [(item id, covered words, exact)] of the leaks in pieces of texts."""
        out: dict[int, list] = {}
        for view in self.views:
            for text, found in view.leaks(data, offsets).items():
                out.setdefault(text, []).extend(found)
        return out


class View:
    """Windows of one piece of the benchmark: of ``WINDOW`` tokens, and the whole of a shorter item."""

    def __init__(self, items: list[tuple[int, str]], merged: bool):
        self.merged = merged
        self.ids = [i for i, _ in items]
        self.texts = [(t or "").encode() for _, t in items]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in self.texts])]).astype(np.int64)
        tokens, self.starts, self.ends, self.slot, self.before, self.words = template(
            np.frombuffer(b"".join(self.texts), np.uint8), offsets, merged)
        self.offsets, self.length = offsets, np.diff(self.before)
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        sizes = np.where(self.length >= WINDOW, WINDOW, self.length)
        for size in sorted({int(s) for s in sizes if s >= LEAST}):
            found = windows(tokens, size)
            literal = np.concatenate([[0], np.cumsum(~self.slot)])
            at = np.concatenate([np.arange(self.before[k], self.before[k + 1] - size + 1) for k in np.flatnonzero(sizes == size)])
            at = at[literal[at + size] > literal[at]]  # one token at least is no placeholder
            if not len(at):
                continue
            order = np.argsort(found[at], kind="stable")
            sieve = np.zeros(1 << 20, bool)
            sieve[(found[at] & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.by_size[size] = found[at][order], at[order], sieve
        self.item_of = np.repeat(np.arange(len(items)), self.length)
        self.need = np.minimum(COVER, np.bincount(self.item_of, self.words, len(items))).astype(np.int64)

    def value(self, token: int) -> bytes:
        k = int(self.item_of[token])
        return _value(self.texts[k][self.starts[token] - self.offsets[k]:self.ends[token] - self.offsets[k]])

    def leaks(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, bool]]]:
        tokens, starts, ends, _, before, _ = template(data, offsets, self.merged)
        hits = []
        for size, (hashes, at, sieve) in self.by_size.items():
            found = windows(tokens, size)
            some = np.flatnonzero(sieve[(found & np.uint64((1 << 20) - 1)).astype(np.int64)])
            first, last = np.searchsorted(hashes, found[some], "left"), np.searchsorted(hashes, found[some], "right")
            many = last - first
            here = np.repeat(some, many)
            there = at[np.repeat(first, many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)]
            text = np.searchsorted(before, here, "right") - 1
            whole = here + size <= before[text + 1]
            hits.append(np.stack([text, self.item_of[there], here - there, there, np.full(len(here), size)])[:, whole])
        out: dict[int, list] = {}
        if not hits or not sum(h.shape[1] for h in hits):
            return out
        all_ = np.concatenate(hits, axis=1)
        all_ = all_[:, np.lexsort((all_[3], all_[2], all_[1], all_[0]))]
        new = np.flatnonzero(np.any(all_[:3, 1:] != all_[:3, :-1], axis=0)) + 1
        for a, b in zip([0, *new], [*new, all_.shape[1]]):
            text, item, shift = (int(x) for x in all_[:3, a])
            covered = np.unique((all_[3, a:b, None] + np.arange(int(all_[4, a]))[None]).ravel())
            if self.words[covered].sum() < self.need[item]:
                continue
            slots = covered[self.slot[covered]]
            pairs = [(self.value(int(t)), _value(data[starts[t + shift]:ends[t + shift]].tobytes())) for t in slots]
            found = judged(covered, self.words[covered], slots, pairs, int(self.need[item]))
            if found:
                out.setdefault(text, []).append((self.ids[item], *found))
        return out


def _value(text: bytes) -> bytes:
    return b" ".join(text.lower().split())


def judged(covered: np.ndarray, words: np.ndarray, slots: np.ndarray, pairs: list[tuple[bytes, bytes]], need: int) -> tuple[int, bool] | None:
    """(words, exact) of the leak in a match, or None. ``pairs``: per slot, its value in the item and in the document.

    A match whose item values each have one value in the document is a leak as a whole. Else it is cut: into runs of
    equal values, which are leaks by themselves, and into runs without the slots whose value differs from the one that
    its item value mostly has. The latter are leaks if the match shows that values were exchanged on purpose (one that
    occurs again is exchanged alike), or from ``TORN`` words on."""
    counts: dict[bytes, Counter] = {}
    for mine, own in pairs:
        counts.setdefault(mine, Counter())[own] += 1
    if all(len(c) == 1 for c in counts.values()):
        return int(words.sum()), all(mine == own for mine, own in pairs)
    usual = {}
    for mine, c in counts.items():
        (own, most), *others = c.most_common(2)
        usual[mine] = own if not others or others[0][1] < most else None
    shown = any(len(c) == 1 and mine not in c and sum(c.values()) > 1 for mine, c in counts.items())
    equal = _longest(covered, words, slots[[mine != own for mine, own in pairs]])
    alike = _longest(covered, words, slots[[usual[mine] != own for mine, own in pairs]])
    if alike > equal and alike >= (need if shown else max(need, TORN)):
        return alike, False
    return (equal, True) if equal >= need else None


def _longest(covered: np.ndarray, words: np.ndarray, cuts: np.ndarray) -> int:
    """Words of the longest run of neighbours among the covered tokens without the cuts."""
    keep = ~np.isin(covered, cuts)
    left = covered[keep]
    if not len(left):
        return 0
    at = np.concatenate([[0], np.flatnonzero(np.diff(left) != 1) + 1])
    return int(np.add.reduceat(words[keep], at).max())


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep_only: bool = False) -> DataFrame:
    """Rows of ``docs`` with ``items`` (ids of the items that leak, ascending), ``leaked_tokens`` (most tokens of one
    item), ``exact`` (a leak with equal slot values) and ``contaminated``; or, with ``keep_only``, the rows without a
    leak in the columns of ``docs``. ``benchmark``: item_id, text."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null")
    volume = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    pieces = max(1, -(-volume // PIECE_BYTES))
    held = [f for f in docs.schema.fields if keep_only or f.name.lower() not in OUT]
    out = docs.select(*[F.col(f"`{f.name}`") for f in held], F.array().cast("array<long>").alias("_items"),
                      F.lit(0).cast("long").alias("_most"), F.lit(False).alias("_exact"))
    schema = out.schema
    for k in range(pieces):
        rows = items.filter(F.pmod(F.xxhash64("item_id", F.lit(23)), F.lit(pieces)) == k).collect()  # a piece: bounded
        sent = docs.sparkSession.sparkContext.broadcast(sorted((r["item_id"], r["text"] or "") for r in rows))
        out = out.mapInArrow(_step(sent, text), schema)
    if keep_only:
        return out.filter(F.size("_items") == 0).drop("_items", "_most", "_exact")
    return out.select(*[F.col(f"`{f.name}`") for f in held], F.array_sort(F.array_distinct("_items")).alias("items"),
                      F.col("_most").alias("leaked_tokens"), F.col("_exact").alias("exact"),
                      (F.size("_items") > 0).alias("contaminated"))


def _step(sent, text: str):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = Benchmark(sent.value)
        for batch in batches:
            found: dict[int, list] = {}
            for first, data, offsets in W.texts(batch, text):
                found |= {first + k: v for k, v in bench.leaks(data, offsets).items()}
            if found:
                names = batch.schema.names
                items, most, exact = (batch.column(names.index(n)).to_pylist() for n in ("_items", "_most", "_exact"))
                for k, leaks in found.items():
                    items[k] = items[k] + [i for i, _, _ in leaks]
                    most[k] = max(most[k], *(n for _, n, _ in leaks))
                    exact[k] = exact[k] or any(e for _, _, e in leaks)
                columns = {"_items": pa.array(items, pa.list_(pa.int64())), "_most": pa.array(most, pa.int64()), "_exact": pa.array(exact, pa.bool_())}
                batch = pa.RecordBatch.from_arrays([columns.get(n, batch.column(k)) for k, n in enumerate(names)], names)
            yield batch

    return step


@register("op8_decontaminate")
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark")).select("doc_id", *OUT)
