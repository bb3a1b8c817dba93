"""Language-model scores by online logistic mixing of hashed-context bit predictors.

The model. A token (word, or the end of a text) has a class of ``CLASS_BITS`` bits, a hash of the word. Its
probability is that of the class in its context times that of the word in its class. The class is coded bit by bit.
Each bit is predicted in three hashed contexts: none, the class before, and the two classes before (hashed to
``PAIRS`` contexts). A predictor's estimate comes from the counts of its context in all training tokens. The estimates are
mixed in the logistic domain; the weights are chosen by the bit's place and by how much the contexts have seen
(the gate), and are learned online, after each token, by the gradient of the coding cost. An adaptive map from the
mixed estimate to what followed such estimates refines it, learned online as well. A word in its class
has probability (c + 1) / (N + V + 1) with the class's training tokens N and distinct words V; 1 stands for all unknown words.

The weights and the map start from the same values in every text and are carried through it to its end, however long it is; so a
score depends on the text and the training counts only.

Over the words stands a predictor whose contexts grow with the corpus. A text is cut into phrases, after a pair of words that a
hash selects (one of ``2 ** CUT_BITS``) and at its end; all tokens are in phrases. The context of a phrase is the full hash of the
``ORDER`` words before it. One bit says whether the phrase is the one that followed its context most often in training (ties: the
smaller hash); it is predicted by a rate that is chosen by how often the context was seen and how large the share of that phrase
is (the gate), moved in the logistic domain by a bias that a text learns online from its own bits. With rate p and the words'
probability q, the predicted phrase has p + (1 - p) * q and any other (1 - p) * q; so the probabilities add up to 1. A training text
is scored as before it is learned: each of its phrases is left out of the counts that predict it. The rates are those of
all training phrases, counted with the same omission.

The plan. The first scan sends, per piece of texts, its vocabulary with counts to the parts of the words, where counts
over all training texts are made and go back to the piece; likewise its distinct (context, phrase) pairs with counts to the
parts of the contexts, from where a byte per pair goes back; and per task its sums of class contexts, which are added by
slices. All of this grows with the corpus; the added table of classes is bounded by its parameters and is sent to the tasks.
The second scan codes the classes and sends each piece's words and phrases in their order to where its word
counts are, and there the scores are added up. A frequent word or phrase costs one entry per piece in its part; what meets in
one task beyond that are the different phrases after one context, 8 bytes each.

Both scans must cut the input into the same partitions, as a scan of files does; a piece whose vocabulary
differs in the second scan ends the job with an error.

Defined results: a null text is empty and is scored as its end alone. A null id counts as the empty text for the crc.
Rows that repeat are texts of their own. With no training rows all counts are 0. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _packed as P
from . import _words as W
from ._catalog import register
from ._cluster import new_folder, read_table

CLASS_BITS, PAIRS = 10, 1 << 11
CUT_BITS, ORDER = 2, 3
#: Bits of a phrase in a (context, phrase) pair of 64; rate and bound of the bias that a text learns.
PHRASE_BITS, BIAS_RATE, BIAS = 24, 0.4, 6.0
GATES = 16
#: Tokens whose predictions are looked up together.
AHEAD = 1 << 12
CLASSES = 1 << CLASS_BITS
CELLS = CLASSES * (1 + CLASSES + PAIRS)
SLICES = 64
#: Start weights of the three predictors, rate of the weights, places and rate of the adaptive map.
WEIGHTS, RATE, PLACES, MAP_RATE = (0.3, 0.45, 0.35), 0.015, 33, 0.02
END = np.uint64(0x5BF0_3635_DEA4_11A7)

PACKED = "part int, kind int, piece long, place int, a binary, b binary, c binary"
VOCABULARY, CONTEXTS, ENTRIES, WORD_COUNTS, CLASS_SIZES, PHRASES, PHRASE_CODES, RATES = range(8)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [x.split()[0] for x in PACKED.split(", ")])


# tokens ------------------------------------------------------------------------------------------------------

def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token, tokens before each text and after the last); each text closes with its end."""
    hashes, before = W.words(data, offsets)
    at = before + np.arange(len(before))
    out = np.full(int(at[-1]), END, np.uint64)
    inside = np.ones(len(out), bool)
    inside[at[1:] - 1] = False
    out[inside] = hashes
    return out, at


def class_of(hashes: np.ndarray) -> np.ndarray:
    return (W.mixed(hashes ^ np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - CLASS_BITS)).astype(np.int64)


def context_rows(classes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of the context of one class before, row of the context of two) of the table of class contexts; row 0 is
    the context without any. Before a text stand ends."""
    end = int(class_of(np.array([END]))[0])
    one, two = np.empty_like(classes), np.empty_like(classes)
    one[1:], two[2:] = classes[:-1], classes[:-2]
    firsts = at[:-1]
    one[firsts] = two[firsts] = end
    seconds = firsts[firsts + 1 < at[1:]] + 1
    two[seconds] = end
    pair = W.mixed((one * CLASSES + two).astype(np.uint64)) & np.uint64(PAIRS - 1)
    return 1 + one, 1 + CLASSES + pair.astype(np.int64)


def phrases(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first token of each phrase, (context, phrase) pair as one number, whether it has a context) for texts of tokens. The
    upper bits are the context's. Phrases with fewer than ``ORDER`` words before them in their text have no context."""
    place = W.tables()[2]
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[at[:-1]] = END
    last = W.mixed(hashes * place[1] + before * place[2]) >> np.uint64(64 - CUT_BITS) == 0
    last[at[1:] - 1] = True
    starts = np.append(0, np.flatnonzero(last)[:-1] + 1) if len(hashes) else np.empty(0, np.int64)
    lens = np.diff(starts, append=len(hashes))
    inner = np.arange(len(hashes)) - np.repeat(starts, lens)
    phrase = np.add.reduceat(hashes * place[inner & 0xFFFF], starts) if len(starts) else np.empty(0, np.uint64)
    phrase = W.mixed(phrase + lens.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    context = np.zeros(len(starts), np.uint64)
    for k in range(1, ORDER + 1):
        context += hashes[np.maximum(starts - k, 0)] * place[16 + k]
    owner = np.searchsorted(at, starts, "right") - 1
    pair = W.mixed(context) >> np.uint64(PHRASE_BITS) << np.uint64(PHRASE_BITS) | phrase >> np.uint64(64 - PHRASE_BITS)
    return starts, pair, starts - at[owner] >= ORDER


def planes(x: np.ndarray) -> bytes:
    """The bytes of whole numbers, all first bytes first: what is alike lies together and is compressed."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def unplaned(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


# first scan --------------------------------------------------------------------------------------------------

def _gather(parts: int):
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int64)
        number = 0
        for batch in batches:
            learn = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            for first, data, offsets in W.texts(batch, "text"):
                piece, number = (TaskContext.get().partitionId() << 32) | number, number + 1
                hashes, at = tokens(data, offsets)
                taught = np.repeat(learn[first:first + len(at) - 1], np.diff(at))
                words, which = np.unique(hashes, return_inverse=True)
                counts = np.bincount(which[taught], minlength=len(words))
                cuts = np.searchsorted(P.part_of(words, parts), np.arange(parts + 1))
                out = [(k, VOCABULARY, piece, k, words[a:b].tobytes(), counts[a:b].astype(np.uint32).tobytes(), b"")
                       for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]
                starts, pairs, has = phrases(hashes, at)
                pairs, which = np.unique(pairs[has], return_inverse=True)
                counts = np.bincount(which[taught[starts[has]]], minlength=len(pairs)).astype(np.uint32)
                cuts = np.searchsorted(P.part_of(pairs, parts), np.arange(parts + 1))
                out += [(k, PHRASES, piece, k, planes(pairs[a:b]), planes(counts[a:b]), b"")
                        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]
                if out:
                    yield _rows(out)
                classes = class_of(hashes)
                one, two = context_rows(classes, at)
                classes = classes[taught]
                for row in (np.zeros(len(classes), np.int64), one[taught], two[taught]):
                    cells += np.bincount(row * CLASSES + classes, minlength=CELLS)
        if cells.any():
            yield _rows([(k % parts, CONTEXTS, 0, k, c.astype(np.uint32 if cells.max() < 2**32 else np.uint64).tobytes(), b"", b"")
                         for k, c in enumerate(np.array_split(cells, SLICES)) if c.any()])

    return gather


def gate(seen: np.ndarray, most: np.ndarray) -> np.ndarray:
    """0..15 for a context seen ``seen`` times, ``most`` of them with its most frequent phrase."""
    share = np.where(most == seen, 3, np.where(2 * most >= seen, 2, np.where(4 * most >= seen, 1, 0)))
    return np.searchsorted([2, 3, 6], seen, "right") * 4 + share


def follow(pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What predicts the phrase of each of the sorted, distinct pairs with training counts ``n``: 0 where nothing does, else
    1 + 2 * gate + (whether the predicted phrase is the pair's). First for texts that were not learned from, then for one of
    the ``n`` training phrases, which is left out of the counts."""
    context = pairs >> np.uint64(PHRASE_BITS)
    starts = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
    of = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(pairs)))
    number = np.arange(len(pairs))
    seen = np.add.reduceat(n, starts)

    def best(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        most = np.maximum.reduceat(n, starts)
        return most, np.minimum.reduceat(np.where(n == most[of], number, len(pairs)), starts)

    most, first = best(n)
    others = n.copy()
    others[first] = -1
    next_, second = best(others)
    hit = number == first[of]
    plain = np.where(seen[of] > 0, 1 + 2 * gate(seen, most)[of] + hit, 0)
    next_ = np.maximum(next_, 0)[of]
    left = n - 1
    stays = hit & ((left > next_) | ((left == next_) & (number < second[of])))
    out = 1 + 2 * gate(seen[of] - 1, np.where(stays, left, np.where(hit, next_, most[of]))) + stays
    return plain.astype(np.uint8), np.where((seen[of] > 1) & (n > 0), out, 0).astype(np.uint8)


def _add_phrases(rows: list[tuple], parts: int) -> Iterator[pa.RecordBatch]:
    """One part: what predicts the phrases of each piece, back to the piece; hits and phrases by gate."""
    sizes = [len(a) // 8 for _, _, a, _ in rows]
    all_, which = np.unique(np.concatenate([unplaned(a, np.uint64) for _, _, a, _ in rows]), return_inverse=True)
    n = np.bincount(which, np.concatenate([unplaned(b, np.uint32) for _, _, _, b in rows]), minlength=len(all_)).astype(np.int64)
    plain, left = follow(all_, n)
    told = np.bincount(left, n, minlength=1 + 2 * GATES).astype(np.int64)
    yield _rows([(0, RATES, 0, 0, told.tobytes(), b"", b"")])
    at = 0
    for (piece, place, _, _), size in zip(rows, sizes):
        own = which[at:at + size]
        yield _rows([(P.home(piece, parts), PHRASE_CODES, piece, place, plain[own].tobytes(), left[own].tobytes(), b"")])
        at += size


def _add(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """One part: word counts over all pieces, back to the pieces; sizes of the classes; sums of table slices; phrases."""
    pieces, words, counts, slices, followed = [], [], [], {}, []
    bounds = [len(c) for c in np.array_split(np.empty(CELLS, np.int8), SLICES)]
    for batch in batches:
        for _, kind, piece, place, a, b, _ in zip(*(c.to_pylist() for c in batch.columns)):
            if kind == CONTEXTS:
                got = np.frombuffer(a, np.uint32 if len(a) == 4 * bounds[place] else np.uint64).astype(np.int64)
                slices[place] = slices[place] + got if place in slices else got
            elif kind == PHRASES:
                followed.append((piece, place, a, b))
            else:
                pieces.append((piece, place))
                words.append(np.frombuffer(a, np.uint64))
                counts.append(np.frombuffer(b, np.uint32))
    for place, cells in slices.items():
        yield _rows([(0, CONTEXTS, 0, place, cells.tobytes(), b"", b"")])
    if followed:
        yield from _add_phrases(followed, parts)
        del followed
    if not pieces:
        return
    sizes = [len(w) for w in words]
    all_, which = np.unique(np.concatenate(words), return_inverse=True)
    del words
    total = np.bincount(which, np.concatenate(counts), minlength=len(all_)).astype(np.int64)
    known = total > 0
    classes = class_of(all_)
    yield _rows([(0, CLASS_SIZES, 0, 0, np.bincount(classes, total, minlength=CLASSES).astype(np.int64).tobytes(),
                  np.bincount(classes[known], minlength=CLASSES).astype(np.int64).tobytes(), b"")])
    at = 0
    for (piece, place), n in zip(pieces, sizes):
        c = total[which[at:at + n]]
        yield _rows([(P.home(piece, parts), WORD_COUNTS, piece, place, c.astype(np.uint32 if c.max() < 2**32 else np.uint64).tobytes(),
                      n.to_bytes(4, "little"), b"")])
        at += n


# the model ---------------------------------------------------------------------------------------------------

class Model:
    """Predictors of the bits of a class, from the counts of class contexts.

    A class is the leaf of a binary tree; node 1 is its root and node k has the children 2k and 2k + 1."""

    def __init__(self, cells: np.ndarray):
        leaves = cells.reshape(-1, CLASSES)
        level, ones, alls = leaves, [], []
        for _ in range(CLASS_BITS):
            ones.insert(0, level[:, 1::2])
            level = level[:, ::2] + level[:, 1::2]
            alls.insert(0, level)
        pad = np.zeros((len(leaves), 1))
        one, all_ = np.concatenate([pad, *ones], axis=1), np.concatenate([pad, *alls], axis=1)
        #: log odds of a 1 at each node of each context, and 0..3 for what the context has seen there
        self.odds = np.log((one + 0.4) / (all_ - one + 0.4)).astype(np.float32).ravel()
        self.seen = np.searchsorted([2, 16, 256], all_.ravel(), "right").astype(np.uint8)


def code_lengths(model: Model, classes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each text's classes."""
    return np.bincount(np.repeat(np.arange(len(at) - 1), np.diff(at)), token_lengths(model, classes, at), minlength=len(at) - 1)


def token_lengths(model: Model, classes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each class of the texts. Texts learn side by side, token by token; what does not
    depend on what a text has learned is looked up for ``AHEAD`` tokens at once."""
    depth = np.arange(CLASS_BITS)
    path = ((np.arange(CLASSES)[:, None] | CLASSES) >> (CLASS_BITS - depth)).astype(np.int64)  # nodes of a class
    bit = ((np.arange(CLASSES)[:, None] >> (CLASS_BITS - 1 - depth)) & 1).astype(np.float32)
    one, two = context_rows(classes, at)
    one, two = one * CLASSES, two * CLASSES
    counts = np.diff(at)
    order = np.argsort(-counts, kind="stable")
    starts, lens = at[:-1][order], counts[order]
    lanes = len(lens)
    gates = 16
    weights = np.tile(np.array(WEIGHTS, np.float32), (lanes * CLASS_BITS * gates, 1))
    shape = 1 / (1 + np.exp(-(np.arange(PLACES, dtype=np.float32) - PLACES // 2) / 2))
    refined = np.tile(shape.astype(np.float32), lanes * CLASS_BITS)
    slot = np.arange(lanes * CLASS_BITS).reshape(lanes, CLASS_BITS)
    cost = np.zeros(len(classes))
    active = np.searchsorted(-lens, -np.arange(1, (int(lens[0]) if lanes else 0) + 1), "right")
    t = 0
    while t < len(active):
        n = int(active[t])
        here = active[t:t + max(1, AHEAD // n)]
        i = np.minimum(starts[:n] + np.arange(t, t + len(here))[:, None], len(classes) - 1)
        nodes, bits = path[classes[i]], bit[classes[i]]
        at1, at2 = one[i][..., None] + nodes, two[i][..., None] + nodes
        odds = model.odds[nodes], model.odds[at1], model.odds[at2]
        own = slot[:n] * gates + (model.seen[at1] * 4 + model.seen[at2])
        mixed = np.ones(bits.shape, np.float32)
        for k, n in enumerate(here):
            s0, s1, s2 = (x[k, :n] for x in odds)
            b, o = bits[k, :n], own[k, :n]
            w = weights[o]
            z = np.clip(w[..., 0] * s0 + w[..., 1] * s1 + w[..., 2] * s2, -12, 12)
            p = 1 / (1 + np.exp(-z))
            where = slot[:n] * PLACES + np.clip(np.rint(2 * z) + PLACES // 2, 0, PLACES - 1).astype(np.int64)
            q = refined[where]
            mixed[k, :n] = (p + q) / 2
            off = (b - p) * np.float32(RATE)
            w[..., 0] += off * s0
            w[..., 1] += off * s1
            w[..., 2] += off * s2
            weights[o] = w
            refined[where] = q + (b - q) * np.float32(MAP_RATE)
        mixed = np.clip(mixed, 1e-5, 1 - 1e-5)
        logs = np.log(np.where(bits > 0, mixed, 1 - mixed).prod(axis=2, dtype=np.float64))
        inside = np.arange(i.shape[1]) < here[:, None]
        cost[i[inside]] = logs[inside]
        t += len(here)
    return cost


def phrase_scores(log: np.ndarray, code: np.ndarray, owner: np.ndarray, texts: int, rates: np.ndarray) -> np.ndarray:
    """log10 probability of each text. ``log``: of each phrase as words; ``code``: what predicts it (see ``follow``);
    ``owner``: its text, ascending; ``rates``: of the gates."""
    out = np.bincount(owner, np.where(code == 0, log, 0.0), minlength=texts)
    told = np.flatnonzero(code)
    per = np.bincount(owner[told], minlength=texts)
    at = np.cumsum(per) - per
    order = np.argsort(-per, kind="stable")
    first = at[order]
    active = np.searchsorted(-per[order], -np.arange(1, (int(per.max()) if texts else 0) + 1), "right")
    odds = np.log(rates / (1 - rates))
    bias = np.zeros(texts)
    for t, lanes in enumerate(active):
        i = told[first[:lanes] + t]
        hit = (code[i] - 1) & 1
        p = 1 / (1 + np.exp(-np.clip(odds[(code[i] - 1) >> 1] + bias[:lanes], -9, 9)))
        words = log[i]
        out[order[:lanes]] += np.where(hit == 1, np.log10(p + (1 - p) * 10.0 ** words), np.log10(1 - p) + words)
        bias[:lanes] = np.clip(bias[:lanes] + BIAS_RATE * (hit - p), -BIAS, BIAS)
    return out


# second scan -------------------------------------------------------------------------------------------------

def _code(parts: int, sent):
    """Texts -> per piece: keys and sizes of the texts; words of the tokens; lengths, logarithms and pairs of the phrases."""
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, room, _ = sent.value
        model = Model(cells)
        number = 0
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            learn = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for first, data, offsets in W.texts(batch, "text"):
                piece, number = (TaskContext.get().partitionId() << 32) | number, number + 1
                hashes, at = tokens(data, offsets)
                n = len(at) - 1
                classes = class_of(hashes)
                log = token_lengths(model, classes, at) / np.log(10) - room[classes]
                words, which = np.unique(hashes, return_inverse=True)
                starts, pairs, has = phrases(hashes, at)
                pairs, pair = np.unique(pairs[has], return_inverse=True)
                own = np.zeros(len(starts), np.uint32)  # 0: no context
                own[has] = pair + 1
                per_text = np.diff(np.searchsorted(starts, at))
                texts = np.concatenate([keys[first:first + n], np.diff(at), per_text, learn[first:first + n], [len(words), len(pairs)]])
                yield _rows([(P.home(piece, parts), ENTRIES, piece, n, texts.astype(np.int64).tobytes(), planes(which.astype(np.uint32)),
                              planes(np.diff(starts, append=len(hashes)).astype(np.uint32)) + planes(own)
                              + np.add.reduceat(log, starts).tobytes())])

    return code


def _total(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """The pieces of one part with their word counts and phrase codes -> sums per text."""
    _, _, rates = sent.value
    entries, counts, codes = {}, {}, {}
    for batch in batches:
        for _, kind, piece, place, a, b, c in zip(*(x.to_pylist() for x in batch.columns)):
            if kind == ENTRIES:
                entries[piece] = place, a, b, c
            elif kind == PHRASE_CODES:
                codes.setdefault(piece, {})[place] = a, b
            else:
                n = int.from_bytes(b, "little")
                counts.setdefault(piece, {})[place] = np.frombuffer(a, np.uint32 if len(a) == 4 * n else np.uint64)
    for piece, (n, a, b, c) in entries.items():
        *texts, (n_words, n_pairs) = np.split(np.frombuffer(a, np.int64), n * np.arange(1, 5))
        key, n_tokens, per_text, learn = texts
        found = counts.get(piece, {})
        total = np.concatenate([found[k] for k in sorted(found)] or [np.empty(0, np.uint32)]).astype(np.int64)
        found = codes.get(piece, {})
        plain, left = (np.frombuffer(b"".join(found[k][x] for k in sorted(found)), np.uint8) for x in (0, 1))
        if (len(total), len(plain)) != (n_words, n_pairs):
            raise ValueError(f"piece {piece} has {n_words} words and {n_pairs} pairs, and {len(total)} and {len(plain)} in the first scan: "
                             "the input's partitions changed")
        word = unplaned(b, np.uint32)
        m = len(c) // 16
        lens, own = unplaned(c[:4 * m], np.uint32).astype(np.int64), unplaned(c[4 * m:8 * m], np.uint32)
        firsts = np.cumsum(n_tokens) - n_tokens
        logs = np.log10(total + 1.0)[word]
        log = np.frombuffer(c, np.float64, m, 8 * m) + np.add.reduceat(logs, np.cumsum(lens) - lens)
        owner = np.repeat(np.arange(n), per_text)
        none = np.zeros(1, np.uint8)
        code = np.where(learn[owner] > 0, np.append(none, left)[own], np.append(none, plain)[own]).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (key, n_tokens, np.add.reduceat((total > 0).astype(np.int64)[word], firsts), np.add.reduceat(logs, firsts),
                                   phrase_scores(log, code, owner, n, rates))],
            ["key", "n_tokens", "n_known", "plain", "score"])


def lm_score(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for rows doc_id, text; rows with
    ``held_out`` are not learned from."""
    spark = docs.sparkSession
    parts = P.parts_of(spark)
    base = docs.select("doc_id", "text").withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    key = F.xxhash64("doc_id", "text")
    folder = new_folder(spark, "counts")
    sent = base.select((~F.col("held_out")).alias("learn"), "text").mapInArrow(_gather(parts), PACKED)
    P.by_part(sent, parts).mapInArrow(lambda it: _add(it, parts), PACKED).write.partitionBy("kind").parquet(folder)
    stored = spark.read.schema(PACKED).parquet(folder)
    cells = np.zeros(CELLS, np.int64)
    slices = np.array_split(cells, SLICES)  # views: a table of fixed size
    for r in stored.filter(F.col("kind") == CONTEXTS).collect():
        slices[r["place"]][:] = np.frombuffer(r["a"], np.int64)
    tokens_, words_ = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in stored.filter(F.col("kind") == CLASS_SIZES).toLocalIterator():  # a row of fixed size per part
        tokens_ += np.frombuffer(r["a"], np.int64)
        words_ += np.frombuffer(r["b"], np.int64)
    n, v = int(tokens_.sum()), int(words_.sum())
    told = np.zeros(1 + 2 * GATES, np.int64)
    for r in stored.filter(F.col("kind") == RATES).toLocalIterator():  # a row of fixed size per part
        told += np.frombuffer(r["a"], np.int64)
    miss, hit = told[1::2], told[2::2]
    model = spark.sparkContext.broadcast((cells, np.log10(tokens_ + words_ + 1.0), (hit + 0.4) / (hit + miss + 0.8)))
    coded = base.select(key.alias("key"), (~F.col("held_out")).alias("learn"), "text").mapInArrow(_code(parts, model), PACKED)
    counted = stored.filter(F.col("kind").isin(WORD_COUNTS, PHRASE_CODES))
    sums = (P.by_part(coded.unionByName(counted), parts)
            .mapInArrow(lambda it: _total(it, model), "key long, n_tokens long, n_known long, plain double, score double"))
    # Rows that repeat have the same key and the same sums.
    sums = sums.groupBy("key").agg(*[F.first(c).alias(c) for c in ("n_tokens", "n_known", "plain", "score")])
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    rows = base.select(key.alias("key"), "doc_id", "held_out", size.alias("_bytes"))
    return rows.join(sums, "key").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        (F.col("plain") - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1.0)))).alias("base_score"), "score",
        (-F.col("score") * F.lit(float(np.log2(10))) / F.when(F.col("_bytes") > 0, F.col("_bytes"))).alias("bits_per_byte"))


@register("op6_lm_score")
def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return lm_score(docs, held_out)
