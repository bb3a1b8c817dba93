from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np

from texloom.llm import _words as W
from texloom.llm import lm_score as L

from .helpers import docs_table, words, written


def _base(rows):
    """Counts and base scores by hand."""
    sets = [words(t) + [None] for _, t in rows]
    held = [zlib.crc32(str(i if i is not None else "").encode()) % 7 == 2 for i, _ in rows]
    c = Counter(w for s, h in zip(sets, held) if not h for w in s)
    n, v = sum(c.values()), len(c)
    return [(i, h, len(s), sum(c[w] > 0 for w in s), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in s))
            for (i, _), s, h in zip(rows, sets, held)]


def _run(spark, scratch, rows):
    sf = written(spark, scratch, {"documents": docs_table(spark, rows)})
    return L.op6_lm_score(spark, sf).collect()


def _check(got, rows):
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(_base(rows), key=key), strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 * max(1, abs(b[5]))
        assert math.isfinite(a[6]) and a[6] < 0


def _prose(seed, n=300):
    r = random.Random(seed)
    topics = [[f"{t}{k}" for k in range(40)] for t in "abcd"]
    return [(k, " ".join(r.choice(topics[k % 4]) for _ in range(r.randint(20, 120)))) for k in range(n)]


def test_counts_and_base_scores(spark, scratch):
    rows = _prose(1, 120) + [(500, None), (501, ""), (None, "A a a"), (None, "A a a"), (502, "w " * 100_000), (3, "a1 a2"), (3, "a1 a2")]
    _check(_run(spark, scratch, rows), rows)


def test_small_pieces_give_the_same(spark, scratch, monkeypatch):
    rows = _prose(2, 60)
    want = {r.doc_id: r.score for r in _run(spark, f"{scratch}/a", rows)}
    monkeypatch.setattr(W, "CHUNK_BYTES", 1500)
    base = spark.read.parquet(f"{scratch}/a/documents.parquet")
    from pyspark.sql import functions as F
    shuffled = base.repartition(7, "doc_id")
    got = {r.doc_id: r.score for r in L.lm_score(shuffled, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 * abs(want[k]) for k in want)


def test_held_out_texts_cost_less_than_the_base(spark, scratch):
    got = [r for r in _run(spark, scratch, _prose(3, 600)) if r.held_out]
    assert len(got) > 40
    assert sum(r.score for r in got) > 0.93 * sum(r.base_score for r in got)
    assert all(abs(r.bits_per_byte) < 8 for r in got)


def test_empty_table_and_other_columns(spark, scratch):
    assert _run(spark, f"{scratch}/a", []) == []
    from pyspark.sql import functions as F
    docs = docs_table(spark, [(1, "a b")]).withColumn("score", F.lit("x")).withColumn("held_out", F.lit(7))
    assert len(L.lm_score(docs, F.lit(False)).collect()) == 1
    only = L.lm_score(docs, F.lit(True)).collect()[0]
    assert (only.train_tokens, only.n_known) == (0, 0) and only.base_score == 0.0


def test_class_codes_are_probabilities():
    """Over all classes of a last token the model's probabilities add up to 1."""
    draw = np.random.default_rng(7)
    cells = np.zeros(L.CELLS, np.int64)
    cells[draw.integers(0, L.CELLS, 200_000)] += draw.integers(1, 50, 200_000)
    model = L.Model(cells)
    head = draw.integers(0, L.CLASSES, 300)
    at = np.concatenate([[0], np.cumsum(np.full(L.CLASSES, 301))])
    classes = np.concatenate([np.append(head, k) for k in range(L.CLASSES)])
    shared = L.code_lengths(model, head, np.array([0, 300]))[0]
    total = np.exp(L.code_lengths(model, classes, at) - shared).sum()
    assert abs(total - 1) < 1e-3


def test_segments_learn():
    """A text that keeps to one class is coded ever cheaper."""
    model = L.Model(np.zeros(L.CELLS, np.int64))
    short = L.code_lengths(model, np.full(20, 5), np.array([0, 20]))[0] / 20
    long = L.code_lengths(model, np.full(200, 5), np.array([0, 200]))[0] / 200
    assert long > short > L.CLASS_BITS * math.log(0.5) * 1.001


def _follow_by_hand(pairs, n):
    """The two codes of each pair, by the definition."""
    groups = {}
    for j, x in enumerate(pairs):
        groups.setdefault(x >> L.PHRASE_BITS, []).append(j)

    def code(counts, j):
        seen = sum(counts.values())
        if not seen:
            return 0
        best = min(counts, key=lambda k: (-counts[k], k))
        return 1 + 2 * int(L.gate(np.array([seen]), np.array([counts[best]]))[0]) + (best == j)

    out = []
    for j, x in enumerate(pairs):
        counts = {k: n[k] for k in groups[x >> L.PHRASE_BITS]}
        out.append((code(counts, j), code(counts | {j: n[j] - 1}, j) if n[j] else 0))
    return out


def test_predicted_phrases_against_counts():
    draw = np.random.default_rng(11)
    for _ in range(40):
        contexts = draw.integers(0, 12, 50).astype(np.uint64) << np.uint64(L.PHRASE_BITS)
        pairs = np.unique(contexts | draw.integers(0, 6, 50).astype(np.uint64))
        n = draw.integers(0, 4, len(pairs))
        plain, left = L.follow(pairs, n)
        assert list(zip(plain.tolist(), left.tolist())) == _follow_by_hand(pairs.tolist(), n.tolist())


def test_phrase_probabilities():
    """The predicted phrase and all others together have probability 1, after any earlier bits."""
    rates = np.linspace(0.05, 0.95, L.GATES)
    q = np.array([0.5, 0.3, 0.2])
    for g in (0, 7, 15):
        head = [(-1.0, 2 + 2 * g), (-2.0, 1 + 2 * g), (-0.5, 0)]
        base = L.phrase_scores(np.array([x for x, _ in head]), np.array([c for _, c in head]), np.zeros(3, int), 1, rates)[0]
        total = 0
        for k, x in enumerate(np.log10(q)):
            rows = [*head, (x, 1 + 2 * g + (k == 1))]
            total += 10 ** (L.phrase_scores(np.array([x for x, _ in rows]), np.array([c for _, c in rows]), np.zeros(4, int), 1, rates)[0] - base)
        assert abs(total - 1) < 1e-9


def _plain_scores(rows):
    """Scores of (doc_id, text) rows, text by text, with dictionaries of counts."""
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    texts = []
    for _, t in rows:
        data = np.frombuffer((t or "").encode(), np.uint8)
        texts.append(L.tokens(data, np.array([0, len(data)])))
    cells, words, pairs = np.zeros(L.CELLS, np.int64), Counter(), Counter()
    for (hashes, at), h in zip(texts, held):
        if not h:
            words.update(hashes.tolist())
            classes = L.class_of(hashes)
            for ctx in (np.zeros(len(classes), np.int64), *L.context_rows(classes, at)):
                np.add.at(cells, ctx * L.CLASSES + classes, 1)
            _, pair, has = L.phrases(hashes, at)
            pairs.update(pair[has].tolist())
    model = L.Model(cells)
    of = L.class_of(np.array(list(words), np.uint64))
    room = np.bincount(of, list(words.values()), minlength=L.CLASSES) + np.bincount(of, minlength=L.CLASSES) + 1
    for hashes, at in texts:
        _, pair, has = L.phrases(hashes, at)
        for x in pair[has].tolist():
            pairs[x] += 0
    keys = sorted(pairs)
    codes = dict(zip(keys, _follow_by_hand(keys, [pairs[k] for k in keys])))
    hits, told = Counter(), Counter()
    for k in keys:
        if (c := codes[k][1]):
            told[(c - 1) >> 1] += pairs[k]
            hits[(c - 1) >> 1] += pairs[k] * ((c - 1) & 1)
    rates = [(hits[g] + 0.4) / (told[g] + 0.8) for g in range(L.GATES)]
    out = []
    for (hashes, at), h in zip(texts, held):
        classes = L.class_of(hashes)
        each = L.token_lengths(model, classes, at) / math.log(10) - np.log10(room[classes])
        each += [math.log10(words[x] + 1) for x in hashes.tolist()]
        starts, pair, has = L.phrases(hashes, at)
        ends, score, bias = [*starts[1:], len(hashes)], 0.0, 0.0
        for a, b, x, known in zip(starts, ends, pair.tolist(), has):
            q = each[a:b].sum()
            c = codes[x][not h] if known else 0
            if not c:
                score += q
                continue
            rate, hit = rates[(c - 1) >> 1], (c - 1) & 1
            p = 1 / (1 + math.exp(-max(-9, min(9, math.log(rate / (1 - rate)) + bias))))
            score += math.log10((p if hit else 0) + (1 - p) * 10 ** q) if hit else math.log10(1 - p) + q
            bias = max(-L.BIAS, min(L.BIAS, bias + L.BIAS_RATE * (hit - p)))
        out.append(score)
    return out


def test_scores_against_a_plain_scorer(spark, scratch):
    prose = _prose(5, 80)
    rows = prose + [(1000 + k, t) for k, t in prose[:15]] + [(2000, None), (2001, ""), (2002, "a b"), (2003, "w " * 3000), (2004, "w w w w w x")]
    want = {i: x for (i, _), x in zip(rows, _plain_scores(rows))}
    got = {r.doc_id: r.score for r in _run(spark, scratch, rows)}
    assert got.keys() == want.keys()
    for k in want:
        assert abs(got[k] - want[k]) < 1e-5 * max(1, abs(want[k])), k


def test_documents_that_occur_twice_cost_less(spark, scratch):
    """A text whose copy was learned from is told apart from all others, whichever of the two is held out."""
    held = lambda k: zlib.crc32(str(k).encode()) % 7 == 2
    prose = _prose(6, 300)
    rows = prose + [(5000 + k, t) for k, t in prose[:40]]
    got = {r.doc_id: r.bits_per_byte for r in _run(spark, scratch, rows)}
    pairs = [(k, 5000 + k) for k, _ in prose[:40]]
    twice = [got[a] for p in pairs for a, b in (p, p[::-1]) if not held(b)]
    once = [got[k] for k, _ in prose[40:]]
    assert len(twice) > 60 and max(twice) < min(once)
    assert np.median(twice) < 0.3 * np.median(once)


def _lengths_by_hand(model, classes):
    """Logarithms of the classes of one text, a bit at a time: weights and map learn through the whole text."""
    weights, refined, out = {}, {}, []
    one, two = L.context_rows(classes, np.array([0, len(classes)]))
    for c, a, b in zip(classes.tolist(), one.tolist(), two.tolist()):
        node, total = 1, 0.0
        for depth in range(L.CLASS_BITS):
            at = [row * L.CLASSES + node for row in (0, a, b)]
            s = [float(model.odds[x]) for x in at]
            w = weights.setdefault((depth, int(model.seen[at[1]]), int(model.seen[at[2]])), list(L.WEIGHTS))
            z = max(-12.0, min(12.0, sum(x * y for x, y in zip(w, s))))
            p = 1 / (1 + math.exp(-z))
            place = max(0, min(L.PLACES - 1, round(2 * z) + L.PLACES // 2))
            q = refined.get((depth, place), 1 / (1 + math.exp(-(place - L.PLACES // 2) / 2)))
            bit = c >> (L.CLASS_BITS - 1 - depth) & 1
            mixed = max(1e-5, min(1 - 1e-5, (p + q) / 2))
            total += math.log(mixed if bit else 1 - mixed)
            for k in range(3):
                w[k] += L.RATE * (bit - p) * s[k]
            refined[depth, place] = q + (bit - q) * L.MAP_RATE
            node = 2 * node + bit
        out.append(total)
    return out


def test_weights_are_carried_through_a_long_text(monkeypatch):
    """A token far into a text is coded with all that the text has taught: by hand, and cheaper than the first tokens."""
    draw = np.random.default_rng(3)
    cells = np.zeros(L.CELLS, np.int64)
    cells[draw.integers(0, L.CELLS, 300_000)] += draw.integers(1, 30, 300_000)
    model = L.Model(cells)
    texts = [draw.integers(0, 40, n) for n in (900, 1, 300, 700)]
    classes, at = np.concatenate(texts), np.cumsum([0, *map(len, texts)])
    got = L.token_lengths(model, classes, at)
    for k, text in enumerate(texts):
        assert np.allclose(got[at[k]:at[k + 1]], _lengths_by_hand(model, text), rtol=1e-3, atol=1e-2)
    monkeypatch.setattr(L, "AHEAD", 5)
    assert np.array_equal(got, L.token_lengths(model, classes, at))
    same = L.token_lengths(model, np.full(600, 5), np.array([0, 600]))
    assert same[256:300].mean() > same[200:250].mean() > same[:40].mean()
