from __future__ import annotations

import random

from pyspark.sql import functions as F

from texloom.llm import decontaminate as D

from .helpers import docs_table


def _bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def _filler(r, n):
    return " ".join(r.choice(["alpha", "beta", "gamma", "delta", "omega", "kappa", "sigma"]) + str(r.choice(["x", "y", "z", "q"])) for _ in range(n))


ITEM = ("Maria drives her old truck from Boston at 45 km every hour, while Peter starts 3 hours later from Boston at 60 km; "
        "after how many hours will Peter reach the truck of the other driver?")


def _found(spark, texts, items, **more):
    out = D.decontaminate(docs_table(spark, [(k, t) for k, t in enumerate(texts)]), _bench(spark, items), **more)
    return {r.doc_id: r for r in out.collect()}


def test_exact_and_reparameterised(spark):
    r = random.Random(1)
    renamed = ITEM.replace("Peter", "Ivan").replace("Boston", "Lima").replace("45", "72").replace("60", "81.5").replace(" km", " miles")
    torn = ITEM.replace("from Boston at 60", "from Denver at 60")  # one name, two values
    half = " ".join(ITEM.split()[:16])
    short = " ".join(ITEM.split()[:9])
    texts = [_filler(r, 50) + ". " + ITEM + " " + _filler(r, 30), _filler(r, 20) + ". " + renamed, _filler(r, 40), half + " " + _filler(r, 9),
             short + " " + _filler(r, 9), ITEM.replace("\n", " ").replace(" ", "\n  ").upper().lower(), None, "", _filler(r, 20000) + ". " + ITEM]
    got = _found(spark, texts + [torn], [(7, ITEM), (8, _filler(random.Random(5), 30))])
    assert [got[k].contaminated for k in range(9)] == [True, True, False, True, False, got[5].contaminated, False, False, True]
    assert got[0].exact and got[8].exact and not got[1].exact
    assert got[0]["items"] == [7] and got[1]["items"] == [7] and got[2]["items"] == []
    # torn slots break the match that spans them
    assert got[9].leaked_tokens < got[0].leaked_tokens


def test_inconsistent_slots_are_no_leak(spark):
    item = "the box has 5 red stones and 5 blue stones and then 7 more of them are put on top by hand"
    ok, wrong = item.replace("5", "11").replace("7", "4"), item.replace("5 red", "11 red").replace("5 blue", "12 blue").replace("7", "4")
    got = _found(spark, [ok, wrong], [(1, item)])
    assert got[0].contaminated and not got[0].exact and not got[1].contaminated


def test_runs_beside_conflicting_slots(spark):
    """What is copied word for word, or exchanged alike, is a leak also where a slot of the same match conflicts."""
    r = random.Random(6)
    item = " ".join([_filler(r, 30), "at 45 and", _filler(r, 30), "at 45 then", _filler(r, 30), "at 45 or", _filler(r, 5)])
    edited = "at 46 or".join(item.rsplit("at 45 or", 1))
    swapped = edited.replace("45", "72")
    torn = ITEM.replace("from Boston at 60", "from Denver at 60")
    merged = ITEM.replace("45", "60")  # two values become one
    renamed = ITEM.replace("Peter", "Ivan").replace("later from Boston", "later from Lima")
    got = _found(spark, [edited, swapped, torn, merged, renamed], [(1, item), (2, ITEM)])
    assert [got[k]["items"] for k in range(5)] == [[1], [1], [2], [2], [2]]
    assert [got[k].exact for k in range(5)] == [True, False, True, False, False]
    assert all(got[k].leaked_tokens >= D.COVER for k in range(5))


def test_capitals_and_runs_of_names(spark):
    """A sentence's first word in mid-sentence, exchanged first names, and values of another number of words."""
    short, first = "What is the capital of that old country", "Tom has 5 apples and eats two of them"
    long = "the train from Boston to the coast leaves at 45 km from here and stops in Lima for very long"
    more = long.replace("Boston", "New York").replace("45 km", "72").replace("Lima", "Santa Fe de Bogota")
    got = _found(spark, ["we were asked, What is the capital of that old country", 'so they said "What is the capital of that old country" again',
                         "look at this. Anna has 9 apples and eats two of them", "and then Mary Ann has 9 apples and eats two of them", more,
                         "what is the capital of that old house", "Anna has 9 pears and eats two of them"],
                 [(1, short), (2, first), (3, long)])
    assert [got[k]["items"] for k in range(7)] == [[1], [1], [2], [2], [3], [], []]
    assert [got[k].exact for k in range(5)] == [True, True, False, False, False]


def test_against_brute_force_windows(spark):
    """Exact passages: a document leaks an item just if it shares COVER consecutive words with it (or the whole of a shorter one)."""
    r = random.Random(3)
    items = [(k, _filler(r, r.choice([4, 6, 9, 20, 40]))) for k in range(30)]
    texts = []
    for _ in range(150):
        t = _filler(r, r.randint(0, 40)).split()
        if r.random() < 0.6:
            w = r.choice(items)[1].split()
            a = r.randint(0, len(w))
            t[r.randint(0, len(t)):0] = w[a:a + r.randint(1, 40)]
        texts.append(" ".join(t))

    def leaks(text, item):
        w, n = item.split(), text.split()
        size = min(len(w), D.COVER)
        return len(w) >= D.LEAST and any(w[a:a + size] == n[b:b + size] for a in range(len(w) - size + 1) for b in range(len(n) - size + 1))

    got = _found(spark, texts, items)
    for k, t in enumerate(texts):
        assert got[k]["items"] == [i for i, x in items if leaks(t, x)], (t, got[k])


def test_pieces_give_the_same(spark, monkeypatch):
    r = random.Random(4)
    items = [(k, _filler(r, 25)) for k in range(40)] + [(5, None), (None, "a b c d e f g h"), (41, "")]
    texts = [items[k][1] + " x " + items[k + 1][1] for k in range(0, 39)]
    want = {k: tuple(v) for k, v in _found(spark, texts, items).items()}
    monkeypatch.setattr(D, "PIECE_BYTES", 700)
    assert {k: tuple(v) for k, v in _found(spark, texts, items).items()} == want
    assert want[3][5] == [3, 4]


def test_odd_tables(spark):
    docs = docs_table(spark, [(1, ITEM), (1, ITEM), (None, None)]).withColumn("Items", F.lit(1)).withColumn("exact", F.lit("e")).withColumn("x y", F.lit(0))
    out = D.decontaminate(docs, _bench(spark, [(1, ITEM), (2, ITEM)]))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "x y", *D.OUT]
    assert sorted(r["items"] for r in out.collect()) == [[], [1, 2], [1, 2]]
    assert [r.contaminated for r in D.decontaminate(docs, _bench(spark, [])).collect()] == [False] * 3
    assert D.decontaminate(docs_table(spark, []), _bench(spark, [(1, ITEM)])).collect() == []
    kept = D.decontaminate(docs, _bench(spark, [(1, ITEM)]), keep_only=True)
    assert kept.schema == docs.schema and kept.count() == 1
