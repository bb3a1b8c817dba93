"""Each stage of the pipeline against a plain version of its decision, and the whole of it on odd rows."""
from __future__ import annotations

import random

import corpus_pipeline as P
from texloom.llm import suffix_dedup as S

from .helpers import docs_table, jaccard_components, repeats, words, written

R = random.Random(12)
VOCAB = [f"{a}{b}{c}" for a in "bdgklm" for b in "aeiou" for c in ("n", "r", "st")]


def _text(n):
    return " ".join(R.choice(VOCAB) for _ in range(n))


ITEM = _text(30)
PASSAGE = _text(80)


def _rows():
    rows = [(k, _text(R.randint(30, 90)), R.choice(["a", "b", None])) for k in range(200)]
    rows += [(200 + k, _text(20) + " idiot moron " + _text(20) + " idiot", "a") for k in range(60)]
    rows += [(300 + k, rows[k][1], "b") for k in range(10)]  # exact copies
    rows += [(320 + k, rows[20 + k][1] + " more", "b") for k in range(10)]  # near copies
    rows += [(340 + k, _text(60) + ". " + PASSAGE + " " + _text(60), "a") for k in range(5)]  # a passage that repeats
    rows += [(350 + k, _text(40) + ". " + ITEM + " " + _text(40 + k), "c") for k in range(1)]  # a leak
    return rows + [(400, None, None), (401, "", "a"), (402, "", "a"), (None, "no id but words enough to stay here", "a"), (403, _text(30_000), "c")]


def _folder(spark, scratch, rows):
    labels = [(i, 1, int("idiot" in (t or ""))) for i, t, _ in rows if i is not None]
    return written(spark, scratch, {"documents": docs_table(spark, rows), "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
                                    "benchmark": spark.createDataFrame([(1, ITEM)], "item_id long, text string")})


def test_stages(spark, scratch):
    rows = _rows()
    sf = _folder(spark, scratch, rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    seen = {}
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, sf)
        if k < len(P.STAGES) - 1:
            assert out.columns == names
        out.write.parquet(f"{scratch}/out-{k}")
        before, docs = docs, spark.read.parquet(f"{scratch}/out-{k}")
        seen[name] = before.collect(), docs.collect()
    ids = lambda rs: sorted((r.doc_id for r in rs), key=repr)
    # 1
    was, now = seen["toxicity"]
    assert ids(now) == ids([r for r in was if "idiot" not in (r.text or "")])
    # 2
    was, now = seen["jaccard_join"]
    own = {r[0]: r for r in jaccard_components([(r.doc_id, r.text) for r in was])}
    assert ids(now) == ids([r for r in was if own[r.doc_id][2] == r.doc_id])
    # 3
    was, now = seen["suffix_dedup"]
    data = [(r.text or "").encode() for r in was]
    kept = {r.doc_id: bytes(b for b, g in zip(d, gone) if not g).decode("utf-8", "ignore") for r, d, gone in zip(was, data, repeats(data, S.SIZE))}
    got = {r.doc_id: r for r in now}
    assert {i: (r.text or "") for i, r in got.items()} == {i: t for i, t in kept.items() if t.strip() or i in (400, 401, 402)}
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in now) and got[400].text is None
    assert any(kept[r.doc_id] != r.text for r in was if r.text)
    # 4
    was, now = seen["decontaminate"]
    assert ids(now) == ids([r for r in was if ITEM not in (r.text or "")]) and len(was) == len(now) + 1
    # 5
    was, now = seen["source_mix"]
    assert sorted(((r.doc_id, r.size) for r in now), key=repr) == sorted(((r.doc_id, len(words(r.text))) for r in was), key=repr)
    assert all(0 <= r.taken <= 3 * r.size for r in now)


def test_run_on_repeated_rows_and_empty_tables(spark, scratch):
    text = _text(60)
    rows = [(1, text, "a"), (1, text, "a"), (None, text, "a"), (2, None, None), (2, None, None), (3, "x", "b")]
    sf = _folder(spark, f"{scratch}/a", rows)
    got = P.run(spark, sf).collect()
    assert sorted(((r.doc_id, r.size) for r in got), key=repr) == sorted([(1, 60), (2, 0), (2, 0), (3, 1)], key=repr)
    assert P.run(spark, _folder(spark, f"{scratch}/b", [])).collect() == []
