"""Ordered helpers under skew: one group holds most rows and spans many slices."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from texloom.operators import ordered
from texloom.operators import tokens as TK


def rows(n_hot=3000, n_small=40, seed=7):
    rnd = random.Random(seed)
    out = []
    for t in range(n_hot):  # the hot group
        out.append((0, t, rnd.choice("aab"), f"h{t}"))
    for g in range(1, n_small + 1):
        for t in range(rnd.randint(1, 6)):
            out.append((g, t, rnd.choice("ab"), f"s{g}.{t}"))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "g long, t long, v string, text string")


def test_hot_group_spans_slices(spark):
    s = ordered.sliced(frame(spark, rows()), ["g"], ["t"], n=8)
    slices = s.where("g = 0").select(ordered.SLICE).distinct().count()
    assert slices >= 4


def test_running_sum_and_row_number(spark):
    data = rows()
    df = frame(spark, data).withColumn("w", F.length("text"))
    got = {(r.g, r.t): (r.rs, r.rn) for r in
           ordered.row_number(ordered.running_sum(df, ["g"], ["t"], "w", "rs", n=8), ["g"], ["t"], "rn", n=8).collect()}
    exp, acc = {}, {}
    for g, t, _, text in sorted(data):
        s, n = acc.get(g, (0, 0))
        s, n = s + len(text), n + 1
        acc[g] = (s, n)
        exp[(g, t)] = (s, n)
    assert got == exp


def test_previous_value_and_change_runs(spark):
    data = rows()
    df = frame(spark, data)
    prev = {(r.g, r.t): r.p for r in ordered.previous_value(df, ["g"], ["t"], "v", "p", n=8).collect()}
    runs = {(r.g, r.t): r.run for r in ordered.change_runs(df, ["g"], ["t"], "v", "run", n=8).collect()}
    last, run = {}, {}
    for g, t, v, _ in sorted(data):
        p = last.get(g)
        assert prev[(g, t)] == p
        run[g] = 1 if p is None else run[g] + (p != v)
        assert runs[(g, t)] == run[g]
        last[g] = v


def test_merge_and_dedupe_adjacent(spark):
    data = rows()
    df = frame(spark, data)
    merged = {(r.g, r.run): (r.v, r.first_t, r.n_items, r.text) for r in
              TK.merge_adjacent_text(df, ["g"], "t", "text", "v").collect()}
    exp, cur = {}, {}
    for g, t, v, text in sorted(data):
        c = cur.get(g)
        if c is None or c[1] != v:
            c = [(c[0] + 1) if c else 1, v, t, 0, []]
            cur[g] = c
        c[3] += 1
        c[4].append(text)
        exp[(g, c[0])] = (v, c[2], c[3], " ".join(c[4]))
    assert merged == exp
    kept = sorted((r.g, r.t) for r in TK.dedupe_adjacent_text(df, ["g"], ["t"], "v").collect())
    want, last = [], {}
    for g, t, v, _ in sorted(data):
        if last.get(g) != v:
            want.append((g, t))
        last[g] = v
    assert kept == want


def test_concat_in_order_chunks(spark):
    df = spark.createDataFrame([(1, i, str(i)) for i in range(50)], "k long, pos long, s string")
    r = ordered.concat_in_order(df, ["k"], "pos", "s", ",", "out", chunk=7, count_out="n").first()
    assert r.out == ",".join(str(i) for i in range(50)) and r.n == 50 and r.pos == 0

GROUPS = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 60), st.sampled_from("ab")), min_size=1, max_size=80,
                  unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=8, deadline=None)
@given(GROUPS)
def test_random_groups_match_python(spark, data):
    df = spark.createDataFrame([(g, t, v, f"{g}.{t}") for g, t, v in data], "g long, t long, v string, text string")
    sums = {(r.g, r.t): r.rs for r in ordered.running_sum(df, ["g"], ["t"], F.length("text"), "rs", n=3).collect()}
    runs = {(r.g, r.t): r.run for r in ordered.change_runs(df, ["g"], ["t"], "v", "run", n=3).collect()}
    acc, last, run = {}, {}, {}
    for g, t, v in sorted(data):
        acc[g] = acc.get(g, 0) + len(f"{g}.{t}")
        assert sums[(g, t)] == acc[g]
        run[g] = 1 if g not in last else run[g] + (last[g] != v)
        assert runs[(g, t)] == run[g]
        last[g] = v


def test_a_long_run_is_many_bounded_pieces(spark):
    """One run of 200,000 turns: its pieces hold all texts in order, and none is over the bound."""
    n, bound = 200_000, 64_000
    df = spark.range(n).selectExpr("1L AS g", "id AS t", "concat('t', id) AS text", "'a' AS v").repartition(16)
    rows = sorted(TK.merge_adjacent_text(df, ["g"], "t", "text", "v", piece_bytes=bound).collect(), key=lambda r: r.piece)
    assert {r.run for r in rows} == {1} and len(rows) > 20
    assert max(len(r.text) for r in rows) <= bound + 10 and sum(r.n_items for r in rows) == n
    assert " ".join(r.text for r in rows) == " ".join(f"t{k}" for k in range(n))
    assert [r.first_t for r in rows] == sorted(r.first_t for r in rows)


def test_a_run_is_one_row_in_the_query(spark, scratch):
    """Long runs stay whole, across chunks without texts as well; without any text a run's value is empty."""
    from texloom.plans.queries_interleave import merge_adjacent_text
    big = "x" * 5000
    data = [(1, t, "user", big + str(t)) for t in range(4)] + [(1, 4, "assistant", None), (1, 5, "user", "a")]
    data += [(2, t, "assistant", "w" if t in (0, 9000) else None) for t in range(0, 9001, 500)]
    spark.createDataFrame(data, "conv_id long, turn long, role string, text string").write.parquet(f"{scratch}/conversations.parquet")
    got = sorted(map(tuple, merge_adjacent_text(spark, scratch).collect()))
    assert got == [(1, 1, "prompt", 0, 4, " ".join(big + str(t) for t in range(4))), (1, 2, "response", 4, 1, ""),
                   (1, 3, "prompt", 5, 1, "a"), (2, 1, "response", 0, 19, "w w")]
