"""Mixing sources to target weights by a min-cost flow over membership patterns.

A document belongs to one or more sources. Documents are aggregated by their membership pattern; the flow
network has one node per pattern and per source. A pattern offers its words ``max_repeat`` times, the r-th
copy at cost ``(r - 1) ** 2`` (convex, so first copies go first), to each of its sources; a source takes its
target. The flow of a pattern says how many whole copies all of its documents get and how many words more;
those are taken by documents in a seeded order, whole documents while they fit; what then is missing or too much is evened
out by up to ``ROUNDS`` documents whose sizes are closest to it.

The flow network is as large as the number of distinct patterns, not of documents; it is solved on the
driver, and more than ``max_patterns`` patterns are refused with an error (merge small sources first).

The seeded order is split in ``BINS`` hash ranges: words are summed per pattern and range, and only the one
range of a pattern that holds the end of its extra copy is put in order row by row. So a source with a third
of all documents is never gathered.

Defined results: a null text has size 0, a document of size 0 takes 0 words, and a null source is a source
of its own, the last one. A document whose list of sources is null or empty belongs to none: nothing of it is taken, and its
``source_size`` and ``target`` are null. Rows that repeat are documents of their own, and each is taken or left. An empty table gives no
rows.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ._catalog import register
from ._cluster import cut, read_table

#: Hash ranges of a pattern, and how many wide ones they make: a running sum goes over one level at a time.
BINS, STEPS = 1 << 14, 1 << 7
#: Single documents per pattern that may get a copy more or less, to come closer to the target than whole steps of the
#: seeded order do.
ROUNDS = 6
#: The pattern of documents without any source.
NO_SOURCE = "[]"


def word_count(text: Column) -> Column:
    """Number of words, runs of anything but space, tab, LF, VT, FF and CR; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_order(sources: Sequence[str | None]) -> list[str | None]:
    """By code point, null last."""
    return sorted(sources, key=lambda s: (s is None, s or ""))


def target_words(sizes: Mapping[str | None, int], max_repeat: int = 3) -> dict[str | None, float]:
    """Weights 1, 2, 3, repeating, share all words; a target stops at ``max_repeat`` times its source's size
    and the excess is shared again by weight until no target is above."""
    order = source_order(list(sizes))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    fixed: dict[str | None, float] = {}
    total = float(sum(sizes.values()))
    while True:
        free = [s for s in order if s not in fixed]
        rest, shares = total - sum(fixed.values()), sum(weight[s] for s in free)
        share = {s: rest * weight[s] / shares for s in free}
        above = [s for s in free if share[s] > max_repeat * sizes[s]]
        if not above:
            return {s: (fixed | share)[s] for s in order}
        fixed |= {s: float(max_repeat * sizes[s]) for s in above}


def min_cost_flow(supply: Mapping[str, int], members: Mapping[str, Sequence], quota: Mapping, max_repeat: int) -> dict[str, int]:
    """Words that each pattern gives, at least total repetition cost, with as much of the quotas met as can be.

    Successive shortest paths with potentials over source -> pattern (an arc per copy) -> its sources -> sink.
    """
    head: list[list[int]] = []
    to, room, price = [], [], []

    def node() -> int:
        head.append([])
        return len(head) - 1

    def arc(a: int, b: int, capacity: int, cost: int) -> int:
        for x, y, c, p in ((a, b, capacity, cost), (b, a, 0, -cost)):
            head[x].append(len(to))
            to.append(y)
            room.append(c)
            price.append(p)
        return len(to) - 2

    start, sink = node(), node()
    at = {s: node() for s in quota}
    for s, q in quota.items():
        arc(at[s], sink, q, 0)
    copies: dict[str, list[int]] = {}
    for key, words in supply.items():
        p = node()
        copies[key] = [arc(start, p, words, r * r) for r in range(max_repeat)]
        for s in members[key]:
            arc(p, at[s], max_repeat * words, 0)
    potential = [0] * len(head)
    while True:
        far = [None] * len(head)
        came = [-1] * len(head)
        far[start] = 0
        heap = [(0, start)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for e in head[a]:
                if room[e] and (far[to[e]] is None or d + price[e] + potential[a] - potential[to[e]] < far[to[e]]):
                    far[to[e]], came[to[e]] = d + price[e] + potential[a] - potential[to[e]], e
                    heapq.heappush(heap, (far[to[e]], to[e]))
        if far[sink] is None:
            return {key: sum(room[e ^ 1] for e in arcs) for key, arcs in copies.items()}
        potential = [p + f if f is not None else p for p, f in zip(potential, far)]
        path, a = [], sink
        while a != start:
            path.append(came[a])
            a = to[came[a] ^ 1]
        flow = min(room[e] for e in path)
        for e in path:
            room[e] -= flow
            room[e ^ 1] += flow


def mix_plan(patterns: Sequence[tuple[str, int]], max_repeat: int, weights=None) -> tuple[dict, dict, dict]:
    """(words given by pattern, size by source, target by source) for (pattern as JSON list, words) rows."""
    members = {key: json.loads(key) for key, _ in patterns}
    sizes: dict = {}
    for key, words in patterns:
        for s in members[key]:
            sizes[s] = sizes.get(s, 0) + words
    targets = (weights or target_words)(sizes, max_repeat) if sizes else {}
    given = min_cost_flow(dict(patterns), members, {s: round(t) for s, t in targets.items()}, max_repeat)
    return given, sizes, targets


def mix_sources(docs: DataFrame, sources: str, size: str, key: str = "doc_id", seed: int = 17, max_repeat: int = 3,
                max_patterns: int = 20_000) -> DataFrame:
    """Rows of ``docs`` with ``copies``, ``taken`` (copies * size), ``source_size`` and ``target`` (both of the
    first source of the document). ``sources``: an array column of source names; ``size``: words."""
    spark = docs.sparkSession
    drawn = F.xxhash64(F.col(key).cast("string"), F.lit(seed))
    base = cut(docs.drop("copies", "taken", "source_size", "target")
               .withColumn("_pattern", F.coalesce(F.to_json(F.array_sort(F.array_distinct(F.col(sources)))), F.lit(NO_SOURCE)))
               .withColumn("_draw", drawn)
               .withColumn("_bin", F.pmod(F.shiftright("_draw", 20), F.lit(BINS)).cast("int"))
               .withColumn("_row", F.monotonically_increasing_id()))
    sums = base.groupBy("_pattern", "_bin").agg(F.sum(size).alias("_words"))
    rows = sums.groupBy("_pattern").agg(F.sum("_words").alias("w")).orderBy("_pattern").limit(max_patterns + 1).collect()
    if len(rows) > max_patterns:
        raise ValueError(f"over {max_patterns} membership patterns; merge small sources first")
    words = [(r["_pattern"], r["w"]) for r in rows]
    given, sizes, targets = mix_plan(words, max_repeat)
    plan = []
    for pattern, offered in words:
        whole = min(given[pattern] // offered, max_repeat) if offered else 0
        first = source_order(json.loads(pattern))[:1]
        plan.append((pattern, whole, given[pattern] - whole * offered, *([sizes[first[0]], float(targets[first[0]])] if first else [None, None])))
    schema = T.StructType([T.StructField("_pattern", T.StringType()), T.StructField("_whole", T.LongType()),
                           T.StructField("_rest", T.LongType()), T.StructField("source_size", T.LongType()),
                           T.StructField("target", T.DoubleType())])
    planned = spark.createDataFrame(plan, schema)  # a row per pattern: at most max_patterns
    # The range where the rest ends: first among STEPS wide ranges, then in the narrow ones of that wide range.
    narrow = sums.withColumn("_wide", F.floor(F.col("_bin") / F.lit(BINS // STEPS)).cast("int"))
    wide = _crossing(narrow.groupBy("_pattern", "_wide").agg(F.sum("_words").alias("_words"))
                     .join(F.broadcast(planned.select("_pattern", "_rest")), "_pattern").withColumn("_before", F.lit(0)), "_wide")
    edge = _crossing(narrow.join(F.broadcast(planned.select("_pattern", "_rest")), "_pattern")
                     .join(F.broadcast(wide), ["_pattern", "_wide"]), "_bin").withColumnRenamed("_bin", "_edge")  # a row per pattern
    placed = (base.join(F.broadcast(planned), "_pattern")
              .join(F.broadcast(edge), "_pattern", "left"))  # a row per pattern again
    inside = Window.partitionBy("_pattern").orderBy("_draw", "_row").rowsBetween(Window.unboundedPreceding, 0)
    at_edge = (placed.filter(F.col("_bin") == F.col("_edge"))
               .withColumn("_more", F.col("_before") + F.sum(size).over(inside) <= F.col("_rest")))
    others = (placed.filter(F.col("_edge").isNull() | (F.col("_bin") != F.col("_edge")))
              .withColumn("_more", F.coalesce(F.col("_bin") < F.col("_edge"), F.lit(False)) & (F.col("_rest") > 0)))
    drawn_rows = cut(others.unionByName(at_edge)
                     .withColumn("_copies", F.when(F.col("_pattern") == NO_SOURCE, 0).otherwise(F.col("_whole") + F.col("_more").cast("long"))))
    turned = _changes(spark, _closer(drawn_rows, size, {p: given[p] for p, _ in words}, max_repeat))
    mixed = (drawn_rows.join(F.broadcast(turned), "_row", "left")
             .withColumn("copies", F.col("_copies") + F.coalesce("_turn", F.lit(0))))
    return (mixed.withColumn("taken", F.col("copies") * F.col(size))
            .select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("copies", "taken", "source_size", "target")],
                    "source_size", "target", "copies", "taken"))


def _crossing(sums: DataFrame, at: str) -> DataFrame:
    """Per pattern, the first range ``at`` up to which ``_before`` and the words of the ranges exceed ``_rest``, with the words before it."""
    up_to = Window.partitionBy("_pattern").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return (sums.withColumn("_cum", F.col("_before") + F.sum("_words").over(up_to)).filter("_cum > _rest")
            .groupBy("_pattern").agg(F.min_by(F.struct(at, (F.col("_cum") - F.col("_words")).alias("_before")), at).alias("_e"))
            .select("_pattern", f"_e.{at}", "_e._before"))


def _changes(spark: SparkSession, turns: Mapping[int, int]) -> DataFrame:
    """Copies more or less of single rows: ROUNDS rows per pattern at most."""
    return spark.createDataFrame(list(turns.items()), "_row long, _turn long")


def _closer(rows: DataFrame, size: str, given: Mapping[str, int], max_repeat: int) -> dict[int, int]:
    """Copies more or less of single rows that bring the patterns closer to their words: in each round, of each pattern,
    one copy of the row whose size is closest to what is missing or too much."""
    gaps = {r["_pattern"]: given[r["_pattern"]] - r["w"] for r in
            rows.groupBy("_pattern").agg(F.sum(F.col("_copies") * F.col(size)).alias("w")).collect()}
    turns: dict[int, int] = {}
    for _ in range(ROUNDS):
        gaps = {p: g for p, g in gaps.items() if g}
        if not gaps:
            break
        open_ = rows.sparkSession.createDataFrame(list(gaps.items()), "_pattern string, _gap long")
        now = F.col("_copies") + F.coalesce("_turn", F.lit(0))
        can = F.when(F.col("_gap") > 0, now < max_repeat).otherwise(now > 0)
        off = F.abs(F.abs("_gap") - F.col(size))
        best = (rows.join(F.broadcast(open_), "_pattern").join(F.broadcast(_changes(rows.sparkSession, turns)), "_row", "left")
                .filter(can & (F.col(size) > 0) & (off < F.abs("_gap"))).groupBy("_pattern")
                .agg(F.min(F.struct(off.alias("off"), "_draw", "_row", F.col(size).alias("size"))).alias("b")).collect())
        done, gaps = gaps, {}
        for r in best:
            sign = 1 if done[r["_pattern"]] > 0 else -1
            turns[r["b"]["_row"]] = turns.get(r["b"]["_row"], 0) + sign
            gaps[r["_pattern"]] = done[r["_pattern"]] - sign * r["b"]["size"]
    return turns


def mixed_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for a table of documents."""
    sized = docs.select("doc_id", F.array("source").alias("sources"), word_count(F.col("text")).alias("size"))
    return mix_sources(sized, "sources", "size").select("doc_id", "size", "source_size", "target", "taken", "copies")


@register("op4_source_mix")
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_documents(read_table(spark, sf_dir, "documents"))
