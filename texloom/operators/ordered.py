"""Ordered operations within groups that stay balanced when one group is huge.

A plain ``Window.partitionBy(group).orderBy(pos)`` sends a whole group to one
task; a paper or conversation holding a third of all rows would then run in a
single task. These helpers split every group into contiguous, ordered slices
with a range shuffle on ``(group, order)`` (sampled bounds cut a hot group into
many slices), run the window per slice, and repair the slice borders with a
table of the groups that cross a border: at most two per slice, so it is
broadcast with a bound that does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

SLICE = "_slice"


def sliced(df: DataFrame, keys: list[str], order: list[str], n: int | None = None) -> DataFrame:
    """Range-partition on ``keys + order`` and tag each row with its slice id.

    Rows of one group are contiguous in order across consecutive slices. Without
    ``n`` the count starts at ``spark.sql.shuffle.partitions`` and AQE may merge
    small neighbouring slices (merging keeps them contiguous). The result is
    checkpointed: every helper reads it twice (per-row window and
    per-slice totals), and range bounds come from sampling, so two separate
    evaluations above a shuffle could cut slices differently. A checkpoint fixes
    the slice of every row once, and a lost executor re-reads it instead of
    re-running the plan above.
    """
    ranged = df.repartitionByRange(n, *keys, *order) if n else df.repartitionByRange(*keys, *order)
    return materialize(ranged.withColumn(SLICE, F.spark_partition_id()))


def _border_groups(s: DataFrame, keys: list[str]) -> DataFrame:
    """Groups that open or close some slice: at most two per slice.

    Slices hold contiguous ranges of ``(keys, order)``, so only such a group can
    continue from one slice into the next; every other group sits inside one
    slice and needs no repair. The result has at most ``2 * n_slices`` rows
    whatever the data size, which is what makes the broadcasts below safe.
    """
    k = F.struct(*keys)
    ends = s.groupBy(SLICE).agg(F.min(k).alias("lo"), F.max(k).alias("hi"))
    return ends.select(F.explode(F.array("lo", "hi")).alias("k")).select("k.*").distinct()


def _border_rows(s: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``s`` whose group is a border group (broadcast semi-join, bounded side)."""
    return s.join(F.broadcast(_border_groups(s, keys)), keys, "left_semi")


def running_sums(df: DataFrame, keys: list[str], order: list[str], values: dict[str, str | Column],
                 inclusive: bool = True, n: int | None = None) -> DataFrame:
    """Each ``out: value`` = sum of the value over earlier rows of the group (and this row when ``inclusive``); all in one
    pass over the slices."""
    held = {out: f"_v{k}" for k, out in enumerate(values)}
    df = df.select("*", *[(v if isinstance(v, Column) else F.col(v)).cast("long").alias(held[out]) for out, v in values.items()])
    s = sliced(df, keys, order, n)
    upto = Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    local = s.select("*", *[F.coalesce(F.sum(v).over(upto), F.lit(0)).alias(f"{v}_local") for v in held.values()])
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    totals = _border_rows(s, keys).groupBy(*keys, SLICE).agg(*[F.sum(v).alias(f"{v}_tot") for v in held.values()])
    offsets = totals.select(*keys, SLICE, *[F.coalesce(F.sum(f"{v}_tot").over(before), F.lit(0)).alias(f"{v}_off") for v in held.values()])
    joined = local.join(F.broadcast(offsets), [*keys, SLICE], "left")
    kept = [c for c in df.columns if c not in held.values() and c not in values]
    return joined.select(*kept, *[(F.col(f"{v}_local") + F.coalesce(F.col(f"{v}_off"), F.lit(0))).alias(out) for out, v in held.items()])


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str | Column, out: str,
                inclusive: bool = True, n: int | None = None) -> DataFrame:
    """``out`` = sum of ``value`` over earlier rows of the group (and this row when ``inclusive``)."""
    return running_sums(df, keys, order, {out: value}, inclusive, n)


def row_number(df: DataFrame, keys: list[str], order: list[str], out: str, n: int | None = None) -> DataFrame:
    """1-based ordinal within the group (ties broken by slice then by order)."""
    return running_sum(df, keys, order, F.lit(1), out, inclusive=True, n=n)


def previous_value(df: DataFrame, keys: list[str], order: list[str], value: str, out: str,
                   n: int | None = None) -> DataFrame:
    """``lag(value, 1)`` within the group; the first row of a slice reads the last row of the slice before."""
    s = sliced(df, keys, order, n)
    w = Window.partitionBy(*keys, SLICE).orderBy(*order)
    local = s.withColumn("_prev", F.lag(value, 1).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    last = (_border_rows(s, keys).groupBy(*keys, SLICE)
            .agg(F.max_by(F.col(value), F.struct(*order)).alias("_last")))
    carry = last.withColumn("_carry", F.lag("_last", 1).over(Window.partitionBy(*keys).orderBy(SLICE))).drop("_last")
    return (local.join(F.broadcast(carry), [*keys, SLICE], "left")
            .withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_prev")))
            .drop("_prev", "_first", "_carry", SLICE))


def change_runs(df: DataFrame, keys: list[str], order: list[str], value: str, out: str = "run",
                n: int | None = None, before: dict[str, Column] | None = None) -> DataFrame:
    """Run id (1-based) that grows each time ``value`` differs from the row before. ``before``: sums over the group's earlier
    rows, in the same pass.

    One slicing pass: per slice, a window gives the changes inside the slice; a
    table with one row per border group and slice (first value, last value,
    change count) gives the changes at slice borders and the offsets of earlier
    slices.
    """
    before = before or {}
    s = sliced(df.withColumns({f"_v_{k}": v.cast("long") for k, v in before.items()}), keys, order, n)
    w = Window.partitionBy(*keys, SLICE).orderBy(*order)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    prev = F.lag(value, 1).over(w)
    local = (s.withColumn("_chg", F.coalesce((prev != F.col(value)).cast("long"), F.lit(0)))
             .withColumn("_lc", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    edges = (_border_rows(local, keys).groupBy(*keys, SLICE)
             .agg(F.min_by(F.col(value), F.struct(*order)).alias("_fv"),
                  F.max_by(F.col(value), F.struct(*order)).alias("_lv"),
                  F.sum("_chg").alias("_n"), *[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in before]))
    ws = Window.partitionBy(*keys).orderBy(SLICE)
    edges = edges.withColumn("_fc", F.coalesce((F.lag("_lv", 1).over(ws) != F.col("_fv")).cast("long"), F.lit(0)))
    edges = edges.withColumn("_off", F.coalesce(
        F.sum(F.col("_n") + F.col("_fc")).over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    edges = edges.withColumns({f"_o_{k}": F.sum(f"_t_{k}").over(ws.rowsBetween(Window.unboundedPreceding, -1)) for k in before})
    local = local.withColumns({k: F.coalesce(F.sum(f"_v_{k}").over(earlier), F.lit(0)) for k in before})
    sums = {k: F.col(k) + F.coalesce(F.col(f"_o_{k}"), F.lit(0)) for k in before}
    return (local.join(F.broadcast(edges.select(*keys, SLICE, "_fc", "_off", *[f"_o_{k}" for k in before])), [*keys, SLICE], "left")
            .withColumns(sums).drop(*[f"_o_{k}" for k in before], *[f"_v_{k}" for k in before])
            .withColumn(out, F.lit(1) + F.coalesce(F.col("_off"), F.lit(0)) + F.coalesce(F.col("_fc"), F.lit(0))
                        + F.col("_lc"))
            .drop("_chg", "_lc", "_fc", "_off", SLICE))


def run_ids(df: DataFrame, keys: list[str], order: list[str], breaks: Column, out: str,
            n: int | None = None) -> DataFrame:
    """Gaps and islands: rows between two break rows share a run id (the count of breaks so far)."""
    return running_sum(df, keys, order, breaks.cast("int"), out, inclusive=True, n=n)


def concat_in_order(df: DataFrame, keys: list[str], order: str, text: str, sep: str, out: str,
                    chunk: int = 4096, count_out: str | None = None, whole: bool = False) -> DataFrame:
    """Join ``text`` of each group in ``order`` with ``sep``, pre-joined in chunks (``whole``: not, the groups are small).

    The first aggregation joins chunks of ``chunk`` consecutive positions with a
    partial (map-side) pass, so the final shuffle moves one row per chunk, not
    one per item. ``order`` must be an integer position.
    """
    if whole:
        rows = F.sort_array(F.collect_list(F.struct(F.col(order), F.col(text))))
        count = [F.count(F.lit(1)).alias(count_out)] if count_out else []
        return df.groupBy(*keys).agg(F.min(order).alias(order), F.array_join(F.transform(rows, lambda x: x[text]), sep).alias(out), *count)
    part = (df.withColumn("_chunk", F.floor(F.col(order) / chunk))
            .groupBy(*keys, "_chunk")
            .agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_cnt"),
                 F.when(F.count(text) > 0, F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order), F.col(text)))),
                                                                    lambda x: x[text]), sep)).alias("_piece")))
    aggs = [F.min("_first").alias(order),
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_chunk", "_piece"))),
                                     lambda x: x["_piece"]), sep).alias(out)]
    if count_out:
        aggs.append(F.sum("_cnt").alias(count_out))
    return part.groupBy(*keys).agg(*aggs)
