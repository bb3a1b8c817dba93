"""Array -> rows without evaluating the array twice.

For ``posexplode``/``explode`` Spark infers a ``size(arr) > 0`` filter and pushes
it below the projection that computes ``arr``, so an expensive array (regex
extraction, the per-document item pipeline) is computed once for the filter and
once for the rows. The ``_outer`` generators get no inferred filter; the single
NULL row they emit for an empty array is dropped after the generator, where the
filter cannot be pushed further down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import let


def explode_pos(df: DataFrame, keep, arr: Column, pos: str = "pos", value: str = "value") -> DataFrame:
    """``(keep..., pos bigint, value)``: one row per element with its 0-based position."""
    return (df.select(*keep, F.posexplode_outer(arr).alias(pos, value))
            .where(F.col(pos).isNotNull())
            .withColumn(pos, F.col(pos).cast("long")))


def explode_values(df: DataFrame, keep, arr: Column, value: str = "value") -> DataFrame:
    """``(keep..., value)``: one row per element (NULL elements kept)."""
    return explode_pos(df, keep, arr, "_pos", value).drop("_pos")


def where_computed(df: DataFrame, keep, value: Column, name: str, cond) -> DataFrame:
    """``(keep..., name)`` for the rows where ``cond(value)`` holds, computing ``value`` once.

    A plain ``withColumn(name, value).where(cond)`` is rewritten by Catalyst into
    a filter evaluated below the projection, which computes ``value`` a second
    time. Here the test runs on a zero-or-one element array and the row is
    produced by a generator, which the filter cannot pass.
    """
    return explode_pos(df, keep, F.filter(F.array(value), cond), "_keep", name).drop("_keep")


def first_per_key(items: Column, key) -> Column:
    """The first element of an array per ``key(element, index)``, in order. Sorts (key, index) pairs, so long arrays
    are not searched once per element. ``items`` should be a lambda variable (see ``let``)."""
    pairs = F.sort_array(F.transform(items, lambda x, i: F.struct(key(x, i).alias("k"), i.alias("i"))))
    firsts = let(pairs, lambda s: F.filter(s, lambda p, n: (n == 0) | ~p["k"].eqNullSafe(
        F.element_at(s, F.greatest(n, F.lit(1)))["k"])))
    return let(F.sort_array(F.transform(firsts, lambda p: p["i"])), lambda at: F.transform(at, lambda i: F.element_at(items, i + 1)))
