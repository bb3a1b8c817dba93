from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def lit_re(pattern: str) -> Column:
    """A regex as a literal column (some functions read a bare str as a column name)."""
    return F.lit(pattern)


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and hand it to ``fn`` (a one-element ``transform``).

    Catalyst inlines a column defined by ``withColumn`` at every place it is
    used; used inside a lambda it would be recomputed per element. A lambda
    variable is evaluated once, so each stage below binds its input this way.
    """
    return F.element_at(F.transform(F.array(value), fn), 1)


def running_sums(numbers: Column, block: int = 64, levels: int = 2) -> Column:
    """Sum of an array's integers up to and with each (not of an empty array; ``numbers`` should be a lambda variable).

    An array grows by copying, so it grows within blocks only: a block's sums start from those of the blocks before
    it, which are summed the same way one level up."""
    def within(part: Column, start: Column) -> Column:
        sums = F.aggregate(part, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
        return let(sums, lambda a: F.slice(a, F.lit(2), F.size(a)))

    if not levels:
        return within(numbers, F.lit(0))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / block).cast("int")),
                         lambda b: F.slice(numbers, b * block + 1, F.lit(block)))

    def joined(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda acc, x: acc + x))
        return let(totals, lambda t: let(running_sums(t, block, levels - 1), lambda upto: F.flatten(F.transform(
            parts, lambda p, i: within(p, F.when(i == 0, F.lit(0)).otherwise(F.element_at(upto, F.greatest(i, F.lit(1)))))))))

    return let(blocks, joined)
