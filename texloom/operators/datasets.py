"""Dataset-level operators: resume, append, per-paper collections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .assets import file_keys
from .tokens import file_ranks


def resume_anti(new: DataFrame, done: DataFrame, keys=("paper_id",)) -> DataFrame:
    """Rows of ``new`` whose key is not in ``done`` (exact key match, not a prefix)."""
    return new.join(done.select(*keys), list(keys), "left_anti")


def append_union(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing rows followed by new rows (columns matched by name)."""
    return existing.unionByName(new, allowMissingColumns=True)


def append_arrays(old: DataFrame, new: DataFrame, key: str = "paper_id",
                  fields=("texts", "images", "captions")) -> DataFrame:
    """A key's old arrays, then its new ones.

    Without ``part`` one row per key (for keys known to be small). With ``part`` (bounded rows, in order) the new parts
    are numbered on from the key's last old part, so no row grows and none is joined with another."""
    if "part" in old.columns and "part" in new.columns:
        last = old.groupBy(key).agg((F.max("part") + 1).alias("_next"))
        moved = new.join(last, key, "left").withColumn("part", F.col("part") + F.coalesce("_next", F.lit(0))).drop("_next")
        return old.select(key, "part", *fields).unionByName(moved.select(key, "part", *fields))
    o = old.select(key, *[F.col(f).alias(f"_o_{f}") for f in fields])
    n = new.select(key, *[F.col(f).alias(f"_n_{f}") for f in fields])
    j = o.join(n, key, "full_outer")
    empty = F.array().cast("array<string>")
    return j.select(key, *[F.concat(F.coalesce(f"_o_{f}", empty), F.coalesce(f"_n_{f}", empty)).alias(f)
                           for f in fields])


def array_parts(per_file: DataFrame, part_size: int, fields=("texts", "images", "captions")) -> DataFrame:
    """``(paper_id, part, fields...)``: the arrays of a paper's files one after another, in parts of ``part_size`` files
    (ranks over names only); no row holds more."""
    ranked = per_file.join(file_ranks(per_file), file_keys(per_file)).withColumn("part", F.floor(F.col("rank") / part_size).cast("long"))
    rows = F.sort_array(F.collect_list(F.struct("rank", *fields)))

    def field(name):
        return lambda p: p[name]

    return ranked.groupBy("paper_id", "part").agg(*[F.flatten(F.transform(rows, field(f))).alias(f) for f in fields])


# Most items one output row (part) of a per-paper list holds: no group grows with the data.
PART_SIZE = 256


def collect_records(df: DataFrame, keys, order, fields, out: str = "records", part_by: str | None = None,
                    part_size: int = PART_SIZE) -> DataFrame:
    """Records of a group as arrays of structs sorted by ``order``, in bounded parts.

    With ``part_by`` (a 0-based ordinal within the group) the records go to parts
    ``part = part_by div part_size``: one row per ``(keys, part)``, each part at most
    ``part_size`` records, so a huge group is spread over many tasks and rows; the
    group's list is its parts in ``part`` order. Without it, one row per group
    (only for groups known to be small).
    """
    order, fields = list(order), list(fields)
    grp = list(keys)
    if part_by is not None:
        df = df.withColumn("part", F.floor(F.col(part_by) / part_size).cast("long"))
        grp.append("part")
    lst = F.sort_array(F.collect_list(F.struct(*order, *fields)))
    return (df.groupBy(*grp)
            .agg(F.count(F.lit(1)).alias("n_records"),
                 F.transform(lst, lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias(out)))
