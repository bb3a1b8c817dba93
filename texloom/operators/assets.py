"""Figure files: resolution against archive members, output names, manifests.

Resolution is an equi-join on ``(archive, path)`` (on the paper where a table has no
archives): a reference means a file of its own archive. Paths are normalised on
both sides. Both sides carry only keys and short strings (never file bytes), so the
shuffle is small. With AQE the join becomes a broadcast only after the member side has
been measured under ``spark.sql.adaptive.autoBroadcastJoinThreshold``, else it stays
sort-merge; AQE also splits skewed partitions of the figure side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_path, paper_id_normalize, path_basename, path_stem
from ..session import materialize
from . import ordered


def _unit(*frames: DataFrame) -> str:
    """The column that says which archive a row is from; the paper where archives are not known."""
    return "archive" if all("archive" in f.columns for f in frames) else "paper_id"


def file_keys(df: DataFrame) -> list[str]:
    """The columns that name a file: versions of a paper may hold the same path."""
    return [c for c in ("archive", "paper_id", "tex_path") if c in df.columns]


def _member_keys(members: DataFrame, unit: str, match: str) -> DataFrame:
    m = members.select(F.col(unit).alias("_m_unit"), normalize_path("member_path").alias("_m_path"))
    if match == "root_basename":
        # Lookup of the base name at the archive root only.
        m = m.where(~F.col("_m_path").contains("/"))
    return m


def ref_key(ref: str, match: str) -> Column:
    """The member path that a reference is looked up as."""
    return path_basename(normalize_path(ref)) if match == "root_basename" else normalize_path(ref)


def resolve_assets(figs: DataFrame, members: DataFrame, policy: str = "drop", ref: str = "image_ref",
                   match: str = "path", doc_keys: tuple[str, ...] | None = None,
                   out: str = "resolved") -> DataFrame:
    """Check that each referenced file exists in its archive.

    ``policy``: ``"drop"`` keeps resolved rows only; ``"keep"`` keeps every row and
    adds a boolean ``out``; ``"all_or_nothing"`` drops every row of a document
    that has any unresolved reference. ``match``: ``"path"`` (relative path, normalised)
    or ``"root_basename"`` (base name looked up at the archive root).
    """
    unit = _unit(figs, members)
    m = _member_keys(members, unit, match)
    on = (F.col(unit) == F.col("_m_unit")) & (ref_key(ref, match) == F.col("_m_path"))
    if policy == "drop":
        return figs.join(m, on, "left_semi")
    if policy == "keep":
        return (figs.join(m.distinct(), on, "left").withColumn(out, F.col("_m_path").isNotNull())
                .drop("_m_unit", "_m_path"))
    if policy == "all_or_nothing":
        keys = list(doc_keys or file_keys(figs))
        missing = figs.join(m, on, "left_anti").select(*keys).distinct()
        return figs.join(missing, keys, "left_anti")
    raise ValueError(f"unknown policy {policy!r}")


# Output file-name formats. "{paper id with . as _}_{base name}",
# the same with the extension replaced by ".jpeg", and "{paper id with . as _}_{ordinal}.png".
JPEG_EXT = ".jpeg"
INDEXED_EXT = ".png"


def asset_name_prefixed(paper_id, path, jpeg: bool = False) -> Column:
    """``{id}_{basename}``; with ``jpeg`` the extension becomes ``.jpeg``."""
    pid = paper_id if isinstance(paper_id, Column) else F.col(paper_id)
    name = F.concat(paper_id_normalize(pid), F.lit("_"), path_basename(path))
    return F.concat(path_stem(name), F.lit(JPEG_EXT)) if jpeg else name


def asset_name_indexed(paper_id, index) -> Column:
    """``{id}_{i}.png``."""
    pid = paper_id if isinstance(paper_id, Column) else F.col(paper_id)
    idx = index if isinstance(index, Column) else F.col(index)
    return F.concat(paper_id_normalize(pid), F.lit("_"), idx.cast("string"), F.lit(INDEXED_EXT))


def dedupe_output_images(df: DataFrame, keys: tuple[str, ...] = ("paper_id", "tex_path"), name: str = "out_name",
                         order: tuple[str, ...] = ("pos", "img_pos")) -> DataFrame:
    """Keep the first row (by ``order``) per output name within each document.

    An aggregation (``min`` of a struct led by the order columns) rather than a
    window: it combines map-side before the shuffle.
    """
    others = [c for c in df.columns if c not in (*keys, name)]
    firsts = df.groupBy(*keys, name).agg(F.min(F.struct(*order, *[c for c in others if c not in order])).alias("_r"))
    return firsts.select(*keys, name, *[F.col("_r")[c].alias(c) for c in others])


def file_offsets(counts: DataFrame, key: str = "paper_id") -> DataFrame:
    """For a row per file with its number of figures ``n_figs``: ``off`` (figures in earlier files of its paper) and ``rank``
    (0-based place of the file), files in the order of archive and path. Names and numbers only; one pass for both."""
    files = file_keys(counts)
    return materialize(ordered.running_sums(counts.select(*files, "n_figs"), [key], [c for c in files if c != key],
                                            {"off": "n_figs", "rank": F.lit(1)}, inclusive=False))


def figure_ordinal(figs: DataFrame, out: str = "fig_index", key: str = "paper_id", pos: str = "pos",
                   offsets: DataFrame | None = None) -> DataFrame:
    """0-based ordinal of each figure in its paper, files in the order of archive and path.

    ``figs`` holds all figures of each file, numbered from 0 in ``pos``. The offset of a file comes from a row per
    file (``offsets``, else counted here); no figure text is sorted or stored.
    """
    files = file_keys(figs)
    if offsets is None:
        offsets = file_offsets(figs.groupBy(*files).agg((F.max(pos) + 1).alias("n_figs")), key)
    before = offsets.select(*files, F.col("off").alias("_before"))
    return figs.join(before, files).withColumn(out, F.col("_before") + F.col(pos)).drop("_before")


def frame_manifest(images: DataFrame, keys: tuple[str, ...] = ("paper_id",),
                   order: tuple[str, ...] | None = None, out: str = "frame") -> DataFrame:
    """Frame index of each image in its paper's stack, in reading order."""
    order = list(order or [c for c in file_keys(images) if c not in keys] + ["pos", "img_pos"])
    return (ordered.row_number(images, list(keys), order, "_rn")
            .withColumn(out, F.col("_rn") - 1).drop("_rn"))


def decode_base64_assets(records: DataFrame, field: str = "image", out: str = "image_bytes") -> DataFrame:
    """Records that have ``field`` get its base64 decoding (NULL when not base64)."""
    return (records.where(F.col(field).isNotNull())
            .withColumn(out, F.expr(f"try_to_binary(`{field}`, 'base64')")))
