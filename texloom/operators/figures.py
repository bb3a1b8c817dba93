"""Figure rows from LaTeX documents: one row per ``figure`` environment.

All steps are narrow (no shuffle): a document row becomes its figure rows in
the task that read it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import latex as L
from .assets import asset_name_prefixed, file_keys, file_offsets, resolve_assets
from .rows import explode_pos, first_per_key, let


FIELDS = ("image_ref", "has_image", "caption", "has_caption", "caption_unparsed", "label", "has_label")


def _fields(m, cap) -> list:
    """The figure fields of a marked body and its caption (NULL if there is none that closes)."""
    return [
        L.first_image(m).alias("image_ref"),
        L.has_image(m).alias("has_image"),
        F.coalesce(cap, F.lit("")).alias("caption"),
        cap.isNotNull().alias("has_caption"),
        (cap.isNull() & m.rlike(L.CAPTION_CMD)).alias("caption_unparsed"),
        L.label(m).alias("label"),
        L.has_label(m).alias("has_label"),
    ]


def extract_figures(docs: DataFrame, content: str = "content", keep: tuple[str, ...] | None = None,
                    pos: str = "pos", body: str = "body", strip_comments: bool = True) -> DataFrame:
    """``(keep..., pos, body, <fields>)``: every figure environment, ``pos`` 0-based in document
    order, with its fields (``image_ref`` = first includegraphics or '', ``has_image``,
    ``caption``, ``has_caption``, ``caption_unparsed``, ``label``, ``has_label``).
    ``keep``: the columns that name a file.

    The fields are computed inside the array, before the rows are generated: a later
    filter on them (``require_*``) then cannot be pushed below the generator and
    re-run the regexes. ``%`` comments are no part of a document; they are removed first.
    """
    keep = keep or file_keys(docs)
    text = L.strip_comments(content) if strip_comments else F.col(content)
    arr = F.transform(L.figure_bodies(text), lambda bd, i: let(L.marked(bd), lambda m: let(L.caption_or_null(m), lambda cap: F.struct(
        i.cast("long").alias(pos), bd.alias(body), *_fields(m, cap)))))
    rows = explode_pos(docs, keep, arr, "_i", "_f")
    return rows.select(*keep, *[F.col("_f")[c].alias(c) for c in (pos, body, *FIELDS)])


def figure_facts(docs: DataFrame, content: str = "content") -> DataFrame:
    """The file keys and ``facts``: per figure of the file, in order, ``image_ref`` (first image or '') and ``caption_unparsed``.
    A row per file, without its text or captions."""
    def fact(bd):
        return let(L.marked(bd), lambda m: F.struct(L.first_image(m).alias("image_ref"), (
            L.caption_or_null(m).isNull() & m.rlike(L.CAPTION_CMD)).alias("caption_unparsed")))
    return docs.select(*file_keys(docs), F.transform(L.figure_bodies(L.strip_comments(content)), fact).alias("facts"))


def figure_places(facts: DataFrame, members: DataFrame) -> DataFrame:
    """Of each file ``off`` (figures in earlier files of its paper), ``rank`` (its place in the paper) and ``present``: the
    positions of its figures whose first image is in the archive. From ``figure_facts``; names and numbers only."""
    keys = file_keys(facts)
    refs = require_image(fact_rows(facts)).select(*keys, "pos", "image_ref")
    present = (resolve_assets(refs, members, policy="drop").groupBy(*keys)
               .agg(F.collect_set("pos").alias("present")))
    offsets = file_offsets(facts.select(*keys, F.size("facts").cast("long").alias("n_figs")))
    return offsets.select(*keys, "off", "rank").join(present, keys, "left")


def document_images(docs: DataFrame, content: str = "content", keep=None) -> DataFrame:
    """``(keep..., pos, img_pos, image_ref, out_name, caption, has_caption)``: every image command of every figure,
    distinct in its figure, the first per output name in its document. All inside the document's row."""
    keep = keep or file_keys(docs)

    def images(bd, i):
        return let(L.marked(bd), lambda m: let(L.caption_or_null(m), lambda cap: F.transform(L.all_images(m), lambda img, j: F.struct(
            i.cast("long").alias("pos"), j.cast("long").alias("img_pos"), img.alias("image_ref"),
            asset_name_prefixed("paper_id", img, jpeg=True).alias("out_name"), F.coalesce(cap, F.lit("")).alias("caption"),
            cap.isNotNull().alias("has_caption")))))

    every = F.flatten(F.transform(L.figure_bodies(L.strip_comments(content)), images))
    firsts = let(every, lambda items: first_per_key(items, lambda x, i: x["out_name"]))
    rows = explode_pos(docs, keep, firsts, "_i", "_f")
    return rows.select(*keep, "_f.pos", "_f.img_pos", "_f.image_ref", "_f.out_name", "_f.caption", "_f.has_caption")


def figure_all_images(figs: DataFrame, body: str = "body", out: str = "image_refs") -> DataFrame:
    """Add every image path of the figure (includegraphics, epsfig, epsfbox), duplicates removed."""
    return figs.withColumn(out, let(L.marked(body), L.all_images))


def require_image(figs: DataFrame) -> DataFrame:
    return figs.where(F.col("image_ref") != "")


def require_caption(figs: DataFrame, non_empty: bool = True) -> DataFrame:
    cond = F.col("has_caption")
    if non_empty:
        cond = cond & (F.length("caption") > 0)
    return figs.where(cond)


def fact_rows(facts: DataFrame) -> DataFrame:
    """``figure_facts`` as ``(keys..., pos, image_ref, caption_unparsed)``."""
    keys = file_keys(facts)
    return explode_pos(facts, keys, F.col("facts"), "pos", "_f").select(*keys, "pos", "_f.image_ref", "_f.caption_unparsed")


def caption_errors(figs: DataFrame) -> DataFrame:
    """Figures whose caption has no argument that closes: a row each for the errors table."""
    return (figs.where("caption_unparsed")
            .select(*file_keys(figs), "pos", F.lit("caption").alias("stage"),
                    F.lit("the caption's braces do not close").alias("message")))
