"""Figure queries: the figure+caption variants over the LaTeX view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import latex as L
from ..functions.text import CLEAN_RULES_FULL, asset_kind, clean_text, rewrite_extension
from ..operators import assets as A
from ..operators import figures as FG
from ..operators.rows import let
from . import fixtures as fx
from .catalog import register
from .sqlkit import caption_sql, clean_sql, file_sql, path_sql, q

# ----------------------------------------------------------------- oracle parts
KEYS = ["archive", "paper_id", "tex_path"]
FIGS_SQL = ("SELECT archive, paper_id, tex_path, " + "unnest(f) AS body, unnest(range(len(f))) AS pos FROM "
            f"(SELECT archive, paper_id, tex_path, regexp_extract_all(content, {q(L.FIGURE_RE2)}, 1, 's') AS f FROM clean_docs) x")
FIELDS_SQL = ("SELECT *, coalesce(cap, '') AS caption, cap IS NOT NULL AS has_caption FROM ("
              f"SELECT archive, paper_id, tex_path, pos, body, {path_sql(f'regexp_extract(body, {q(L.INCLUDEGRAPHICS_RE2)}, 1)')} AS image_ref, "
              f"regexp_matches(body, {q(L.INCLUDEGRAPHICS_RE2)}) AS has_image, {caption_sql('body')} AS cap, "
              f"regexp_extract(body, {q(L.LABEL_RE2)}, 1) AS label, "
              f"regexp_matches(body, {q(L.LABEL_RE2)}) AS has_label FROM figs) fc")


def exists_sql(row: str) -> str:
    """The file that ``row.image_ref`` names is in its archive."""
    return f"EXISTS (SELECT 1 FROM files m WHERE m.archive = {row}.archive AND m.member_path = {file_sql(f'{row}.image_ref')})"


# Ordinals run over a paper's archives and files in the order of their names.
ORDINAL_SQL = "SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY archive, tex_path, pos) - 1 AS fig_index FROM ff"


def _with(select: str, *views: str, ctes: str = "") -> str:
    """Oracle SQL: derived views, the figure CTEs ``figs``/``ff``, extra CTEs, then ``select``."""
    base = fx.with_views("", "tex_docs", *views).rstrip()
    extra = f", {ctes}" if ctes else ""
    return f"{base}, figs AS ({FIGS_SQL}), ff AS ({FIELDS_SQL}){extra} {select}"


def _figures(spark, sf_dir):
    return FG.extract_figures(fx.tex_docs(spark, sf_dir), keep=KEYS)


# ----------------------------------------------------------------- A: pairs
@register("figure_caption_pairs", _with(
    "SELECT archive, paper_id, tex_path, pos, image_ref, caption FROM ff "
    "WHERE image_ref <> '' AND has_caption AND length(caption) > 0"))
def figure_caption_pairs(spark, sf_dir):
    """Figures with an image path and a non-empty caption (variant A, no file step)."""
    figs = FG.require_caption(FG.require_image(_figures(spark, sf_dir)), non_empty=True)
    return figs.select("archive", "paper_id", "tex_path", "pos", "image_ref", "caption")


# ----------------------------------------------------------------- A: with files
@register("figure_records_resolved", _with(
    "SELECT f.archive, f.paper_id, f.tex_path, f.pos, replace(f.paper_id, '.', '_') || '_' || "
    "regexp_extract(f.image_ref, '([^/]*)$', 1) AS image_filename, f.caption FROM ff f "
    "WHERE f.image_ref <> '' AND f.has_caption AND length(f.caption) > 0 "
    f"AND {exists_sql('f')}",
    "members"))
def figure_records_resolved(spark, sf_dir):
    """Variant A with the file step: drop figures whose file is missing, name the copy ``{id}_{basename}``."""
    figs = FG.require_caption(FG.require_image(_figures(spark, sf_dir)), non_empty=True)
    figs = figs.select("archive", "paper_id", "tex_path", "pos", "image_ref", "caption")
    hit = A.resolve_assets(figs, fx.members(spark, sf_dir), policy="drop")
    return hit.select("archive", "paper_id", "tex_path", "pos",
                      A.asset_name_prefixed("paper_id", "image_ref").alias("image_filename"), "caption")


# ----------------------------------------------------------------- E: labeled, keep missing
@register("figure_records_labeled", _with(
    f"SELECT o.paper_id, o.fig_index, CASE WHEN {exists_sql('o')} THEN "
    "replace(o.paper_id, '.', '_') || '_' || cast(o.fig_index AS string) || '.png' END AS image_filename, "
    "o.caption, CASE WHEN o.has_label THEN o.label END AS label "
    f"FROM ({ORDINAL_SQL}) o "
    "WHERE o.has_image AND o.has_caption", "members"))
def figure_records_labeled(spark, sf_dir):
    """Variant E: ordinal over the paper, caption required, label optional, missing file kept as NULL."""
    figs = _figures(spark, sf_dir).select("archive", "paper_id", "tex_path", "pos", "image_ref", "has_image", "caption",
                                          "has_caption", "label", "has_label")
    figs = A.figure_ordinal(figs)  # counts figures later skipped, as the file names do
    figs = figs.where("has_image AND has_caption")
    res = A.resolve_assets(figs, fx.members(spark, sf_dir), policy="keep")
    return res.select(
        "paper_id", "fig_index",
        F.when(F.col("resolved"), A.asset_name_indexed("paper_id", "fig_index")).alias("image_filename"),
        "caption", F.when(F.col("has_label"), F.col("label")).alias("label"))


# ----------------------------------------------------------------- D: image+label+caption
@register("figure_records_d", _with(
    "SELECT o.paper_id, o.fig_index, replace(o.paper_id, '.', '_') || '_' || cast(o.fig_index AS string) || '.png' "
    "AS image, CASE WHEN o.has_label THEN o.label ELSE '' END AS label, "
    "CASE WHEN o.has_caption THEN o.caption ELSE '' END AS caption "
    f"FROM ({ORDINAL_SQL}) o "
    f"WHERE o.image_ref <> '' AND {exists_sql('o')}", "members"))
def figure_records_d(spark, sf_dir):
    """Variant D's image_caption records: file required, label and caption default to ''."""
    figs = _figures(spark, sf_dir).select("archive", "paper_id", "tex_path", "pos", "image_ref", "caption", "has_caption",
                                          "label", "has_label")
    figs = A.figure_ordinal(figs)
    figs = A.resolve_assets(FG.require_image(figs), fx.members(spark, sf_dir), policy="drop")
    return figs.select(
        "paper_id", "fig_index", A.asset_name_indexed("paper_id", "fig_index").alias("image"),
        F.when(F.col("has_label"), F.col("label")).otherwise(F.lit("")).alias("label"),
        F.when(F.col("has_caption"), F.col("caption")).otherwise(F.lit("")).alias("caption"))


# ----------------------------------------------------------------- B: all images of a figure
def _all_images_select() -> str:
    parts = " , ".join(f"regexp_extract_all(body, {q(p)}, 1)" for p in (L.INCLUDEGRAPHICS_RE2, L.EPSFIG_RE2, L.EPSFBOX_RE2))
    # first-occurrence distinct: keep element i when it does not occur in positions < i
    cat = f"list_transform(list_concat({parts}), lambda r: {path_sql('r')})"
    return (f"SELECT archive, paper_id, tex_path, pos, caption, has_caption, "
            f"list_filter({cat}, lambda x, i: x <> '' AND NOT list_contains({cat}[1:i-1], x)) AS imgs FROM ff")


IMGS_SQL = (f"imgs AS ({_all_images_select()}), "
            "img AS (SELECT archive, paper_id, tex_path, pos, caption, has_caption, unnest(imgs) AS image_ref, "
            "unnest(range(len(imgs))) AS img_pos FROM imgs), "
            "named AS (SELECT *, replace(paper_id, '.', '_') || '_' || "
            "regexp_replace(regexp_extract(image_ref, '([^/]*)$', 1), '\\.[^./]*$', '') || '.jpeg' AS out_name FROM img), "
            "firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY archive, tex_path, out_name "
            "ORDER BY pos, img_pos) AS rn FROM named) WHERE rn = 1)")


@register("figure_images_all", _with(
    "SELECT archive, paper_id, tex_path, pos, img_pos, image_ref, out_name, "
    f"CASE WHEN has_caption THEN {clean_sql('caption', CLEAN_RULES_FULL)} END AS caption FROM firsts", ctes=IMGS_SQL))
def figure_images_all(spark, sf_dir):
    """Variant B's figure images: every image command of a figure, distinct, named
    ``{id}_{stem}.jpeg``, first per output name in a document, caption cleaned (NULL when absent)."""
    docs = fx.tex_docs(spark, sf_dir)
    imgs = FG.document_images(docs, keep=KEYS)
    return imgs.select(*KEYS, "pos", "img_pos", "image_ref", "out_name",
                       F.when(F.col("has_caption"), clean_text("caption", "full")).alias("caption"))


# ----------------------------------------------------------------- B: all-or-nothing documents
REFS_SQL = ("refs AS (SELECT archive, paper_id, tex_path, unnest(list_transform(list_concat("
            + " , ".join(f"regexp_extract_all(content, {q(p)}, 1, 's')" for p in (L.INCLUDEGRAPHICS_RE2, L.EPSFIG_RE2, L.EPSFBOX_RE2))
            + f"), lambda r: {path_sql('r')})) AS image_ref FROM clean_docs)")


@register("docs_all_assets_present", _with(
    "SELECT d.archive, d.paper_id, d.tex_path, count(r.image_ref) AS n_refs FROM tex_docs d "
    "LEFT JOIN refs r ON r.archive = d.archive AND r.tex_path = d.tex_path "
    "WHERE NOT EXISTS (SELECT 1 FROM refs r2 WHERE r2.archive = d.archive AND r2.tex_path = d.tex_path "
    f"AND NOT {exists_sql('r2')}) GROUP BY d.archive, d.paper_id, d.tex_path", "members", ctes=REFS_SQL))
def docs_all_assets_present(spark, sf_dir):
    """Variant B's all-or-nothing rule: documents whose every image reference resolves,
    with the number of references. One left join and one aggregation."""
    docs = fx.tex_docs(spark, sf_dir).withColumn("content", L.strip_comments("content"))
    refs = docs.select(*KEYS, F.explode_outer(let(L.marked("content"), L.image_refs)).alias("image_ref"))
    found = A.resolve_assets(refs, fx.members(spark, sf_dir), policy="keep")
    return (found.groupBy(*KEYS)
            .agg(F.count("image_ref").alias("n_refs"), F.bool_and(F.col("image_ref").isNull() | F.col("resolved")).alias("whole"))
            .where("whole").drop("whole"))


# ----------------------------------------------------------------- manifest, links, kinds
@register("frame_manifest", _with(
    "SELECT archive, paper_id, tex_path, pos, img_pos, out_name, "
    "row_number() OVER (PARTITION BY paper_id ORDER BY archive, tex_path, pos, img_pos) - 1 AS frame FROM firsts", ctes=IMGS_SQL))
def frame_manifest(spark, sf_dir):
    """Frames of each paper's image stack, in reading order (variant B's stack, as a table)."""
    imgs = figure_images_all(spark, sf_dir).select("archive", "paper_id", "tex_path", "pos", "img_pos", "out_name")
    return A.frame_manifest(imgs).select("archive", "paper_id", "tex_path", "pos", "img_pos", "out_name", "frame")


@register("rewrite_pdf_links", _with(
    "SELECT archive, paper_id, tex_path, pos, CASE WHEN image_ref LIKE '%.pdf' THEN replace(image_ref, '.pdf', '.png') "
    "ELSE image_ref END AS image_filename FROM ff WHERE has_image"))
def rewrite_pdf_links(spark, sf_dir):
    """Relink ``.pdf`` image names to ``.png`` (every occurrence, case-sensitive suffix test)."""
    figs = _figures(spark, sf_dir).where("has_image")
    return figs.select("archive", "paper_id", "tex_path", "pos", rewrite_extension("image_ref").alias("image_filename"))


@register("asset_kinds", fx.with_views(
    "SELECT archive, paper_id, member_path, CASE WHEN lower(member_path) LIKE '%.pdf' THEN 'pdf' ELSE 'raster' END AS kind "
    "FROM members WHERE member_path NOT LIKE '%.tex'", "members"))
def asset_kinds(spark, sf_dir):
    """Archive image members classified as PDF or raster (case-insensitive suffix)."""
    m = fx.members(spark, sf_dir).where(~F.col("member_path").endswith(".tex"))
    return m.select("archive", "paper_id", "member_path", asset_kind("member_path").alias("kind"))


@register("caption_errors", _with(
    f"SELECT archive, paper_id, tex_path, pos FROM ff WHERE regexp_matches(body, {q(r'\\caption([^a-zA-Z]|$)')}) "
    "AND NOT has_caption"))
def caption_errors(spark, sf_dir):
    """Figures whose caption could not be read (goes to the errors table)."""
    return FG.caption_errors(_figures(spark, sf_dir)).select("archive", "paper_id", "tex_path", "pos")
