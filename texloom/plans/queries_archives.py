"""Archive queries: members, errors, decoded ``.tex``, the figure plan from archives,
incremental ingestion, input listing."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from ..session import materialize
from ..sources import archives as S
from ..streaming.ingest import ingest_archives
from . import archive_fixture as AF
from . import fixtures as fx
from . import variants as V
from .catalog import register
from .queries_figures import FIELDS_SQL, FIGS_SQL, exists_sql
from .sqlkit import file_sql

DOCS_SQL = fx.TEX_DOCS_SQL


def _members(spark, sf_dir):
    return S.with_paper_id(S.expand_archive(AF.packed_archives(spark, sf_dir)))


def _members_once(spark, sf_dir):
    """Members for the errors, which read them twice (archives, then ``.tex`` files): expanded once, with the bytes of ``.tex`` files only."""
    return V.expand_members(AF.packed_archives(spark, sf_dir), keep_content=(".tex",))


@register("archive_members", (
    f"WITH d AS ({DOCS_SQL}), f AS (SELECT archive, doc_id, tex_path AS member_path, strlen(content) + "
    f"CASE WHEN {AF.BAD_UTF8} THEN 1 ELSE 0 END AS length FROM d "
    + "".join(f"UNION ALL SELECT archive, doc_id, {file_sql(p)}, 4 + strlen({p}) FROM d WHERE {c} " for c, p in AF.DOC_FILES)
    + f") SELECT archive, member_path, length FROM f WHERE NOT ({AF.BROKEN_TAR})"))
def archive_members(spark, sf_dir):
    """Every archive expanded into its member files (path and size)."""
    m = S.expand_archive(AF.packed_archives(spark, sf_dir))
    return m.where(F.col("error").isNull()).select("archive", "member_path", "length")


@register("archive_errors", (
    f"WITH d AS ({DOCS_SQL}) SELECT paper_id, 'expand' AS stage, archive AS path FROM d WHERE {AF.BROKEN_TAR} "
    f"UNION ALL SELECT paper_id, 'decode', archive || '!' || tex_path FROM d WHERE {AF.BAD_UTF8}"))
def archive_errors(spark, sf_dir):
    """The errors table: archives that are not tars and ``.tex`` files that are not UTF-8."""
    m = _members_once(spark, sf_dir)
    return S.errors_of(m, S.read_tex(m)).select("paper_id", "stage", "path")


@register("failed_archives", f"WITH d AS ({DOCS_SQL}) SELECT archive FROM d WHERE {AF.BROKEN_TAR}")
def failed_archives(spark, sf_dir):
    """Distinct archives that could not be opened."""
    m = _members_once(spark, sf_dir)
    return S.failed_archives(S.errors_of(m, S.read_tex(m)))


@register("archive_tex", (
    f"WITH d AS ({DOCS_SQL}) SELECT paper_id, archive, tex_path, content FROM d "
    f"WHERE NOT ({AF.BROKEN_TAR}) AND NOT ({AF.BAD_UTF8})"))
def archive_tex(spark, sf_dir):
    """``.tex`` members decoded (strict UTF-8, universal newlines); undecodable ones excluded."""
    return S.read_tex(_members(spark, sf_dir)).where(F.col("content").isNotNull())


PAIRS_FROM_ARCHIVES_SQL = (
    f"WITH tex_docs AS (SELECT * FROM ({fx.TEX_DOCS_SQL}) t WHERE NOT ({AF.BROKEN_TAR}) AND NOT ({AF.BAD_UTF8})), "
    f"clean_docs AS ({fx.CLEAN_DOCS_SQL}), members AS ({fx.MEMBERS_SQL}), files AS ({fx.FILES_SQL}), figs AS ({FIGS_SQL}), ff AS ({FIELDS_SQL}) "
    "SELECT f.paper_id, f.tex_path, f.pos, replace(f.paper_id, '.', '_') || '_' || "
    "regexp_extract(f.image_ref, '([^/]*)$', 1) AS image_filename, f.caption FROM ff f "
    f"WHERE f.image_ref <> '' AND f.has_caption AND length(f.caption) > 0 AND {exists_sql('f')}")


@register("archive_figure_pairs", PAIRS_FROM_ARCHIVES_SQL)
def archive_figure_pairs(spark, sf_dir):
    """Variant A end to end from archives: expand, decode, figures, captions, file check, names."""
    members = V.expand_members(AF.packed_archives(spark, sf_dir))
    return V.figure_caption_records(members).select("paper_id", "tex_path", "pos", "image_filename", "caption")


# Archives that are replaced between the runs: first another file under their path.
REPLACED = "substr(path, 19, 1) IN ('1', '4', '6')"  # the last digit of the paper


@register("ingest_incremental", PAIRS_FROM_ARCHIVES_SQL)
def ingest_incremental_query(spark, sf_dir):
    """The archive plan as an available-now stream, run twice: v1 archives first, some of them in an older state; then these are replaced
    and the v2 archives added. The second run takes the new and the replaced ones, and a replaced archive's rows are superseded."""
    root = AF.shared_scratch(spark, "ingest")
    src, out, ckpt = f"{root}/in", f"{root}/out", f"{root}/checkpoint"

    def process(members):
        figures = materialize(V.document_figures(members).drop("body"))
        return {"figures": V.figure_caption_records(members, figures=figures).select("archive", "paper_id", "tex_path", "pos", "image_filename", "caption"),
                "errors": V.errors_table(members, figures)}

    v1 = F.col("path").contains("v1")
    older = F.coalesce(F.expr(REPLACED), F.lit(False))
    replaced = _listing(spark, sf_dir).where(v1 & older)
    one = replaced.agg(F.min("path")).first()[0]
    AF.write_archive_files(AF.packed_archives(spark, sf_dir, v1 & ~older), src)
    if one is not None:
        some = AF.packed_archives(spark, sf_dir, F.col("path") == one).select("content").first()  # a small archive that is not theirs
        AF.write_archive_files(replaced.withColumn("content", F.lit(bytes(some.content))), src)
    ingest_archives(spark, src, out, ckpt, process, n_buckets=8)
    time.sleep(1.1)  # a modification time of its own
    AF.write_archive_files(AF.packed_archives(spark, sf_dir, ~v1 | older), src)
    ingest_archives(spark, src, out, ckpt, process, n_buckets=8)
    return V.read_output(spark, out, "figures").select("paper_id", "tex_path", "pos", "image_filename", "caption")


def _listing(spark, sf_dir):
    """Names of the view's archives; no content."""
    return fx._base(spark, sf_dir).select(F.col("archive").alias("path"))


@register("count_inputs", "SELECT count(*) AS n_inputs FROM documents")
def count_inputs(spark, sf_dir):
    """Number of listed input archives."""
    return _listing(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_inputs"))


@register("limit_inputs", f"SELECT archive AS path FROM ({fx.BASE_SQL}) d ORDER BY path LIMIT 500")
def limit_inputs(spark, sf_dir):
    """The first 500 input archives by path (the reference's listing cap, made deterministic)."""
    return S.limit_inputs(_listing(spark, sf_dir), 500)
