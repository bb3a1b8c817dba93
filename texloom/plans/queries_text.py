"""Text queries: cleaning chains, document body, ids, paths, tokens, concatenation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import latex as L
from ..functions import text as T
from ..operators import tokens as TK
from ..operators.rows import explode_pos, let
from . import fixtures as fx
from .catalog import register
from .queries_figures import KEYS
from .sqlkit import clean_sql, path_sql, q

BODY_SQL = ("CASE WHEN strpos(content, '\\begin{document}') > 0 "
            "THEN substr(content, strpos(content, '\\begin{document}')) ELSE content END")


# ----------------------------------------------------------------- cleaning
@register("clean_text_full", fx.with_views(
    f"SELECT archive, paper_id, tex_path, doc_id, {clean_sql('content', T.CLEAN_RULES_FULL)} AS text FROM tex_docs",
    "tex_docs"))
def clean_text_full(spark, sf_dir):
    """The full 17-step LaTeX cleaning chain over every document of the view."""
    return fx.tex_docs(spark, sf_dir).select(*KEYS, "doc_id",
                                             T.clean_text("content", "full").alias("text"))


@register("clean_text_short", fx.with_views(
    f"SELECT archive, paper_id, tex_path, doc_id, {clean_sql('content', T.CLEAN_RULES_SHORT)} AS text FROM tex_docs",
    "tex_docs"))
def clean_text_short(spark, sf_dir):
    """The short 10-step chain."""
    return fx.tex_docs(spark, sf_dir).select(*KEYS, "doc_id",
                                             T.clean_text("content", "short").alias("text"))


@register("clean_text_documents",
          f"SELECT doc_id, {clean_sql('text', T.CLEAN_RULES_FULL)} AS text FROM documents")
def clean_text_documents(spark, sf_dir):
    """The full chain over the raw prose of ``documents``."""
    return fx.documents(spark, sf_dir).select("doc_id", T.clean_text("text", "full").alias("text"))


# ----------------------------------------------------------------- body, ids, paths
@register("document_body", fx.with_views(
    f"SELECT archive, paper_id, tex_path, doc_id, strpos(content, '\\begin{{document}}') > 0 AS has_begin, "
    f"{BODY_SQL} AS body FROM tex_docs", "tex_docs"))
def document_body(spark, sf_dir):
    """Text from ``\\begin{document}`` on (unchanged when absent)."""
    d = fx.tex_docs(spark, sf_dir)
    return d.select(*KEYS, "doc_id",
                    (F.instr("content", T.BEGIN_DOCUMENT) > 0).alias("has_begin"),
                    T.document_body("content").alias("body"))


# Archive names derived from the view: new-style, arXiv-prefixed, old-style, nested.
ARCHIVE_NAME = ("CASE doc_id % 4 WHEN 0 THEN paper_id || '.tar.gz' "
                "WHEN 1 THEN 'arXiv-' || paper_id || 'v1.tar.gz' "
                "WHEN 2 THEN 'src/hep-th' || lpad(cast(doc_id AS string), 7, '0') || '.gz' "
                "ELSE 'raw/' || paper_id || '.gz' END")

@register("paper_ids", fx.with_views(
    "SELECT doc_id, name, regexp_replace(regexp_extract(name, '([^/]*)$', 1), '\\.[^.]*$', '') AS stem, "
    "CASE WHEN regexp_extract(regexp_extract(name, '([^/]*)$', 1), '(?:arXiv-)?(\\d+\\.\\d+)', 1) <> '' "
    "THEN regexp_extract(regexp_extract(name, '([^/]*)$', 1), '(?:arXiv-)?(\\d+\\.\\d+)', 1) "
    "ELSE regexp_replace(regexp_extract(name, '([^/]*)$', 1), '\\.[^.]*$', '') END AS paper_id, "
    "replace(CASE WHEN regexp_extract(regexp_extract(name, '([^/]*)$', 1), '(?:arXiv-)?(\\d+\\.\\d+)', 1) <> '' "
    "THEN regexp_extract(regexp_extract(name, '([^/]*)$', 1), '(?:arXiv-)?(\\d+\\.\\d+)', 1) "
    "ELSE regexp_replace(regexp_extract(name, '([^/]*)$', 1), '\\.[^.]*$', '') END, '.', '_') AS paper_key "
    f"FROM (SELECT doc_id, {ARCHIVE_NAME} AS name FROM tex_docs) n", "tex_docs"))
def paper_ids(spark, sf_dir):
    """Paper ids from archive names: stem, regex id with stem fallback, normalised key."""
    n = fx.tex_docs(spark, sf_dir).selectExpr("doc_id", f"{ARCHIVE_NAME} AS name")
    pid = T.paper_id_regex("name", fallback="stem")
    return n.select("doc_id", "name", T.paper_id_stem("name").alias("stem"), pid.alias("paper_id"),
                    T.paper_id_normalize(pid).alias("paper_key"))


@register("page_keys",
          "SELECT page_id, root, CASE WHEN starts_with(url, root || '/') THEN substr(url, length(root) + 2) END AS key, "
          "regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1) AS basename FROM "
          "(SELECT page_id, url, regexp_extract(url, '^([a-z]+://[^/]+)', 1) AS root FROM pages) p")
def page_keys(spark, sf_dir):
    """Object keys relative to each page's site root, and base names."""
    p = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    p = p.withColumn("root", F.regexp_extract("url", r"^([a-z]+://[^/]+)", 1))
    return p.select("page_id", "root", T.relative_key("url", F.col("root")).alias("key"),
                    T.path_basename(F.regexp_replace("url", r"[?#].*$", "")).alias("basename"))


IMAGE_OPTION = r"(?:\[[^\]]*\])?"


@register("strip_braces", fx.with_views(
    "SELECT archive, paper_id, tex_path, unnest(a) AS arg, unnest(range(len(a))) AS pos, "
    "unnest(list_transform(a, lambda x: regexp_replace(trim(x), '^\\{(.*)\\}$', '\\1', 's'))) AS path FROM "
    f"(SELECT archive, paper_id, tex_path, regexp_extract_all(content, {q(r'\\includegraphics' + IMAGE_OPTION + r'(\{[^{}]*\})')}, 1) "
    "AS a FROM tex_docs) x", "tex_docs"))
def strip_braces(spark, sf_dir):
    """Image arguments as written (``{path}``) with the braces stripped."""
    args = F.regexp_extract_all("content", F.lit(r"\\includegraphics" + IMAGE_OPTION + r"(\{[^{}]*\})"), F.lit(1))
    d = explode_pos(fx.tex_docs(spark, sf_dir), KEYS, args, "pos", "arg")
    return d.select(*KEYS, "arg", "pos",
                    T.strip_braces("arg").alias("path"))


# ----------------------------------------------------------------- tokens
TOKENS_SQL = (
    "toks AS (SELECT archive, paper_id, tex_path, unnest(t) AS token, unnest(range(len(t))) AS pos FROM "
    f"(SELECT archive, paper_id, tex_path, regexp_extract_all({BODY_SQL}, {q(L.TOKEN_RE2)}, 0, 's') AS t FROM clean_docs) x), "
    "ktoks AS (SELECT *, CASE WHEN starts_with(token, '\\begin{figure}') THEN 'figure' "
    "WHEN starts_with(token, '\\section') AND ends_with(token, '}') THEN 'section' "
    "WHEN (starts_with(token, '\\includegraphics') OR starts_with(token, '\\epsfig') "
    "OR starts_with(token, '\\epsfbox')) AND ends_with(token, '}') THEN 'image' ELSE 'text' END AS kind FROM toks)")


def image_token_sql(x: str) -> str:
    return path_sql(f"regexp_extract({x}, {q(L.IMAGE_TOKEN_RE2)}, 1)")


def _tok_sql(select: str) -> str:
    return fx.with_views("", "tex_docs").rstrip() + ", " + TOKENS_SQL + " " + select


@register("tokenize_tex", _tok_sql("SELECT archive, paper_id, tex_path, pos, kind, token FROM ktoks"))
def tokenize_tex(spark, sf_dir):
    """Every document body tiled into tokens with their kind."""
    return TK.token_rows(fx.tex_docs(spark, sf_dir)).select(*KEYS, "pos", "kind", "token")


@register("extract_sections", _tok_sql(
    f"SELECT archive, paper_id, tex_path, pos, regexp_extract(token, {q(L.SECTION_RE2)}, 1) AS title "
    "FROM ktoks WHERE kind = 'section'"))
def extract_sections(spark, sf_dir):
    """Section titles with their token position."""
    t = TK.token_rows(fx.tex_docs(spark, sf_dir)).where(F.col("kind") == "section")
    return t.select(*KEYS, "pos", let(L.marked("token"), L.section_title).alias("title"))


@register("standalone_images", _tok_sql(
    f"SELECT archive, paper_id, tex_path, pos, {image_token_sql('token')} AS image_ref "
    "FROM ktoks WHERE kind = 'image'"))
def standalone_images(spark, sf_dir):
    """Image commands outside any figure environment."""
    t = TK.token_rows(fx.tex_docs(spark, sf_dir)).where(F.col("kind") == "image")
    return t.select(*KEYS, "pos", let(L.marked("token"), L.image_path).alias("image_ref"))


# ----------------------------------------------------------------- concatenation
@register("paper_concat_tex", fx.with_views(
    "SELECT paper_id, part, count(*) AS n_files, min(r) AS first_file, string_agg(content, '' ORDER BY r) AS content "
    "FROM (SELECT paper_id, content, r, cast(floor(r / 256) AS BIGINT) AS part FROM (SELECT paper_id, content, "
    "row_number() OVER (PARTITION BY paper_id ORDER BY archive, tex_path) - 1 AS r FROM tex_docs) a) b "
    "GROUP BY paper_id, part", "tex_docs"))
def paper_concat_tex(spark, sf_dir):
    """All ``.tex`` files of a paper joined in path order, in parts of at most 256 files."""
    return TK.concat_tex(fx.tex_docs(spark, sf_dir).select(*KEYS, "content"))
