"""Interleaved text/figure queries (variants B, C, D and the normal form) and run
operators over conversation turns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import latex as L
from ..functions import text as T
from ..operators import assets as A
from ..operators import figures as FG
from ..operators import tokens as TK
from ..operators.rows import explode_values, where_computed
from ..session import materialize
from . import fixtures as fx
from .catalog import register
from .queries_figures import FIELDS_SQL, FIGS_SQL, KEYS, ORDINAL_SQL, exists_sql
from .queries_text import TOKENS_SQL, image_token_sql
from .sqlkit import caption_sql, clean_sql, path_sql, q

PID_NORM = "replace(paper_id, '.', '_')"
BASENAME = "regexp_extract({x}, '([^/]*)$', 1)"


def _name_sql(x: str, jpeg: bool) -> str:
    base = f"{PID_NORM} || '_' || {BASENAME.format(x=x)}"
    return f"regexp_replace({base}, '\\.[^./]*$', '') || '.jpeg'" if jpeg else base


def _cap(x: str) -> str:
    return caption_sql(x)


def items_sql(clean: str = "full", figures: str = "figure", standalone: bool = True, dedupe_names: bool = False,
              dedupe_adjacent: bool = False) -> str:
    """DuckDB CTEs ending in ``final(paper_id, tex_path, pos, kind, text, image_ref, name, caption, label)``:
    the same items as ``operators.tokens.interleave``, built with windows over token rows."""
    rules = T.CLEAN_RULES_FULL if clean == "full" else T.CLEAN_RULES_SHORT
    cols = "archive, paper_id, tex_path, c, sub"
    parts = [
        f"SELECT {cols}, 0 AS k, 'text' AS kind, {clean_sql('raw', rules)} AS text, NULL AS image_ref, "
        "NULL AS name, NULL AS caption, NULL AS label FROM raw WHERE rkind = 'run'",
        f"SELECT {cols}, 0, 'text', regexp_extract(raw, {q(L.SECTION_RE2)}, 1), NULL, NULL, NULL, NULL "
        "FROM raw WHERE rkind = 'section'",
    ]
    img = path_sql(f"regexp_extract(raw, {q(L.INCLUDEGRAPHICS_RE2)}, 1)")
    lab = f"CASE WHEN regexp_matches(raw, {q(L.LABEL_RE2)}) THEN regexp_extract(raw, {q(L.LABEL_RE2)}, 1) END"
    if figures == "figure":
        parts.append(f"SELECT {cols}, 0, 'figure', NULL, nullif({img}, ''), NULL, {_cap('raw')}, {lab} "
                     "FROM raw WHERE rkind = 'figure'")
    elif figures == "first_image":
        parts.append(f"SELECT {cols}, 0, 'figure', NULL, {img}, {_name_sql(img, False)}, {_cap('raw')}, {lab} "
                     f"FROM raw WHERE rkind = 'figure' AND {img} <> ''")
    elif figures == "images":
        cat = "list_concat(" + ", ".join(f"regexp_extract_all(raw, {q(p)}, 1)"
                                         for p in (L.INCLUDEGRAPHICS_RE2, L.EPSFIG_RE2, L.EPSFBOX_RE2)) + ")"
        cat = f"list_transform({cat}, lambda r: {path_sql('r')})"
        imgs = f"list_filter({cat}, lambda x, i: x <> '' AND NOT list_contains({cat}[1:i-1], x))"
        cap = clean_sql(_cap('raw'), T.CLEAN_RULES_FULL)
        parts.append(
            f"SELECT {cols}, k, 'image', NULL, image_ref, {_name_sql('image_ref', True)}, cap, NULL FROM "
            f"(SELECT {cols}, unnest({imgs}) AS image_ref, unnest(range(len({imgs}))) AS k, {cap} AS cap "
            "FROM raw WHERE rkind = 'figure') fi")
    if standalone:
        sp = image_token_sql("raw")
        parts.append(f"SELECT {cols}, 0, 'image', NULL, {sp}, {_name_sql(sp, figures == 'images')}, NULL, NULL "
                     "FROM raw WHERE rkind = 'image'")
    ctes = [
        "g AS (SELECT *, sum(CASE WHEN kind <> 'text' THEN 1 ELSE 0 END) OVER "
        "(PARTITION BY archive, tex_path ORDER BY pos ROWS UNBOUNDED PRECEDING) AS c FROM ktoks)",
        "raw AS (SELECT archive, paper_id, tex_path, c, 1 AS sub, 'run' AS rkind, string_agg(token, '' ORDER BY pos) AS raw "
        "FROM g WHERE kind = 'text' GROUP BY archive, paper_id, tex_path, c "
        "UNION ALL SELECT archive, paper_id, tex_path, c, 0, kind, token FROM g WHERE kind <> 'text')",
        "it0 AS (" + " UNION ALL ".join(parts) + ")",
        "it1 AS (SELECT *, row_number() OVER (PARTITION BY archive, tex_path ORDER BY c, sub, k) AS ipos FROM it0 "
        "WHERE NOT (kind = 'text' AND (text IS NULL OR text = '')))",
    ]
    cur = "it1"
    if dedupe_names:
        ctes.append(f"it2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY archive, tex_path, "
                    f"CASE WHEN kind = 'image' THEN name END ORDER BY ipos) AS rn FROM {cur}) "
                    "WHERE kind <> 'image' OR rn = 1)")
        cur = "it2"
    if dedupe_adjacent:
        ctes.append(f"it3 AS (SELECT * FROM (SELECT *, lag(kind) OVER w AS pk, lag(text) OVER w AS pt FROM {cur} "
                    "WINDOW w AS (PARTITION BY archive, tex_path ORDER BY ipos)) "
                    "WHERE NOT (kind = 'text' AND pk IS NOT NULL AND pk = 'text' AND pt = text))")
        cur = "it3"
    ctes += [
        f"mm AS (SELECT *, sum(CASE WHEN kind <> 'text' THEN 1 ELSE 0 END) OVER (PARTITION BY archive, tex_path "
        f"ORDER BY ipos ROWS UNBOUNDED PRECEDING) AS m FROM {cur})",
        "merged AS (SELECT archive, paper_id, tex_path, m, 1 AS sub2, 'text' AS kind, string_agg(text, ' ' ORDER BY ipos) AS text, "
        "NULL AS image_ref, NULL AS name, NULL AS caption, NULL AS label FROM mm WHERE kind = 'text' "
        "GROUP BY archive, paper_id, tex_path, m UNION ALL SELECT archive, paper_id, tex_path, m, 0, kind, text, image_ref, name, "
        "caption, label FROM mm WHERE kind <> 'text')",
        "final AS (SELECT archive, paper_id, tex_path, row_number() OVER (PARTITION BY archive, tex_path ORDER BY m, sub2) - 1 "
        "AS pos, kind, text, image_ref, name, caption, label FROM merged)",
    ]
    return ", ".join(ctes)


def _items_query(select: str, extra_views=(), **policy) -> str:
    base = fx.with_views("", "tex_docs", *extra_views).rstrip()
    return f"{base}, {TOKENS_SQL}, {items_sql(**policy)} {select}"


# ----------------------------------------------------------------- normal form
@register("interleaved_items", _items_query(
    "SELECT archive, paper_id, tex_path, pos, kind, text, image_ref, caption, label FROM final"))
def interleaved_items(spark, sf_dir):
    """Every document as reading-order items: merged cleaned text, figures (first
    image, raw caption, label) and stand-alone images."""
    docs = TK.interleave(fx.tex_docs(spark, sf_dir).select(*KEYS, "content"))
    return TK.item_rows(docs).select(*KEYS, "pos", "kind", "text", "image_ref", "caption", "label")


# ----------------------------------------------------------------- B: three arrays
B_POLICY = dict(clean="full", figures="images", standalone=True, dedupe_names=True)


def arrays_record(items) -> F.Column:
    """``{texts, images, captions}``: texts and images aligned (one NULL each), captions one per image."""
    return F.to_json(F.struct(
        F.transform(items, lambda x: x["text"]).alias("texts"),
        F.transform(items, lambda x: x["name"]).alias("images"),
        F.transform(F.filter(items, lambda x: x["kind"] == "image"), lambda x: x["caption"]).alias("captions")))


@register("interleaved_arrays", _items_query(
    "SELECT archive, paper_id, tex_path, cast(to_json(struct_pack(texts := list(text ORDER BY pos), "
    "images := list(CASE WHEN kind = 'image' THEN name END ORDER BY pos), "
    "captions := list(caption ORDER BY pos) FILTER (WHERE kind = 'image'))) AS VARCHAR) AS record FROM final f "
    "GROUP BY archive, paper_id, tex_path HAVING count(*) FILTER (WHERE kind = 'image') > 0 "
    "AND NOT EXISTS (SELECT 1 FROM final x WHERE x.archive = f.archive AND x.tex_path = f.tex_path "
    f"AND x.kind = 'image' AND NOT {exists_sql('x')})", extra_views=("members",), **B_POLICY))
def interleaved_arrays(spark, sf_dir):
    """Variant B: per document, texts/images/captions arrays; documents without images are not
    written, and one missing image file drops the document."""
    docs = checked_arrays(image_documents(fx.tex_docs(spark, sf_dir).select(*KEYS, "content")), fx.members(spark, sf_dir))
    return docs.select(*KEYS, arrays_record(F.col("items")).alias("record"))


def image_documents(docs):
    """``(file keys, items)`` of the documents that have images. The items feed both the file check and the output: computed
    once, lineage cut."""
    return materialize(where_computed(TK.interleave(docs, **B_POLICY), KEYS, F.col("items"), "items",
                                      lambda it: F.exists(it, lambda x: x["kind"] == "image")))


def image_refs(docs):
    """``(file keys, image_ref)`` of the images of ``image_documents``."""
    return explode_values(docs, KEYS, F.transform(F.filter("items", lambda x: x["kind"] == "image"), lambda x: x["image_ref"]), "image_ref")


def checked_arrays(docs, members):
    """Those of ``image_documents`` whose images are all in their archive."""
    bad = (A.resolve_assets(image_refs(docs), members, policy="keep").where(~F.col("resolved"))
           .select("archive", "tex_path").distinct())  # names only
    return docs.join(bad, ["archive", "tex_path"], "left_anti")


# ----------------------------------------------------------------- C: mixed JSON list
C_POLICY = dict(clean="short", figures="first_image", standalone=False, dedupe_adjacent=True)


# Fixed value: the marker that tags a figure entry in variant C's list.
FIGURE_MARK = "FIGURE:"


def mixed_list_json(items) -> F.Column:
    """``["text", ["FIGURE:", "name"], ...]`` as JSON text (a mixed array has no Spark type)."""
    frag = F.transform(items, lambda x: F.when(x["kind"] == "text", F.regexp_replace(
        F.to_json(F.array(x["text"])), r"^\[|\]$", "")).otherwise(F.to_json(F.array(F.lit(FIGURE_MARK), x["name"]))))
    return F.concat(F.lit("["), F.array_join(frag, ","), F.lit("]"))


@register("interleaved_list", _items_query(
    "SELECT archive, paper_id, tex_path, '[' || string_agg(CASE WHEN kind = 'text' THEN to_json(text) "
    "ELSE to_json(['FIGURE:', name]) END, ',' ORDER BY pos) || ']' AS record FROM final "
    "GROUP BY archive, paper_id, tex_path", **C_POLICY))
def interleaved_list(spark, sf_dir):
    """Variant C: per document, a JSON list of texts (short chain, adjacent duplicates dropped,
    runs merged) and ``["FIGURE:", name]`` pairs; empty documents are not written."""
    docs = TK.interleave(fx.tex_docs(spark, sf_dir).select(*KEYS, "content"), **C_POLICY)
    return where_computed(docs, KEYS, F.col("items"), "items", lambda it: F.size(it) > 0) \
        .select(*KEYS, mixed_list_json(F.col("items")).alias("record"))


# ----------------------------------------------------------------- D: segments + figures
@register("interleaved_segments", fx.with_views("", "tex_docs", "members").rstrip() + (
    f", figs AS ({FIGS_SQL}), ff AS ({FIELDS_SQL}), "
    f"ord AS ({ORDINAL_SQL}), okf AS (SELECT * FROM ord o WHERE image_ref <> '' AND {exists_sql('o')}), "
    "segs AS (SELECT archive, paper_id, tex_path, unnest(s) AS text, unnest(range(len(s))) AS seg FROM "
    "(SELECT archive, paper_id, tex_path, string_split_regex(content, '\\\\begin\\{figure\\}.*?\\\\end\\{figure\\}', 's') AS s "
    "FROM clean_docs) x) "
    "SELECT s.archive, s.paper_id, s.tex_path, s.seg, regexp_replace(s.text, '^\\s+|\\s+$', '', 'g') AS text, "
    "CASE WHEN f.fig_index IS NOT NULL THEN replace(s.paper_id, '.', '_') || '_' || cast(f.fig_index AS string) "
    "|| '.png' END AS image, CASE WHEN f.fig_index IS NULL THEN NULL WHEN f.has_label THEN f.label ELSE '' END "
    "AS label, CASE WHEN f.fig_index IS NULL THEN NULL WHEN f.has_caption THEN f.caption ELSE '' END AS caption "
    "FROM segs s LEFT JOIN okf f ON f.archive = s.archive AND f.tex_path = s.tex_path AND f.pos = s.seg"))
def interleaved_segments(spark, sf_dir):
    """Variant D's ``full`` list, per document: text segments between figures, each followed by
    its figure's image/label/caption when the figure has an image whose file exists."""
    docs = fx.tex_docs(spark, sf_dir).select(*KEYS, "content")
    zipped = materialize(TK.zip_in_row(docs))
    rows = TK.zipped_segments(zipped, FG.figure_places(TK.zipped_facts(zipped), fx.members(spark, sf_dir)))
    return rows.select(*KEYS, "seg", T.strip_ws("text").alias("text"), "figure.image", "figure.label", "figure.caption")


PIECE = 256
D_FULL_SQL = fx.with_views("", "tex_docs", "members").rstrip() + (
    f", figs AS ({FIGS_SQL}), ff AS ({FIELDS_SQL}), "
    f"ord AS ({ORDINAL_SQL}), okf AS (SELECT * FROM ord o WHERE image_ref <> '' AND {exists_sql('o')}), "
    "cut AS (SELECT archive, paper_id, tex_path, string_split_regex(content, '\\\\begin\\{figure\\}.*?\\\\end\\{figure\\}', 's') AS s "
    "FROM clean_docs), "
    "ranked AS (SELECT *, row_number() OVER w - 1 AS r, coalesce(sum(len(s) - 1) OVER (PARTITION BY paper_id ORDER BY archive, tex_path "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM cut WINDOW w AS (PARTITION BY paper_id ORDER BY archive, tex_path)), "
    "each AS (SELECT paper_id, r, off, unnest(s) AS text, unnest(range(len(s))) AS i FROM ranked), "
    f"pieces AS (SELECT paper_id, cast(off + i AS BIGINT) AS seg, cast(floor(r / {PIECE}) AS BIGINT) AS piece, "
    "string_agg(text, '' ORDER BY r) AS text FROM each GROUP BY ALL), "
    "ends AS (SELECT *, min(piece) OVER (PARTITION BY paper_id, seg) AS lo, max(piece) OVER (PARTITION BY paper_id, seg) AS hi FROM pieces), "
    "lefts AS (SELECT * REPLACE (CASE WHEN piece = lo THEN regexp_replace(text, '^\\s+', '') ELSE text END AS text) FROM ends), "
    "segs AS (SELECT * REPLACE (CASE WHEN piece = hi THEN regexp_replace(text, '\\s+$', '') ELSE text END AS text) FROM lefts) "
    "SELECT s.paper_id, s.seg, s.piece, s.text, "
    "CASE WHEN f.fig_index IS NOT NULL THEN replace(s.paper_id, '.', '_') || '_' || cast(f.fig_index AS string) "
    "|| '.png' END AS image, CASE WHEN f.fig_index IS NULL THEN NULL WHEN f.has_label THEN f.label ELSE '' END "
    "AS label, CASE WHEN f.fig_index IS NULL THEN NULL WHEN f.has_caption THEN f.caption ELSE '' END AS caption "
    "FROM segs s LEFT JOIN okf f ON f.paper_id = s.paper_id AND f.fig_index = s.seg AND s.piece = s.hi")


@register("interleaved_full", D_FULL_SQL)
def interleaved_full(spark, sf_dir):
    """Variant D's ``full`` list over the concatenation of each paper's files: text segments
    between figure environments (the last segment of a file runs on into the next file), in pieces of at most 256
    files, the last piece followed by its figure's image/label/caption when that figure has an image whose file exists."""
    docs = fx.tex_docs(spark, sf_dir).select(*KEYS, "content")
    return D_full(materialize(TK.zip_in_row(docs)), fx.members(spark, sf_dir)).select("paper_id", "seg", "piece", "text", "image", "label", "caption")


def D_full(zipped, members):
    """``(paper_id, seg, piece, text, image, label, caption, archive, image_ref)``: segments with the figures that follow them;
    ``zipped``: ``zip_in_row`` of the documents, materialized."""
    rows = TK.zipped_segments(zipped, FG.figure_places(TK.zipped_facts(zipped), members))
    source = F.when(F.col("figure").isNotNull(), F.struct(F.col("archive"), "figure.*"))
    segs = TK.paper_segments(rows.withColumn("figure", source), PIECE)
    return segs.select("paper_id", "seg", "piece", "text", "figure.image", "figure.label", "figure.caption", "figure.archive", "figure.image_ref")


# ----------------------------------------------------------------- runs over conversation turns
SIDE_SQL = "CASE WHEN role = 'assistant' THEN 'response' ELSE 'prompt' END"


def _turns(spark, sf_dir, *cols):
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", *cols)
    return c.withColumn("side", F.expr(SIDE_SQL))


@register("adjacent_dedupe",
          "SELECT conv_id, turn, side FROM (SELECT conv_id, turn, side, lag(side) OVER "
          f"(PARTITION BY conv_id ORDER BY turn) AS prev FROM (SELECT *, {SIDE_SQL} AS side FROM conversations) s) c "
          "WHERE prev IS NULL OR prev <> side")
def adjacent_dedupe(spark, sf_dir):
    """Drop a turn whose side (prompt: system/user, response: assistant) equals the previous turn's."""
    c = _turns(spark, sf_dir).select("conv_id", "turn", "side")
    return TK.dedupe_adjacent_text(c, ["conv_id"], ["turn"], "side")


@register("merge_adjacent_text",
          "SELECT conv_id, cast(run AS BIGINT) AS run, side, min(turn) AS first_turn, count(*) AS n_items, "
          "coalesce(string_agg(text, ' ' ORDER BY turn), '') AS text FROM (SELECT *, sum(CASE WHEN prev IS NULL OR prev <> side "
          "THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS run FROM "
          "(SELECT conv_id, turn, side, text, lag(side) OVER (PARTITION BY conv_id ORDER BY turn) AS prev "
          f"FROM (SELECT *, {SIDE_SQL} AS side FROM conversations) s) a) b GROUP BY conv_id, run, side")
def merge_adjacent_text(spark, sf_dir):
    """Consecutive turns of the same side merged into one text, in turn order (gaps and islands): a row per run."""
    c = _turns(spark, sf_dir, "text")
    return TK.merge_adjacent_text(c, ["conv_id"], "turn", "text", "side", piece_bytes=None).select(
        "conv_id", "run", "side", "first_turn", "n_items", "text")
