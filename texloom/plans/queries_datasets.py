"""Dataset queries: resume, append, per-paper collections, base64 assets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assets as A
from ..operators import datasets as D
from . import fixtures as fx
from .catalog import register
from .queries_figures import KEYS, ORDINAL_SQL, _with, exists_sql, figure_caption_pairs, figure_records_d
from .queries_interleave import B_POLICY, _items_query, checked_arrays, image_documents


@register("resume_pending", fx.with_views(
    "SELECT archive, paper_id, tex_path, doc_id FROM tex_docs t WHERE NOT EXISTS "
    "(SELECT 1 FROM done d WHERE d.paper_id = t.paper_id)", "tex_docs", "done"))
def resume_pending(spark, sf_dir):
    """Documents of papers not yet in the output (exact id match)."""
    docs = fx.tex_docs(spark, sf_dir).select(*KEYS, "doc_id")
    return D.resume_anti(docs, fx.done(spark, sf_dir))


@register("append_union", _with(
    "SELECT archive, paper_id, tex_path, pos, image_ref, caption, CASE WHEN paper_id IN (SELECT paper_id FROM done) "
    "THEN 'existing' ELSE 'new' END AS batch FROM ff WHERE image_ref <> '' AND has_caption AND length(caption) > 0",
    "done"))
def append_union(spark, sf_dir):
    """A dataset that holds the finished papers, extended by the pending ones only."""
    pairs = figure_caption_pairs(spark, sf_dir)
    done = fx.done(spark, sf_dir)
    existing = pairs.join(done, "paper_id", "left_semi").withColumn("batch", F.lit("existing"))
    new = D.resume_anti(pairs, done).withColumn("batch", F.lit("new"))
    return D.append_union(existing, new)


def _doc_arrays_sql() -> str:
    return ("doc_arrays AS (SELECT archive, paper_id, tex_path, list(text ORDER BY pos) AS texts, "
            "list(CASE WHEN kind = 'image' THEN name END ORDER BY pos) AS images, "
            "list(caption ORDER BY pos) FILTER (WHERE kind = 'image') AS captions FROM final f "
            "GROUP BY archive, paper_id, tex_path HAVING count(*) FILTER (WHERE kind = 'image') > 0 "
            "AND NOT EXISTS (SELECT 1 FROM final x WHERE x.archive = f.archive AND x.tex_path = f.tex_path "
            f"AND x.kind = 'image' AND NOT {exists_sql('x')}))")


PART = 256


@register("append_arrays", _items_query(
    ", " + _doc_arrays_sql() + f", ranked AS (SELECT *, archive LIKE '%v1%' AS old, cast(floor((row_number() OVER "
    f"(PARTITION BY paper_id, archive LIKE '%v1%' ORDER BY archive, tex_path) - 1) / {PART}) AS BIGINT) AS part FROM doc_arrays), "
    "parts AS (SELECT paper_id, old, part, flatten(list(texts ORDER BY archive, tex_path)) AS texts, "
    "flatten(list(images ORDER BY archive, tex_path)) AS images, flatten(list(captions ORDER BY archive, tex_path)) AS captions "
    "FROM ranked GROUP BY ALL), nexts AS (SELECT paper_id, max(part) + 1 AS n FROM parts WHERE old GROUP BY ALL) "
    "SELECT p.paper_id, p.part + CASE WHEN old THEN 0 ELSE coalesce(n.n, 0) END AS part, cast(to_json(struct_pack(texts := texts, "
    "images := images, captions := captions)) AS VARCHAR) AS record FROM parts p LEFT JOIN nexts n USING (paper_id)",
    extra_views=("members",), **B_POLICY).replace("FROM final , doc_arrays", "FROM final, doc_arrays")
    .replace(" , doc_arrays AS", ", doc_arrays AS"))
def append_arrays(spark, sf_dir):
    """Variant B's append: a paper's arrays from its first version, in parts of at most 256 files, extended by the parts
    of its second version."""
    docs = checked_arrays(image_documents(fx.tex_docs(spark, sf_dir).select(*KEYS, "content")), fx.members(spark, sf_dir))
    docs = docs.select(*KEYS, F.transform("items", lambda x: x["text"]).alias("texts"),
                       F.transform("items", lambda x: x["name"]).alias("images"),
                       F.transform(F.filter("items", lambda x: x["kind"] == "image"), lambda x: x["caption"]).alias("captions"))
    first = F.col("archive").contains("v1")
    both = D.append_arrays(*(D.array_parts(docs.where(c), PART) for c in (first, ~first)))
    return both.select("paper_id", "part", F.to_json(F.struct("texts", "images", "captions")).alias("record"))


@register("collect_records", _with(
    "SELECT paper_id, cast(floor(fig_index / 256) AS BIGINT) AS part, count(*) AS n_records, "
    "cast(to_json(list(struct_pack(image := image, label := label, "
    "caption := caption) ORDER BY fig_index)) AS VARCHAR) AS record FROM (SELECT o.paper_id, o.fig_index, "
    "replace(o.paper_id, '.', '_') || '_' || cast(o.fig_index AS string) || '.png' AS image, "
    "CASE WHEN o.has_label THEN o.label ELSE '' END AS label, CASE WHEN o.has_caption THEN o.caption ELSE '' END "
    "AS caption FROM (" + ORDINAL_SQL + ") o WHERE o.image_ref <> '' AND " + exists_sql("o") + ") r GROUP BY paper_id, part", "members"))
def collect_records(spark, sf_dir):
    """Variant D's image_caption list per paper, in figure order, as JSON parts of at most 256 records."""
    recs = figure_records_d(spark, sf_dir)
    per = D.collect_records(recs, ["paper_id"], ["fig_index"], ["image", "label", "caption"], part_by="fig_index")
    return per.select("paper_id", "part", "n_records", F.to_json("records").alias("record"))


# Records with an ``image`` field holding base64 bytes, none, or a path (not base64).
B64_SPARK = ("CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 10 = 5 THEN 'figs/f1.png' "
             "ELSE regexp_replace(base64(encode(text, 'UTF-8')), '[\\r\\n]', '') END")
B64_DUCK = ("CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 10 = 5 THEN 'figs/f1.png' "
            "ELSE to_base64(encode(text)) END")


@register("base64_roundtrip", (
    "SELECT doc_id, replace(paper_id, '.', '_') || '_' || cast(doc_id AS string) || 'file.png' AS out_name, "
    "octet_length(try(from_base64(image))) AS n_bytes, md5(try(from_base64(image))) AS md5 FROM "
    f"(SELECT doc_id, paper_id, {B64_DUCK} AS image FROM ({fx.BASE_SQL}) b) r WHERE image IS NOT NULL"))
def base64_roundtrip(spark, sf_dir):
    """Decode base64 ``image`` fields of records that have one; a value that is not base64
    decodes to NULL."""
    recs = fx._base(spark, sf_dir).select("doc_id", "paper_id", F.expr(B64_SPARK).alias("image"))
    dec = A.decode_base64_assets(recs)
    return dec.select("doc_id",
                      F.concat(F.replace("paper_id", F.lit("."), F.lit("_")), F.lit("_"), F.col("doc_id").cast("string"),
                               F.lit("file.png")).alias("out_name"),
                      F.octet_length("image_bytes").cast("long").alias("n_bytes"), F.md5("image_bytes").alias("md5"))
