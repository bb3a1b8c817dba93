"""Policies over the shared normal form: file resolution, resume, append, sinks."""

from __future__ import annotations

import base64
import json
import os

from pyspark.sql import functions as F

from texloom.operators import assets as A
from texloom.operators import datasets as D
from texloom.sources import datasets as SD

from .conftest import local_path

FIGS = [("p1", "a.tex", 0, "figs/x.png"), ("p1", "a.tex", 1, "figs/missing.png"),
        ("p1", "b.tex", 0, "figs/x.png"), ("p2", "a.tex", 0, "y.png")]
MEMBERS = [("p1", "figs/x.png"), ("p1", "figs/x.png"), ("p2", "y.png"), ("p2", "x.png")]


def frames(spark):
    f = spark.createDataFrame(FIGS, "paper_id string, tex_path string, pos long, image_ref string")
    m = spark.createDataFrame(MEMBERS, "paper_id string, member_path string")
    return f, m


def keyset(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_resolve_policies(spark):
    f, m = frames(spark)
    drop = A.resolve_assets(f, m, policy="drop")
    assert keyset(drop, "paper_id", "tex_path", "pos") == [("p1", "a.tex", 0), ("p1", "b.tex", 0), ("p2", "a.tex", 0)]
    keep = A.resolve_assets(f, m, policy="keep")
    assert keep.count() == 4  # duplicate member rows do not duplicate figures
    assert keyset(keep.where(~F.col("resolved")), "image_ref") == [("figs/missing.png",)]
    aon = A.resolve_assets(f, m, policy="all_or_nothing")
    assert keyset(aon, "paper_id", "tex_path") == [("p1", "b.tex"), ("p2", "a.tex")]
    root = A.resolve_assets(f, m, policy="drop", match="root_basename")
    assert keyset(root, "paper_id", "image_ref") == [("p2", "y.png")]


def test_dedupe_output_names_keeps_first(spark):
    df = spark.createDataFrame([("p", "t", 0, 0, "a/x.png"), ("p", "t", 0, 1, "b/x.eps"), ("p", "t", 1, 0, "c/y.png")],
                               "paper_id string, tex_path string, pos long, img_pos long, image_ref string")
    df = df.withColumn("out_name", A.asset_name_prefixed("paper_id", "image_ref", jpeg=True))
    got = keyset(A.dedupe_output_images(df), "out_name", "image_ref")
    assert got == [("p_x.jpeg", "a/x.png"), ("p_y.jpeg", "c/y.png")]


def test_resume_exact_key_not_prefix(spark):
    new = spark.createDataFrame([("2301.0001",), ("2301.00012",), ("2301.5",)], "paper_id string")
    done = spark.createDataFrame([("2301.00012",)], "paper_id string")
    assert keyset(D.resume_anti(new, done), "paper_id") == [("2301.0001",), ("2301.5",)]


def test_rerun_adds_nothing(spark, scratch):
    out = scratch + "/figures"
    batch = spark.createDataFrame([("p1", 0, "a.png", "cap"), ("p2", 0, "b.png", "cap2")],
                                  "paper_id string, pos long, image_filename string, caption string")
    for _ in range(2):
        try:
            done = spark.read.parquet(out).select("paper_id").distinct()
            todo = D.resume_anti(batch, done)
        except Exception:  # noqa: BLE001  (no output yet)
            todo = batch
        SD.write_figures_parquet(todo, out, n_buckets=4)
    assert spark.read.parquet(out).count() == 2


def test_append_arrays_full_outer(spark):
    old = spark.createDataFrame([("p1", ["a", None], [None, "x.jpeg"], ["c"])],
                                "paper_id string, texts array<string>, images array<string>, captions array<string>")
    new = spark.createDataFrame([("p1", ["b"], [None], []), ("p2", ["z"], [None], [])],
                                "paper_id string, texts array<string>, images array<string>, captions array<string>")
    got = {r.paper_id: (r.texts, r.images, r.captions) for r in D.append_arrays(old, new).collect()}
    assert got == {"p1": (["a", None, "b"], [None, "x.jpeg", None], ["c"]), "p2": (["z"], [None], [])}


def test_json_dataset_roundtrip_and_relink(spark, scratch):
    src = local_path(scratch) + "/json"
    os.makedirs(src)
    with open(f"{src}/2301_00001_imagesonly.json", "w") as f:
        f.write('[{"image_filename": "x.pdf.d/y.pdf", "caption": "c"}, {"caption": "no image"},'
                ' {"image_filename": "a.PDF", "caption": "u"}]')
    recs = SD.read_json_dataset(spark, src, SD.FIGURE_RECORD)
    assert [r.item for r in recs.orderBy("item").collect()] == [0, 1, 2]
    with open(f"{src}/empty.json", "w") as f:
        f.write("[]")
    with open(f"{src}/broken.json", "w") as f:
        f.write('[{"image_filename": "a.pdf"')
    with open(f"{src}/more.json", "w") as f:
        f.write('[{"label": "a.pdf", "n": {"k": [1]}, "image_filename": "a.pdf", "caption": "q\\"a.pdf"}]')
    out = SD.rewrite_json_dataset(spark, src, scratch + "/json_relinked", SD.FIGURE_RECORD)
    got = {r.source.rsplit("/", 1)[-1]: (json.loads(r.records) if r.records else None, r.error) for r in out.collect()}
    assert got == {
        "2301_00001_imagesonly.json": ([{"image_filename": "x.png.d/y.png", "caption": "c"}, {"caption": "no image"},
                                        {"image_filename": "a.PDF", "caption": "u"}], None),
        "empty.json": ([], None), "broken.json": (None, "not a JSON list"),
        "more.json": ([{"label": "a.pdf", "n": {"k": [1]}, "image_filename": "a.png", "caption": 'q"a.pdf'}], None)}


def test_collect_and_write_json(spark, scratch):
    recs = spark.createDataFrame([("p1", 1, "b"), ("p1", 0, "a"), ("p2", 0, "z")],
                                 "paper_id string, fig_index long, image string")
    per = D.collect_records(recs, ["paper_id"], ["fig_index"], ["image"])
    got = {r.paper_id: [x.image for x in r.records] for r in per.collect()}
    assert got == {"p1": ["a", "b"], "p2": ["z"]}
    out = scratch + "/per_paper"
    SD.write_json_dataset(per.select("paper_id", F.to_json("records").alias("record")), out, n_buckets=4)
    SD.write_json_dataset(per.where("paper_id = 'p1'").select("paper_id", F.to_json("records").alias("record")),
                          out, n_buckets=4)
    assert spark.read.json(out).count() == 2  # the rewritten bucket replaced itself only


def test_base64_and_asset_export(spark, scratch):
    payload = b"\x89PNG\r\n"
    recs = spark.createDataFrame([(0, base64.b64encode(payload).decode()), (1, None), (2, "figs/f1.png")],
                                 "i int, image string")
    dec = {r.i: r.image_bytes for r in A.decode_base64_assets(recs).collect()}
    assert dec == {0: bytearray(payload), 2: None}
    assets = spark.createDataFrame([("p", "a.png", "p_a.png", ".png", 3, b"PNG")],
                                   "paper_id string, src_path string, out_name string, ext string, length long, "
                                   "content binary")
    root = scratch + "/assets_files"
    assert SD.export_asset_files(assets, root) == 1
    with open(local_path(root) + "/p_a.png", "rb") as f:
        assert f.read() == b"PNG"
    SD.write_assets(assets, scratch + "/assets", n_buckets=4)
    assert spark.read.parquet(scratch + "/assets").first().out_name == "p_a.png"
    keys = SD.relative_keys(spark, local_path(root))
    assert [r.key for r in keys.collect()] == ["p_a.png"]


def test_per_paper_outputs_in_bounded_parts(spark):
    from texloom.operators import tokens as TK
    docs = spark.createDataFrame([("p", f"f{i:02d}.tex", f"<{i}>") for i in range(7)] + [("q", "a.tex", "x")],
                                 "paper_id string, tex_path string, content string")
    parts = {(r.paper_id, r.part): (r.n_files, r.first_file, r.content)
             for r in TK.concat_tex(docs, part_size=3).collect()}
    assert parts == {("p", 0): (3, 0, "<0><1><2>"), ("p", 1): (3, 3, "<3><4><5>"), ("p", 2): (1, 6, "<6>"),
                     ("q", 0): (1, 0, "x")}
    recs = spark.createDataFrame([("p", i, f"r{i}") for i in range(5)], "paper_id string, idx long, v string")
    got = {r.part: [x.v for x in r.records] for r in
           D.collect_records(recs, ["paper_id"], ["idx"], ["v"], part_by="idx", part_size=2).collect()}
    assert got == {0: ["r0", "r1"], 1: ["r2", "r3"], 2: ["r4"]}
