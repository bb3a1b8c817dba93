"""Figure extraction, captions (nesting, size), tokens and the in-row interleave."""

from __future__ import annotations


from texloom.operators import figures as FG
from texloom.operators import tokens as TK

def docs(spark, *contents):
    return spark.createDataFrame([("2301.00001", f"d{i}.tex", c) for i, c in enumerate(contents)],
                                 "paper_id string, tex_path string, content string")


def figs(spark, *contents):
    return FG.extract_figures(docs(spark, *contents)).orderBy("tex_path", "pos").collect()


def test_nested_caption_and_label(spark):
    tex = r"\begin{figure}\includegraphics[width=1]{a/b.png}\caption{a \emph{b {c}} d}\label{f:1}\end{figure}"
    (f,) = figs(spark, tex)
    assert f.image_ref == "a/b.png" and f.caption == r"a \emph{b {c}} d" and f.label == "f:1"
    assert f.has_caption and f.has_label and f.has_image


def test_long_caption_no_stack_overflow(spark):
    cap = r"\emph{a}" * 20000
    (f,) = figs(spark, r"\begin{figure}\includegraphics{x.png}\caption{" + cap + r"}\end{figure}")
    assert f.caption == cap


def test_captions_nest_to_any_depth(spark):
    for depth in (4, 6, 40, 2000):
        cap = "x" + "{a" * depth + "}" * depth + r" \} \{ y"
        (f,) = figs(spark, r"\begin{figure}\includegraphics{x.png}\caption[s]{" + cap + r"}\label{l}\end{figure}")
        assert f.caption == cap and f.label == "l"


def test_unclosed_caption_goes_to_errors(spark):
    tex = r"\begin{figure}\includegraphics{x.png}\caption{a{b}\end{figure}"
    rows = FG.extract_figures(docs(spark, tex))
    assert [r.message for r in FG.caption_errors(rows).collect()] == ["the caption's braces do not close"]
    assert rows.first().caption == "" and not rows.first().has_caption


def test_comments_are_no_part_of_a_document(spark):
    tex = ("% \\begin{figure}\\includegraphics{c.png}\\end{figure}\n50\\% \\begin{figure}\n% \\includegraphics{old.png}\n"
           "\\includegraphics{k.png}\\\\% \\caption{no}\n\\caption{yes 5\\%}\\end{figure}")
    d = docs(spark, tex)
    assert [(r.image_ref, r.caption) for r in FG.extract_figures(d).collect()] == [("k.png", "yes 5\\%")]
    assert FG.extract_figures(d, strip_comments=False).count() == 2


def test_arguments_are_stripped(spark):
    tex = (r"\section{A {bold {one}}}\section[short]{long}\includegraphics{ s.png }\includegraphics{{ a b.png }}"
           "\\begin{figure}\\includegraphics[width=1]{ {t.png}}\\end{figure}end\\")
    d = docs(spark, tex)
    rows = [(r.kind, r.token) for r in TK.token_rows(d).orderBy("pos").collect()]
    assert "".join(t for _, t in rows) == tex  # tokens tile the text, the lone backslash included
    items = TK.item_rows(TK.interleave(d)).orderBy("pos").collect()
    assert [(r.kind, r.image_ref) for r in items if r.kind != "text"] == [("image", "s.png"), ("image", "a b.png"), ("figure", "t.png")]
    assert items[0].text.startswith("A {bold {one}} long")


def test_paths_are_normalised(spark):
    from texloom.functions.text import normalize_path
    paths = {"./figs/a.png": "figs/a.png", " a//b/../c.png\n": "a/c.png", "../x": "x", "a/./b": "a/b", "/abs/p": "abs/p", "": ""}
    df = spark.createDataFrame([(p,) for p in paths], "p string").select("p", normalize_path("p").alias("n"))
    assert {r.p: r.n for r in df.collect()} == paths


def test_figure_star_and_missing_parts(spark):
    tex = (r"\begin{figure*}\includegraphics{w.png}\end{figure*}"
           r"\begin{figure}\caption{no image}\end{figure}"
           r"\begin{figure}\includegraphics{only.png}\end{figure}"
           r"\begin{figure}\caption[short]{long one}\includegraphics{p.pdf}\end{figure}")
    rows = figs(spark, tex)
    assert [(r.pos, r.image_ref, r.caption, r.has_caption) for r in rows] == [
        (0, "", "no image", True), (1, "only.png", "", False), (2, "p.pdf", "long one", True)]
    assert FG.require_caption(FG.require_image(FG.extract_figures(docs(spark, tex)))).count() == 1


def test_all_images_distinct_first_occurrence(spark):
    tex = (r"\begin{figure}\epsfig{e.eps}\includegraphics{b.png}\includegraphics{a.png}"
           r"\includegraphics{b.png}\epsfbox{f.eps}\end{figure}")
    f = FG.figure_all_images(FG.extract_figures(docs(spark, tex))).first()
    assert f.image_refs == ["b.png", "a.png", "e.eps", "f.eps"]


def items(spark, tex, **policy):
    d = TK.interleave(docs(spark, tex), **policy)
    return [(r.kind, r.text, r.image_ref, r.name) for r in TK.item_rows(d).orderBy("pos").collect()]


def test_interleave_normal_form(spark):
    tex = (r"\documentclass{article}\begin{document}\section{Intro}Some \textbf{bold} text."
           r"\begin{figure}\includegraphics{a.png}\caption{Cap}\end{figure}"
           r"More $x$ text.\includegraphics{s.png}Tail 12pt.\end{document}")
    assert items(spark, tex) == [
        ("text", "Intro Some text.", None, None),
        ("figure", None, "a.png", None),
        ("text", "More text.", None, None),
        ("image", None, "s.png", "2301_00001_s.png"),
        ("text", "Tail .", None, None),
    ]


def test_interleave_b_policy_names_and_dedupe(spark):
    tex = (r"\begin{document}A\begin{figure}\includegraphics{d1/x.png}\epsfig{d2/x.eps}\caption{C \emph{x}}"
           r"\end{figure}B\includegraphics{y.pdf}\end{document}")
    got = items(spark, tex, clean="full", figures="images", standalone=True, dedupe_names=True)
    assert got == [("text", "A", None, None), ("image", None, "d1/x.png", "2301_00001_x.jpeg"),
                   ("text", "B", None, None), ("image", None, "y.pdf", "2301_00001_y.jpeg")]


def test_interleave_c_policy_adjacent_dedupe(spark):
    # Three equal texts in a row leave one; figures without an image break nothing.
    tex = (r"\begin{document}\section{a}\begin{figure}\caption{x}\end{figure}\section{a}"
           r"\includegraphics{s.png}\section{a}\begin{figure}\includegraphics{f/g.png}\end{figure}z\end{document}")
    got = items(spark, tex, clean="short", figures="first_image", standalone=False, dedupe_adjacent=True)
    assert got == [("text", "a", None, None), ("figure", None, "f/g.png", "2301_00001_g.png"), ("text", "z", None, None)]


def test_no_figures_text_only(spark):
    assert items(spark, r"\begin{document}just text\end{document}") == [("text", "just text", None, None)]
    assert items(spark, "") == []


def test_split_and_zip_two_figures(spark):
    tex = "t0 \\begin{figure}\\includegraphics{a.png}\\end{figure} t1 \\begin{figure}\\includegraphics{b.png}\\end{figure} t2"
    d = docs(spark, tex)
    segs = TK.split_on_figures(d)
    f = FG.extract_figures(d).select("paper_id", "tex_path", "pos", "image_ref")
    rows = TK.zip_segments(segs, f).orderBy("seg").collect()
    assert [(r.seg, r.text, r.image_ref) for r in rows] == [(0, "t0", "a.png"), (1, "t1", "b.png"), (2, "t2", None)]


def test_tokens_tile_the_body(spark):
    tex = r"\begin{document}a\\section{x}\section{T}b\includegraphics[w]{p.png}\begin{figure}q\end{figure}\end{document}"
    rows = TK.token_rows(docs(spark, tex)).orderBy("pos").collect()
    assert "".join(r.token for r in rows) == tex
    kinds = [(r.kind, r.token) for r in rows if r.kind != "text"]
    assert kinds == [("section", r"\section{T}"), ("image", r"\includegraphics[w]{p.png}"),
                     ("figure", r"\begin{figure}q\end{figure}")]


def test_paper_segments_across_files(spark):
    fig = "\\begin{figure}\\includegraphics{%s}\\end{figure}"
    d = spark.createDataFrame([("p", "a.tex", "A0 " + fig % "x.png" + " A1"),
                               ("p", "b.tex", " B0 "),
                               ("p", "c.tex", "C0" + fig % "gone.png" + "C1")],
                              "paper_id string, tex_path string, content string")
    got = sorted((r.seg, r.text) for r in TK.paper_segments(TK.raw_segments(d)).collect())
    # a.tex's tail runs into b.tex and c.tex; every figure environment splits, valid or not.
    assert got == [(0, "A0"), (1, "A1 B0 C0"), (2, "C1")]


def _zip_files(spark):
    fig = "\\begin{figure}\\includegraphics{%s}\\caption{%s}\\end{figure}"
    d = spark.createDataFrame([("t1", "p", "a.tex", "A0 " + fig % ("x.png", "c0") + " A1 " + fig % ("gone.png", "c1") + " A2"),
                               ("t1", "p", "b.tex", " B0 "),
                               ("t1", "p", "c.tex", "C0" + fig % ("./x.png", "c2") + "C1 % " + fig % ("x.png", "no")),
                               ("t2", "q", "a.tex", fig % ("x.png", "other archive")), ("t2", "q", "b.tex", ""), ("t2", "q", "c.tex", None)],
                              "archive string, paper_id string, tex_path string, content string")
    members = spark.createDataFrame([("t1", "p", "x.png"), ("t2", "q", "y.png")], "archive string, paper_id string, member_path string")
    return d, members


def test_figures_zipped_in_the_row(spark):
    d, members = _zip_files(spark)
    zipped = TK.zip_in_row(d)
    facts = TK.zipped_facts(zipped)
    assert sorted(map(str, facts.where("size(facts) > 0").collect())) == sorted(map(str, FG.figure_facts(d).where("size(facts) > 0").collect()))
    rows = TK.zipped_segments(zipped, FG.figure_places(facts, members))
    got = sorted((r.archive, r.tex_path, r.seg, r.text, r.figure and (r.figure.image, r.figure.caption)) for r in rows.collect())
    assert got == [("t1", "a.tex", 0, "A0 ", ("p_0.png", "c0")), ("t1", "a.tex", 1, " A1 ", None), ("t1", "a.tex", 2, " A2", None),
                   ("t1", "b.tex", 0, " B0 ", None), ("t1", "c.tex", 0, "C0", ("p_2.png", "c2")), ("t1", "c.tex", 1, "C1 ", None),
                   ("t2", "a.tex", 0, "", None), ("t2", "a.tex", 1, "", None), ("t2", "b.tex", 0, "", None)]


def test_papers_segments_carry_their_figures(spark):
    """With pieces of one file: the figure comes with the last piece of its segment, once."""
    from texloom.plans.queries_interleave import D_full
    d, members = _zip_files(spark)
    rows = TK.paper_segments(TK.zipped_segments(TK.zip_in_row(d), FG.figure_places(FG.figure_facts(d), members)), 1)
    got = sorted((r.seg, r.piece, r.text, r.figure and r.figure.caption) for r in rows.where("paper_id = 'p'").collect())
    assert got == [(0, 0, "A0", "c0"), (1, 0, "A1", None), (2, 0, "A2", None), (2, 1, " B0 ", None), (2, 2, "C0", "c2"), (3, 2, "C1", None)]
    whole = D_full(TK.zip_in_row(d), members).where("image is not null")
    assert sorted((r.paper_id, r.seg, r.image, r.archive, r.image_ref) for r in whole.collect()) == [
        ("p", 0, "p_0.png", "t1", "x.png"), ("p", 2, "p_2.png", "t1", "./x.png")]


def test_arguments_after_blanks_and_a_newline(spark):
    tex = ("\\begin{figure}\\includegraphics[width=1cm] {a.png}\\includegraphics[a={[b]}]\n  {p}\\caption {One {two}}"
           "\\label\t\n{l:1}\\end{figure}\\section\n{Title}\\section\n\n{no title}\\includegraphics \n {s.png}")
    d = docs(spark, tex)
    (f,) = figs(spark, tex)
    assert (f.image_ref, f.caption, f.label, f.caption_unparsed) == ("a.png", "One {two}", "l:1", False)
    assert FG.figure_all_images(FG.extract_figures(d)).first().image_refs == ["a.png", "p"]
    rows = TK.token_rows(d).orderBy("pos").collect()
    assert "".join(r.token for r in rows) == tex
    assert [r.kind for r in rows if r.kind != "text"] == ["figure", "section", "image"]
    got = [(r.kind, r.text, r.image_ref) for r in TK.item_rows(TK.interleave(d)).orderBy("pos").collect()]
    assert got == [("figure", None, "a.png"), ("text", "Title", None), ("image", None, "s.png")]


def test_options_hold_brackets_in_braces(spark):
    tex = r"\begin{figure}\includegraphics[alt={x ] y {[}}, w=1]{a.png}\caption[short {]}]{long [x] \} }\end{figure}".replace("\\\\", "\\")
    (f,) = figs(spark, tex)
    assert (f.image_ref, f.caption) == ("a.png", r"long [x] \} ")


def test_titles_of_any_depth(spark):
    for depth in (7, 20, 900):
        title = "a" + "{b" * depth + "}" * depth + " c"
        tex = "x\\section[s]{" + title + "}y } z"
        assert [r.token for r in TK.token_rows(docs(spark, tex)).where("kind = 'section'").collect()] == ["\\section[s]{" + title + "}"]
        assert items(spark, tex)[0][1].startswith(f"x {title} y")


def test_unbalanced_braces_and_marks_in_the_text(spark):
    tex = "} { a\x00b\x01c\x011;d \\section{T\x00\x01} \\{ \\section{open \\includegraphics{p.png}"
    assert "".join(r.token for r in TK.token_rows(docs(spark, tex)).orderBy("pos").collect()) == tex
    got = items(spark, tex)
    assert ("image", None, "p.png", "2301_00001_p.png") in got
    assert any("T\x00\x01" in (t or "") for _, t, _, _ in got) and any("a\x00b\x01c\x011;d" in (t or "") for _, t, _, _ in got)


def test_levels_match_a_stack(spark):
    import random
    import re

    from pyspark.sql import functions as F

    from texloom.functions import latex as L
    r = random.Random(3)
    texts = ["".join(r.choice("{}{}ab\\\x01\x00\n[]") for _ in range(r.randint(0, 400))) for _ in range(60)] + ["", "{" * 5000 + "}" * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", L.marked("t").alias("m"))
    for row in df.select("t", "m", L.plain(F.col("m")).alias("back")).collect():
        assert row.back == row.t
        depth, want = 0, []
        for tok in re.findall(r"(?s)\\.|[{}]", row.t):
            if tok == "{":
                depth += 1
                want.append(depth)
            elif tok == "}":
                want.append(depth)
                depth -= 1
        assert [int(x) for x in re.findall(r"[{}]\x01(-?\d+);", re.sub(r"(?s)\\.", "", row.m))] == want
