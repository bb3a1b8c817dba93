"""Column -> Column text functions (all JVM-side, no Python UDFs).

Every pattern is a Java regex. ``(?U)`` makes ``\\d \\w \\s`` Unicode-aware and
``(?d)`` makes ``.`` stop only at ``\\n``; together they give the same matches as
Python's ``re`` on ``str`` input, which is what the cleaning rules are written for.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col, let

# The LaTeX cleaning rules, in the order they apply. Each entry is
# (pattern, replacement). The order is part of the contract: later rules see the
# output of earlier ones. Entries 1-9 and 14 form the short chain, 1-17 the full
# chain (a rule that would restore the body of a caption command never fires
# after rule 1 and is left out).
CLEAN_RULES_FULL: list[tuple[str, str]] = [
    (r"\\[a-zA-Z]+", ""),
    (r"\\[^a-zA-Z]", ""),
    (r"\{[^}]*\}", ""),
    (r"\$.*?\$", ""),
    (r"%.*", ""),
    (r"width=[\d.]+", ""),
    (r"[\d.]+pt", ""),
    (r"[\d.]+in", ""),
    (r"[\d.]+em", ""),
    (r",\s*trim=[\d\s]+,\s*clip\s+figures/[\w.]+", ""),
    (r",\s*trim=[\d\s]+\s+figures/[\w.]+", ""),
    (r"(?i)[\w./]+\.(pdf|png|jpg|jpeg|gif|bmp|tiff|svg)", ""),
    (r"trim=[\d\s.]+_?", ""),
    ("SQUEEZE", ""),
    (r"^\s*-\s+", ""),
    (r"^\s*\\\[\s*\\\]\s*", ""),
    ("SQUEEZE", ""),
]
CLEAN_RULES_SHORT: list[tuple[str, str]] = CLEAN_RULES_FULL[:9] + [("SQUEEZE", "")]

_FLAGS = "(?Ud)"

# Rules that open with a run of characters may start at the run's start only. A rule that
# matches from inside a run also matches from its start, so the removed spans are the same;
# but a long run is read once, not once from each of its characters.
RUN_START = {r"[\d.]+": r"(?<![\d.])", r"[\w./]+": r"(?<![\w./])"}
BRACE_GROUP = r"\{[^}]*\}"


def _from_run_start(pattern: str) -> str:
    flags, body = ("(?i)", pattern[4:]) if pattern.startswith("(?i)") else ("", pattern)
    for run, guard in RUN_START.items():
        if body.startswith(run):
            return flags + guard + body
    return pattern


def _drop_brace_groups(c: Column) -> Column:
    """Rule 3 on the text up to its last closing brace: an opening brace after that can close nowhere, and
    would be searched to the end of the text for nothing."""
    upto = F.length(c) - F.instr(F.reverse(c), "}") + 1
    kept = F.when(F.instr(c, "}") > 0, upto).otherwise(F.lit(0))
    return F.concat(F.regexp_replace(c.substr(F.lit(1), kept), _FLAGS + BRACE_GROUP, ""),
                    c.substr(kept + 1, F.length(c)))


def squeeze_ws(c: Column) -> Column:
    """Collapse whitespace runs to one space and strip both ends.

    After the collapse every whitespace run is a single ASCII space, so the
    built-in ``trim`` (spaces only) strips exactly what a regex strip would."""
    return F.trim(F.regexp_replace(c, _FLAGS + r"\s+", " "))


def strip_ws(c) -> Column:
    """Trim all (Unicode) whitespace, like Python's ``str.strip()``."""
    return F.regexp_replace(col(c), _FLAGS + r"^\s+|(?<!\s)\s+$", "")


def strip_left(c) -> Column:
    return F.regexp_replace(col(c), _FLAGS + r"^\s+", "")


def strip_right(c) -> Column:
    return F.regexp_replace(col(c), _FLAGS + r"(?<!\s)\s+$", "")


def clean_text(c, chain: str = "full") -> Column:
    """Apply the cleaning rules in order. ``chain`` is ``"full"`` or ``"short"``."""
    rules = CLEAN_RULES_FULL if chain == "full" else CLEAN_RULES_SHORT
    out = col(c)
    for pattern, repl in rules:
        if pattern == "SQUEEZE":
            out = squeeze_ws(out)
        elif pattern == BRACE_GROUP:
            out = F.element_at(F.transform(F.array(out), _drop_brace_groups), 1)  # evaluates its input once
        else:
            out = F.regexp_replace(out, _FLAGS + _from_run_start(pattern), repl)
    return out


def decode_text(content) -> Column:
    """Bytes -> text: strict UTF-8 (NULL when invalid) and universal newlines."""
    text = F.try_validate_utf8(col(content).cast("string"))
    return F.regexp_replace(text, "\r\n?", "\n")


BEGIN_DOCUMENT = "\\begin{document}"


def document_body(c) -> Column:
    """Text from the first ``\\begin{document}`` on; unchanged when it is absent."""
    def of(text: Column) -> Column:
        return let(F.instr(text, BEGIN_DOCUMENT), lambda at: F.when(at > 0, text.substr(at, F.lit(2_147_483_647))).otherwise(text))

    return let(col(c), of)


def path_basename(p) -> Column:
    return F.regexp_extract(col(p), r"([^/]*)$", 1)


def path_stem(p) -> Column:
    """Path without its last extension (the directory part is kept)."""
    return F.regexp_replace(col(p), r"\.[^./]*$", "")


def path_ext(p) -> Column:
    return F.regexp_extract(col(p), r"(\.[^./]*)$", 1)


def relative_key(p, root) -> Column:
    """Path relative to ``root`` (object key on upload); NULL when outside it.

    ``root`` is a fixed string or a column (a per-row root)."""
    prefix = F.lit(root.rstrip("/") + "/") if isinstance(root, str) else F.concat(col(root), F.lit("/"))
    p = col(p)
    return F.when(p.startswith(prefix), F.substr(p, F.length(prefix) + 1))


def paper_id_stem(name) -> Column:
    """Archive base name without its last extension (``a.tar.gz`` -> ``a.tar``)."""
    return F.regexp_replace(path_basename(name), r"\.[^.]*$", "")


# Fixed value: the paper-id pattern of new-style ids, optional "arXiv-" prefix.
PAPER_ID_PATTERN = r"(?:arXiv-)?(\d+\.\d+)"


def paper_id_regex(name, fallback: str = "stem") -> Column:
    """First ``\\d+.\\d+`` id in the base name; ``fallback`` when none:
    ``"stem"`` (base name without extension), ``"empty"`` or ``"unknown"``."""
    base = path_basename(name)
    found = F.regexp_extract(base, PAPER_ID_PATTERN, 1)
    alt = {"stem": paper_id_stem(name), "empty": F.lit(""), "unknown": F.lit("unknown")}[fallback]
    return F.when(found != "", found).otherwise(alt)


def paper_id_normalize(c) -> Column:
    return F.replace(col(c), F.lit("."), F.lit("_"))


def normalize_path(p) -> Column:
    """A relative path without outer whitespace, ``.`` and empty segments, and with ``a/..`` resolved, as a file
    system resolves it below the archive's root (``./figs//a.png`` and ``x/../figs/a.png`` are ``figs/a.png``)."""
    parts = F.filter(F.split(strip_ws(col(p)), "/"), lambda x: (x != "") & (x != "."))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, x: F.when(
        (x == "..") & (F.size(acc) > 0), F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(x == "..", acc).otherwise(F.array_append(acc, x)))
    return F.array_join(kept, "/")


def strip_braces(c) -> Column:
    """Strip whitespace, then drop one pair of enclosing braces."""
    return F.regexp_replace(strip_ws(col(c)), r"(?s)^\{(.*)\}$", "$1")


def rewrite_extension(c) -> Column:
    """If the value ends in ``.pdf``, replace every ``.pdf`` by ``.png`` (case-sensitive)."""
    c = col(c)
    return F.when(c.endswith(".pdf"), F.replace(c, F.lit(".pdf"), F.lit(".png"))).otherwise(c)


def asset_kind(c, case_sensitive: bool = False) -> Column:
    c = col(c)
    probe = c if case_sensitive else F.lower(c)
    return F.when(probe.endswith(".pdf"), F.lit("pdf")).otherwise(F.lit("raster"))
