"""Helpers for writing the DuckDB oracle SQL text."""

from __future__ import annotations

from ..functions.latex import CAPTION_REST_RE2


def q(s: str) -> str:
    """A SQL string literal (DuckDB keeps backslashes literally)."""
    return "'" + s.replace("'", "''") + "'"


def unnest_pos(list_expr: str, val: str, pos: str = "pos") -> str:
    """Select-list fragment: one row per element with a 0-based position."""
    return f"unnest({list_expr}) AS {val}, unnest(range(len({list_expr}))) AS {pos}"


def clean_sql(expr: str, rules: list[tuple[str, str]]) -> str:
    """The cleaning chain as nested ``regexp_replace`` calls (RE2; ASCII classes)."""
    out = expr
    for pattern, repl in rules:
        if pattern == "SQUEEZE":
            out = f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"
        elif pattern.startswith("(?i)"):
            out = f"regexp_replace({out}, {q(pattern[4:])}, {q(repl)}, 'gi')"
        else:
            out = f"regexp_replace({out}, {q(pattern)}, {q(repl)}, 'g')"
    return out


def ws_sql(x: str) -> str:
    """Outer whitespace stripped."""
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def path_sql(x: str) -> str:
    """An image argument as a path: outer whitespace and one pair of braces go."""
    return ws_sql(f"regexp_replace({ws_sql(x)}, '^\\{{(.*)\\}}$', '\\1', 's')")


def file_sql(x: str) -> str:
    """The view's paths under their normal names."""
    return f"replace(replace(regexp_replace({x}, '^[.]/', ''), 'figs/../', ''), '//', '/')"


def caption_sql(x: str) -> str:
    """First caption of ``x`` by brace balance, NULL when absent or not closed: with the text cut at closing braces, the
    argument ends with the first piece up to which there are as many opening braces as pieces before it."""
    rest = f"regexp_extract({x}, {q(CAPTION_REST_RE2)}, 1)"
    upto = "p[1:k + 1]"
    opens = f"length(array_to_string({upto}, '')) - length(replace(array_to_string({upto}, ''), '{{', ''))"
    ends = (f"list_filter(list_transform(range(0, len(p) - 1), lambda k: CASE WHEN {opens} = k "
            f"THEN length(array_to_string({upto}, '}}')) END), lambda v: v IS NOT NULL)[1]")
    found = (f"list_transform([string_split(regexp_replace({rest}, '\\\\.', 'xx', 'gs'), '}}')], lambda p: {ends})[1]")
    return f"CASE WHEN {found} IS NOT NULL THEN substr({rest}, 1, {found}) END"
