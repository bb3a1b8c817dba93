"""LaTeX structure as column expressions: figures, images, captions, labels, tokens.

A regex stands in for a syntax tree. One pass gives every brace the level of its pair (``marked``); commands
then take their options and arguments by back reference to the level: at any depth, after blanks and a newline, and with
``]`` inside the braces of an option. Every pattern avoids repeated capture groups that Java matches recursively (a long
caption would otherwise overflow the JVM stack): repeated groups are possessive, which Java runs in a loop.

``*_RE2`` strings are the same languages in the RE2 dialect, to a fixed depth of braces; the DuckDB oracle uses them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col, let, lit_re, running_sums
from .text import strip_braces, strip_ws

# ---------------------------------------------------------------- patterns
FIGURE = r"(?s)\\begin\{figure\}(.*?)\\end\{figure\}"
FIGURE_RE2 = r"\\begin\{figure\}(.*?)\\end\{figure\}"  # with option 's'

# Between a command and its argument: blanks and at most one newline (an empty line ends the paragraph).
WS = r"[ \t]*(?:\n[ \t]*)?"

# Marked text (``marked``): every brace that is not escaped is followed by MARK, its level and ";". A brace and the one
# that closes it have one level, and no brace between them has it, so a back reference finds the end of an argument
# at any depth.
MARK = "\x01"
_LEVEL = r"\x01(-?\d+);"
_ANY_LEVEL = r"\x01-?\d+;"


def _opt(g: int) -> str:
    """An option in brackets, braces and what they hold taken whole; group ``g``."""
    return rf"(?:{WS}\[(?:[^\]{{}}\\]++|\\.|\{{{_LEVEL}.*?\}}\x01\{g};)*+\])?"


def _arg(g: int) -> str:
    """An argument in braces: its level is group ``g``, its text the next one."""
    return rf"{WS}\{{{_LEVEL}(.*?)\}}\x01\{g};"


def _command(name: str, g: int = 1) -> str:
    """A command with an option and an argument (group ``g + 2``)."""
    return name + _opt(g) + _arg(g + 1)


_GRAPHICS, _SECTION = r"\\includegraphics\*?", r"\\section\*?"
INCLUDEGRAPHICS = "(?s)" + _command(_GRAPHICS)
EPSFIG = "(?s)" + _command(r"\\epsfig")
EPSFBOX = "(?s)" + _command(r"\\epsfbox")
IMAGE = "(?s)" + _command(r"\\[a-z]+\*?")
SECTION = "(?s)" + _command(_SECTION)
ARG = 3
LABEL = r"(?s)\\label" + _arg(1)
LABEL_ARG = 2
# The first caption, closed (group 4 holds its brace) or not.
CAPTION = r"(?s)\\caption" + _opt(1) + rf"{WS}\{{{_LEVEL}(?:(.*?)(\}}\x01\2;)|.*)"
CAPTION_CMD = r"\\caption(?![a-zA-Z])"
_FIGURE_MARKED = r"\\begin\{" + _ANY_LEVEL + r"figure\}" + _ANY_LEVEL + r".*?\\end\{" + _ANY_LEVEL + r"figure\}" + _ANY_LEVEL
_STRUCTURE = [_FIGURE_MARKED, _command(_SECTION, 1), _command(_GRAPHICS, 4), _command(r"\\eps(?:fig|fbox)", 7)]
STRUCTURE = "(?s)" + "|".join(_STRUCTURE)

# One alternation that tiles a document into tokens: figure environments,
# section titles, image commands, then plain text runs and leftover commands
# (a lone backslash at the end included). Repeated groups are possessive, so
# matching is iterative.
TOKEN = STRUCTURE + r"|[^\\]+|\\(?:[a-zA-Z]+|\x01[~z]|.)?"


# The same for RE2, which has no back references: braces to a fixed depth, more than the oracle's documents have.
_BASE_RE2 = r"(?:[^{}\\]|\\.)*"
_BALANCED_RE2 = _BASE_RE2
for _ in range(24):
    _BALANCED_RE2 = _BASE_RE2 + r"(?:\{" + _BALANCED_RE2 + r"\}" + _BASE_RE2 + ")*"
OPT_RE2 = rf"(?:{WS}\[(?:[^\]{{}}\\]|\\.|\{{{_BALANCED_RE2}\}})*\])?"


def _command_re2(name: str, capture: bool = True) -> str:
    inner = f"({_BALANCED_RE2})" if capture else _BALANCED_RE2
    return name + OPT_RE2 + WS + r"\{" + inner + r"\}"


INCLUDEGRAPHICS_RE2 = "(?s)" + _command_re2(_GRAPHICS)
EPSFIG_RE2, EPSFBOX_RE2 = "(?s)" + _command_re2(r"\\epsfig"), "(?s)" + _command_re2(r"\\epsfbox")
SECTION_RE2 = "(?s)" + _command_re2(_SECTION)
IMAGE_TOKEN_RE2 = "(?s)^" + _command_re2(r"\\[a-z]+\*?") + "$"
LABEL_RE2 = r"(?s)\\label" + WS + r"\{(" + _BALANCED_RE2 + r")\}"
CAPTION_REST_RE2 = r"(?s)\\caption" + OPT_RE2 + WS + r"\{(.*)"
TOKEN_RE2 = "|".join([r"\\begin\{figure\}.*?\\end\{figure\}", _command_re2(_SECTION, False), _command_re2(_GRAPHICS, False),
                      _command_re2(r"\\eps(?:fig|fbox)", False), r"[^\\]+", r"\\(?:[a-zA-Z]+|.)?"])  # with option 's'


# ---------------------------------------------------------------- levels
NUL = "\x00"
# Up to and with a brace that is not escaped.
_UP_TO_BRACE = r"(?s)(?:[^{}\\]++|\\.)*+[{}]"


def _escaped(text: Column) -> Column:
    """The text with its own MARK and NUL characters escaped (``text`` should be a lambda variable)."""
    odd = (F.instr(text, MARK) > 0) | (F.instr(text, NUL) > 0)
    return F.when(odd, F.replace(F.replace(text, F.lit(MARK), F.lit(MARK + "~")), F.lit(NUL), F.lit(MARK + "z"))).otherwise(text)


def marked(content) -> Column:
    """The text with a level at every brace (see ``MARK``): one pass over the braces. A MARK or NUL of the text itself is
    escaped, so NUL can part the text later. ``plain`` gives the text back."""
    def pieces(text: Column) -> Column:
        # A last brace ends the last piece; it goes again.
        return F.regexp_extract_all(F.concat(_escaped(text), F.lit(" }")), lit_re(_UP_TO_BRACE), F.lit(0))

    def level(ps: Column) -> Column:
        opens = F.transform(ps, lambda p: F.when(p.endswith("{"), F.lit(1)).otherwise(F.lit(-1)))
        return let(opens, lambda o: let(running_sums(o), lambda depth: F.array_join(F.transform(ps, lambda p, i: F.when(
            i == F.size(ps) - 1, F.substring(p, F.lit(1), F.length(p) - 2)).otherwise(F.concat(
                p, F.lit(MARK), (F.element_at(depth, i + 1) + F.when(F.element_at(o, i + 1) > 0, F.lit(0)).otherwise(F.lit(1))).cast("string"),
                F.lit(";")))), "")))

    return let(let(col(content), pieces), level)


def plain(m: Column) -> Column:
    """Marked text, or a part of it, without its levels."""
    def bare(x: Column) -> Column:
        text = F.replace(F.replace(F.regexp_replace(x, _ANY_LEVEL, ""), F.lit(MARK + "z"), F.lit(NUL)), F.lit(MARK + "~"), F.lit(MARK))
        return F.when(F.instr(x, MARK) > 0, text).otherwise(x)

    return let(m, bare)


# ---------------------------------------------------------------- columns
COMMENT = r"(?d)((?<!\\)(?:\\\\)*)%.*"
COMMENT_RE2 = r"(^|[^\\])((?:\\\\)*)%[^\n]*"  # keeps groups 1 and 2


def strip_comments(content) -> Column:
    r"""Drop ``%`` comments; an escaped ``\%`` stays, and ``\\%`` is a line break and a comment."""
    return F.regexp_replace(col(content), COMMENT, "$1")


def figure_bodies(content) -> Column:
    """Bodies of all ``figure`` environments (not ``figure*``), in order: the text cut at the environments, every second
    part."""
    cut = let(col(content), lambda t: F.split(F.regexp_replace(_escaped(t), FIGURE, NUL + "$1" + NUL), NUL, -1))
    return F.transform(F.filter(cut, lambda _, i: i % 2 == 1), plain)


def _path(c: Column) -> Column:
    """An image argument as a path: outer whitespace and one pair of braces go."""
    return strip_ws(strip_braces(c))


def first_image(m: Column) -> Column:
    r"""Path of the first ``\includegraphics`` of marked text; ``''`` when there is none."""
    return _path(plain(F.regexp_extract(m, INCLUDEGRAPHICS, ARG)))


def has_image(m: Column) -> Column:
    return m.rlike(INCLUDEGRAPHICS)


def image_refs(m: Column) -> Column:
    """Every image path of marked text, repeats included: ``includegraphics``, then ``epsfig``, then ``epsfbox``."""
    parts = [F.regexp_extract_all(m, lit_re(p), F.lit(ARG)) for p in (INCLUDEGRAPHICS, EPSFIG, EPSFBOX)]
    return F.transform(F.concat(*parts), lambda x: _path(plain(x)))


def all_images(m: Column) -> Column:
    """The image paths of marked text, first occurrence kept."""
    return F.array_distinct(F.filter(image_refs(m), lambda x: x != ""))


def caption_or_null(m: Column) -> Column:
    """Raw text of the first caption of marked text, braces kept to any depth; NULL when absent or not closed."""
    return F.when(F.regexp_extract(m, CAPTION, 4) != "", plain(F.regexp_extract(m, CAPTION, 3)))


def label(m: Column) -> Column:
    return plain(F.regexp_extract(m, LABEL, LABEL_ARG))


def has_label(m: Column) -> Column:
    return m.rlike(LABEL)


def section_title(m: Column) -> Column:
    return plain(F.regexp_extract(m, SECTION, ARG))


def image_path(m: Column) -> Column:
    """Path argument of an image command (marked)."""
    return _path(plain(F.regexp_extract(m, IMAGE, ARG)))


def parts(m: Column) -> Column:
    """Marked text cut into plain text runs (even index) and structural commands (odd index), both marked."""
    return F.split(F.regexp_replace(m, STRUCTURE, NUL + "$0" + NUL), NUL, -1)


def tokens(content) -> Column:
    """The document tiled into tokens (see ``TOKEN``)."""
    return F.transform(let(marked(content), lambda m: F.regexp_extract_all(m, lit_re(TOKEN), F.lit(0))), plain)


def token_kind(t: Column) -> Column:
    r"""Kind of a token: figure, section, image or text.

    A structural token always ends with ``}`` (in marked text with its level); a text token that merely starts
    like a command name (``\section`` without a brace) never does.
    """
    closed = t.endswith("}") | t.endswith(";")
    return (
        F.when(t.startswith("\\begin{figure}") | t.startswith("\\begin{" + MARK), F.lit("figure"))
        .when(t.startswith("\\section") & closed, F.lit("section"))
        .when((t.startswith("\\includegraphics") | t.startswith("\\epsfig") | t.startswith("\\epsfbox")) & closed,
              F.lit("image"))
        .otherwise(F.lit("text"))
    )
