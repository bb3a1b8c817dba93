"""Column -> Column building blocks."""

from . import latex, text  # noqa: F401
from .text import (  # noqa: F401
    asset_kind,
    clean_text,
    decode_text,
    document_body,
    paper_id_normalize,
    paper_id_regex,
    paper_id_stem,
    path_basename,
    path_ext,
    path_stem,
    relative_key,
    rewrite_extension,
    strip_braces,
    strip_ws,
)
