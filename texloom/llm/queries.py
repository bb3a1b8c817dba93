"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (  # noqa: F401  (each module registers its query)
    centroid_clusters,
    chat_format,
    decontaminate,
    jaccard_join,
    lm_score,
    source_mix,
    spelling_variants,
    substring_dedup,
    suffix_dedup,
    topk_search,
    toxicity,
    url_filter,
    warc,
)
from ._catalog import ORACLE as _ORACLE
from ._catalog import QUERIES as _QUERIES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = _QUERIES
ORACLE: dict[str, str] = _ORACLE
