"""URL filters: a trie over reversed host labels and path segments, broadcast to the tasks.

``url_filter`` judges every row. The rules (allow and block entries) are built into one trie: the labels
of the host from the last to the first, and at the node of a host the segments of the rule's path. A url
walks down its host's labels, and at each node that has rules down its path's segments; of all rules met on
the way the longest wins (length of host and path; at equal length the longer host; then ``block`` over
``allow``).

A trie is sent to every task, so its size is bounded: up to ``max_rules`` rules and ``max_chars``
characters of rules. Longer lists go through ``url_filter_join``, which looks up every host suffix and path
prefix of a url by an equi-join and gives the same rows.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule and the default
verdict. Every row gives one row, repeated rows included; the columns of the input stay, and a column of the
input named like a column of the result is replaced. An empty rule list gives every row the default.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._catalog import register
from ._cluster import read_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OUT = ("host", "path", "rule", "verdict")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(_after(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def build_trie(rules: Iterable[tuple[str, str, str]]) -> dict:
    """Trie of (verdict, host, path). A node: ``next`` by label, ``paths`` (root of the path trie) or None."""
    root: dict = {"next": {}, "paths": None}
    for verdict, host, path in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"verdict {verdict!r} of {host}{path} is neither allow nor block")
        node = root
        for label in reversed(host.split(".")) if host else ():
            node = node["next"].setdefault(label, {"next": {}, "paths": None})
        node["paths"] = at = node["paths"] or {"next": {}, "ends": {}}
        *whole, rest = path.split("/")
        for segment in whole:  # a segment followed by a slash must match whole
            at = at["next"].setdefault(segment, {"next": {}, "ends": {}})
        # what follows the last slash may go on in the url; block wins a tie
        if at["ends"].get(rest, ("allow",))[0] == "allow":
            at["ends"][rest] = (verdict, host, path)
    return root


def longest_match(trie: dict, host: str, path: str) -> tuple[str, str, str] | None:
    """The longest rule (verdict, host, path) that fits the host or a parent of it, and starts the path."""
    best = None
    segments = path.split("/")
    node, labels = trie, iter(reversed(host.split(".") if host else []))
    while node is not None:
        if (at := node["paths"]) is not None:
            for segment in segments:
                for rest, rule in at["ends"].items() if len(at["ends"]) < 8 else _ends(at["ends"], segment):
                    if segment.startswith(rest) and (best is None or _longer(rule, best)):
                        best = rule
                if (at := at["next"].get(segment)) is None:
                    break
        label = next(labels, None)
        node = node["next"].get(label) if label is not None else None
    return best


def _ends(ends: dict, segment: str) -> Iterator[tuple[str, tuple]]:
    return ((segment[:k], ends[segment[:k]]) for k in range(len(segment) + 1) if segment[:k] in ends)


def _longer(a: tuple, b: tuple) -> bool:
    return (len(a[1]) + len(a[2]), len(a[1])) > (len(b[1]) + len(b[2]), len(b[1]))


def url_filter(df: DataFrame, rules: Sequence[tuple[str, str, str]], url: str = "url", default: str = "allow",
               max_rules: int = 1_000_000, max_chars: int = 64_000_000) -> DataFrame:
    """The rows of ``df`` with host, path, rule and verdict; ``rules``: (allow or block, host, path)."""
    if len(rules) > max_rules or sum(len(h) + len(p) for _, h, p in rules) > max_chars:
        raise ValueError(f"over {max_rules} rules or {max_chars} characters: use url_filter_join")
    trie = df.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        found = [longest_match(trie.value, h, p) for h, p in zip(hosts, paths)]
        return pd.DataFrame({"rule": [None if m is None else m[1] + m[2] for m in found],
                             "verdict": [default if m is None else m[0] for m in found]}, dtype=object)

    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in OUT]
    parts = df.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    judged = parts.withColumn("_judged", judge("host", "path"))
    return judged.select(*kept, "host", "path", "_judged.rule", "_judged.verdict")


def url_filter_join(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """As ``url_filter`` for rules of any number, a table (verdict, host, path).

    A distinct url is looked up once under each of its host suffixes and path prefixes; the longest match per
    url is an aggregation with partial results per task, so a hot host moves few rows.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in OUT]
    parts = df.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rules = rules.groupBy(F.col("host").alias("_h"), F.col("path").alias("_p")).agg(F.max("verdict").alias("_v"))
    labels = F.split("host", r"\.")
    suffixes = F.array_append(F.transform(F.sequence(F.lit(1), F.size(labels)),
                                          lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")), F.lit(""))
    keys = (parts.select("host", "path").distinct()
            .select("host", "path", F.explode(F.array_distinct(suffixes)).alias("_h"))
            .join(rules.select("_h").distinct(), "_h", "left_semi")
            .select("host", "path", "_h", F.explode(F.sequence(F.lit(0), F.length("path"))).alias("_n"))
            .withColumn("_p", F.expr("substring(path, 1, _n)")))
    best = (keys.join(rules, ["_h", "_p"])
            .groupBy("host", "path")
            .agg(F.max_by(F.struct(F.concat("_h", "_p").alias("rule"), F.col("_v").alias("verdict")),
                          F.struct(F.length("_h") + F.length("_p"), F.length("_h"))).alias("_b")))
    judged = parts.join(best, ["host", "path"], "left")
    return judged.select(*kept, "host", "path", F.col("_b.rule").alias("rule"),
                         F.coalesce("_b.verdict", F.lit(default)).alias("verdict"))


#: The rules of the registered query: (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), r(v, h, q) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), m AS (
  SELECT p.page_id, p.host, p.path, r.h || r.q AS rule, r.v
  FROM p LEFT JOIN r ON (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.q)
)
SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, coalesce(arg_max(v, length(rule)), 'allow') AS verdict
FROM m GROUP BY page_id, host, path
"""


@register("op9_url_filter", SQL)
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, RULES).select("page_id", "host", "path", "rule", "verdict")
