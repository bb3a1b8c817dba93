"""Plain versions of the operators, and small tables."""

from __future__ import annotations

import re

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_table(spark, rows):
    """(doc_id, text) or (doc_id, text, source) rows as a table of documents."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, DOCS)


def written(spark, scratch, tables):
    """A folder with the given tables, as the registered queries read them."""
    for name, df in tables.items():
        df.write.parquet(f"{scratch}/{name}.parquet")
    return scratch


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(UPPER, LOWER)))


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def jaccard_components(rows):
    """Per row: (shingles, component id, links)."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))
    links = [0] * len(rows)

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                up[root(a)] = root(b)
    out = []
    for a, (i, _) in enumerate(rows):
        ids = [rows[b][0] for b in range(len(rows)) if root(b) == root(a) and rows[b][0] is not None]
        out.append((i, len(sets[a]), min(ids) if ids and sets[a] else i, links[a]))
    return out


def repeats(texts, size):
    """Per text: flags of the bytes that a repeated string of ``size`` bytes covers."""
    from collections import Counter
    seen = Counter(t[k:k + size] for t in texts for k in range(len(t) - size + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for k in range(len(t) - size + 1):
            if seen[t[k:k + size]] > 1:
                gone[k:k + size] = [True] * size
        out.append(gone)
    return out
