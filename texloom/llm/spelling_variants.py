"""Spelling variants of a vocabulary by sorted rotations.

1. A word with a terminator is rotated so that its letter at place i comes last: ``rest of the word | terminator |
   beginning`` and then the letter. Words that differ from it only in that letter have the same rotation up to the last
   character. A word that lacks the letter has that very prefix as a whole rotation of its own. So every word gives, per
   letter, an entry (prefix, letter), and per place between letters an entry (prefix, no letter).
2. Entries are shuffled by prefix and sorted by prefix, then falling count. Each range of equal prefixes is a group, and one
   scan finds per entry how many others of its group are near and which of them has the largest count. Only these two
   facts are emitted, no pairs.
3. A letter within a run of the same letter can be left out at several places with the same result. Only the run's first place
   counts, that is a letter that differs from the last character of the prefix. So every near pair meets in exactly
   one group, and the facts of a word's groups add up.
4. Links from words to forms are followed by pointer doubling. A form has at least ten times the count, so there are no
   circles.

A group holds at most one word without a letter (the prefix is that word, rotated) and one word per letter of the alphabet,
whatever the data: no group grows with the input. Counting words is partially aggregated, in tasks and before the shuffle.

Defined results: a null text has no runs; a null id reads as the empty string in the hash (``:run``); rows that repeat
count each. Letters are a-z and U+00C0 to U+00FF (with the two signs among them), compared as they are: only A-Z
are lower-cased. Forms that tie in count go to the first in code-point order. Other columns are ignored; an empty table gives no
rows. A text is worked through in overlap-free pieces that end between runs, so memory does not grow with its length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._catalog import register
from ._cluster import cut, read_table

LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A form has so many times the count of its variant.
TIMES = 10
#: One in so many (document, run) pairs loses a letter.
ONE_IN = 31
LETTERS = "A-Za-zÀ-ÿ"
#: Different words that a task counts before it hands them on.
HELD = 1 << 18
#: Characters of a text that are searched at once.
PIECE = 1 << 22
#: Comes after every letter and before no other character of a word.
TERMINATOR = "$"


# words -------------------------------------------------------------------------------------------------------

def runs(text: str, least: int, piece: int = PIECE) -> Iterator[str]:
    """Maximal runs of letters of at least so many, piece by piece; a piece ends after a run."""
    run, rest = re.compile(f"[{LETTERS}]{{{least},}}"), re.compile(f"[{LETTERS}]*")
    at = 0
    while at < len(text):
        end = rest.match(text, min(at + piece, len(text))).end()
        yield from run.findall(text, at, end)
        at = end


def document_words(doc_id: int | None, text: str, least: int = LEAST_LENGTH) -> Counter:
    """The words of a document with their counts, as Latin-1 bytes (a letter is a byte)."""
    out: Counter = Counter()
    start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    lowered: Counter = Counter()
    for run, n in Counter(runs(text, least)).items():
        lowered[run.encode("latin-1").lower()] += n  # of bytes: A-Z only
    for word, n in lowered.items():
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
        if h % ONE_IN == 0:
            k = h % len(word)
            word = word[:k] + word[k + 1:]
            if len(word) < least:
                continue
        out[word] += n
    return out


def count_words(docs: DataFrame, least: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, held: int = HELD) -> DataFrame:
    """word, n of the words of doc_id, text."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in found], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(found.values()), pa.int64())], ["word", "n"])

        found: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if text.is_valid:
                    found.update(document_words(doc_id, text.as_py(), least))
                if len(found) >= held:
                    yield rows()
                    found.clear()
        if found:
            yield rows()

    return (docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count))


# rotations ---------------------------------------------------------------------------------------------------

def rotations(words: DataFrame) -> DataFrame:
    """prefix, letter (empty: none), n: the entries of the words (word, n)."""
    length = F.length("word")
    place = F.explode(F.sequence(F.lit(0), length)).alias("place")
    at = words.select("word", "n", place)
    before = F.concat(F.lit(TERMINATOR), F.substring("word", F.lit(1), F.col("place")))
    whole = F.concat(F.substring("word", F.col("place") + 1, length), before)
    skipped = F.concat(F.substring("word", F.col("place") + 2, length), before)
    # the place after the last letter has no letter to leave out
    kinds = F.array(F.struct(whole.alias("prefix"), F.lit("").alias("letter")),
                    F.struct(F.when(F.col("place") < length, skipped).alias("prefix"),
                             F.substring("word", F.col("place") + 1, F.lit(1)).alias("letter")))
    return at.select("n", F.inline(kinds)).filter("prefix is not null")


def _words_of(prefix: list[str], letter: list[str]) -> list[str]:
    """The words of entries."""
    out = []
    for p, c in zip(prefix, letter):
        end, _, begin = p.partition(TERMINATOR)
        out.append(begin + c + end)
    return out


def scan(prefix: pa.Array, letter: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per entry of whole groups, sorted by prefix, then falling count, then word: (near entries of its group, the
    place of the first of them or -1)."""
    size = len(prefix)
    opens = np.ones(size, bool)
    if size > 1:
        opens[1:] = pc.not_equal(prefix.slice(1), prefix.slice(0, size - 1)).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(opens)
    ends = np.append(starts[1:], size)
    group = np.cumsum(opens) - 1
    none = pc.equal(letter, "").to_numpy(zero_copy_only=False)
    # the letter goes on a run that the prefix ends with: left out, it gives the word that the run's first place gives
    again = pc.equal(letter, pc.utf8_slice_codeunits(prefix, -1)).to_numpy(zero_copy_only=False) & ~none
    lone, twin = np.full(len(starts), -1), np.full(len(starts), -1)  # at most one of each in a group
    lone[group[none]] = np.flatnonzero(none)
    twin[group[again]] = np.flatnonzero(again)
    barred = np.where(none, twin[group], np.where(again, lone[group], -1))
    at = np.arange(size)
    near = (ends - starts)[group] - 1 - (barred >= 0)
    best = np.full(size, -1)
    for k in range(3):  # one of the first three is neither the entry nor the one barred from it
        place = starts[group] + k
        ok = (best < 0) & (place < ends[group]) & (place != at) & (place != barred)
        best[ok] = place[ok]
    return near, best


FACTS = "word string, near long, form string, form_n long"


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by prefix -> per entry with near ones its word, their number, and the first of them."""
    def found(table: pa.Table) -> pa.RecordBatch | None:
        prefix = table.column("prefix").combine_chunks()
        same = pc.equal(prefix.slice(1), prefix.slice(0, len(prefix) - 1)).to_numpy(zero_copy_only=False)
        many = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        if not many.any():
            return None
        table = table.filter(pa.array(many))
        prefix, letter, n = (table.column(c).combine_chunks() for c in ("prefix", "letter", "n"))
        words = _words_of(prefix.to_pylist(), letter.to_pylist())
        count = n.to_numpy()
        ranks = pc.rank(prefix, tiebreaker="dense").to_numpy()
        order = pa.array(np.lexsort((pc.rank(pa.array(words), tiebreaker="dense").to_numpy(), -count, ranks)))
        prefix, letter, count, named = prefix.take(order), letter.take(order), count[order], pa.array(words).take(order)
        near, best = scan(prefix, letter)
        keep = near > 0
        picked = pa.array(best[keep])
        return pa.RecordBatch.from_arrays([named.filter(pa.array(keep)), pa.array(near[keep]), named.take(picked), pa.array(count[best[keep]])],
                                          ["word", "near", "form", "form_n"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        last = table.column("prefix")[len(table) - 1]
        # the last group may go on; groups are as small as the alphabet, so it begins among the last few rows
        tail = pc.equal(table.column("prefix"), last).to_numpy().argmax()
        if tail and (rows := found(table.slice(0, int(tail)))) is not None:
            yield rows
        held = table.slice(int(tail)).to_batches()
    if held and (rows := found(pa.Table.from_batches(held))) is not None:
        yield rows


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, and the near word of the largest count (form, form_n) of the words that have one."""
    entries = rotations(words).repartition("prefix").sortWithinPartitions("prefix")
    best = F.min(F.struct((-F.col("form_n")).alias("m"), F.col("form").alias("w")))
    return (entries.mapInArrow(_facts, FACTS).groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", F.col("b.w").alias("form"), (-F.col("b.m")).alias("form_n")))


def roots(links: DataFrame) -> DataFrame:
    """word, root: links (word, form) followed to their end. Each step doubles how far a link reaches; ends when none
    moves, after a few steps, since a form has ``TIMES`` times the count."""
    links = cut(links.select("word", F.col("form").alias("root")))
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = cut(links.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                          F.col("further").isNotNull().alias("went")))
        links = moved.select("word", "root")
        if moved.filter("went").isEmpty():
            return links


def spelling_variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words (word, n)."""
    words = cut(words)
    found = words.join(near_words(words), "word", "left")
    frequent = F.col("form_n") >= times * F.col("n")
    named = cut(found.select("word", F.when(frequent, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                             F.when(frequent, F.col("form_n")).alias("form_n")))
    ends = roots(named.filter("form is not null"))
    return (named.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


#: crc32 as a fold over bits (reflected polynomial); the words by the contract, pairs by edit distance.
SQL = f"""
WITH RECURSIVE t AS (
  SELECT list(list_reduce(list_prepend(CAST(k AS UBIGINT), CAST(range(8) AS UBIGINT[])),
    lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, CAST(3988292384 AS UBIGINT)) ELSE a // 2 END) ORDER BY k) AS crc
  FROM range(256) AS r(k)
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), each AS (
  SELECT id, run, count(*) AS n, string_split(id || ':' || run, '') AS chars FROM runs WHERE length(run) >= {LEAST_LENGTH} GROUP BY id, run
), bytes AS (
  SELECT run, n, flatten(list_transform(chars, lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64] END)) AS b
  FROM each
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), CAST(b AS UBIGINT[])),
    lambda a, x: xor(a // 256, t.crc[CAST(xor(a % 256, x) AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT)) AS h
  FROM bytes, t
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % {ONE_IN} = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n
    FROM hashed) GROUP BY word HAVING length(word) >= {LEAST_LENGTH} AND sum(n) >= {LEAST_COUNT}
), cuts AS (
  SELECT DISTINCT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)
), near AS (
  SELECT DISTINCT a.word AS word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION SELECT DISTINCT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT DISTINCT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= {TIMES} * w.n THEN b.m END AS form_n,
         CASE WHEN b.m >= {TIMES} * w.n THEN (SELECT min(x.other) FROM near x WHERE x.word = w.word AND x.m = b.m) END AS form
  FROM words w LEFT JOIN best b ON b.word = w.word
), chain AS (
  SELECT word, word AS tip, 0 AS steps FROM forms
  UNION ALL SELECT chain.word, forms.form, steps + 1 FROM chain JOIN forms ON forms.word = chain.tip WHERE forms.form IS NOT NULL
)
SELECT f.word, f.form, (SELECT arg_max(tip, steps) FROM chain WHERE chain.word = f.word) AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM forms f
"""


@register("op13_spelling_variants", SQL)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(count_words(read_table(spark, sf_dir, "documents")))
