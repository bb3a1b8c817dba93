"""Toxicity categories by a chain of linear classifiers.

Categories are predicted in a fixed order. A model is a logistic regression over the presence of words and word
beginnings (hashed), and over the probabilities of all earlier categories. In training these are
out-of-fold: each row's earlier probabilities come from models that were fitted on the other folds, so later
models see them with the errors that they have on new documents.

Fitting: a bounded sample of the labelled rows (``max_rows``, drawn by a hash of the id; all rows where there
are fewer) goes through one task; that is the operator's only sample. Per fit, the features kept are those
whose share among the category's rows differs most from their share among the others (by its standard error).
The model is a fixed number of weights, sent to the tasks; every document is scored over its whole text
without a shuffle.

Defined results: a null or empty text has no features and gets the models' base rates. Rows without a label
take no part in fitting; a label of an id that several documents share counts for each. With no labelled
rows all probabilities are 0 and nothing is rejected. Repeated rows get equal scores; other columns stay, and
those named like a category or ``rejected`` are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _words as W
from ._catalog import register
from ._cluster import read_table

#: Hashed features, kept features per fit, folds, steps of a fit, weight of the squared weights.
BITS, KEPT, FOLDS, STEPS, RIDGE = 19, 3000, 4, 200, 2e-5
MAX_ROWS = 12_000
#: Word beginnings of these lengths in bytes are features beside the whole word.
BEGINNINGS = (4, 5, 6)
#: Common English insults. A labelled toxic row that holds one is of the category ``insult``.
INSULTS = ("clown", "disgusting", "dumb", "fool", "idiot", "jerk", "loser", "moron", "pathetic", "scum", "stupid", "trash",
           "worthless")
CATEGORIES = ("low_quality", "insult", "toxic")
REJECT = ("toxic", 0.3)


# features ----------------------------------------------------------------------------------------------------

def _separators() -> np.ndarray:
    """Per byte: neither a letter or digit of ASCII nor part of another character."""
    sep = np.ones(256, bool)
    for a, b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
        sep[a:b] = False
    return sep


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, texts they are of), repeats included, of pieces of texts as ``_words.texts`` gives them."""
    starts, ends, before = W.word_spans(data, offsets, _separators()[data])
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    _, value, place = W.tables()
    lens = ends - starts
    at = np.cumsum(lens) - lens
    inner = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(at, lens)
    sums = np.zeros(len(inner) + 1, np.uint64)
    np.cumsum(value[data[np.repeat(starts, lens) + inner]] * place[inner & 0xFFFF], out=sums[1:])
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    numbers, owners = [], []
    for k in (*BEGINNINGS, 0):
        some = np.flatnonzero(lens > k) if k else slice(None)
        a, n = at[some], (np.full(len(at[some]), k) if k else lens)
        kind = np.uint64(0x51_7C_C1_B7_27_22_0A_95 if k else 0)
        numbers.append((W.mixed((sums[a + n] - sums[a]) ^ kind) >> np.uint64(64 - BITS)).astype(np.int64) & ~np.int64(1))
        owners.append(owner[some])
    return np.concatenate(numbers), np.concatenate(owners)


def _distinct(numbers: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each feature of a text once, and with its lowest bit turned once more if it occurs again."""
    both, many = np.unique((owners << np.int64(BITS)) | numbers, return_counts=True)
    both = np.sort(np.concatenate([both, both[many > 1] ^ 1]))
    both = both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both
    return both & np.int64((1 << BITS) - 1), both >> np.int64(BITS)


# fitting -----------------------------------------------------------------------------------------------------

def entries(packed: Iterable[bytes]) -> np.ndarray:
    """The feature numbers of packed texts, text after text, in 4 bytes each: with their owners the largest arrays of the fitting task."""
    return np.concatenate([np.frombuffer(b, np.uint32) for b in packed])


def owners_of(packed: Iterable[bytes]) -> np.ndarray:
    lens = [len(b) // 4 for b in packed]
    return np.repeat(np.arange(len(lens), dtype=np.int32), lens)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(numbers: np.ndarray, owners: np.ndarray, extra: np.ndarray, y: np.ndarray, rows: np.ndarray) -> dict:
    """Logistic regression on some rows. ``extra``: dense columns. Returns weights of features, extras and the bias.

    Adam over the whole batch, a fixed number of steps; features that under 5 rows hold are left out."""
    n = len(y)
    inside = np.zeros(n, bool)
    inside[rows] = True
    hit = inside[owners]
    many = np.bincount(numbers[hit], minlength=1 << BITS)
    ofs = np.bincount(numbers[hit & (y > 0)[owners]], minlength=1 << BITS)
    ones, all_ = y[rows].sum(), len(rows)
    if not 0 < ones < all_:
        rate = (ones + 0.5) / (all_ + 1)
        return {"bias": float(np.log(rate / (1 - rate))), "index": np.empty(0, np.int64), "weight": np.empty(0),
                "extra": np.zeros(extra.shape[1])}
    share = many / all_
    score = np.abs(ofs / ones - (many - ofs) / (all_ - ones)) / np.sqrt(share * (1 - share) * (1 / ones + 1 / (all_ - ones)) + 1e-12)
    score[many < 5] = 0
    kept = np.sort(np.argsort(-score, kind="stable")[:KEPT])
    kept = kept[score[kept] > 4]
    column, chosen = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, bool)
    column[kept], chosen[kept] = np.arange(len(kept)), True
    use = hit & chosen[numbers]
    cols, local = column[numbers[use]], np.searchsorted(rows, owners[use])
    del hit, use
    if not len(cols):
        kept, cols, local = kept[:0], np.empty(0, np.int64), np.empty(0, np.int64)
    # the entries by row and by column; sums over runs are faster than counting into places
    held, row_at = np.unique(local, return_index=True)
    by_column = np.argsort(cols, kind="stable")
    local_by_column, column_at = local[by_column], np.searchsorted(cols[by_column], np.arange(len(kept)))
    dense, target = extra[rows], y[rows]
    w = np.zeros(len(kept) + extra.shape[1] + 1)
    w[-1] = np.log(ones / (all_ - ones))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        z = dense @ w[len(kept):-1] + w[-1]
        if len(cols):
            z[held] += np.add.reduceat(w[cols], row_at)
        off = (_sigmoid(z) - target) / all_
        sums = np.add.reduceat(off[local_by_column], column_at) if len(cols) else np.empty(0)
        g = np.concatenate([sums, dense.T @ off, [off.sum()]])
        g[:-1] += RIDGE * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (1 - step / (STEPS + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return {"bias": float(w[-1]), "index": kept, "weight": w[:len(kept)], "extra": w[len(kept):-1]}


def predict(model: dict, numbers: np.ndarray, owners: np.ndarray, extra: np.ndarray) -> np.ndarray:
    weight = np.zeros(1 << BITS)
    weight[model["index"]] = model["weight"]
    return _sigmoid(np.bincount(owners, weight[numbers], minlength=len(extra)) + extra @ model["extra"] + model["bias"])


def fit_chain(numbers: np.ndarray, owners: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> list[dict]:
    """Models of the categories (columns of ``labels``) in their order."""
    rows = np.arange(len(labels))
    earlier = np.zeros((len(labels), 0))
    chain = []
    for y in labels.T.astype(float):
        chain.append(fit(numbers, owners, earlier, y, rows))
        out = np.zeros(len(labels))
        if chain and len(chain) < labels.shape[1]:
            for k in range(FOLDS):
                own = fold == k
                if own.any() and not own.all():
                    out[own] = predict(fit(numbers, owners, earlier, y, rows[~own]), numbers, owners, earlier)[own]
            earlier = np.column_stack([earlier, out])
    return chain


def train(docs: DataFrame, labels: DataFrame, categories: Mapping[str, Callable[[Column], Column]], max_rows: int = MAX_ROWS,
          seed: int = 11) -> list[dict]:
    """The chain, fitted on at most about ``max_rows`` labelled rows.

    ``docs``: doc_id, text. ``labels``: doc_id and what the categories need. ``categories``: name -> function of
    the text column that gives the 0/1 label."""
    total = labels.count()
    share = min(1.0, max_rows / max(1, total))
    drawn = (F.xxhash64("doc_id", F.lit(seed)) / F.lit(2.0**64)) + 0.5
    sample = labels.filter(drawn < F.lit(share))  # about max_rows rows, whatever the table's size
    label = F.array(*[f(F.col("text")).cast("int") for f in categories.values()])
    rows = (docs.join(F.broadcast(sample), "doc_id")
            .select("text", label.alias("y"), F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(FOLDS)).cast("int").alias("fold"),
                    F.xxhash64("doc_id", "text").alias("place"))
            .filter(~F.exists("y", lambda x: x.isNull())))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in W.texts(batch, "text"):
                n = len(offsets) - 1
                numbers, owners = _distinct(*features(data, offsets))
                at = np.searchsorted(owners, np.arange(n + 1))
                packed = [numbers[at[k]:at[k + 1]].astype(np.uint32).tobytes() for k in range(n)]
                cols = [batch.column(k).slice(first, n) for k in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), *cols], ["x", "y", "fold", "place"])

    def fitted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([f for f in frames if len(f)] or [pd.DataFrame(columns=["x", "y", "fold", "place"])], ignore_index=True)
        if not len(rows):
            return
        numbers, owners, y, fold = entries(rows["x"]), owners_of(rows["x"]), np.array(rows["y"].tolist()), rows["fold"].to_numpy()
        del rows
        chain = fit_chain(numbers, owners, y, fold)
        yield pd.DataFrame({"step": range(len(chain)), "bias": [c["bias"] for c in chain], "index": [c["index"].tolist() for c in chain],
                            "weight": [c["weight"].tolist() for c in chain], "extra": [c["extra"].tolist() for c in chain]})

    data = rows.mapInArrow(featured, "x binary, y array<int>, fold int, place long")
    # One task fits the sample, in an order that does not depend on the input's partitions.
    model = data.repartition(1).sortWithinPartitions("place", "x").mapInPandas(
        fitted, "step int, bias double, index array<long>, weight array<double>, extra array<double>")
    return [{"bias": r["bias"], "index": np.array(r["index"], np.int64), "weight": np.array(r["weight"]), "extra": np.array(r["extra"])}
            for r in sorted(model.collect(), key=lambda r: r["step"])]


# scoring -----------------------------------------------------------------------------------------------------

def score(docs: DataFrame, chain: Sequence[dict], names: Sequence[str], reject: tuple[str, float] = REJECT,
          keep_only: bool = False) -> DataFrame:
    """Rows of ``docs`` with a probability per category and ``rejected``; or, with ``keep_only``, the rows that are
    not rejected, in the columns of ``docs``."""
    held = [f for f in docs.schema.fields if keep_only or f.name.lower() not in {*map(str.lower, names), "rejected"}]
    added = [] if keep_only else [T.StructField(n, T.DoubleType()) for n in names] + [T.StructField("rejected", T.BooleanType())]
    which, bound = names.index(reject[0]), reject[1]
    sent = docs.sparkSession.sparkContext.broadcast(list(chain))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = sent.value
        used = np.zeros(1 << BITS, bool)
        for c in chain:
            used[c["index"]] = True
        for batch in batches:
            for first, data, offsets in W.texts(batch, "text"):
                n = len(offsets) - 1
                p = np.zeros((n, len(names)))
                if chain:
                    numbers, owners = features(data, offsets)
                    some = used[numbers] | used[numbers ^ 1]
                    numbers, owners = _distinct(numbers[some], owners[some])
                    for k, model in enumerate(chain):
                        p[:, k] = predict(model, numbers, owners, p[:, :k])
                out = p[:, which] >= bound
                rows = batch.slice(first, n)
                columns = [rows.column(rows.schema.get_field_index(f.name)) for f in held]
                if keep_only:
                    yield pa.RecordBatch.from_arrays(columns, [f.name for f in held]).filter(pa.array(~out))
                else:
                    yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, p.T), pa.array(out)],
                                                     [*(f.name for f in held), *names, "rejected"])

    return docs.select(*[f"`{f.name}`" for f in held], *([] if any(f.name == "text" for f in held) else ["text"])).mapInArrow(
        judge, T.StructType([*held, *added]))


def label_rules() -> dict[str, Callable[[Column], Column]]:
    """Categories of the ``labels`` table (quality, toxic): low quality, toxic with a listed insult, toxic."""
    insult = r"(?i)(?<![\p{L}\p{N}])(?:" + "|".join(INSULTS) + r")(?![\p{L}\p{N}])"
    return {"low_quality": lambda text: F.col("quality") == 0,
            "insult": lambda text: (F.col("toxic") == 1) & F.coalesce(text.rlike(insult), F.lit(False)),
            "toxic": lambda text: F.col("toxic") == 1}


def trained(docs: DataFrame, labels: DataFrame) -> list[dict]:
    return train(docs.select("doc_id", "text"), labels.select("doc_id", "quality", "toxic"), label_rules())


@register("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = trained(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, chain, CATEGORIES).select("doc_id", *CATEGORIES, "rejected")
