"""Shuffles of packed arrays: tasks exchange a few rows with long arrays instead of a row per element."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ._words import mixed


def parts_of(spark: SparkSession) -> int:
    """Number of parts of a packed shuffle: as many as a shuffle has partitions, to be sized with the data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def by_part(df: DataFrame, parts: int) -> DataFrame:
    """Rows of part k to partition k."""
    return df.repartitionById(parts, "part")


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Part of a 64-bit hash: ranges of its upper half."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def home(piece: int, parts: int) -> int:
    """The part that a piece's own rows come back to."""
    return int(mixed(np.array([piece], np.uint64))[0] % np.uint64(parts))


def split_by(part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(stable order of elements by part, elements before each part and after the last)."""
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def groups(frames: Iterable[pd.DataFrame], key: str) -> Iterator[tuple[object, pd.DataFrame]]:
    """(key, rows) of frames that are sorted by a key; a group may go on in the next frames."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        values = frame[key].to_numpy()
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        for a, b in zip([0, *cuts], [*cuts, len(frame)]):
            if held and held[0][key].iloc[0] != values[a]:
                yield held[0][key].iloc[0], pd.concat(held, ignore_index=True)
                held = []
            held.append(frame.iloc[a:b])
    if held:
        yield held[0][key].iloc[0], pd.concat(held, ignore_index=True)
