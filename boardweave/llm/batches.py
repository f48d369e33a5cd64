"""Arrow batches of texts as flat arrays, and steps shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from boardweave.plans.session import fresh_dir

SLICE_BYTES = 1 << 21
NO_ID = 1 << 62  # in orders, rows without an id come from here on; ids are smaller
#: The word rule of all operators: runs of bytes other than space, tab and the four line controls.
GAPS = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
ODD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` from a table in the shared folder: computed once, and safe when executors go."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def order_id(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The id; rows without one follow all others, each at a place that its text gives."""
    return F.coalesce(F.col(doc_id).cast("long"), F.shiftrightunsigned(F.xxhash64(text), 2) + F.lit(NO_ID))


def id_of(order: str = "id") -> Column:
    return F.when(F.col(order) < NO_ID, F.col(order))


def unused(columns: Iterable[str], stem: str) -> str:
    """A column name that is in no table of these columns."""
    taken = {c.lower() for c in columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of the batches with about ``size`` bytes of text each, and one row at least; no null texts."""
    for batch in batches:
        place = batch.schema.get_field_index(text)
        column = batch.column(place).cast(pa.large_string()).fill_null("")
        batch = batch.set_column(place, text, column)
        ends = offsets_of(column)[1:]
        begin = 0
        while begin < len(ends):
            reach = (ends[begin - 1] if begin else offsets_of(column)[0]) + size
            end = max(begin + 1, int(np.searchsorted(ends, reach, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def offsets_of(column: pa.LargeStringArray) -> np.ndarray:
    if not len(column):
        return np.zeros(1, np.int64)
    return np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]


def bytes_of(column: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts one after another, and where each text begins (one more entry for the end)."""
    offsets = offsets_of(column)
    held = column.buffers()[2] if len(column) else None
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words(NamedTuple):
    """``data[start[i]:end[i]]`` is word i; ``first[d]`` to ``first[d + 1]`` are the words of text d."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def words_of(column: pa.LargeStringArray) -> Words:
    data, offsets = bytes_of(column)
    gap = GAPS[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = True
    before[1:] = gap[:-1]
    after = np.empty(len(data), bool)
    after[-1:] = True
    after[:-1] = gap[1:]
    start = np.flatnonzero(~gap & (before | edge[:-1]))
    end = np.flatnonzero(~gap & (after | edge[1:])) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def run_hashes(units: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``units[start:end]``; the runs are in order and not empty."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    powers = np.cumprod(np.full(int(length.max()), ODD, np.uint64))
    first = np.cumsum(length) - length
    within = np.arange(int(length.sum())) - np.repeat(first, length)
    values = (units[within + np.repeat(start, length)].astype(np.uint64) + np.uint64(1)) * powers[within]
    return mixed(np.add.reduceat(values, first) ^ (length.astype(np.uint64) << np.uint64(56)))


def word_hashes(words: Words) -> np.ndarray:
    return run_hashes(words.data, words.start, words.end)


def joined_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of each pair, in this order."""
    return mixed(left * ODD + (right ^ (right >> np.uint64(32))))


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` neighbours, by doubling; entry i begins at i, the last ``size - 1`` are missing."""
    reach = 1
    while reach < size and len(h):
        step = min(reach, size - reach)
        h = joined_hashes(h[: max(0, len(h) - step)], h[step:])
        reach += step
    return h


def starts_within(first: np.ndarray, size: int) -> np.ndarray:
    """Marks the words at which a window of ``size`` words of one text begins."""
    left = np.repeat(first[1:], np.diff(first)) - np.arange(first[-1])
    return left >= size
