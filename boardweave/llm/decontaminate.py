"""Benchmark passages in documents, within an edit budget.

An item of m characters may differ by k = m // PIECE - 1 edits. Cut into k + 1
pieces, one piece at least is then intact. All pieces of a block of items stand
in one Aho-Corasick automaton, which reads each text once; around each hit
Myers' bit-parallel distance verifies the item. Case and runs of white space
do not count. Items under ``LEAST`` characters match exactly, between word edges.

Items come in blocks of a stated size, each sent to the tasks by itself: the
documents are read once for each block, and a benchmark of any size keeps tasks
and driver within bounds: of several blocks each one's result is written before
the next is fetched. With one block no document moves.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from boardweave.llm.batches import slices, unused, written

PIECE = 16
LEAST = 25  # items of fewer characters may stand in any longer word; they match only between word edges
BLOCK_CHARS = 2_000_000


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(text: str) -> list[tuple[int, str]]:
    """Budget plus one pieces of nearly equal length, with their offsets."""
    n = max(1, len(text) // PIECE)
    cuts = [i * len(text) // n for i in range(n + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


#: Letters of scripts that are written without spaces have an edge on either side.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def _letter(c: str) -> bool:
    return c.isalnum() or bool(unicodedata.combining(c))


def edge(text: str, place: int) -> bool:
    """Whether no word goes on over this place of the text."""
    if not 0 < place < len(text):
        return True
    a, b = text[place - 1], text[place]
    return not (_letter(a) and _letter(b)) or (not unicodedata.combining(b) and bool(_UNSPACED.match(a) or _UNSPACED.match(b)))


class Pattern:
    """Myers' bit vectors of one item."""

    def __init__(self, text: str) -> None:
        self.size, self.masks = len(text), {}
        for i, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def ends(self, text: str) -> Iterator[int]:
        """For each place of the text, the least distance of the item to a part that ends there."""
        full, top = (1 << self.size) - 1, 1 << (self.size - 1)
        plus, minus, score = full, 0, self.size
        for c in text:
            same = self.masks.get(c, 0)
            vertical = same | minus
            across = (((same & plus) + plus) ^ plus) | same
            up, down = minus | (full & ~(across | plus)), plus & across
            score += bool(up & top) - bool(down & top)
            up, down = (up << 1) & full, (down << 1) & full
            plus, minus = down | (full & ~(vertical | up)), up & vertical
            yield score

    def best(self, text: str) -> tuple[int, int]:
        """The least distance, and the first place after a part that has it."""
        return min((d, i + 1) for i, d in enumerate(self.ends(text)))


class Items:
    def __init__(self, items: tuple[tuple[int | None, str], ...]) -> None:
        self.items = [(i, t) for i, t in ((i, normal(t)) for i, t in items) if t]
        self.forward = [Pattern(t) for _, t in self.items]
        self.backward = [Pattern(t[::-1]) for _, t in self.items]
        self.budget = [max(1, len(t) // PIECE) - 1 for _, t in self.items]
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text) in enumerate(self.items):
            for at, piece in pieces(text):
                places.setdefault(piece, []).append((k, at))
        self.machine = ahocorasick.Automaton()
        for piece, where in places.items():
            self.machine.add_word(piece, (len(piece), where))
        if places:
            self.machine.make_automaton()
        self.any = bool(places)

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, distance, begin, end) of each item's best place in a normal text."""
        if not self.any:
            return []
        seen: dict[int, set[int]] = {}
        found: dict[int, tuple[int, int, int]] = {}
        for last, (size, where) in self.machine.iter(text):
            for k, at in where:
                budget, length = self.budget[k], len(self.items[k][1])
                origin = last + 1 - size - at
                if length < LEAST:
                    if k not in found and edge(text, origin) and edge(text, last + 1):
                        found[k] = (0, origin, last + 1)
                    continue
                if origin in seen.setdefault(k, set()):
                    continue  # another piece of this item has had the same window
                seen[k].add(origin)
                low, high = max(0, origin - budget), min(len(text), origin + length + budget)
                distance, end = self.forward[k].best(text[low:high]) if high > low else (length, 0)
                if distance <= budget:
                    end += low
                    _, back = self.backward[k].best(text[max(0, end - length - budget) : end][::-1])
                    match = (distance, end - back, end)
                    found[k] = min(found.get(k, match), match)
        return [(k, *match) for k, match in sorted(found.items())]


@lru_cache(1)
def _items(items: tuple[tuple[int | None, str], ...]) -> Items:
    return Items(items)


def original_places(text: str) -> list[int]:
    """For each character of normal(text), its place in the text; one more for the end."""
    places, blank = [], False
    for i, c in enumerate(text):
        if c.isspace():
            blank = bool(places)
            continue
        if blank:
            places.append(i - 1)
            blank = False
        places += [i] * len(c.lower())
    return [*places, (places[-1] + 1 if places else 0)]


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> tuple[int, Iterator[tuple[tuple[int | None, str], ...]]]:
    """The number of blocks of about ``block_chars`` characters, and the items of each; a block is fetched when it is asked for."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars) or 1
    if n > 1:
        rows = written(rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))), "items")

    def block(b: int) -> tuple[tuple[int | None, str], ...]:
        own = rows.where(F.col("block") == b) if n > 1 else rows
        return tuple(sorted(((r["item_id"], r["text"]) for r in own.collect()), key=str))

    return n, map(block, range(n))


def _matches_in(items: tuple[tuple[int | None, str], ...]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _items(items)
        for piece in slices(batches):
            rows = []
            for doc, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), strict=True):
                if found := known.find(normal(text)):
                    places = original_places(text)
                    rows += [(doc, known.items[k][0], d, places[a], places[b - 1] + 1 if b else 0) for k, d, a, b in found]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "distance", "start", "end"])

    return run


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, distance, start, end): each document's best place of each item within its budget.

    ``start`` and ``end`` count code points of the original text. Null texts and
    null items match nothing; an item that stands twice is searched once.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n, blocks = item_blocks(benchmark, block_chars)
    found = (rows.mapInArrow(_matches_in(b), "doc_id long, item_id long, distance long, start long, end long") for b in blocks)
    if n == 1:
        return next(found)
    return reduce(DataFrame.unionByName, (written(f, "matches") for f in found))


def without_matches(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents, all columns kept, in which no item of the benchmark stands."""
    n, blocks = item_blocks(benchmark, block_chars)
    if n == 1:
        clean = unused(docs.columns, "clean")
        return docs.withColumn(clean, _is_clean(next(blocks))("text")).where(F.col(clean)).drop(clean)
    # A text decides alone: each block's are written as two hashes before the next block is fetched.
    one, two = unused(docs.columns, "gone1"), unused(docs.columns, "gone2")
    hashes = F.xxhash64("text"), F.xxhash64(F.lit(1), "text")
    gone = (written(docs.select(hashes[0].alias(one), hashes[1].alias(two), "text").where(~_is_clean(b)("text")).select(one, two).distinct(), "unclean")
            for b in blocks)
    return docs.join(reduce(DataFrame.unionByName, gone), (hashes[0] == F.col(one)) & (hashes[1] == F.col(two)), "left_anti")


def _is_clean(items: tuple[tuple[int | None, str], ...]):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        known = _items(items)
        return texts.map(lambda t: t is None or not known.find(normal(t))).astype(bool)

    return clean
