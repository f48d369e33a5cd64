"""Fingerprints by one-permutation MinHash with optimal densification and few bits.

A text's set is the hashes of its five-word shingles. One hash of each shingle
gives a bin (upper bits) and a value (lower bits); a bin keeps its least value.
An empty bin asks the others in a random order of its own and takes the value of
the first full one, which keeps the collision probability that of full bins. ``BITS`` low-order bits of each of ``BINS`` values are packed. Of
two fingerprints a share of 2**-BITS of the bins agrees by chance; the likeness
is the agreeing share with this bias taken out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from boardweave.llm.batches import id_of, mixed, order_id, slices, starts_within, window_hashes, word_hashes, words_of

SHINGLE, BINS, BITS = 5, 512, 4
RANGES = 8  # for each task, so that tasks differ little in size
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


@lru_cache(1)
def _ranks() -> np.ndarray:
    """Row i: the rank of each bin in the random order in which the empty bin i asks the others."""
    cells = mixed(np.arange(BINS * BINS, dtype=np.uint64)).reshape(BINS, BINS)
    return np.argsort(np.argsort(cells, axis=1), axis=1).astype(np.uint16)


def densified(bins: np.ndarray) -> np.ndarray:
    """Rows of least values with every empty bin filled, but for rows that are empty throughout."""
    bins, ranks = bins.copy(), _ranks()
    for row in bins:
        taken = row != _NONE
        full, empty = np.flatnonzero(taken), np.flatnonzero(~taken)
        if len(full) and len(empty):
            row[empty] = row[full[ranks[np.ix_(empty, full)].argmin(axis=1)]]
    bins[bins == _NONE] = 0
    return bins


def fingerprints_of(texts: pa.LargeStringArray) -> np.ndarray:
    """A row of BINS small numbers for each text; of a text with fewer words than a shingle, the whole sequence is one."""
    words = words_of(texts)
    n = np.diff(words.first)
    one = word_hashes(words)
    at = np.flatnonzero(starts_within(words.first, SHINGLE))
    hashes, doc = window_hashes(one, SHINGLE)[at], np.searchsorted(words.first, at, "right") - 1
    for size in range(1, SHINGLE):
        few = np.flatnonzero(n == size)
        if len(few):
            hashes = np.r_[hashes, window_hashes(one, size)[words.first[few]]]
            doc = np.r_[doc, few]
    hashes = mixed(hashes)
    bins = np.full((len(n), BINS), _NONE)
    np.minimum.at(bins.reshape(-1), doc * BINS + (hashes >> np.uint64(55)).astype(np.int64), hashes & np.uint64((1 << 55) - 1))
    return (densified(bins) & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def text_of(row: np.ndarray) -> str:
    """Two bins a byte, as hexadecimal digits."""
    return (row[0::2] << BITS | row[1::2]).astype(np.uint8).tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of rows, 0 to 1."""
    chance = 2.0**-BITS
    return np.clip(((a == b).mean(axis=-1) - chance) / (1 - chance), 0.0, 1.0)


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row; null and wordless texts get zeros."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            rows = fingerprints_of(piece.column("text"))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array([text_of(r) for r in rows], pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def edited(text: str, after: str) -> str:
    """The last half of the code points replaced by the first as many, or all, of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows in order; each is compared with the one after it, a guest row only ends its range."""
    held = None  # the last row of the piece before: id, text, fingerprint

    def out(ids: list, texts: list[str], prints: np.ndarray) -> pa.RecordBatch:
        changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
        other = fingerprints_of(pa.array(changed, pa.large_string()))
        own, after = prints[:-1], prints[1:]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
             pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
             pa.array([text_of(r) for r in own], pa.string()), pa.array([text_of(r) for r in other], pa.string()),
             pa.array(likeness(own, other)), pa.array(likeness(own, after))],
            ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    for piece in slices(batches):
        ids, texts, guest = (piece.column(c).to_pylist() for c in ("id", "text", "guest"))
        prints = fingerprints_of(piece.column("text"))
        if held:
            ids, texts, guest, prints = [held[0], *ids], [held[1], *texts], [False, *guest], np.vstack([held[2], prints])
        begin = 0
        for end in [i for i, g in enumerate(guest) if g]:  # a guest ends a range
            if end > begin:
                yield out(ids[begin : end + 1], texts[begin : end + 1], prints[begin : end + 1])
            begin = end + 1
        if begin < len(ids) - 1:
            yield out(ids[begin:], texts[begin:], prints[begin:])
        held = (ids[-1], texts[-1], prints[-1:]) if not guest[-1] else None


def neighbour_report(docs: DataFrame) -> DataFrame:
    """Each document against its edited text and the next document, by ascending doc_id (after the last: the first).

    Rows without id come last; rows that share one are ordered by text. Ranges
    of ids go to partitions. The row after a range's last is the first of the
    next range that has rows: these, one for each range, are sent as guests too.
    """
    spark = docs.sparkSession
    rows = docs.select(order_id().alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    count = RANGES * tasks
    edges = rows.select("id").agg(F.percentile_approx("id", [i / count for i in range(1, count)] or [0.5], 10 * count)).first()[0]
    edges = sorted(set(edges or []))  # a number that partitions set, whatever the input

    def dealt(order):
        return F.size(F.filter(F.lit(edges).cast("array<long>"), lambda e: e < order)) if edges else F.lit(0)

    rows = rows.withColumn("range", dealt(F.col("id")))
    # First id and text of each range: one row a range, found by an aggregation of narrow rows.
    first = rows.groupBy("range").agg(F.min("id").alias("first_id")).orderBy("range").collect()
    heads = {r["first_id"]: first[i - 1]["range"] for i, r in enumerate(first)}
    guests = rows.where(F.col("id").isin([*heads])).groupBy("id").agg(F.min("text").alias("text"))
    place = F.create_map(*[F.lit(x) for pair in heads.items() for x in pair]) if heads else F.lit(None)
    guests = guests.select("id", "text", (place[F.col("id")] if heads else F.lit(0)).alias("range"), F.lit(True).alias("guest"))
    both = rows.select("id", "text", "range", F.lit(False).alias("guest")).unionByName(guests)
    done = both.repartition(tasks, "range").sortWithinPartitions("range", "guest", "id", "text").mapInArrow(
        _compared, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return done.select(id_of().alias("doc_id"), *[c for c in done.columns if c != "id"])
