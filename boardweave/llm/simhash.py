"""Near-duplicate documents by SimHash fingerprints and Golay-code fuzzy hashing.

Fingerprints of 64 bits link when at most three bits differ. Pigeonhole first:
of four blocks of 16 bits one has no error. The other 48 bits then have three
errors at most, so one of their halves has at most one. 23 bits of a half are
a received word of the perfect (23, 12) Golay code. Decoding it and its 23
neighbours gives one to six codeword indices, and two words one bit apart
share an index. A key is the block, its place, the half and one index: about
42 keys of 28 selective bits for each distinct fingerprint.

Copies collapse before the join. In a bucket of equal keys every pair is
verified, but only a spanning forest of the true links leaves it, so the output
does not grow with the square of a group. A bucket over ``BUCKET`` fingerprints
is not held: its rows go to a second pass that compares it block by block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from boardweave.llm.batches import slices, written
from boardweave.llm.components import components

BUCKET = 1 << 14
SMALL = 32
GENERATOR, DATA_BITS, CHECK_BITS = 0b101011100011, 12, 11  # fixed values of the code


def fingerprint(shingles: np.ndarray) -> int:
    """Bit j is 1 if over half of the hashes have it; 0 without hashes."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = 2 * bits.sum(axis=0, dtype=np.int64) > len(shingles)
    return int(np.packbits(over, bitorder="little").view(np.uint64)[0])


def shingle_hashes(text: str, size: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of ``size`` words, A-Z lower-cased, space-joined; of the whole sequence if it is shorter."""
    words = text.encode().lower().split()
    if len(words) > size:
        runs = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
        return np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(seed)), np.uint64, len(words) - size + 1)
    return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)] if words else [], np.uint64)


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches):
        found = [fingerprint(shingle_hashes(t)) for t in piece.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(np.array(found, np.uint64).view(np.int64))], ["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint as a signed long) of every row; null texts count as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _fingerprints, "doc_id long, fingerprint long")


@lru_cache(1)
def _code() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits, and the error of each syndrome."""
    rest = np.arange(1 << 23, dtype=np.int64)[: 1 << DATA_BITS]

    def syndrome(v: np.ndarray) -> np.ndarray:
        for bit in range(22, CHECK_BITS - 1, -1):
            v = np.where(v >> bit & 1, v ^ (GENERATOR << (bit - CHECK_BITS)), v)
        return v

    low, high = syndrome(rest), syndrome(np.arange(1 << CHECK_BITS, dtype=np.int64) << DATA_BITS)
    one = 1 << np.arange(23, dtype=np.int64)
    two = (one[:, None] | one).ravel()
    errors = np.unique(np.concatenate([[0], (two[:, None] | one).ravel()]))  # weights 0 to 3
    of = np.empty(1 << CHECK_BITS, np.int64)
    of[low[errors & 0xFFF] ^ high[errors >> DATA_BITS]] = errors
    return low, high, of


def codeword_index(received: np.ndarray) -> np.ndarray:
    """Number of the one codeword within three bits of each 23-bit word."""
    low, high, error = _code()
    return (received ^ error[low[received & 0xFFF] ^ high[received >> DATA_BITS]]) >> CHECK_BITS


def nearby_indices(received: np.ndarray) -> np.ndarray:
    """Sorted indices of each word and its 23 neighbours, -1 in place of repeats; words one bit apart share one."""
    around = received[:, None] ^ np.concatenate([[0], 1 << np.arange(23, dtype=np.int64)])
    found = np.sort(codeword_index(around), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``prints`` and the keys they have."""
    rows, keys = [], []
    prints = prints.view(np.uint64)
    for place in range(4):
        shift = np.uint64(16 * place)
        block = ((prints >> shift) & np.uint64(0xFFFF)).astype(np.int64)
        low = prints & ((np.uint64(1) << shift) - np.uint64(1))
        high = (prints >> shift) >> np.uint64(16)
        other = (low | (high << shift)).astype(np.int64)  # the 48 bits without the block
        for half in range(2):
            found = nearby_indices((other >> (24 * half)) & 0x7FFFFF)
            row, column = np.nonzero(found >= 0)
            rows.append(row)
            keys.append(((place * 2 + half) << 28) | (block[row] << DATA_BITS) | found[row, column])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, len(batch), 4096):
            prints = batch.column("fingerprint").slice(begin, 4096).to_numpy(zero_copy_only=False)
            rows, keys = fuzzy_keys(prints)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[rows])], ["key", "fingerprint"])


def near(a: np.ndarray, b: np.ndarray | np.int64, most: int) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= most


def forest(prints: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among a bucket's fingerprints."""
    left, a, b = np.unique(prints), [], []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            close = near(left, x, most)
            if close.any():
                a.append(np.full(int(close.sum()), x))
                b.append(left[close])
                queue.extend(left[close])
                left = left[~close]
    return (np.concatenate(a), np.concatenate(b)) if a else (prints[:0], prints[:0])


_VERIFIED = "key long, u long, v long, block int"


def _rows(key: np.ndarray | None, u: np.ndarray, v: np.ndarray, block: int | None) -> pa.RecordBatch:
    n = len(u)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, pa.int64()) if key is None else pa.array(key), pa.array(u), pa.array(v),
         pa.nulls(n, pa.int32()) if block is None else pa.array(np.full(n, block, np.int32))],
        ["key", "u", "v", "block"])


def _verify(most: int, bucket: int):
    """Over rows sorted by key: links (u, v); of larger buckets the rows with their block, then one row with the number of blocks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held, blocks = None, [], 0  # the bucket that the next batch may go on with

        def close() -> Iterator[pa.RecordBatch]:
            rest = np.concatenate(held) if held else np.zeros(0, np.int64)
            if blocks:
                if len(rest):
                    yield _rows(np.full(len(rest), held_key), rest, rest, blocks)
                yield _rows(np.array([held_key]), np.array([0]), np.array([blocks + bool(len(rest))]), -1)
            elif len(rest) > 1:
                u, v = forest(rest, most)
                yield _rows(None, u, v, None)

        for batch in batches:
            keys, prints = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fingerprint"))
            if not len(keys):
                continue
            cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            size = np.diff(np.r_[cut, len(keys)])
            inner = np.ones(len(cut), bool)  # buckets that lie wholly in this batch
            inner[-1] = False
            if held_key is not None and keys[0] == held_key:
                inner[0] = False
            few = np.repeat(inner & (size <= SMALL), size)
            for gap in range(1, SMALL):
                pair = few[:-gap] & few[gap:] & (keys[:-gap] == keys[gap:]) if gap < len(keys) else np.zeros(0, bool)
                if not pair.any():
                    break
                at = np.flatnonzero(pair)
                at = at[near(prints[at], prints[at + gap], most)]
                yield _rows(None, prints[at], prints[at + gap], None)
            for i in np.flatnonzero(~inner | (size > SMALL)):
                if held_key is None or keys[cut[i]] != held_key:
                    yield from close()
                    held_key, held, blocks = int(keys[cut[i]]), [], 0
                held.append(prints[cut[i] : cut[i] + size[i]])
                while sum(map(len, held)) > bucket:
                    rest = np.concatenate(held)
                    yield _rows(np.full(bucket, held_key), rest[:bucket], rest[:bucket], blocks)
                    held, blocks = [rest[bucket:]], blocks + 1
        yield from close()

    return run


def links(prints: DataFrame, most: int = 3, bucket: int = BUCKET) -> DataFrame:
    """(u, v): links among distinct fingerprints that connect all that ``most`` differing bits connect (0 to 3)."""
    if not 0 <= most <= 3:
        raise ValueError("the keys reach three differing bits")
    keyed = prints.mapInArrow(_keyed, "key long, fingerprint long")
    found = written(
        keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_verify(most, bucket), _VERIFIED), "verified")
    first = found.where("key is null").select("u", "v")
    # Larger buckets: each block meets each other block of its bucket in one task.
    blocks = found.where("block = -1").select("key", F.col("v").alias("blocks"))
    if blocks.isEmpty():
        return first
    many = found.where("block >= 0").join(blocks, "key").select(
        "key", "block", F.col("u").alias("fingerprint"), F.explode(F.expr("sequence(0L, blocks - 1)")).alias("other"))
    met = many.select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("key"), "fingerprint")
    second = met.repartition("key").sortWithinPartitions("key").mapInArrow(_verify(most, 4 * bucket), _VERIFIED)
    return first.unionByName(second.where("key is null").select("u", "v"))


def near_duplicates(docs: DataFrame, most: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    ``component_id`` is the smallest doc_id that links reach, of rows that have
    one; null where the component has none. Texts without words have fingerprint
    zero and link like any other. Rows with equal ids keep their own rows.
    """
    rows = written(fingerprints(docs), "fingerprints")
    each = written(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct")
    found = components(links(each.select("fingerprint"), most))
    member = each.join(found, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    roots = member.groupBy("root").agg(F.min("least").alias("component_id"))
    roots = roots.select(F.bitwise_not(F.bitwise_not("root")).alias("w"), "component_id")
    of = written(member.join(roots, F.col("root") == F.col("w")).select(F.col("fingerprint").alias("print"), "component_id"), "classes")
    return rows.join(of, F.col("fingerprint") == F.col("print")).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
