"""Groups of documents by the true similarity of their sets of five-word shingles.

The keys are those of Golay-code fuzzy hashing, as in ``simhash``, for a wider
budget of errors. A text's fingerprint has 256 bits, the signs of the sums of
its shingles' hashes; at a Jaccard similarity of 0.8 about 39 of them differ.
Pigeonhole: some of its ``SEGMENTS`` segments of 23 bits then has few errors,
and two segments with two errors or less always have the index of a codeword in
common, with three or four errors about every second time. Such an index has
12 bits only. A key joins it with the least of the shingles' hashes in an order
of the segment's own, which two sets have in common as often as their
similarity says; hence unlike texts do not meet, however many there are.

Pairs that meet are compared by size and by all 256 bits, and the sets of those
that may be alike are compared exactly. Equal sets are one node throughout.

Of a bucket of equal keys all nodes are first compared with the least one: a
join and not a window, so that a hot bucket is split. Buckets whose nodes are in
one class by then are done. In the others all pairs of different classes are
compared, in blocks of bounded size that hold the sets with 32 bits of each shingle, and
links that connect classes leave a bucket: no more than it has nodes. They are verified like the first.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from boardweave.llm.batches import (ODD, mixed, run_hashes, slices, starts_within, unused, window_hashes, words_of, written)
from boardweave.llm.components import components
from boardweave.llm.simhash import nearby_indices

SHINGLE = 5
LEAST = (4, 5)  # the least similarity
SEGMENTS, SEGMENT, PARTS = 10, 23, 4  # segments of a fingerprint, bits of each, and 64-bit parts
#: Differing bits of 256 that pairs within the least similarity do not exceed: 39 are expected, 48 of the smallest sets, with a deviation of 6.
MOST_BITS = 76
BLOCK = 1 << 10  # nodes of a bucket that are compared with each other at once
FEW = 1 << 20  # rows of longs that are small enough for every executor
ROWS = 1000  # texts in a batch
_PRINT = [f"f{i}" for i in range(PARTS)]
_ANCHOR = [f"a{i}" for i in range(SEGMENTS)]


def shingle_sets(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct runs of ``SHINGLE`` words (A-Z lower-cased) of each text, ascending, text by text, and where each text begins.

    A text with fewer words has its whole sequence as the one shingle.
    """
    words = words_of(texts)
    data = words.data + ((words.data >= 65) & (words.data <= 90)).astype(np.uint8) * np.uint8(32)
    one, n = run_hashes(data, words.start, words.end), np.diff(words.first)
    at = np.flatnonzero(starts_within(words.first, SHINGLE))
    hashes, doc = window_hashes(one, SHINGLE)[at], np.searchsorted(words.first, at, "right") - 1
    for size in range(1, SHINGLE):
        few = np.flatnonzero(n == size)
        if len(few):
            hashes, doc = np.r_[hashes, window_hashes(one, size)[words.first[few]]], np.r_[doc, few]
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    hashes, doc = mixed(hashes[new]), doc[new]
    return hashes, np.searchsorted(doc, np.arange(len(n) + 1))


def nodes_of(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One number for each set: equal for equal sets; 0 for the empty one."""
    sums = np.r_[np.uint64(0), np.cumsum(mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)))]
    sizes = np.diff(first)
    return np.where(sizes > 0, mixed((sums[first[1:]] - sums[first[:-1]]) ^ mixed(sizes.astype(np.uint64))), 0).astype(np.uint64)


def _stamped(hashes: np.ndarray, number: int) -> np.ndarray:
    """Another hash of each shingle, for each number."""
    return mixed(hashes ^ mixed(np.array([number + 1], np.uint64) * ODD))


def prints_of(hashes: np.ndarray, first: np.ndarray, block: int = 1 << 15) -> np.ndarray:
    """A row of ``PARTS`` 64-bit parts for each set: a bit is 1 if over half of the shingles' hashes have it."""
    sizes = np.diff(first)
    ones = np.zeros((len(sizes), 64 * PARTS), np.int64)
    for begin in range(0, len(hashes), block):  # a long text takes several blocks
        part = hashes[begin : begin + block]
        sets = np.searchsorted(first, np.arange(begin, begin + len(part)), "right") - 1
        cut = np.flatnonzero(np.r_[True, sets[1:] != sets[:-1]])
        for i in range(PARTS):
            bits = np.unpackbits(_stamped(part, i).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones[sets[cut], 64 * i : 64 * (i + 1)] += np.add.reduceat(bits, cut, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > sizes[:, None], axis=1, bitorder="little").view(np.uint64).reshape(len(sizes), PARTS)


def anchors_of(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each set and segment, the least hash in the segment's order; 0 for the empty set."""
    full = np.flatnonzero(np.diff(first))
    found = np.zeros((len(first) - 1, SEGMENTS), np.uint64)
    if len(full):
        for i in range(SEGMENTS):
            found[full, i] = np.minimum.reduceat(_stamped(hashes, PARTS + i), first[full])
    return found


def keys_of(prints: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows, and the keys they have: indices of the codewords near each segment, each with the segment's anchor."""
    bits = np.unpackbits(np.ascontiguousarray(prints).view(np.uint8), axis=1, bitorder="little")
    rows, keys = [], []
    for i in range(SEGMENTS):
        received = bits[:, SEGMENT * i : SEGMENT * (i + 1)].astype(np.int64) @ (1 << np.arange(SEGMENT, dtype=np.int64))
        found = nearby_indices(received)
        row, column = np.nonzero(found >= 0)
        rows.append(row)
        keys.append(mixed(anchors[row, i] ^ mixed((found[row, column] << 8 | i).astype(np.uint64))))
    return np.concatenate(rows), np.concatenate(keys)


def _marked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches):
        hashes, first = shingle_sets(piece.column("text"))
        prints, anchors = prints_of(hashes, first).view(np.int64), anchors_of(hashes, first).view(np.int64)
        rest = [c for c in piece.schema.names if c != "text"]
        found = [nodes_of(hashes, first).view(np.int64), np.diff(first), *prints.T, *anchors.T]
        yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in rest), *(pa.array(x) for x in found)], [*rest, "node", "size", *_PRINT, *_ANCHOR])


def _columns(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1).view(np.uint64)


def _keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, len(batch), 2048):
            part = batch.slice(begin, 2048)
            rows, keys = keys_of(_columns(part, _PRINT), _columns(part, _ANCHOR))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(part.column("node").to_numpy(zero_copy_only=False)[rows])], ["key", "node"])


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches):
        hashes, first = shingle_sets(piece.column("text"))
        values = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(hashes.view(np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes_of(hashes, first).view(np.int64)), values], ["node", "shingles"])


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Whole texts go to Python ``ROWS`` at a time, so that a batch of them takes a few MB on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def few(df: DataFrame, rows: int | None = None) -> DataFrame:
    """For a join: sent to every executor if it is small, dealt out by its key otherwise."""
    return F.broadcast(df) if (df.limit(FEW + 1).count() if rows is None else rows) <= FEW else df


def _counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """A written table and its number of rows."""
    found = Observation()
    return written(df.observe(found, F.count("*").alias("n")), label), found.get["n"]


def _again(name: str):
    """The column as an expression: a join then deals this side anew, and may split the other where a key is hot."""
    return F.bitwise_not(F.bitwise_not(name))


def _sizes_fit(a: str, b: str):
    return F.greatest(a, b) * LEAST[0] <= F.least(a, b) * LEAST[1]


def _likely(pairs: DataFrame, nodes: DataFrame) -> tuple[DataFrame, int]:
    """The pairs (u, v) that sizes and fingerprints allow to be alike, and how many there are."""
    out, n = _counted(pairs, "met")
    for end in "uv":
        own = nodes.select(_again("node").alias(f"w{end}"), F.col("size").alias(f"n{end}"), *[F.col(c).alias(c + end) for c in _PRINT])
        out = few(out, n).join(own, F.col(end) == F.col(f"w{end}"))
    differ = sum((F.bit_count(F.col(c + "u").bitwiseXOR(F.col(c + "v"))) for c in _PRINT), F.lit(0))
    return _counted(out.where(_sizes_fit("nu", "nv") & (differ <= MOST_BITS)).select("u", "v"), "pairs")


def _sets_of(ends: DataFrame, n: int, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes in ``ends`` (w), of ``n`` rows, made of one row of each."""
    shown = nodes.join(few(ends, n), F.col("node") == F.col("w"), "left_semi").select(F.col("shown").alias("shown_row"))
    shown, rows = _counted(shown, "shown")
    texts = docs.join(few(shown, rows), F.col("row") == F.col("shown_row"), "left_semi").select("text")
    with _small_batches(docs.sparkSession):
        return written(texts.mapInArrow(_sets, "node long, shingles array<long>").dropDuplicates(["node"]), "sets")


def _verified(pairs: DataFrame, n: int, docs: DataFrame, nodes: DataFrame) -> tuple[DataFrame, int]:
    """The ``n`` pairs (u, v) whose sets are alike, and how many they are."""
    sets = _sets_of(pairs.select(F.col("u").alias("w")).union(pairs.select("v")), 2 * n, docs, nodes)
    a = sets.select(_again("node").alias("wu"), F.col("shingles").alias("a"))
    b = sets.select(F.col("node").alias("wv"), F.col("shingles").alias("b"))
    both = few(pairs, n).join(b, F.col("v") == F.col("wv")).join(a, F.col("u") == F.col("wu"))
    both = both.select("u", "v", (F.size("a") + F.size("b")).alias("n"), F.size(F.array_intersect("a", "b")).alias("both"))
    return _counted(both.where(F.col("both") * sum(LEAST) >= F.col("n") * LEAST[0]).select("u", "v"), "alike")


def _apart(members: DataFrame, found: DataFrame | None) -> DataFrame:
    """(key, node, root) of the buckets whose nodes are in several classes."""
    if found is not None:
        found = few(found.select(_again("node").alias("w"), F.col("root").alias("class")))
        members = members.join(found, F.col("node") == F.col("w"), "left").select("key", "node", F.coalesce("class", "node").alias("root"))
    several = members.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select(_again("key").alias("k"), "low")
    if found is not None:
        several = few(written(several, "several"))
    return members.join(several, F.col("key") == F.col("k")).drop("k")


def _linked(root: np.ndarray, node: np.ndarray, size: np.ndarray, side: np.ndarray, prints: np.ndarray, sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Pairs of alike nodes that connect classes. Nodes of side 0 meet each other, or, if there are nodes of side 1, those."""
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    own = not len(right)
    right = left if own else right
    tree = root.copy()
    for k, i in enumerate(left):
        other = right[k + 1 :] if own else right
        other = other[(tree[other] != tree[i]) & (LEAST[0] * np.maximum(size[other], size[i]) <= LEAST[1] * np.minimum(size[other], size[i]))]
        for j in other[np.bitwise_count(prints[other] ^ prints[i]).sum(axis=1) <= MOST_BITS]:
            if tree[j] != tree[i]:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if both * sum(LEAST) >= LEAST[0] * (size[i] + size[j]):
                    tree[tree == tree[j]] = tree[i]
                    yield int(min(node[i], node[j])), int(max(node[i], node[j]))


def _within():
    """Over rows sorted by cell: the links of each cell, of ``BLOCK`` rows and a little more at most."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # of the cell that the next batch may go on with
        names = ["cell", "root", "node", "size", "side"]
        for batch in batches:
            if not len(batch):
                continue
            cell, *rest = (batch.column(c).to_numpy(zero_copy_only=False) for c in names)
            lists = batch.column("shingles")
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            sets = [np.sort(flat[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)]
            rest.append(_columns(batch, _PRINT))
            cut = np.r_[np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]), len(cell)]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if held and held[-1][0] != cell[a]:
                    yield closed(held)
                    held = []
                held.append((cell[a], *(x[a:b] for x in rest), sets[a:b]))
        if held:
            yield closed(held)

    def closed(held: list[tuple]) -> pa.RecordBatch:
        *columns, sets = [*zip(*held, strict=True)][1:]
        found = [*_linked(*(np.concatenate(x) for x in columns), [x for part in sets for x in part])]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["u", "v"])

    return run


def _met(apart: DataFrame, n: int, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (u, v) of different classes within the buckets. A bucket's nodes are dealt into blocks of about half of ``BLOCK``."""
    many = apart.groupBy("key").agg(F.ceil(F.count("*") / (BLOCK // 2)).cast("long").alias("blocks")).select(_again("key").alias("k"), "blocks")
    short = F.transform("shingles", lambda x: F.shiftright(x, 32).cast("int"))
    sets = _sets_of(apart.select(F.col("node").alias("w")), n, docs, nodes).select(_again("node").alias("of"), short.alias("shingles"))
    own = nodes.select(_again("node").alias("w"), "size", *_PRINT)
    rows = few(apart, n).join(own, F.col("node") == F.col("w")).join(few(written(many, "many")), F.col("key") == F.col("k"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", "key"), F.col("blocks")))
    # Each block meets itself and each other block of its bucket in a cell of its own.
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    cell = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
    rows = rows.select(cell.alias("cell"), "root", "node", F.col("size").cast("long"), (F.col("block") > F.col("other")).cast("long").alias("side"), *_PRINT)
    rows = rows.join(sets, F.col("node") == F.col("of")).drop("of")
    return rows.repartition("cell").sortWithinPartitions("cell", "side", "node").mapInArrow(_within(), "u long, v long").distinct()


def classes(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, root) of nodes with others: the least node that links reach. All pairs of a similarity of 0.8 or more that have a key in common are connected.

    ``docs`` has ``row`` and ``text``; ``nodes`` is one row of each distinct set, with ``shown``, the row of a document that has it.
    """
    keyed = nodes.where("size > 0").mapInArrow(_keyed, "key long, node long")
    members = written(_apart(keyed.withColumn("root", F.col("node")), None), "buckets")
    star = members.where("node != low").select(F.col("low").alias("u"), F.col("node").alias("v")).distinct()
    tried, n = _likely(star, nodes)
    alike, _ = _verified(tried, n, docs, nodes)
    found = components(alike, FEW)
    members = members.select("key", "node")
    apart, left = _counted(_apart(members, found).drop("low"), "apart")
    if left:
        new, n = _counted(_met(apart, left, docs, nodes), "pairs")
        more, n = _verified(new, n, docs, nodes)
        if n:
            found = components(alike.union(more), FEW)
    return found


def groups(docs: DataFrame) -> DataFrame:
    """Every row with its columns but ``text``, and ``group``: equal for rows that similar texts connect.

    A column ``row`` of longs identifies rows, and equal rows may share it; without
    one the hash of the text does. Null texts count as empty; texts without words
    are alike. Other columns are not read; an empty table has an empty result.
    """
    rest = unused(docs.columns, "w")
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    if "row" not in docs.columns:
        return groups(docs.withColumn("row", F.xxhash64("text"))).drop("row")
    kept = docs.drop("text")
    added = ["node long", "size long", *[f"{c} long" for c in [*_PRINT, *_ANCHOR]]]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), *added])
    with _small_batches(docs.sparkSession):
        rows = written(docs.mapInArrow(_marked, schema), "nodes")
    one = [F.first(c).alias(c) for c in ["size", *_PRINT, *_ANCHOR]]
    nodes = written(rows.groupBy("node").agg(F.first("row").alias("shown"), *one), "distinct")
    found = classes(docs, nodes).select(_again("node").alias(rest), F.col("root").alias("root"))
    return rows.join(found, F.col("node") == F.col(rest), "left").select(*kept.columns, F.coalesce("root", "node").alias("group"))
