"""Repeated word sequences across documents, level by level at doubled lengths.

The contract's unit is a window of ``LENGTH`` words. Windows of ``SHORT`` words,
half of it, are compared first, and only at anchors: in each window of
``LENGTH`` words the short window with the least hash. Equal windows have equal
anchors, so no repeat is lost while four fifths of the positions need not move.
Short windows that occur in one document alone end there. The rest are extended
to the full length, and those of them that also start in an earlier document are
the result. ``longest_repeats`` goes on doubling until no candidate survives.

Whole copies of an earlier text are found first, by the hash of the text. A map
task sends of equal windows only those of its earliest document and knows the
others' fate already, and of a window that a document repeats only the first
place, marked: the other places are found again in the text. So the hottest
window reaches its reducer once or twice for each
piece of a few MB of text. Reducers stream over sorted rows and hold no group.
The texts are exchanged once; three joins read that one exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from boardweave.llm.batches import (
    NO_ID, SLICE_BYTES, Words, id_of, joined_hashes, mixed, order_id, slices, starts_within, window_hashes,
    word_hashes, words_of, written)

LENGTH = 13
FURTHER = 1 << 30  # added to a place in place of all further ones with the same window in the same text
_OCCURRENCE = "h long, tag long, id long, spot long"
_PLACE = "id long, spot long, n long"


def _short(length: int) -> int:
    return max(1, length // 2)


def _anchors(words: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Short hashes, starts of windows of ``length`` words, and the least short hash within each of them."""
    short = _short(length)
    h = window_hashes(word_hashes(words), short)
    span = length - short + 1
    least, reach = h, 1
    while reach < span and len(least):
        step = min(reach, span - reach)
        least = np.minimum(least[: max(0, len(least) - step)], least[step:])
        reach += step
    starts = np.flatnonzero(starts_within(words.first, length)[: len(least)])
    return h, starts, least


def _text_check(words: Words) -> np.ndarray:
    """16 bits of each text, to tell rows that share an id."""
    n = np.diff(words.first)
    check = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        # Words alone decide: texts with the same words have the same windows.
        sums = np.add.reduceat(word_hashes(words) * (np.arange(words.first[-1], dtype=np.uint64) - np.repeat(words.first[:-1], n).astype(np.uint64) + np.uint64(1)), words.first[full])
        check[full] = mixed(sums) >> np.uint64(48)
    return check.astype(np.int64)


def _send(h: np.ndarray, tag: np.ndarray, ids: np.ndarray, spot: np.ndarray, doc: np.ndarray, last_level: bool, folded: bool = True) -> Iterator[pa.RecordBatch]:
    """Rows for the reducers, after what this piece alone decides; ``folded``, a window that a text repeats is one row."""
    order = np.lexsort((spot, doc, ids, tag, h))
    h, tag, ids, spot, doc = h[order], tag[order], ids[order], spot[order], doc[order]
    if not len(h):
        return
    new = np.r_[True, (h[1:] != h[:-1]) | (tag[1:] != tag[:-1])]
    group = np.cumsum(new) - 1
    cut = np.flatnonzero(new)
    end = np.r_[cut[1:], len(h)] - 1
    least, most = ids[cut][group], ids[end][group]
    if last_level:  # a later document's window is known to repeat
        known, go = ids > least, ids == least
    else:  # both ends of a repeated group tell the reducer that it has two documents
        known = least != most
        go = ~known | (np.arange(len(h)) == cut[group]) | (np.arange(len(h)) == end[group])
    sent = [x[go] for x in (h, tag, ids, spot)]
    if folded and go.any():
        one = np.r_[True, (group[go][1:] != group[go][:-1]) | (doc[go][1:] != doc[go][:-1])]
        many = np.diff(np.r_[np.flatnonzero(one), len(one)]) > 1
        sent = [x[one] for x in sent]
        # Rows of a group that is decided here stand for themselves: their places are all known.
        sent[3] = sent[3] + np.where(many & ~known[go][one], FURTHER, 0)
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in sent], ["h", "tag", "id", "spot"])
    ids, spot = ids[known], spot[known]
    order = np.lexsort((spot, ids))
    ids, spot = ids[order], spot[order]
    if len(ids):  # as runs of neighbours, dealt out by place
        cut = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (spot[1:] != spot[:-1] + 1)])
        n = np.diff(np.r_[cut, len(ids)])
        deal = mixed(ids[cut].view(np.uint64) ^ mixed(spot[cut].view(np.uint64))).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (deal, -n, ids[cut], spot[cut])], ["h", "tag", "id", "spot"])


def _first_level(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, size=2 * SLICE_BYTES):
            words = words_of(piece.column("text"))
            h, starts, least = _anchors(words, length)
            chosen = np.zeros(len(h), bool)
            for ahead in range(length - _short(length) + 1):
                chosen[starts[h[starts + ahead] == least[starts]] + ahead] = True
            at = np.flatnonzero(chosen)
            doc = np.searchsorted(words.first, at, "right") - 1
            ids = piece.column("id").to_numpy(zero_copy_only=False)[doc]
            yield from _send(h[at].view(np.int64), np.zeros(len(at), np.int64), ids, at - words.first[doc], doc, False)

    return run


def _extended(length: int):
    """Windows of the full length at which an anchor survived."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, size=2 * SLICE_BYTES):
            words = words_of(piece.column("text"))
            h, starts, least = _anchors(words, length)
            alive = np.zeros(len(h) + length, bool)
            lists = piece.column("places")
            sizes = np.diff(lists.offsets.to_numpy())
            places, first = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(words.first[:-1], sizes)
            further = places >= FURTHER
            places = np.where(further, places - FURTHER, places) + first
            inside = places < len(h)  # places of another text with this id may lie beyond
            alive[places[inside]] = True
            if further.any():  # all places of the text with the same short window
                text = mixed(np.searchsorted(words.first, np.arange(len(h)), "right").astype(np.uint64)) ^ h
                alive[: len(h)] |= np.isin(text, text[places[inside & further]])
            keep = np.zeros(len(starts), bool)
            for ahead in range(length - _short(length) + 1):
                keep |= (h[starts + ahead] == least[starts]) & alive[starts + ahead]
            at = starts[keep]
            one = word_hashes(words)
            full = window_hashes(one, length)[at].view(np.int64)
            other = (window_hashes(mixed(one + np.uint64(1)), length)[at] >> np.uint64(32)).astype(np.int64)
            doc = np.searchsorted(words.first, at, "right") - 1
            check = _text_check(words)
            ids = piece.column("id").to_numpy(zero_copy_only=False)[doc]
            yield from _send(full, other, ids, (check[doc] << 32) | (at - words.first[doc]), doc, True)

    return run


def _survivors(last_level: bool):
    """Over rows sorted by (h, tag, id): places that occur in two documents, or that an earlier one has too."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # h, tag, first id of the last group, and whether it has two ids
        held: list[np.ndarray] = []  # of the last group, while it has one id

        def out(ids: np.ndarray, spot: np.ndarray, n: np.ndarray | None = None) -> pa.RecordBatch:
            n = np.ones(len(ids), np.int64) if n is None else n
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(spot), pa.array(n)], ["id", "spot", "n"])

        for batch in batches:
            h, tag, ids, spot = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h", "tag", "id", "spot"))
            run_rows = tag < 0
            if run_rows.any():
                yield out(ids[run_rows], spot[run_rows], -tag[run_rows])
                h, tag, ids, spot = (x[~run_rows] for x in (h, tag, ids, spot))
            if not len(h):
                continue
            new = np.r_[before is None or (h[0], tag[0]) != before[:2], (h[1:] != h[:-1]) | (tag[1:] != tag[:-1])]
            group = np.cumsum(new) - (1 if new[0] else 0)  # group 0 may go on from the batch before
            cut = np.flatnonzero(new)
            first = np.concatenate([np.array([] if new[0] else [before[2]], np.int64), ids[cut]])
            if last_level:
                later = ids > first[group]
                yield out(ids[later], spot[later])
                before = (h[-1], tag[-1], first[-1], True)
                continue
            end = np.r_[cut[1:] if new[0] else cut, len(h)] - 1
            two = ids[end] != first
            if not new[0]:
                two[0] |= before[3]
                if two[0] and held:
                    rest = np.concatenate(held)
                    yield out(np.full(len(rest), before[2]), rest)
                    held = []
            else:
                held = []
            good = two[group]
            yield out(ids[good], spot[good])
            if not two[-1]:
                held.append(spot[group == group[-1]])
            else:
                held = []
            before = (h[-1], tag[-1], first[-1], bool(two[-1]))

    return run


def _level(occurrences: DataFrame, last_level: bool) -> DataFrame:
    dealt = occurrences.repartition("h").sortWithinPartitions("h", "tag", "id")
    return dealt.mapInArrow(_survivors(last_level), _PLACE)


def _base(docs: DataFrame) -> DataFrame:
    return docs.select(order_id().alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def _copies(base: DataFrame) -> DataFrame:
    """(copy_id, copy_hash) of rows whose whole text an earlier row has."""
    rows = base.select("id", F.xxhash64("text").alias("c1"), F.xxhash64(F.lit(1), "text").alias("c2"))
    least = rows.groupBy("c1", "c2").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    again = [F.bitwise_not(F.bitwise_not(c)).alias(f"again_{c}") for c in ("c1", "c2")]  # dealt anew, so that hot texts split
    least = least.select(*again, "least")
    found = rows.join(least, (F.col("c1") == F.col("again_c1")) & (F.col("c2") == F.col("again_c2"))).where("id > least")
    return found.select(F.col("id").alias("copy_id"), F.col("c1").alias("copy_hash")).distinct()


def _is_copy():
    """The hash is no join key: all joins then deal the texts by id alone and share one exchange."""
    return (F.col("id") == F.col("copy_id")) & F.expr("xxhash64(text) ^ copy_hash = 0")


def _covered(base: DataFrame, length: int) -> DataFrame:
    """The base with runs of starts of windows that an earlier document has too, and whether the whole text is a copy."""
    copies = _copies(base)
    single = base.join(copies, _is_copy(), "left_anti")
    short = _level(single.mapInArrow(_first_level(length), _OCCURRENCE), False)
    short = short.select("id", F.explode(F.expr("sequence(spot, spot + n - 1)")).alias("spot"))
    places = short.groupBy("id").agg(F.collect_set(F.col("spot").cast("int")).alias("places"))
    alive = base.join(places.withColumnRenamed("id", "place_id"), F.col("id") == F.col("place_id")).drop("place_id")
    full = _level(alive.mapInArrow(_extended(length), _OCCURRENCE), True)
    runs = full.groupBy(F.col("id").alias("run_id")).agg(F.collect_list(F.struct("spot", "n")).alias("runs"))
    return base.join(runs, F.col("id") == F.col("run_id"), "left").join(copies, _is_copy(), "left").select(
        *base.columns, "runs", F.col("copy_id").isNotNull().alias("copied"))


def _same_windows(words: list[bytes], at: np.ndarray, length: int) -> np.ndarray:
    """Starts of all windows that are equal to those at these places."""
    wanted = {tuple(words[i : i + length]) for i in at.tolist()}
    return np.array([i for i in range(len(words) - length + 1) if tuple(words[i : i + length]) in wanted], np.int64)


def _kept(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, list[tuple[list[bytes], int]]]]:
    """Pieces with, for each text, the words that stay and the number of words."""
    for piece in slices(batches):
        words = words_of(piece.column("text"))
        check = _text_check(words)
        runs, copied = piece.column("runs"), piece.column("copied").to_pylist()
        found = []
        for d, text in enumerate(piece.column("text").to_pylist()):
            own = text.encode().split()
            n = len(own)
            if copied[d] and n >= length:
                own = []
            elif runs[d].is_valid and n >= length:
                flat = runs[d].values
                spot, size = (flat.field(c).to_numpy(zero_copy_only=False) for c in (0, 1))
                mine = (spot >> 32) == check[d]
                change = np.zeros(n + 1, np.int64)
                at, size = spot[mine] & 0xFFFFFFFF, size[mine]
                further = at >= FURTHER
                if further.any():
                    at = np.where(further, at - FURTHER, at)
                    same = _same_windows(own, at[further], length)
                    at, size = np.r_[at, same], np.r_[size, np.ones(len(same), np.int64)]
                np.add.at(change, at, 1)
                np.add.at(change, np.minimum(at + size + length - 1, n), -1)
                own = [own[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
            found.append((own, n))
        yield piece, found


def repeated_word_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row; null texts have no words.

    Rows without id come after all others; rows that share an id are no source for each other.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, found in _kept(batches, length):
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array([n for _, n in found], pa.int64()),
                 pa.array([n - len(own) for own, n in found], pa.int64()),
                 pa.array([hashlib.sha256(b" ".join(own)).hexdigest() for own, _ in found])],
                ["id", "n_words", "n_removed", "kept_sha256"])

    rows = _covered(_base(docs), length).mapInArrow(run, "id long, n_words long, n_removed long, kept_sha256 string")
    return rows.select(id_of().alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def _ordered(base: DataFrame) -> DataFrame:
    """The rows with an id of their own each."""
    shared = written(base.groupBy(F.col("id").alias("shared_id")).count().where("count > 1").select("shared_id"), "shared")
    if shared.isEmpty():
        return base
    same = F.col("id") == F.col("shared_id")
    # Rows equal in id and text are interchangeable: their numbers may be dealt in any order.
    again = base.join(shared, same, "left_semi").withColumn("k", F.row_number().over(Window.partitionBy("id").orderBy(F.xxhash64("text"))))
    moved = F.shiftrightunsigned(F.xxhash64("id", "text", "k"), 2) + F.lit(NO_ID)
    again = again.select(F.when(F.col("k") == 1, F.col("id")).otherwise(moved).alias("id"), *[c for c in base.columns if c != "id"])
    return base.join(shared, same, "left_anti").unionByName(written(again, "again"))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents, all columns kept, without repeated words.

    A text that loses none is unchanged, of others the kept words are joined by
    one space; n_chars, if there, follows. Documents that lose every word go.
    Rows that share an order are sources too: the first by text hash keeps its
    place, the others follow among the rows without id.
    """
    others = [F.col(c) for c in docs.columns if c != "text"]
    base = docs.select(order_id().alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), F.struct(*others).alias("row"))
    base = _ordered(base)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, found in _kept(batches, length):
            stay = np.array([bool(own) or not n for own, n in found], bool)
            texts = [t if len(own) == n else b" ".join(own).decode()
                     for t, (own, n) in zip(piece.column("text").to_pylist(), found, strict=True)]
            batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), piece.column("row")], ["text", "row"])
            yield batch.filter(pa.array(stay))

    schema = T.StructType([T.StructField("text", T.StringType()), base.schema["row"]])
    rows = _covered(base, length).mapInArrow(run, schema)

    def column(name: str):
        if name == "text":
            return F.col("text")
        kind = docs.schema[name].dataType
        return F.length("text").cast(kind).alias(name) if name == "n_chars" else F.col("row").getField(name).alias(name)

    return rows.select(*map(column, docs.columns))


def longest_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, length): the longest of the doubled lengths at which a window of the document stands in another too.

    Windows that repeat at ``length`` are extended to twice that length, and so
    on until no candidate survives; each level is a written table of places. A
    document without a window that repeats has no row.
    """
    base = _base(docs)
    reached, places, n = None, None, length
    while True:
        occurrences = base.withColumn("places", F.lit(None).cast("array<int>")) if places is None else base.join(places, "id")
        found = written(_level(occurrences.mapInArrow(_windows(n), _OCCURRENCE), False), "repeats")
        found = found.select("id", F.explode(F.expr("sequence(spot, spot + n - 1)")).alias("spot"))
        level = found.select("id", F.lit(n).alias("length")).distinct()
        if level.isEmpty():
            break
        reached = level if reached is None else reached.unionByName(level)
        places, n = found.groupBy("id").agg(F.collect_set(F.col("spot").cast("int")).alias("places")), 2 * n
    if reached is None:
        return level.select(id_of().alias("doc_id"), "length")
    return reached.groupBy("id").agg(F.max("length").alias("length")).select(id_of().alias("doc_id"), "length")


def _windows(size: int):
    """Windows of ``size`` words whose two halves both survived the level before, or all at the first level."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            words = words_of(piece.column("text"))
            at = np.flatnonzero(starts_within(words.first, size))
            lists = piece.column("places")
            if lists.null_count < len(lists):
                alive = np.zeros(int(words.first[-1]) + size, bool)
                spots = lists.flatten().to_numpy(zero_copy_only=False) + np.repeat(words.first[:-1], np.diff(lists.offsets.to_numpy()))
                alive[spots[spots < len(alive)]] = True
                at = at[alive[at] & alive[at + size // 2]]
            h = window_hashes(word_hashes(words), size)[at].view(np.int64)
            doc = np.searchsorted(words.first, at, "right") - 1
            yield from _send(h, np.zeros(len(at), np.int64), piece.column("id").to_numpy(zero_copy_only=False)[doc], at - words.first[doc], doc, False, False)

    return run
