"""How the tokens of two tokenizers overlap, and in how many documents each pair of ids is linked.

Both tokenizers see a space and the text. Neither joins what stands before a
space that follows a sign other than white space with what stands after it, so a text falls into units at such spaces. Each
distinct unit is encoded and aligned once by a worker; a text is its units one
after another. That holds for byte-level pieces cut by the usual pattern and for pieces that
have their space mark in front; tests compare it with whole texts.

Each document is aligned once. Its sums and digest are stored with its links: the
distinct pairs and how often it links each, packed. From these come the pairs of each task with the
number of its documents that link them. The distinct pairs get a minimal perfect
hash function, in shards of bounded size: levels of bits, in which a pair owns
the bit that no other pair of its level hit, and is as many as owned bits come before it. Counts are dense vectors in this order, one for each
shard and some tasks, summed like a tree: ``FAN`` vectors become one until one
is left. The key of each place is kept and compared when it is looked up.

At last the pairs of the stored links are looked up, without the texts. Functions and
vectors of ``BLOCK`` pairs at most go to the workers at once; the stored links of a corpus with
more distinct pairs are passed over once for each block.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from boardweave.llm.batches import mixed, slices, written

SHARD = 1 << 17  # pairs of a hash function, about
BLOCK = 1 << 22  # pairs that workers hold at once
FAN = 4  # vectors that are summed at once
HELD = 1 << 21  # pairs that a task gathers before it sends them
READ = 1 << 18  # pairs of stored links that are unpacked at once, and one document
SEGMENT = 1 << 20  # characters of a text whose units are held at once
CACHE = 1 << 23  # characters of the units that a worker remembers
B_BITS = 20  # a pair is the first id shifted by these, and the second one
_CUT = re.compile(r"(?<=\S) ")
_MIXED = re.compile(r"\s ")
#: Units that are encoded together: any signs below U+0250 but white space, controls and the like.
_JOINED = re.compile(r"\S\Z")
_PLAIN = re.compile(r"[!-~\u00a1-\u00ac\u00ae-\u024f]+")


def units_of(text: str) -> list[str]:
    """The parts of a text between single spaces that follow another sign than white space; each stands for a space and itself."""
    return _CUT.split(text) if text[:1] == " " or _MIXED.search(text) else text.split(" ")


def segments_of(text: str) -> Iterator[str]:
    """A text in pieces that begin at a unit, so that no more than about ``SEGMENT`` characters are cut at once."""
    begin = 0
    while len(text) - begin > SEGMENT and (cut := _CUT.search(text, begin + SEGMENT)):
        yield text[begin : cut.start()]
        begin = cut.end()
    yield text[begin:] if begin else text


class _Grown:
    """An array that grows at its end."""

    def __init__(self) -> None:
        self.data, self.size = np.zeros(1024, np.int64), 0

    def add(self, more: np.ndarray) -> None:
        while self.size + len(more) > len(self.data):
            self.data = np.r_[self.data, np.zeros_like(self.data)]
        self.data[self.size : self.size + len(more)] = more
        self.size += len(more)


class Aligned(NamedTuple):
    """The sums of a text's units, the digest of its groups, its distinct pairs in order and how often it links each."""

    sums: dict[str, int]
    sha256: str
    pairs: np.ndarray
    times: np.ndarray


def _counted(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones in order, and how often each is there."""
    pairs = np.sort(pairs)
    cut = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]][: len(pairs)])
    return pairs[cut], np.diff(cut, append=len(pairs))


def _summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of all parts in order, and the sum of each one's numbers."""
    pairs, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(pairs, kind="stable")
    pairs = pairs[order]
    cut = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]][: len(pairs)])
    return pairs[cut], np.add.reduceat(counts[order], cut) if len(cut) else counts


def packed(pairs: np.ndarray, times: np.ndarray) -> bytes:
    """Links as bytes: the steps from pair to pair and the numbers, byte by byte of equal weight, compressed."""
    steps = np.diff(pairs, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8)
    return zstandard.compress(steps.T.tobytes() + times.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(links: bytes) -> tuple[np.ndarray, np.ndarray]:
    held = np.frombuffer(zstandard.decompress(links), np.uint8).reshape(12, -1)
    return np.cumsum(np.ascontiguousarray(held[:8].T).view("<i8").ravel()), np.ascontiguousarray(held[8:].T).view("<u4").ravel().astype(np.int64)


class Aligner:
    """Encodes and aligns units, and remembers them.

    For each unit: 0 or 1 whether the bytes of both rows are those of the unit,
    the numbers of tokens, groups and links, and the pairs that it links.
    Most new units are encoded together, as one text: those of Latin letters and
    common signs. For these a faster library with the first vocabulary is used, if there is one.
    """

    NAMES = ("ok", "n_a", "n_b", "n_groups", "n_links")

    def __init__(self, a_path: str, b_path: str, a_fast: tuple[str, str] | None = None) -> None:
        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.fast = None
        if a_fast:
            path, pattern = a_fast
            with open(path, "rb") as lines:
                ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("aligned", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        signs = _byte_signs()
        vocabulary = self.a.get_vocab()
        a_bytes = {i: bytes(signs[c] for c in t) if all(c in signs for c in t) else t.encode() for t, i in vocabulary.items()}
        self.a_bytes = [a_bytes.get(i, b"") for i in range(max(a_bytes) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.sizes = [np.array([len(x) for x in held], np.int64) for held in (self.a_bytes, self.b_bytes)]
        self.space = [self.b.piece_to_id("▁")]
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.text: list[str] = []
        self.held = 0
        self.values, self.keys, self.begin = [_Grown() for _ in self.NAMES], _Grown(), _Grown()
        self.begin.add(np.zeros(1, np.int64))

    def numbers(self, units: list[str]) -> np.ndarray:
        """The number of each unit, good until the next call."""
        try:
            return np.fromiter(map(self.slot.__getitem__, units), np.int64, len(units))
        except KeyError:
            self._meet(dict.fromkeys(units))
            return np.fromiter(map(self.slot.__getitem__, units), np.int64, len(units))

    def ready(self, texts: list[str]) -> list[list[str] | None]:
        """Learns what is new in all these texts at once; the units of each text that is no longer than a segment."""
        found = [units_of(t) if len(t) <= SEGMENT else None for t in texts]
        self._meet({u for units in found if units for u in units})
        return found

    def _meet(self, units: Iterable[str]) -> None:
        if self.held > CACHE:
            self._forget()
        plain, joined, alone = [], [], []
        for u in units:
            if u not in self.slot:
                (plain if self.fast and _PLAIN.fullmatch(u) else joined if _JOINED.search(u) and "▁" not in u else alone).append(u)
        if plain:
            self._learn(plain, self.fast.encode_ordinary(f" {' '.join(plain)}"), self.b.encode(" ".join(plain)))
        if joined:  # none ends with white space, so all begin at a cut
            self._learn(joined, self.a.encode(f" {' '.join(joined)}", add_special_tokens=False).ids, self.b.encode(" ".join(joined)))
        for u in alone:
            self._learn([u], self.a.encode(f" {u}", add_special_tokens=False).ids, self.b.encode(u) if u else self.space)

    def _learn(self, units: list[str], a: list[int], b: list[int]) -> None:
        """Units that stand one after another in both rows of tokens."""
        whole = "".join(f" {u}" for u in units).encode()
        ok = b"".join(map(self.a_bytes.__getitem__, a)) == whole == b"".join(map(self.b_bytes.__getitem__, b))
        if not ok and len(units) > 1:
            for u in units:
                self._learn([u], self.a.encode(f" {u}", add_special_tokens=False).ids, self.b.encode(u))
            return
        for u in units:
            self.slot[u] = len(self.slot)
            self.held += len(u) + 8
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        if not ok:
            values = [np.array([x], np.int64) for x in (0, len(a), len(b), 0, 0)]
            keys, cut, texts = np.zeros(0, np.int64), np.zeros(1, np.int64), [""]
        else:
            # Between two neighbouring ends, of either row, one token of each lies over the same bytes: a link.
            a_ends, b_ends = (np.cumsum(sizes[row]) for sizes, row in zip(self.sizes, (a, b), strict=True))
            ends = np.union1d(a_ends, b_ends)
            keys = a[np.searchsorted(a_ends, ends)] << B_BITS | b[np.searchsorted(b_ends, ends)]
            both = np.intersect1d(a_ends, b_ends, assume_unique=True)
            unit_ends = np.cumsum([len(u.encode()) + 1 for u in units])
            found = [np.searchsorted(x, unit_ends, "right") for x in (a_ends, b_ends, both, ends)]
            values = [np.ones(len(units), np.int64), *(np.diff(np.r_[0, x]) for x in found)]
            cut = found[3]
            a_upto, b_upto = ([0, *np.searchsorted(x, both, "right").tolist()] for x in (a_ends, b_ends))
            left, right = list(map(str, a.tolist())), list(map(str, b.tolist()))
            groups = [f"{','.join(left[i:j])}|{','.join(right[k:m])}" for i, j, k, m in zip(a_upto, a_upto[1:], b_upto, b_upto[1:], strict=False)]
            upto = [0, *found[2].tolist()]
            texts = [";".join(groups[i:j]) for i, j in zip(upto, upto[1:], strict=False)]
        for grown, column in zip(self.values, values, strict=True):
            grown.add(column)
        self.text += texts
        self.begin.add(self.keys.size + cut)
        self.keys.add(keys)

    def aligned(self, text: str, units: list[str] | None = None) -> Aligned | None:
        """A text, whose units may be given if it is no longer than a segment; None if the bytes of a row are not those of the text."""
        total, sha, links = np.zeros(len(self.NAMES), np.int64), hashlib.sha256(), []
        for own in [units] if units is not None else map(units_of, segments_of(text)):
            at = self.numbers(own)
            found = [grown.data[at] for grown in self.values]
            if not found[0].all():
                return None
            total += [x.sum() for x in found]
            sha.update((";" if links else "").encode() + ";".join(map(self.text.__getitem__, at.tolist())).encode())
            size = found[-1]
            within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - self.begin.data[at], size)
            links.append(_counted(self.keys.data[within]))
        return Aligned(dict(zip(self.NAMES, total.tolist(), strict=True)), sha.hexdigest(), *(links[0] if len(links) == 1 else _summed(links)))

    def sums(self, text: str) -> tuple[dict[str, int], str] | None:
        """The sums of a text's units and the digest of its groups; None if the bytes of a row are not those of the text."""
        found = self.aligned(text)
        return found and found[:2]

    def pairs(self, text: str) -> np.ndarray:
        """The distinct pairs that a text links."""
        found = self.aligned(text)
        return found.pairs if found else np.zeros(0, np.int64)


def _byte_signs() -> dict[str, int]:
    """The sign that byte-level vocabularies write for each byte: itself if it is printable Latin, else the next free one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    signs, rest = {chr(b): b for b in plain}, [b for b in range(256) if b not in plain]
    return signs | {chr(256 + k): b for k, b in enumerate(rest)}


class PerfectHash(NamedTuple):
    """``words`` are the bits of all levels, ``ends`` the words up to each level's end."""

    words: np.ndarray
    ends: np.ndarray

    @staticmethod
    def spots(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
        h = mixed(keys.astype(np.uint64) ^ mixed(np.array([level + 7], np.uint64)))
        return ((h >> np.uint64(32)) * np.uint64(bits) >> np.uint64(32)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, spare: float = 1.5) -> PerfectHash:
        """Of distinct keys; those that meet others at a level go on to the next."""
        left, parts, ends = keys, [], []
        while len(left):
            bits = 64 * int(np.ceil(max(1, spare * len(left)) / 64))
            spot = cls.spots(left, len(ends), bits)
            alone = np.bincount(spot, minlength=bits) == 1
            parts.append(np.packbits(alone, bitorder="little").view(np.uint64))
            ends.append(bits // 64 + (ends[-1] if ends else 0))
            left = left[~alone[spot]]
        return cls(np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.array(ends, np.int64))

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; of keys it was not built of, any place or -1."""
        before = np.r_[0, np.cumsum(np.bitwise_count(self.words).astype(np.int64))]
        found, left, begin = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, end in enumerate(self.ends.tolist()):
            spot = self.spots(keys[left], level, 64 * (end - begin))
            word, bit = begin + (spot >> 6), (spot & 63).astype(np.uint64)
            held = self.words[word]
            own = (held >> bit & np.uint64(1)).astype(bool)
            rank = before[word] + np.bitwise_count(held & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            found[left[own]] = rank[own]
            left, begin = left[~own], end
        return found


def shards_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((mixed(keys.astype(np.uint64) + np.uint64(3)) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


class Lookup(NamedTuple):
    """Counts of the pairs of some shards, and the highest count of each first id."""

    shards: int
    functions: dict[int, PerfectHash]
    keys: dict[int, np.ndarray]
    counts: dict[int, np.ndarray]
    best: np.ndarray

    def of(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each pair's count is its first id's highest, and the count; zeros for pairs of other shards.

        A pair whose key is not at its place was in no document that counts, and has zeros too.
        """
        count = np.zeros(len(pairs), np.int64)
        shard = shards_of(pairs, self.shards)
        for own in np.unique(shard).tolist():
            if own in self.functions:
                at = np.flatnonzero(shard == own)
                place = self.functions[own].index(pairs[at])
                known = (place >= 0) & (self.keys[own][place] == pairs[at])
                count[at[known]] = self.counts[own][place[known]]
        return ((count == self.best[pairs >> B_BITS]) & (count > 0)).astype(np.int64), count


_kept: dict[tuple, Aligner] = {}
_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"


def _aligner(paths: tuple) -> Aligner:
    """A worker's own: its tasks share what it has learned."""
    if paths not in _kept:
        _kept.clear()
        _kept[paths] = Aligner(*paths)
    return _kept[paths]


def _aligned(paths: tuple):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, none = _aligner(paths), Aligned(dict.fromkeys(Aligner.NAMES, 0), "", *[np.zeros(0, np.int64)] * 2)
        for piece in slices(batches):
            texts = piece.column("text").to_pylist()
            found = [(aligner.aligned(t, units) if t else None) or none for t, units in zip(texts, aligner.ready(texts), strict=True)]
            numbers = [pa.array([x.sums[c] for x in found], pa.int64()) for c in Aligner.NAMES[1:]]
            digests = pa.array([x.sha256 for x in found], pa.string())
            links = pa.array([packed(x.pairs, x.times) for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *numbers, digests, links], [c.split()[0] for c in _ALIGNED.split(", ")])

    return run


def _linked(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of the batches: rows, the pairs of all their links, how often each is linked, and how many pairs each row has."""
    for batch in batches:
        begin, held, size = 0, [], 0
        for k, links in enumerate(batch.column("links")):
            held.append(unpacked(links.as_py()))
            size += len(held[-1][0])
            if size >= READ or k + 1 == len(batch):
                pairs, times = (np.concatenate(x) for x in zip(*held, strict=True))
                yield batch.slice(begin, k + 1 - begin), pairs, times, np.array([len(x) for x, _ in held], np.int64)
                begin, held, size = k + 1, [], 0


def _gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def out(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(keys), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 16)]) for x in (keys, counts)], ["pair", "n"])

    for _, pairs, _, _ in _linked(batches):
        held.append(_counted(pairs))
        size += len(held[-1][0])
        if size > HELD:
            held = [_summed(held)]
            size = len(held[0][0])
            if size > HELD // 2:
                yield from out(*held[0])
                held, size = [], 0
    if held:
        yield from out(*_summed(held))


def _built(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over pairs sorted by shard: (shard, words, ends, pairs in the order of their places)."""
    shard, held = None, []

    def close() -> Iterator[pa.RecordBatch]:
        if held:
            keys = np.concatenate(held)
            function = PerfectHash.build(keys)
            ordered = np.empty_like(keys)
            ordered[function.index(keys)] = keys
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in (function.words, function.ends, ordered))],
                ["shard", "words", "ends", "pairs"])

    for batch in batches:
        shards, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "pair"))
        for own in np.unique(shards).tolist():
            if own != shard:
                yield from close()
                shard, held = own, []
            held.append(keys[shards == own])
    yield from close()


def _dense(functions: dict[int, PerfectHash], sizes: dict[int, int]):
    """Over (shard, pair, n) sorted by shard and part: one vector for each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, vector = None, np.zeros(0, np.int64)

        def close() -> Iterator[pa.RecordBatch]:
            if at is not None:
                yield _vectors([at[0]], [at[1]], [vector])

        for batch in batches:
            shard, part, keys, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "part", "pair", "n"))
            cut = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (part[1:] != part[:-1])]) if len(shard) else []
            for i, j in zip(cut, [*cut[1:], len(shard)], strict=True):
                if at != (own := (int(shard[i]), int(part[i]))):
                    yield from close()
                    at, vector = own, np.zeros(sizes[own[0]], np.int64)
                np.add.at(vector, functions[own[0]].index(keys[i:j]), n[i:j])
        yield from close()

    return run


def _vectors(shards: list[int], parts: list[int], vectors: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(shards, pa.int64()), pa.array(parts, pa.int64()), pa.array([v.tobytes() for v in vectors], pa.binary())], ["shard", "part", "counts"])


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over vectors sorted by shard and part: their sums."""
    at, total = None, np.zeros(0, np.int64)
    for batch in batches:
        for shard, part, counts in zip(*(batch.column(c).to_pylist() for c in ("shard", "part", "counts")), strict=True):
            vector = np.frombuffer(counts, np.int64)
            if at == (shard, part):
                total = total + vector
                continue
            if at is not None:
                yield _vectors([at[0]], [at[1]], [total])
            at, total = (shard, part), vector
    if at is not None:
        yield _vectors([at[0]], [at[1]], [total])


def _highest(functions: DataFrame, vectors: DataFrame) -> dict[int, int]:
    """The highest count of each first id: an entry for each id of the vocabulary at most."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs, counts in zip(batch.column("pairs").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                first, n = np.frombuffer(pairs, np.int64) >> B_BITS, np.frombuffer(counts, np.int64)
                order = np.lexsort((n, first))
                last = np.flatnonzero(np.r_[first[order][1:] != first[order][:-1], True])
                yield pa.RecordBatch.from_arrays([pa.array(first[order][last]), pa.array(n[order][last])], ["first", "n"])

    both = vectors.select(F.col("shard").alias("own"), "counts").join(functions, F.col("own") == F.col("shard")).select("pairs", "counts")
    found = both.mapInArrow(run, "first long, n long").groupBy("first").agg(F.max("n").alias("n"))
    return {r["first"]: r["n"] for r in found.collect()}


def _lookup(functions: DataFrame, vectors: DataFrame, shards: int, best: np.ndarray) -> Lookup:
    """The functions and vectors of a block, ``BLOCK`` pairs or little more, on the driver."""
    rows = {r["shard"]: r for r in functions.collect()}
    counts = {r["shard"]: np.frombuffer(r["counts"], np.int64) for r in vectors.collect()}
    return Lookup(shards, {k: _function(r) for k, r in rows.items()}, {k: np.frombuffer(r["pairs"], np.int64) for k, r in rows.items()}, counts, best)


def _function(row) -> PerfectHash:
    return PerfectHash(np.frombuffer(row["words"], np.uint64), np.frombuffer(row["ends"], np.int64))


_RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _reported(lookup: Lookup, names: list[str]):
    """Adds what this block's pairs give; rows of these columns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, pairs, times, sizes in _linked(batches):
            ends = np.cumsum(sizes)
            columns = dict(zip(piece.schema.names, piece.columns, strict=True))
            for name, found in zip(("n_best", "count_sum"), lookup.of(pairs), strict=True):
                sums = np.diff(np.r_[0, np.cumsum(found * times)][np.r_[0, ends]])
                columns[name] = pa.array(columns[name].to_numpy(zero_copy_only=False) + sums)
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)

    return run


def pair_counts(aligned: DataFrame) -> tuple[list[tuple[DataFrame, DataFrame]], int]:
    """For each block of shards its hash functions and its count vectors, as written tables, and the number of shards."""
    found = written(aligned.select("links").mapInArrow(_gathered, "pair long, n long"), "pairs")
    each = written(found.select("pair").distinct(), "distinct")
    many, rows = each.count(), found.count()
    shards = -(-many // SHARD)
    blocks = -(-shards * SHARD // BLOCK)
    parts = max(1, -(-rows // max(1, 4 * many)))  # a vector replaces four times as many rows

    def dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = batch.column("pair").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(shards_of(pairs, shards)), *batch.columns], ["shard", *batch.schema.names])

    out = []
    for block in range(blocks):
        reach = BLOCK // SHARD
        inside = F.col("shard").between(block * reach, (block + 1) * reach - 1)
        own = each.mapInArrow(dealt, "shard long, pair long").where(inside)
        functions = written(own.repartition("shard").sortWithinPartitions("shard").mapInArrow(
            _built, "shard long, words binary, ends binary, pairs binary"), "functions")
        held = functions.select("shard", "words", "ends", F.octet_length("pairs").alias("size")).collect()
        dense = _dense({r["shard"]: _function(r) for r in held}, {r["shard"]: r["size"] // 8 for r in held})
        kind = "shard long, part long, counts binary"
        entries = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(parts)).cast("long"))
        entries = entries.mapInArrow(dealt, "shard long, pair long, n long, part long").where(inside)
        vectors = entries.repartition("shard", "part").sortWithinPartitions("shard", "part").mapInArrow(dense, kind)
        left = parts
        while left > 1:
            left = -(-left // FAN)
            vectors = vectors.withColumn("part", F.expr(f"part div {FAN}")).repartition("shard", "part").sortWithinPartitions("shard", "part").mapInArrow(_added, kind)
        out.append((functions, written(vectors, "vectors")))
    return out, shards


def alignments(docs: DataFrame, a_path: str, b_path: str, a_fast: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    Null and empty texts, and texts that a tokenizer does not give back byte by
    byte, have zeros and an empty string, and count for no pair. Rows that
    share an id or are alike are documents of their own. Only ``doc_id`` and ``text`` are read.
    ``a_fast`` is a rank file with the first vocabulary and the pattern that cuts its pieces.
    """
    paths = (a_path, b_path, a_fast)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    aligned = written(docs.mapInArrow(_aligned(paths), _ALIGNED), "aligned")
    blocks, shards = pair_counts(aligned)
    size = Tokenizer.from_file(a_path).get_vocab_size()
    best = np.zeros(size + 1, np.int64)
    for functions, vectors in blocks:
        for first, n in _highest(functions, vectors).items():
            best[first] = max(best[first], n)
    rows = aligned.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    for number, (functions, vectors) in enumerate(blocks, 1):
        names = _RESULT if number == len(blocks) else rows.columns
        rows = rows.mapInArrow(_reported(_lookup(functions, vectors, shards, best), names), rows.select(names).schema)
        rows = written(rows, "block") if number < len(blocks) else rows
    return rows.select(_RESULT)
