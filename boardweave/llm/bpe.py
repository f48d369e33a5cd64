"""Byte-level BPE over content-defined chunks that documents share.

A text is cut where a rolling hash of the last ``WINDOW`` bytes says so, hence
copied passages are cut alike wherever they stand. A chunk is encoded once
while the worker's bounded store holds it. Chunk ends fall inside words, so
each join is repaired: the text around it is encoded again between the nearest
two places at which both encodings must agree. Such a place lies between a
sign that is no white space and white space after it; the split rule never
crosses it and looks no further back. A chunk without such a place joins the
text that is encoded again, and that text grows until both its ends agree.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from boardweave.llm.batches import GAPS, mixed, slices, window_hashes

WINDOW, CUT_BITS = 16, 9  # chunks of 512 bytes on average
STORE_BYTES = 48 << 20


class ChunkedBpe:
    """Ids as ``Tokenizer.from_file(vocabulary).encode(text, add_special_tokens=False)`` has them, and back.

    ``ranks`` names the same vocabulary as merge ranks, ``pattern`` its split rule.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str, cut_bits: int = CUT_BITS, store_bytes: int = STORE_BYTES) -> None:
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.engine = tiktoken.Encoding("chunks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        added = Tokenizer.from_file(vocabulary).get_added_tokens_decoder()
        self.special = {t.content: i for i, t in added.items() if t.special}
        by_id = {i: token for token, i in table.items()} | {i: t.encode() for t, i in self.special.items()}
        tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.size = np.array([len(t) for t in tokens])
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.cut_mask, self.store_bytes = np.uint64((1 << cut_bits) - 1), store_bytes
        self.store: dict[bytes, tuple[bytes, np.ndarray, bytes] | None] = {}
        self.joins: dict[bytes, np.ndarray] = {}
        self.held = 0
        self.encoded = 0  # bytes given to the engine so far

    def _fresh(self, data: bytes) -> np.ndarray:
        self.encoded += len(data)
        return np.array(self.engine.encode_ordinary(data.decode()), np.uint32)

    def _join(self, data: bytes) -> np.ndarray:
        ids = self.joins.get(data)
        if ids is None:
            ids = self._fresh(data)
            if len(data) < 64:
                self._room(2 * len(data) + 150)
                self.joins[data] = ids
        return ids

    def _room(self, more: int) -> None:
        if self.held + more > self.store_bytes:
            self.store.clear()
            self.joins.clear()
            self.held = 0
        self.held += more

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Places after which a chunk begins; always before the first byte of a character."""
        h = window_hashes(mixed(data.astype(np.uint64) + np.uint64(1)), WINDOW)
        at = np.flatnonzero((h & self.cut_mask) == 0) + WINDOW
        at = at[at < len(data)]
        return at[(data[at] & 0xC0) != 0x80]

    @staticmethod
    def agreed(data: np.ndarray) -> np.ndarray:
        """Places that no split crosses: white space after a sign that is surely none."""
        if len(data) < 3:
            return np.zeros(0, np.int64)
        gap, before, lead = GAPS[data[2:]], data[1:-1], data[:-2]
        sign = (before > 0x20) & (before < 0x7F)
        sign |= (before >= 0x80) & (before < 0xC0) & (lead >= 0xC3) & (lead < 0xE0)  # two bytes: no white space from U+00C0 on
        return np.flatnonzero(gap & sign) + 2

    def _chunk(self, data: bytes) -> tuple[bytes, np.ndarray, bytes] | None:
        """What stands before the first agreed place, the ids up to the last, and what follows; None without two places."""
        if data in self.store:
            return self.store[data]
        places = self.agreed(np.frombuffer(data, np.uint8))
        found = None
        if len(places) > 1:
            found = data[: places[0]], self._fresh(data[places[0] : places[-1]]), data[places[-1] :]
        self._room(2 * len(data) + 400)
        self.store[data] = found
        return found

    def _plain(self, text: bytes) -> list[np.ndarray]:
        parts, loose, data = [], b"", np.frombuffer(text, np.uint8)
        begin, apart = 0, []
        for end in [*self.cuts(data).tolist(), len(text)]:
            chunk = self._chunk(text[begin:end])
            if chunk is None:
                apart.append(text[begin:end])
            else:
                head, ids, tail = chunk
                loose = b"".join([loose, *apart, head])
                if loose:
                    parts.append(self._join(loose))
                parts.append(ids)
                loose, apart = tail, []
            begin = end
        loose = b"".join([loose, *apart])
        if loose:
            parts.append(self._join(loose))
        return parts

    def encode(self, text: str) -> np.ndarray:
        parts, rest = [], text
        while rest:
            found = [(rest.find(s), -len(s), s) for s in self.special if s in rest]
            at, _, token = min(found) if found else (len(rest), 0, "")
            if at:
                parts += self._plain(rest[:at].encode())
            if token:
                parts.append(np.array([self.special[token]], np.uint32))
            rest = rest[at + len(token) :]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        """Bytes that are no UTF-8 become replacement characters."""
        size = self.size[ids]
        total = np.cumsum(size)
        within = np.arange(int(total[-1]) if len(total) else 0) - np.repeat(total - size, size)
        return self.flat[np.repeat(self.begin[ids], size) + within].tobytes().decode("utf-8", "replace")


@lru_cache(2)
def _bpe(vocabulary: str, ranks: str, pattern: str) -> ChunkedBpe:
    return ChunkedBpe(vocabulary, ranks, pattern)


def token_digests(docs: DataFrame, vocabulary: str, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row; null texts count as empty.

    No row leaves its task: what workers share is a bounded store of chunks, and
    ids never depend on it.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(vocabulary, ranks, pattern)
        for piece in slices(batches):
            ids = [bpe.encode(t) for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
                 pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def token_ids(docs: DataFrame, vocabulary: str, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(vocabulary, ranks, pattern)
        for piece in slices(batches):
            ids = [bpe.encode(t).astype(np.int64) for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<long>")
