"""Token ids on disk: one zstandard frame for each document and a trailing seek table.

A file is readable by any zstandard decoder. It is a row of data frames (the
ids of one document each, little-endian unsigned integers), an index frame
(ids, place and width) and a skippable frame with the seek table of the public
seekable format: compressed size, size and checksum of every frame. A reader
takes the table from the end of the file and decompresses only what is asked.

Spark writes the files itself: a row holds a file but for its last four bytes,
and these, the format's closing magic number, are the text writer's record end.
Hence any file system that Spark reaches will do.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from boardweave.llm.batches import id_of, order_id, slices, written
from boardweave.llm.wordpieces import WordPieces

SKIPPABLE, CLOSING = 0x184D2A5E, 0x8F92EAB1  # fixed values of the format
FILE_BYTES = 16 << 20


def packed(frames: list[bytes]) -> bytes:
    """The file of these contents, a frame for each."""
    press = zstandard.ZstdCompressor(level=3, write_checksum=True)
    done, table = [], []
    for content in frames:
        done.append(press.compress(content))
        table.append(struct.pack("<III", len(done[-1]), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
    seek = b"".join(table) + struct.pack("<IBI", len(frames), 0x80, CLOSING)
    return b"".join([*done, struct.pack("<II", SKIPPABLE, len(seek)), seek])


class FrameReader:
    """Frames of one file by number; each is verified when it is read."""

    def __init__(self, data: bytes) -> None:
        count, flags, closing = struct.unpack("<IBI", data[-9:])
        if closing != CLOSING or not flags & 0x80:
            raise ValueError("no seek table with checksums")
        begin = len(data) - 9 - 12 * count
        if struct.unpack("<II", data[begin - 8 : begin]) != (SKIPPABLE, 12 * count + 9):
            raise ValueError("damaged seek table")
        self.table = np.frombuffer(data, "<u4", 3 * count, begin).reshape(-1, 3)
        self.at = np.r_[0, np.cumsum(self.table[:, 0], dtype=np.int64)]
        if self.at[-1] != begin - 8:
            raise ValueError("the frames do not fill the file")
        self.data, self.open = data, zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.table)

    def read(self, number: int) -> bytes:
        content = self.open.decompress(self.data[self.at[number] : self.at[number + 1]], max_output_size=int(self.table[number, 1]) or 1)
        if len(content) != self.table[number, 1] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.table[number, 2]:
            raise ValueError(f"frame {number} is damaged")
        return content


class TokenFile:
    """The documents of one file; only asked ones are decompressed."""

    def __init__(self, data: bytes) -> None:
        self.frames = FrameReader(data)
        index = self.frames.read(len(self.frames) - 1)
        head, rest = index.split(b"\n", 1)
        about = json.loads(head)
        self.part, self.shard, self.width = about["part"], about["shard"], about["width"]
        self.ids = np.frombuffer(rest, "<i8")  # orders: see batches.order_id

    def tokens(self, number: int) -> np.ndarray:
        return np.frombuffer(self.frames.read(number), f"<u{self.width}").astype("<u4")


@lru_cache(2)
def _pieces(path: str) -> WordPieces:
    return WordPieces(path)


def _files(path: str, end_id: int, file_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, part, shard = _pieces(path), TaskContext.get().partitionId(), 0
        width = 2 if max(end_id, pieces.library.get_vocab_size() - 1) < 1 << 16 else 4
        frames, ids, size = [], [], 0

        def close() -> pa.RecordBatch:
            head = json.dumps({"part": part, "shard": shard, "width": width}).encode()
            data = packed([*frames, head + b"\n" + np.array(ids, "<i8").tobytes()])
            return pa.RecordBatch.from_arrays([pa.array([data[:-4]], pa.binary())], ["value"])

        for piece in slices(batches):
            found, counts = pieces.encode(piece.column("text").to_pylist())
            for order, own in zip(piece.column("id").to_pylist(), np.split(found, np.cumsum(counts)[:-1]), strict=True):
                frames.append(np.append(own, end_id).astype(f"<u{width}").tobytes())
                ids.append(order)
                size += len(frames[-1])
                if size >= file_bytes:
                    yield close()
                    frames, ids, size, shard = [], [], 0, shard + 1
        if frames:
            yield close()

    return run


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int, file_bytes: int = FILE_BYTES) -> None:
    """All texts as ids with ``end_id`` after each, in ascending doc_id order over the files.

    Rows without id come last. ``file_bytes`` bounds a file's ids before
    compression, and so what a task holds, to this and one document.
    """
    rows = docs.select(order_id().alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    files = rows.repartitionByRange("id").sortWithinPartitions("id", "text").mapInArrow(
        _files(tokenizer, end_id, file_bytes), "value binary")
    (files.select(F.col("value").cast("string")).write
     .option("encoding", "ISO-8859-1").option("lineSep", struct.pack("<I", CLOSING).decode("latin-1"))
     .option("compression", "none").option("maxRecordsPerFile", 1).text(folder))


def _opened(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).where("length > 0").select("content")


def read_documents(spark: SparkSession, folder: str, wanted: list[int]) -> DataFrame:
    """(doc_id, ids) of the wanted documents; no other frame is decompressed. The list is bounded by its caller."""
    keys = set(wanted)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                file = TokenFile(data.as_py())
                at = [i for i, x in enumerate(file.ids.tolist()) if x in keys]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.ids[at]), pa.array([file.tokens(i).astype(np.int64) for i in at], pa.list_(pa.int64()))],
                    ["doc_id", "ids"])

    return _opened(spark, folder).mapInArrow(run, "doc_id long, ids array<long>")


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "shard", "id", "before", "n_tokens", "ids_crc32"]
    for batch in batches:
        for data in batch.column("content"):
            file = TokenFile(data.as_py())
            own = [file.tokens(i) for i in range(len(file.ids))]
            n = np.array([len(x) for x in own], np.int64)
            crc = np.array([zlib.crc32(x.tobytes()) for x in own], np.int64)
            columns = [np.full(len(n), file.part), np.full(len(n), file.shard), file.ids, np.cumsum(n) - n, n, crc]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)


def token_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files.

    ``start`` adds what is before the document in its file to what earlier files
    hold: a running sum over one row for each file.
    """
    rows = written(_opened(spark, folder).mapInArrow(
        _summaries, "part long, shard long, id long, before long, n_tokens long, ids_crc32 long"), "summaries")
    files = rows.groupBy("part", "shard").agg(F.sum("n_tokens").alias("held"))
    order = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", "shard", F.coalesce(F.sum("held").over(order), F.lit(0)).alias("earlier"))
    return rows.join(files, ["part", "shard"]).select(
        id_of().alias("doc_id"), (F.col("earlier") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
