"""WARC archives: write pages with revisit and continuation records, read them back whole.

Writing. Of pages with equal payloads (at least ``min_bytes``) the smallest
page_id is a response, the others are revisits that refer to it. Payloads are
framed in chunks, as servers send them. A record whose block is longer than
``segment_bytes`` is cut: the first segment, then continuation records that
name its id, their number and, on the last, the total length.

Reading. Records are cut from the byte stream by their length, whatever the
payload holds. Continuation records are grouped by origin, ordered by number
and checked against the total length; then the chunked framing is decoded and
the payload is checked against its digest. Only cut records are shuffled.

Text in Spark's files is bytes: a record's end (two line ends) is the text
writer's and reader's record separator, so that Spark writes and reads the
archives on any file system. Files are compressed as a whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

END = b"\r\n\r\n"
CHUNK, SEGMENT = 4096, 32768
SALTS = 64
_RECORD = ("record_id string, type string, target string, refers_to string, digest string, number long, origin string, "
           "total long, block binary")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def framed(payload: bytes, size: int = CHUNK) -> bytes:
    """Chunked transfer coding."""
    parts = [b"%x\r\n%b\r\n" % (len(payload[i : i + size]), payload[i : i + size]) for i in range(0, len(payload), size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def unframed(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are skipped, a damaged frame is an error."""
    parts, at = [], 0
    while True:
        line_end = body.index(b"\r\n", at)
        size = int(body[at:line_end].split(b";")[0].strip() or b"x", 16)
        at = line_end + 2
        if size == 0:
            return b"".join(parts)
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut short")
        parts.append(body[at : at + size])
        at += size + 2


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """Without the end of the record, which the writer adds."""
    lines = [f"{k}: {v}" for k, v in [*headers, ("Content-Length", len(block))] if v is not None]
    return "\r\n".join(["WARC/1.1", *lines]).encode() + END + block


def _line(text: str | None) -> str | None:
    """A header value: one line without outer blanks."""
    return None if text is None else re.sub(r"[\r\n]+", " ", text).strip()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{digest}>"


def page_of(record: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+):\w+>", record or "")
    return int(found[1]) if found else None


def records_of(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool, segment_bytes: int) -> Iterator[bytes]:
    digest = payload_digest(payload)
    own = record_id(page_id, digest)
    common = [("WARC-Target-URI", _line(url)), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("Content-Type", "application/http; msgtype=response")]
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if revisit:
        block = status + b"Content-Length: %d\r\n\r\n" % len(payload)  # the length that the response's payload has
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common,
                       ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                       ("WARC-Refers-To", record_id(first, digest))], block)
        return
    block = status + b"Transfer-Encoding: chunked\r\n\r\n" + framed(payload)
    cuts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    yield _record([("WARC-Type", "response"), ("WARC-Record-ID", own), *common,
                   ("WARC-Segment-Number", 1 if len(cuts) > 1 else None)], cuts[0])
    for number, part in enumerate(cuts[1:], 2):
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}:{number}>"), ("WARC-Date", "1970-01-01T00:00:00Z"),
                       ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", number),
                       ("WARC-Segment-Total-Length", len(block) if number == len(cuts) else None)], part)


def _writer(segment_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), 256):
                out = []
                for row in batch.slice(begin, 256).to_pylist():
                    out += records_of(row["page_id"], row["url"], (row["html"] or "").encode(), row["first"], row["revisit"], segment_bytes)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    return run


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, segment_bytes: int = SEGMENT) -> None:
    """Archives of (page_id, url, html); null html is an empty payload.

    Equal payloads are found on (digest, salt) rows first and then on at most
    ``SALTS`` rows for each digest, so no group is ever in one task. A null
    page_id is never the smallest unless all of its group are null; rows that
    repeat the smallest page_id are responses too.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sum", F.sha1(F.encode("html", "UTF-8"))).withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)))
    pieces = rows.groupBy("sum", "salt").agg(F.min("page_id").alias("least"), F.count("*").alias("n"))
    whole = pieces.groupBy("sum").agg(F.min("least").alias("first"), F.sum("n").alias("n")).where("n > 1").withColumnRenamed("sum", "whole_sum")
    firsts = pieces.join(whole, F.col("sum") == F.col("whole_sum")).select(F.col("sum").alias("group_sum"), F.col("salt").alias("group_salt"), "first")
    dealt = rows.join(firsts, (F.col("sum") == F.col("group_sum")) & (F.col("salt") == F.col("group_salt")), "left")
    again = F.col("group_sum").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.octet_length("html") >= min_bytes)
    records = dealt.select("page_id", "url", "html", "first", again.alias("revisit")).mapInArrow(_writer(segment_bytes), "value binary")
    records.select(F.col("value").cast("string")).write.option("lineSep", END.decode()).option("compression", "gzip").text(folder)


class RecordStream:
    """Cuts one archive's byte stream, given in pieces that an END each followed, into records."""

    def __init__(self) -> None:
        self.parts: list[bytes] = []
        self.have = self.need = 0
        self.headers: dict[str, str] | None = None

    def feed(self, piece: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        self.parts += [piece, END]
        self.have += len(piece) + len(END)
        while True:
            if self.headers is None:
                head, end, rest = b"".join(self.parts).partition(END)
                if not end:
                    return
                if not head.strip(END):  # what the reader leaves at a file's end, where no END follows
                    self._hold(rest)
                    continue
                lines = head.decode("utf-8", "replace").split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError("no record begins here")
                self.headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
                self.need = int(self.headers.get("content-length", "0"))
                self._hold(rest)
            if self.have < self.need + len(END):
                return
            data = b"".join(self.parts)
            if not data.startswith(END, self.need):
                raise ValueError("a record is longer than its length says")
            headers, self.headers = self.headers, None
            self._hold(data[self.need + len(END) :])
            yield headers, data[: self.need]

    def _hold(self, rest: bytes) -> None:
        self.parts, self.have = [rest], len(rest)


def _parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path, stream = None, RecordStream()
    for batch in batches:
        rows = []
        for own, piece in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist(), strict=True):
            if own != path:
                path, stream = own, RecordStream()
            for h, block in stream.feed(piece):
                number, total = h.get("warc-segment-number"), h.get("warc-segment-total-length")
                rows.append((h.get("warc-record-id"), h.get("warc-type"), h.get("warc-target-uri"), h.get("warc-refers-to"),
                             (h.get("warc-payload-digest") or "").removeprefix("sha1:") or None, int(number) if number else None,
                             h.get("warc-segment-origin-id"), int(total) if total else None, block))
        if rows:
            kinds = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.int64(), pa.binary()]
            names = ["record_id", "type", "target", "refers_to", "digest", "number", "origin", "total", "block"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records as they stand in the archives."""
    lines = spark.read.option("lineSep", END.decode()).text(folder).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(_parsed, _RECORD)


def reassembled(records: DataFrame) -> DataFrame:
    """Whole records: (record_id, type, target, refers_to, digest, block, whole).

    A segment that stands twice counts once; as many rows come out as the first
    segment has. ``whole`` is false where a number is missing or the total length
    differs; a continuation without its first segment gives no row.
    """
    uncut = records.where("number is null").select("record_id", "type", "target", "refers_to", "digest", "block", F.lit(True).alias("whole"))
    cut = records.where("number is not null").withColumn("origin", F.coalesce("origin", "record_id"))
    one = cut.groupBy("origin", "number").agg(
        F.min("block").alias("block"), F.max("total").alias("total"), F.count("*").alias("copies"),
        *[F.min(c).alias(c) for c in ("type", "target", "refers_to", "digest")])
    head = F.max(F.when(F.col("number") == 1, F.struct("type", "target", "refers_to", "digest", "copies"))).alias("head")
    groups = one.groupBy("origin").agg(
        head, F.max("total").alias("total"), F.max("number").alias("last"),
        F.array_sort(F.collect_list(F.struct("number", "block"))).alias("segments"))
    # Joined in one pass, as text because that is bytes here too; a fold would copy a long record for each segment.
    block = F.array_join(F.transform("segments", lambda s: s["block"].cast("string")), "").cast("binary")
    joined = groups.where("head is not null").select(
        F.col("origin").alias("record_id"), "head.type", "head.target", "head.refers_to", "head.digest", block.alias("block"),
        "total", "last", F.size("segments").alias("n"), F.explode(F.sequence(F.lit(1), F.col("head.copies").cast("int"))).alias("copy"))
    whole = (F.col("last") == F.col("n")) & (F.octet_length("block").cast("long").eqNullSafe(F.col("total")))
    return uncut.unionByName(joined.select("record_id", "type", "target", "refers_to", "digest", "block", whole.alias("whole")))


def _payloads(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            head, _, body = r["block"].partition(END)
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
            sound, payload, size = r["whole"], None, None
            if r["type"] == "revisit":
                size = int(fields.get(b"content-length", b"0"))
            else:
                try:
                    payload = unframed(body) if fields.get(b"transfer-encoding", b"").lower() == b"chunked" else body
                    size, sound = len(payload), sound and payload_digest(payload) == r["digest"]
                except ValueError:
                    sound = False
            rows.append((page_of(r["record_id"]), r["target"], size, r["digest"], r["type"], page_of(r["refers_to"]), sound, payload))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.binary()]
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "sound", "payload"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 8, kinds, strict=True)], names)


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, sound, payload) of every response and revisit.

    ``payload`` is null for revisits; ``sound`` is false where segments, framing or digest fail.
    """
    return reassembled(read_records(spark, folder)).where("type in ('response', 'revisit')").mapInArrow(
        _payloads, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, sound boolean, payload binary")
