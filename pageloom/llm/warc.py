"""WARC archives with segmented records: written, read back and reassembled (operator 6)."""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .scratch import Scratch

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
FILE_RECORDS = 1000
REVISIT_BYTES = 100
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"
SEGMENTS = """origin string, segment int, total_length long, record_type string, page_id long, refers_to long,
    payload_digest string, payload_bytes long, block binary, problem string"""
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, problem string, payload binary"
SLICE_BYTES = 4 << 20


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


class Unchunker:
    """Takes a chunked HTTP message piece by piece; hands on the payload and hashes it."""

    def __init__(self, sink: Callable[[bytes], object] | None = None) -> None:
        self.digest, self.length, self.sink = hashlib.sha256(), 0, sink
        self.held, self.left, self.state, self.problem = bytearray(), 0, "head", None

    def feed(self, data: bytes) -> None:
        self.held += data
        while self.state not in ("end", "bad"):
            if self.state == "data":
                part = bytes(self.held[: self.left])
                del self.held[: len(part)]
                self.left -= len(part)
                self.digest.update(part)
                self.length += len(part)
                if self.sink:
                    self.sink(part)
                if self.left:
                    return
                self.state = "after"
            elif self.state == "after":
                if len(self.held) < 2:
                    return
                self.state = "size" if self.held[:2] == b"\r\n" else "bad"
                del self.held[:2]
            else:
                mark = b"\r\n\r\n" if self.state == "head" else b"\r\n"
                at = self.held.find(mark)
                if at < 0:
                    return
                line = bytes(self.held[:at])
                del self.held[: at + len(mark)]
                if self.state == "head":
                    self.state = "size"
                elif self.state == "trailer":
                    self.state = "trailer" if line else "end"
                elif re.fullmatch(rb"[0-9A-Fa-f]+(;.*)?", line, re.S):
                    self.left = int(line.split(b";")[0], 16)
                    self.state = "data" if self.left else "trailer"
                else:
                    self.state = "bad"

    def fault(self) -> str | None:
        if self.state == "end" and not self.held:
            return None
        return "broken chunk" if self.state in ("bad", "end") else "cut message"


def records_of(row: dict, name: str, segment: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """The WARC records of one page, without the two line ends that close each."""
    payload = (row["html"] or "").encode()
    head = {
        "WARC-Record-ID": f"<urn:record:{name}>", "WARC-Date": DATE, "WARC-Target-URI": quote(row["url"] or "about:blank", safe=":/?#[]@!$&'()*+,;=%~-._"),
        "Content-Type": "application/http;msgtype=response", "WARC-Payload-Digest": f"sha256:{row['sha']}", "Page-Payload-Length": len(payload),
    }
    if row["page_id"] is not None:
        head["Page-ID"] = row["page_id"]
    if row["first_id"] is not None and row["first_id"] != row["page_id"]:
        more = {"WARC-Type": "revisit", "WARC-Profile": PROFILE, "WARC-Refers-To-Target-URI": quote(row["first_url"] or "about:blank", safe=":/?#[]@!$&'()*+,;=%~-._"), "Page-Refers-To": row["first_id"]}
        yield _record(head | more, HTTP_HEAD)
        return
    block = HTTP_HEAD + chunked(payload)
    cuts = range(0, len(block), segment)
    if len(cuts) == 1:
        yield _record(head | {"WARC-Type": "response"}, block)
        return
    yield _record(head | {"WARC-Type": "response", "WARC-Segment-Number": 1}, block[:segment])
    for n, at in enumerate(cuts[1:], 2):
        own = {"WARC-Type": "continuation", "WARC-Record-ID": f"<urn:record:{name}-{n}>", "WARC-Date": DATE, "WARC-Segment-Origin-ID": head["WARC-Record-ID"], "WARC-Segment-Number": n}
        if n == len(cuts):
            own["WARC-Segment-Total-Length"] = len(block)
        yield _record(own, block[at : at + segment])


def _record(head: dict, block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in (head | {"Content-Length": len(block)}).items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block


def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT_BYTES) -> None:
    """Write ``page_id, url, html`` as gzipped WARC files of at most ``FILE_RECORDS`` records each.

    Of equal payloads of at least ``REVISIT_BYTES`` the smallest page id is the response and
    the others revisit it. A null id never is the one revisited while there is another. Rows
    that repeat the smallest id are responses too. A null html is an empty payload.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    html = F.coalesce(F.col("html"), F.lit(""))
    pages = pages.select(F.col("page_id").cast("long"), "url", "html").withColumns({"sha": F.sha2(html, 256), "bytes": F.octet_length(html)})
    firsts = (
        pages.where(F.col("bytes") >= REVISIT_BYTES).groupBy("sha")
        .agg(F.count("*").alias("n"), F.min(F.when(F.isnotnull("page_id"), F.struct("page_id", "url"))).alias("first"))
        .where("n > 1").select("sha", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"))
    )
    # Spark itself broadcasts this table if its files are small, else splits what is skewed.
    firsts = scratch.keep(firsts, "firsts")
    joined = pages.join(firsts, "sha", "left").select("page_id", "url", "html", "sha", "first_id", "first_url")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            out, held = [], 0
            for row in batch.to_pylist():
                for record in records_of(row, f"{task}-{n}", segment):
                    out.append(record)
                    held += len(record)
                n += 1
                if held > SLICE_BYTES:
                    yield pa.record_batch([pa.array(out, pa.binary())], ["value"])
                    out, held = [], 0
            if out:
                yield pa.record_batch([pa.array(out, pa.binary())], ["value"])

    lines = joined.mapInArrow(encode, "value binary").select(F.col("value").cast("string"))
    lines.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)
    scratch.drop(firsts)


class _Unzipped(io.RawIOBase):
    """The bytes of a gzipped file up to where it is cut or damaged; ``problem`` says which."""

    def __init__(self, content: bytes) -> None:
        self.source, self.problem = gzip.GzipFile(fileobj=io.BytesIO(content)), None

    def readable(self) -> bool:
        return True

    def readinto(self, buffer: memoryview) -> int:
        data = b""
        if not self.problem:
            try:
                data = self.source.read1(len(buffer))
            except EOFError:
                self.problem = "cut file"
            except (OSError, zlib.error):
                self.problem = "damaged file"
        buffer[: len(data)] = data
        return len(data)


def _take(stream: io.BufferedIOBase, length: int) -> bytes:
    """Up to ``length`` bytes, however many a header claims."""
    parts = []
    while length > 0 and (part := stream.read(min(length, SLICE_BYTES))):
        parts.append(part)
        length -= len(part)
    return b"".join(parts)


def parse_archive(content: bytes) -> Iterator[tuple[dict, bytes]]:
    """Headers, lower-cased, and block of each record of one file.

    ``problem`` among the headers names a fault: ``cut record`` where the file ends inside one, ``bad header`` for one that is not
    UTF-8, ``bad length`` where there is no number of bytes; the next line that begins a record is then the next one. A gzipped file that
    ends early or is damaged gives the records before that place, and if none of them is cut, one without a type and with the problem ``cut file`` or ``damaged file``.
    """
    zipped = _Unzipped(content) if content[:2] == b"\x1f\x8b" else None
    stream = io.BufferedReader(zipped) if zipped else io.BytesIO(content)
    cut = False
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        head = {}
        while (line := stream.readline()).strip():
            try:
                text = line.decode()
            except UnicodeDecodeError:
                text, head["problem"] = line.decode(errors="replace"), "bad header"
            key, _, value = text.partition(":")
            if key.strip().lower() != "problem":
                head[key.strip().lower()] = value.strip()
        length = head.get("content-length", "")
        if not line:
            cut, block = True, b""
            head["problem"] = "cut record"
        elif not re.fullmatch("[0-9]{1,18}", length):
            block = b""
            head["problem"] = "bad length"
        else:
            block = _take(stream, int(length))
            if len(block) < int(length):
                cut, head["problem"] = True, "cut record"
        yield head, block
    if zipped and zipped.problem and not cut:
        yield {"problem": zipped.problem}, b""


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per record that isn't a continuation: ``page_id, payload_bytes, payload_digest, record_type, refers_to, problem, payload``.

    Records in one piece are decoded where they are read. Segments are dealt by the identifier
    of their first record and sorted by number; a task then streams through them, one at a time,
    so that neither a page nor a task's pages must fit into memory. Numbers must run from 1 without
    a gap and the lengths add up to the total; else ``problem`` names the fault and the payload is null. No damage of
    a file ends the job: see ``parse_archive``; a header that should hold a number and does not is the problem ``bad number``,
    a segment that names no record ``no record id``. Digests other than SHA-256 are not compared.
    ``payload`` is null unless ``payloads`` asks for it, and for revisits, whose figures come from the header.
    """
    scratch = Scratch(spark, "warc-read")
    names = [x.split()[0] for x in SEGMENTS.split(",")]
    schema = pa.schema([("origin", pa.string()), ("segment", pa.int32()), ("total_length", pa.int64()), ("record_type", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("block", pa.binary()), ("problem", pa.string())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for batch in batches:
            for content in batch.column(0):
                for head, block in parse_archive(content.as_py()):
                    out.append(_segment(head, block, payloads))
                    held += len(block)
                    if held > SLICE_BYTES:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, held = [], 0
        yield pa.RecordBatch.from_pylist(out, schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    parsed = scratch.keep(files.mapInArrow(parse, SEGMENTS), "parsed")
    final = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"]
    whole = parsed.where("origin IS NULL").select(*final, F.col("block").alias("payload"))
    out_schema = pa.schema([schema.field(n) for n in final] + [("payload", pa.binary())])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: _Assembly | None = None
        for batch in batches:
            done, held = [], 0
            for i in range(batch.num_rows):
                row = {n: batch.column(k)[i].as_py() for k, n in enumerate(names)}
                if open_ is None or open_.origin != row["origin"]:
                    if open_:
                        done.append(open_.result())
                        held += len(done[-1]["payload"] or b"")
                    open_ = _Assembly(row["origin"], payloads)
                open_.add(row)
                if held > SLICE_BYTES:
                    yield pa.RecordBatch.from_pylist(done, out_schema)
                    done, held = [], 0
            yield pa.RecordBatch.from_pylist(done, out_schema)
        if open_:
            yield pa.RecordBatch.from_pylist([open_.result()], out_schema)

    segments = parsed.where("origin IS NOT NULL").repartition("origin").sortWithinPartitions("origin", "segment")
    return whole.unionByName(segments.mapInArrow(assemble, RECORDS))


NUMBERS = {
    "page_id": "page-id", "refers_to": "page-refers-to", "payload_bytes": "page-payload-length", "segment": "warc-segment-number", "total_length": "warc-segment-total-length"
}


def _segment(head: dict, block: bytes, payloads: bool) -> dict:
    row = {"record_type": head.get("warc-type"), "problem": head.get("problem")}
    for name, key in NUMBERS.items():
        value = head.get(key)
        good = value is not None and re.fullmatch("[0-9]{1,9}" if name == "segment" else "-?[0-9]{1,18}", value)
        row[name] = int(value) if good else None
        if value and not good:
            row["problem"] = row["problem"] or "bad number"
    digest = head.get("warc-payload-digest", "")
    row["payload_digest"] = digest.removeprefix("sha256:") if digest.startswith("sha256:") else None
    if row["segment"] is not None:
        origin = head.get("warc-segment-origin-id") or head.get("warc-record-id")
        if origin:
            return row | {"origin": origin, "block": block}
        row["problem"] = row["problem"] or "no record id"
    if row["record_type"] in ("revisit", None):
        return row
    parts: list[bytes] = []
    reader = Unchunker(parts.append if payloads else None)
    reader.feed(block)
    row |= _checked(row, reader, row["problem"])
    return row | {"block": b"".join(parts) if payloads and not row["problem"] else None}


def _checked(row: dict, reader: Unchunker, problem: str | None) -> dict:
    problem = problem or reader.fault() or (row["payload_digest"] not in (None, reader.digest.hexdigest()) and "digest differs") or None
    return {"problem": problem, "payload_digest": reader.digest.hexdigest(), "payload_bytes": reader.length}


class _Assembly:
    """The segments of one record, taken in order."""

    def __init__(self, origin: str, payloads: bool) -> None:
        self.origin, self.parts, self.first = origin, [] if payloads else None, None
        self.reader = Unchunker(self.parts.append if payloads else None)
        self.next, self.length, self.total, self.problem = 1, 0, None, None

    def add(self, row: dict) -> None:
        self.problem = self.problem or row["problem"] or ("segment missing or repeated" if row["segment"] != self.next else None)
        self.first = row if row["segment"] == 1 else self.first
        self.total = row["total_length"] if row["total_length"] is not None else self.total
        self.next += 1
        self.length += len(row["block"])
        if not self.problem:
            self.reader.feed(row["block"])

    def result(self) -> dict:
        row = self.first or {"record_type": "response", "page_id": None, "refers_to": None, "payload_digest": None}
        problem = self.problem or (self.length != self.total and "total length differs") or None
        out = {k: row[k] for k in ("record_type", "page_id", "refers_to")} | _checked(row, self.reader, problem)
        return out | {"payload": b"".join(self.parts) if self.parts is not None and not out["problem"] else None}


def op6_warc(spark, sf):
    path = Scratch(spark, "archives").new_path("warc")
    write_archives(spark.read.parquet(f"{sf}/pages.parquet"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem")


OP6_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to, NULL::VARCHAR AS problem
FROM f
"""
