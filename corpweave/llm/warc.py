"""WARC archives with a two-level capture index.

Records are single gzip members in archives that each task writes under a name of
its own.  The index has a line per capture, ordered by reversed-host URL key and
page: range partitions of the order become segments, each a file of compressed
blocks of `BLOCK_LINES` lines, followed by the sparse directory of its blocks.  A
lookup searches the segments' first keys, then the directory, then the block, each
by halving, and reads the record by its range.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave.llm.common import mapped
from corpweave.llm.files import Output, Ranges, new_file
from corpweave.storage import shared_path, written

#: payloads of at least so many bytes are stored once
LEAST_SHARED = 1000
BLOCK_LINES = 1000
#: bytes after which a task begins another archive
ARCHIVE_BYTES = 1 << 30
#: captures in a segment of the index, about; one manifest row a segment, and so many segments at least
SEGMENT_LINES, SEGMENTS = 500_000, 16
#: bytes of an archive that one task reads back, about
READ_BYTES = 64 << 20
LEVEL = 4
DATE = "2020-01-01T00:00:00Z"
_RESPONSE, _REVISIT = "response", "revisit"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then port, path and query in lower
    case; what is no URL keeps its own text, a null one is empty."""
    text = (url or "").strip()
    try:
        parts = urlsplit(text)
        host, port = parts.hostname, parts.port
    except ValueError:
        host = None
    if not host:
        return text.lower().replace("\n", " ").replace("\t", " ")
    labels = host.removeprefix("www.").split(".")
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(labels))}{f':{port}' if port not in (None, 80, 443) else ''}){tail}".lower().replace("\n", " ").replace("\t", " ")


def line_key(key: str, page_id: int | None) -> str:
    """Key of an index line: orders by URL key, then page."""
    return f"{key}\t{(1 << 63) + page_id if page_id is not None else 0:020d}"


def _header_text(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in "\r\n%" else c for c in value)


def record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, size: int, refers_to: int | None, headers: dict[str, str] | None = None) -> bytes:
    """A WARC record: a response with its payload, or (payload None) a revisit."""
    kind = _RESPONSE if payload is not None else _REVISIT
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http + (payload or b"")
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:x-page:{page_id}>", f"WARC-Date: {DATE}"]
    lines += [] if url is None else [f"WARC-Target-URI: {_header_text(url)}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response"]
    if payload is None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    lines += [f"{k}: {_header_text(v)}" for k, v in (headers or {}).items()]
    lines += [f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of one record and its payload; lengths and digests are those found,
    not those declared, where there is a payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:])}
    number = lambda s: None if s in ("", "None") else int(s)
    page = number(fields["warc-record-id"].rpartition(":")[2].rstrip(">"))
    out = {"page_id": page, "record_type": fields["warc-type"], "url": fields.get("warc-target-uri"), "digest": fields["warc-payload-digest"].partition(":")[2], "size": int(declared["content-length"]), "refers_to": None, "payload": None}
    if out["record_type"] == _REVISIT:
        out["refers_to"] = number(fields["warc-refers-to"].rpartition(":")[2].rstrip(">"))
    else:
        out |= {"payload": payload, "size": len(payload), "digest": hashlib.sha1(payload).hexdigest()}
    return out


CAPTURE = "page_id long, key string, archive string, offset long, length long"


def _write_archives(folder: str):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            for page, url, html, digest, size, refers in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "html", "digest", "size", "refers_to"))):
                if out is None or out.at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    out = Output(new_file(folder, "archive", ".warc.gz"))
                payload = None if refers is not None else (html or "").encode("utf-8", "surrogatepass")
                member = gzip.compress(record(page, url, payload, digest, size, refers), LEVEL, mtime=0)
                for into, value in zip(rows, (page, line_key(url_key(url), page), out.uri, out.write(member), len(member))):
                    into.append(value)
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds)], names=["page_id", "key", "archive", "offset", "length"])
        if out is not None:
            out.close()

    return emit


def _write_segments(folder: str):
    """Captures in order -> a segment file of blocks and directory, and its manifest row."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, directory, lines, last = None, [], [], ""

        def flush():
            block = zlib.compress("\n".join(lines).encode("utf-8", "surrogatepass"), LEVEL)
            directory.append((lines[0].rpartition("\t")[0], out.write(block), len(block)))
            lines.clear()

        for batch in batches:
            for key, archive, offset, length in zip(*(batch[c].to_pylist() for c in ("key", "archive", "offset", "length"))):
                if out is None:
                    out = Output(new_file(folder, "index", ".blocks"))
                last = key
                lines.append(f"{key}\t{json.dumps([archive.rpartition('/')[2], offset, length])}")
                if len(lines) >= BLOCK_LINES:
                    flush()
        if out is None:
            return
        if lines:
            flush()
        packed = zlib.compress(json.dumps(directory).encode(), LEVEL)
        out.write(packed)
        out.write(len(packed).to_bytes(8, "little"))
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([last]), pa.array([out.uri])], names=["first_key", "last_key", "segment"])

    return emit


@dataclass
class CaptureIndex:
    """Segments in order, as (first key, last key, file); archives are in `folder` and have
    `size` bytes in all."""

    segments: list[tuple[str, str, str]]
    folder: str
    size: int = 0

    def __post_init__(self) -> None:
        self._firsts = [s[0] for s in self.segments]
        self._directory: tuple[str, list, list] | None = None
        self._block: tuple[str, int, list, list] | None = None
        self._reads = Ranges()

    def __reduce__(self):  # open files and what was read stay behind
        return CaptureIndex, (self.segments, self.folder, self.size)

    def locate(self, key: str) -> list[tuple[str, int, int]]:
        """(archive, offset, length) of the captures with a line key."""
        found, at = [], bisect_right(self._firsts, key) - 1
        while at >= 0 and self.segments[at][1] >= key:
            keys, entries = self._blocks_of(self.segments[at][2])
            b = bisect_right(keys, key) - 1
            while b >= 0:
                heads, tails = self._lines_of(self.segments[at][2], *entries[b])
                i = bisect_right(heads, key)
                while i and heads[i - 1] == key:
                    i -= 1
                    archive, offset, length = json.loads(tails[i])
                    found.append((f"{self.folder}/{archive}", offset, length))
                if i or heads[0] < key:
                    break
                b -= 1
            if keys[0] < key:
                break
            at -= 1
        return found

    def _blocks_of(self, segment: str):
        if self._directory is None or self._directory[0] != segment:
            end = self._reads.size(segment) - 8
            n = int.from_bytes(self._reads.read(segment, end, 8), "little")
            entries = json.loads(zlib.decompress(self._reads.read(segment, end - n, n)))
            self._directory = (segment, [e[0] for e in entries], [(e[1], e[2]) for e in entries])
        return self._directory[1:]

    def _lines_of(self, segment: str, offset: int, length: int):
        if self._block is None or self._block[:2] != (segment, offset):
            text = zlib.decompress(self._reads.read(segment, offset, length)).decode("utf-8", "surrogatepass")
            parts = [line.rpartition("\t") for line in text.split("\n")]
            self._block = (segment, offset, [p[0] for p in parts], [p[2] for p in parts])
        return self._block[2:]


def write_pages(pages: DataFrame, least: int = LEAST_SHARED) -> tuple[CaptureIndex, DataFrame]:
    """Writes `pages` (page_id, url, html) as archives with an index; returns the
    index and the table of captures.

    A null html is an empty payload.  Of equal payloads of at least `least` bytes
    the rows with the largest page_id are responses, all others revisit it; a null
    page_id is less than any and, in a group of such rows alone, a response."""
    spark = pages.sparkSession
    folder = shared_path(spark, "warc")
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", "html", F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).cast("long").alias("size"))
    largest = rows.select("page_id", "digest", "size").filter(F.col("size") >= least).groupBy("digest", "size").agg(F.max("page_id").alias("largest"))
    rows = rows.join(largest, ["digest", "size"], "left")
    rows = rows.withColumn("refers_to", F.when(~F.col("largest").eqNullSafe(F.col("page_id")), F.col("largest")))
    rows = rows.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), "digest", "size", "refers_to")
    captures = written(mapped(rows, _write_archives(folder), CAPTURE), "captures")
    made = captures.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("size")).first()
    ordered = captures.repartitionByRange(max(SEGMENTS, -(-made["n"] // SEGMENT_LINES)), "key").sortWithinPartitions("key")
    segments = mapped(ordered, _write_segments(folder), "first_key string, last_key string, segment string").collect()
    return CaptureIndex(sorted(tuple(s) for s in segments), folder, made["size"]), captures


def read_captures(index: CaptureIndex, wanted: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the captures named in `wanted` (page_id, url), found by the index
    and read by ranges: page_id, payload_bytes, payload_digest, record_type,
    refers_to, url, payload.  Each distinct capture is read once."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [line_key(url_key(u), p) for p, u in zip(batch["page_id"].to_pylist(), batch["url"].to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["key"])

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for key in batch["key"].to_pylist() for r in index.locate(key)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["archive", "offset", "length"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reads = Ranges()
        for batch in batches:
            rows = [parse(gzip.decompress(reads.read(*r))) for r in zip(*(batch[c].to_pylist() for c in ("archive", "offset", "length")))]
            cols = [("page_id", pa.int64()), ("size", pa.int64()), ("digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] if c != "payload" or with_payload else None for r in rows], t) for c, t in cols], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"])
        reads.close()

    asked = mapped(wanted.select(F.col("page_id").cast("long"), "url"), keys, "key string").distinct()
    asked = asked.repartitionByRange(max(SEGMENTS, len(index.segments)), "key").sortWithinPartitions("key")
    places = mapped(asked, locate, "archive string, offset long, length long")
    tasks = max(int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-index.size // READ_BYTES))
    places = places.repartition(tasks, "archive", F.floor(F.col("offset") / READ_BYTES)).sortWithinPartitions("archive", "offset")
    return mapped(places, fetch, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through archives and back: page_id, payload_bytes, payload_digest,
    record_type, refers_to.  See `write_pages` for nulls and repeats (each repeated
    row is a capture of its own); an empty table gives no rows, further columns are
    ignored."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    index, _ = write_pages(pages)
    found = read_captures(index, pages.select("page_id", "url"), with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
