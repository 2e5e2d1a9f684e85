"""Zstandard WARC archives: one frame per record, dictionary in a leading skippable frame.

Writing: pages with equal payloads share a digest; the row with the largest
id is a ``response``, the others are ``revisit`` records without a payload
that refer to it. Every task writes files of its own in the shared folder and
a manifest names the files that count, so repeated tasks leave no duplicates.
Reading: the dictionary is loaded from the skippable frame, each frame is
decoded by itself, and headers, lengths and digests are validated; an
archive that breaks a rule raises ValueError.

Edge cases: a null payload is empty; a null id is smaller than any other; of
equal rows (same id and payload) one is the response and the others revisit
it; a payload shorter than ``min_bytes`` is always a response; a null URL
becomes a urn of the id; line breaks and blanks in URLs are escaped; an empty
table writes nothing; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_mart.llm import files
from retail_mart.llm.common import cut, run_dir

SKIPPABLE = 0x184D2A5D  # fixed value: the skippable frame that holds a dictionary
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"  # fixed value
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
# The dictionary is trained on at most so many pages of at most so many bytes, those with the smallest digests.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 256, 1 << 16, 32 << 10
FILE_BYTES = 64 << 20
DATE = "1970-01-01T00:00:00Z"
_READ = 1 << 15


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train(samples: list[bytes]) -> bytes:
    """A dictionary; plain sample content where there is too little to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


@dataclass
class Page:
    page_id: int | None
    url: str | None
    payload: bytes
    record_type: str = "response"
    refers_to: int | None = None
    #: of the full payload, which a revisit doesn't hold
    payload_bytes: int = -1
    payload_digest: str = ""


def _urn(page_id: int | None, record_type: str, nonce: str) -> str:
    """A response's id follows from its page; a revisit's is its own."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}' + (f':{nonce}' if record_type == 'revisit' else ''))}>"


def encode_record(p: Page, nonce: str) -> bytes:
    d = digest(p.payload)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(p.payload)}\r\n\r\n").encode()
    block = http + (p.payload if p.record_type == "response" else b"")
    url = quote(p.url, safe=":/?#[]@!$&'()*+,;=%") if p.url else f"urn:page:{p.page_id}"
    head = ["WARC/1.1", f"WARC-Type: {p.record_type}", f"WARC-Record-ID: {_urn(p.page_id, p.record_type, nonce)}",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{d}",
            f"WARC-Block-Digest: sha1:{digest(block)}", "Content-Type: application/http;msgtype=response"]
    if p.page_id is not None:
        head.append(f"X-Page-ID: {p.page_id}")
    if p.record_type == "revisit":
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_urn(p.refers_to, 'response', '')}"]
        if p.refers_to is not None:
            head.append(f"X-Refers-To-Page-ID: {p.refers_to}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes, first: str) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not re.fullmatch(first, lines[0]):
        raise ValueError(f"bad first line {lines[0][:60]!r}")
    out: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not re.fullmatch(r"[!#$%&'*+\-.^_`|~0-9A-Za-z]+", name):
            raise ValueError(f"bad header line {line[:60]!r}")
        if out.setdefault(name.lower(), value.strip()) != value.strip():
            raise ValueError(f"two values of {name}")
    return out


def decode_record(raw: bytes) -> Page:
    """Parse and validate one whole record."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("the record's header does not end")
    h = _fields(head, r"WARC/1\.[01]")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest", "warc-target-uri"):
        if name not in h:
            raise ValueError(f"no {name}")
    if not re.fullmatch(r"\d+", h["content-length"]) or len(rest) != int(h["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError("the block's length is not Content-Length")
    block, kind = rest[:-4], h["warc-type"]
    if kind not in ("response", "revisit"):
        raise ValueError(f"unknown record type {kind}")
    if "warc-block-digest" in h and h["warc-block-digest"] != f"sha1:{digest(block)}":
        raise ValueError("the block's digest is wrong")
    http, gap, payload = block.partition(b"\r\n\r\n")
    length = _fields(http, r"HTTP/1\.[01] \d{3}.*").get("content-length", "")
    if not gap or not length.isdigit():
        raise ValueError("bad HTTP header")
    own = h["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != int(length) or digest(payload) != own):
        raise ValueError("the payload does not match its length or digest")
    if kind == "revisit" and (payload or h.get("warc-profile") != REVISIT or "warc-refers-to" not in h):
        raise ValueError("bad revisit record")
    number = lambda k: int(h[k]) if k in h else None
    return Page(number("x-page-id"), h["warc-target-uri"], payload, kind, number("x-refers-to-page-id"), int(length), own)


class ArchiveWriter:
    def __init__(self, f: BinaryIO, dictionary: bytes):
        self.f = f
        packed = zstandard.ZstdCompressor().compress(dictionary)
        f.write(struct.pack("<II", SKIPPABLE, len(packed)) + packed)
        self.bytes = 8 + len(packed)
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.packer = zstandard.ZstdCompressor(level=3, dict_data=known, write_checksum=True, write_content_size=True)

    def add(self, record: bytes) -> None:
        frame = self.packer.compress(record)
        self.f.write(frame)
        self.bytes += len(frame)


def read_archive(f: BinaryIO) -> Iterator[bytes]:
    """The records of an archive; holds one record and a read buffer."""
    head = f.read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != SKIPPABLE:
        raise ValueError("no leading dictionary frame")
    size = struct.unpack("<I", head[4:])[0]
    packed = f.read(size)
    if len(packed) != size:
        raise ValueError("the dictionary frame is cut off")
    raw = zstandard.ZstdDecompressor().decompress(packed) if packed[:4] == ZSTD_MAGIC else packed
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    rest = f.read(_READ)
    while rest:
        frame, parts = unpacker.decompressobj(), []
        while not frame.eof:
            if not rest:
                raise ValueError("a frame is cut off")
            try:
                parts.append(frame.decompress(rest))
            except zstandard.ZstdError as e:
                raise ValueError(f"bad frame: {e}") from e
            rest = frame.unused_data if frame.eof else f.read(_READ)
        yield b"".join(parts)
        if not rest:
            rest = f.read(_READ)


def with_roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, record_type, refers_to); only digests are grouped, so a hot payload pre-aggregates."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    p = p.withColumn("d", F.sha1(F.col("html").cast("binary")))
    n = p.filter(F.octet_length("html") >= min_bytes).groupBy("d", "page_id").agg(F.count("*").alias("n"))
    best = cut(n.groupBy("d").agg(F.max(F.struct("page_id", "n")).alias("best")))
    j = p.join(best, "d", "left").withColumn("wins", F.col("page_id").eqNullSafe(F.col("best.page_id")))
    only = F.col("best").isNull() | ~F.col("wins") | (F.col("best.n") == 1)
    response = F.col("best").isNull() | F.col("wins")
    plain = j.filter(only).withColumn("record_type", F.when(response, "response").otherwise("revisit"))
    cols = ["page_id", "url", "html", "record_type",
            F.when(F.col("record_type") == "revisit", F.col("best.page_id")).alias("refers_to")]
    if not best.filter(F.col("best.n") > 1).limit(1).count():
        return plain.select(*cols)
    # equal rows of the response's id: one of them is the response
    w = Window.partitionBy("d").orderBy("url")
    equal = (j.filter(~only).groupBy("d", "page_id", "url", "html", "best").agg(F.count("*").alias("times"))
             .withColumn("place", F.row_number().over(w))
             .withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
             .withColumn("record_type", F.when((F.col("place") == 1) & (F.col("k") == 1), "response").otherwise("revisit")))
    return plain.select(*cols).union(equal.select(*cols))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write the archives below ``folder``; the manifest (path, records, bytes), itself stored."""
    html = F.col("html").cast("string")
    some = pages.filter((F.octet_length(html) <= SAMPLE_BYTES) & (html != "")).select(F.sha1(html.cast("binary")).alias("d"), html.alias("html"))
    # digests first, then the few texts: no task sends more than SAMPLE_PAGES digests
    last = some.select("d").distinct().orderBy("d").limit(SAMPLE_PAGES).agg(F.max("d").alias("d")).first().d
    sample = some.filter(F.col("d") <= last).distinct().orderBy("d").collect() if last else []
    dictionary = train([r.html.encode() for r in sample]) if sample else b""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, f, path, n = None, None, "", 0
        for b in batches:
            for i in range(b.num_rows):
                page_id, url, body, kind, refers = (c[i].as_py() for c in b.columns)
                if out is None:
                    path, n = f"{folder}/pages-{uuid.uuid4().hex}.warc.zst", 0
                    f = files.create(path)
                    out = ArchiveWriter(f, dictionary)
                out.add(encode_record(Page(page_id, url, body.encode(), kind, refers), f"{path}:{n}"))
                n += 1
                if out.bytes >= FILE_BYTES:
                    f.close()
                    yield pa.RecordBatch.from_pydict({"path": [path], "records": [n], "bytes": [out.bytes]})
                    out = None
        if out is not None:
            f.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [n], "bytes": [out.bytes]})

    return cut(with_roles(pages, min_bytes).mapInArrow(write, "path string, records long, bytes long"))


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of the archives that the manifest names, with payloads on request."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    schema += ", payload binary" if payloads else ""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: list[Page]) -> pa.RecordBatch:
            cols = [pa.array([getattr(p, k) for p in found], t) for k, t in
                    (("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()))]
            return pa.RecordBatch.from_arrays(cols[:6 + payloads], ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"][:6 + payloads])

        for b in batches:
            for path, records in zip(b.column("path").to_pylist(), b.column("records").to_pylist(), strict=True):
                found, n = [], 0
                with files.open_at(path) as f:
                    for raw in read_archive(f):
                        p = decode_record(raw)
                        p.payload = p.payload if payloads else b""
                        found.append(p)
                        n += 1
                        if len(found) >= (64 if payloads else 4096):
                            yield rows(found)
                            found = []
                if n != records:
                    raise ValueError(f"{path}: {n} records, the manifest says {records}")
                yield rows(found)

    return manifest.repartition(max(1, manifest.count()), "path").mapInArrow(read, schema)


def archive_round_trip(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    return read_archives(write_archives(pages, folder or run_dir(pages.sparkSession, "warc"), min_bytes))
