"""WARC archives (3): dictionary-compressed records.

File layout (one file per partition): a leading skippable frame 0x184D2A5D that holds the Zstandard dictionary, then one
Zstandard frame per record (a ``warcinfo`` record first), each followed by an empty skippable frame.  Any Zstandard
reader that loads the dictionary reads the file as one WARC/1.1 stream; any record can be read by its offset alone.

The dictionary is trained on the serialized records of at most ``SAMPLE`` pages of at most ``SAMPLE_BYTES`` bytes (the
smallest hashes of the payloads); without enough of them records are compressed without one (empty frame).

Of pages with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the largest id is archived as ``response``
and the others as ``revisit`` records that refer to it; they hold the HTTP header with the payload's length and digest.
Equal means equal SHA-256; only groups of several pages take part in the join that finds them.

Defined results: null payloads are empty; null urls have no target field; control characters and spaces in urls are percent-encoded;
pages without id are archived without the id field, count as smaller than all, and are read back with a null id; pages that
share the largest id of their group are all responses; an empty table makes no records.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
from collections.abc import Iterator
from uuid import UUID

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.store import hash_sample, read_files, skippable, write_frames

DICTIONARY_FRAME = 0x184D2A5D
REVISIT_BYTES = 1000
SAMPLE = 1500
SAMPLE_BYTES = 1 << 15
DICTIONARY = 1 << 16
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(name: str) -> str:
    return f"<urn:uuid:{UUID(bytes=hashlib.md5(name.encode()).digest(), version=4)}>"


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))] if v is not None)
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    digest = hashlib.sha1(payload).digest()
    target = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    revisit = refers_to is not None
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(f"page:{page_id}" if page_id is not None else f"url:{url}:{digest.hex()}")),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(digest).decode()),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(f"page:{refers_to}") if revisit else None),
        ("X-Page-ID", page_id),
        ("X-Refers-To-Page-ID", refers_to),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    return _record(fields, http if revisit else http + payload)


def _info() -> bytes:
    body = b"software: riskframe\r\nformat: WARC File Format 1.1\r\n"
    return _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("info")), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], body)


def _payloads(batch: pa.RecordBatch, at: int) -> list[bytes]:
    return [x or b"" for x in batch.column(at).cast(pa.binary()).to_pylist()]


def train_dictionary(pages: DataFrame) -> bytes:
    """``pages``: id, url, payload.  Empty if there is too little to learn from."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _payloads(b, 2), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([page_record(i, u, p, None) for i, u, p in rows], pa.binary())], names=["record"])

    few = hash_sample(pages.where(F.octet_length("payload") <= SAMPLE_BYTES), F.col("payload"), SAMPLE)
    samples = [bytes(r["record"]) for r in few.mapInArrow(records, "record binary").collect()]
    if sum(map(len, samples)) < 4 * DICTIONARY:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressed(dictionary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zd = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if zd:
            zd.precompute_compress(level=LEVEL)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zd)
        out, begun = [], False
        for b in batches:
            for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _payloads(b, 2), b.column(3).to_pylist(), strict=True):
                if not begun:
                    out, begun = [skippable(dictionary, DICTIONARY_FRAME), press.compress(_info())], True
                out.append(press.compress(page_record(*row)))
                if len(out) >= 256:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    return run


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Archive every row of ``pages`` below ``path``."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    dictionary = train_dictionary(rows)
    sha = F.sha2(F.col("payload").cast("binary"), 256)
    groups = (rows.where(F.octet_length("payload") >= REVISIT_BYTES).select("id", sha.alias("sha")).groupBy("sha")
              .agg(F.max("id").alias("kept"), F.count("*").alias("n")).where("n > 1").select("sha", "kept"))
    placed = rows.withColumn("sha", sha).join(groups, "sha", "left")
    refers = F.when(F.col("kept").isNotNull() & ~F.col("id").eqNullSafe(F.col("kept")), F.col("kept"))
    records = placed.select("id", "url", "payload", refers.alias("refers_to"))
    write_frames(records.mapInArrow(_compressed(dictionary), "frame binary"), path)


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record of one archive's bytes."""
    size = int.from_bytes(content[4:8], "little")
    if int.from_bytes(content[:4], "little") != DICTIONARY_FRAME:
        raise ValueError("the archive does not begin with its dictionary")
    zd = zstandard.ZstdCompressionDict(content[8 : 8 + size]) if size else None
    reader = zstandard.ZstdDecompressor(dict_data=zd).stream_reader(io.BytesIO(content[8 + size :]), read_across_frames=True)
    stream = io.BufferedReader(reader, 1 << 20)
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError("a record does not begin where the one before it ends")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode().partition(":")
            fields[k.lower()] = v.strip()
        block = stream.read(int(fields["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        yield fields, block


def page_of(fields: dict[str, str], block: bytes) -> dict | None:
    """One page's row from its record (None for other records); a response's digest is checked against its payload."""
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    head, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?i)^content-length: *(\d+)", head, re.M)[1])
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != length):
        raise ValueError(f"payload of {fields['warc-record-id']} does not have its digest")
    number = lambda k: int(fields[k]) if k in fields else None
    return {"page_id": number("x-page-id"), "url": fields.get("warc-target-uri"), "record_type": kind, "payload_bytes": length, "payload_digest": digest,
            "refers_to": number("x-refers-to-page-id"), "payload": payload if kind == "response" else None}


SCHEMA = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Page rows of all archives below ``path``; with ``payload`` the archived bytes as well (null for revisits)."""
    types = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64()}
    if payload:
        types["payload"] = pa.binary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                rows = []
                for record in records(content.as_py()):
                    if (row := page_of(*record)) is not None:
                        rows.append(row)
                    if len(rows) >= 1000:
                        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in types.items()], names=list(types))
                        rows = []
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in types.items()], names=list(types))

    return read_files(spark, path).mapInArrow(run, SCHEMA + ", payload binary" * payload)
