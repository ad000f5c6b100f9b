"""WARC archives in Zstandard form: a dictionary in the leading skippable frame, then one frame per record.

Files are written and read by tasks through Arrow's file systems, at the
locations Spark's session names as shared. A file is known only by the manifest
row its writing task returns, so files of lost attempts are never read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeload.llm.common import attach, written
from homeload.session import shared_folder

#: Fixed values of the formats.
DICTIONARY_FRAME, ZSTD_FRAME, VERSION = 0x184D2A5D, 0xFD2FB528, "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVE_BYTES = 64 << 20
#: Archives beyond that many share reading tasks.
MOST_TASKS = 20_000
SAMPLE_ROWS, SAMPLE_BYTES, DICTIONARY_BYTES = 200, 8192, 64 << 10


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    number = record.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One whole record; a revisit keeps the payload's digest and length but not the payload."""
    digest = payload_digest(payload)
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(len(payload))), ("Content-Type", "application/http;msgtype=response"),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    else:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
        block = b"HTTP/1.1 200 OK\r\n\r\n"
    headers += [("WARC-Block-Digest", f"sha1:{payload_digest(block)}"), ("Content-Length", str(len(block)))]
    head = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The record's fields; raises ``ValueError`` where a header, length or digest is wrong."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or lines[0] != VERSION:
        raise ValueError("not a WARC record")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip() or name.lower() in fields:
            raise ValueError(f"bad header {line!r}")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"header {name} is missing")
    block = rest[: int(fields["content-length"])]
    if len(block) != int(fields["content-length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("record length differs from Content-Length")
    if fields.get("warc-block-digest", "") != f"sha1:{payload_digest(block)}":
        raise ValueError("block digest differs")
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("HTTP header does not end")
    if fields["warc-type"] == "response":
        stated = re.search(rb"(?mi)^content-length: (\d+)\r?$", http)
        if stated is None or int(stated[1]) != len(payload) or int(fields["x-payload-length"]) != len(payload):
            raise ValueError("payload length differs")
        if fields["warc-payload-digest"] != f"sha1:{payload_digest(payload)}":
            raise ValueError("payload digest differs")
    elif fields["warc-type"] != "revisit" or "warc-refers-to" not in fields:
        raise ValueError("neither a response nor a revisit of another record")
    return fields | {"payload": payload}


def read_frames(stream) -> Iterator[bytes]:
    """Decoded records of one archive, one frame at a time; memory holds a single record."""
    import zstandard

    def exactly(n: int) -> bytes:
        data = stream.read(n)
        if len(data) != n:
            raise ValueError("archive is cut short")
        return data

    magic, size = struct.unpack("<II", exactly(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("archive does not start with a dictionary frame")
    stored = exactly(size)
    if stored[:4] == struct.pack("<I", ZSTD_FRAME):
        stored = zstandard.ZstdDecompressor().decompress(stored)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stored)) if stored else zstandard.ZstdDecompressor()
    pending = b""
    while pending or (pending := stream.read(1 << 16)):
        frame, out = reader.decompressobj(), []
        while not frame.eof:
            if not pending and not (pending := stream.read(1 << 16)):
                raise ValueError("last frame is cut short")
            out.append(frame.decompress(pending))
            pending = frame.unused_data if frame.eof else b""
        yield b"".join(out)


def _open(uri: str, mode: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))
    if mode == "r":
        return system.open_input_stream(path)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path)


def train_dictionary(pages: DataFrame, rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> bytes:
    """A compression dictionary from at most ``rows`` starts of payloads; it changes sizes, never contents.

    Too few or too uniform samples give no dictionary; the frame is then empty.
    """
    import zstandard

    starts = [r[0].encode() for r in pages.select(F.substring("html", 1, sample_bytes)).where("html != ''").limit(rows).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, starts).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, refers_to``: of equal payloads of at least ``min_bytes`` the largest page id answers, others refer to it.

    Null payloads are empty ones. Rows that repeat the answering page are
    answers too, and so are payloads that only null ids have. Payloads meet by
    SHA-1 and length in a partial aggregate; only digests that repeat are joined
    back, by a join that can be split.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1("html")).withColumn("size", F.octet_length("html"))
    found = pages.select(
        F.sha1(F.coalesce("html", F.lit(""))).alias("digest"), F.octet_length(F.coalesce("html", F.lit(""))).alias("size"),
        F.col("page_id").cast("long").alias("page_id"),
    ).where(F.col("size") >= min_bytes)
    answers = found.groupBy("digest", "size").agg(F.max("page_id").alias("answer"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = attach(rows, answers, ["digest", "size"])
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("answer")), F.col("answer"))
    return joined.select("page_id", "url", "html", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, dictionary: bytes, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``page_id, url, html, refers_to`` as archives below ``folder``; returns the manifest ``path, records, bytes``."""

    def write(batches):
        import zstandard

        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        coder = zstandard.ZstdCompressor(level=3, dict_data=trained)
        path, stream, size, records = "", None, 0, 0

        def manifest():
            return pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})

        try:
            for batch in batches:
                for page_id, url, html, refers_to in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    if stream is None:
                        path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
                        stream, records = _open(path, "w"), 0
                        lead = zstandard.ZstdCompressor(level=19).compress(dictionary) if dictionary else b""
                        size = 8 + len(lead)
                        stream.write(struct.pack("<II", DICTIONARY_FRAME, len(lead)) + lead)
                    frame = coder.compress(record_bytes(page_id, url, html.encode(), refers_to))
                    stream.write(frame)
                    size, records = size + len(frame), records + 1
                    if size >= archive_bytes:
                        stream.close()
                        stream = None
                        yield manifest()
            if stream is not None:
                stream.close()
                stream = None
                yield manifest()
        finally:
            if stream is not None:
                stream.close()

    rows = pages.select("page_id", "url", "html", "refers_to")
    return written(rows.mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string"


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the manifest's archives, validated; a wrong header, length or digest fails the job.

    ``payload_bytes`` and ``payload_digest`` tell of the full payload, for
    revisits as their headers state. Payloads come along only if asked for.
    """

    def read(batches):
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        names = [f.split()[0] for f in READ.split(", ")]
        for batch in batches:
            for path, stated in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, held, n = [], 0, 0
                with _open(path, "r") as stream:
                    for raw in read_frames(io.BufferedReader(stream, 1 << 20)):
                        r, n = parse_record(raw), n + 1
                        refers = r.get("warc-refers-to")
                        rows.append((
                            page_of(r["warc-record-id"]), r.get("warc-target-uri"), int(r["x-payload-length"]),
                            r["warc-payload-digest"].removeprefix("sha1:"), r["warc-type"],
                            page_of(refers) if refers else None, r["payload"].decode() if with_payload else None,
                        ))
                        held += len(r["payload"]) if with_payload else 0
                        if len(rows) >= 5000 or held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows, held = [], 0
                if n != stated:
                    raise ValueError(f"{path} holds {n} records, its manifest states {stated}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    # one archive is a task's least share; with a stated number tasks are not merged, however small the manifest
    paths = manifest.select("path", "records").repartition(max(1, min(manifest.count(), MOST_TASKS)))
    return paths.mapInArrow(read, READ)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    folder = shared_folder(pages.sparkSession, "warc")
    manifest = write_archives(with_revisits(pages, min_bytes), folder, train_dictionary(pages))
    return read_archives(manifest)


def base32_sql(hex_digits: str) -> str:
    """DuckDB text: base32 of 40 hex digits, five bits at a time."""
    piece = f"CAST('0x' || substr({hex_digits}, 5 * (i // 4) + 1, 5) AS BIGINT)"
    letter = f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((({piece}) >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1)"
    return f"array_to_string(list_transform(range(0, 32), lambda i: {letter}), '')"
