"""WARC archives in Zstandard: one frame per record, and a dictionary in front.

An archive begins with a skippable frame that holds the dictionary its records are compressed with.
Archives are written and read by Spark alone, so they can lie wherever Spark reads and writes. An archive
holds ``ARCHIVE_BYTES`` of frames, or one larger record; a task makes as many as its rows need. Each is a row, and
Spark's line writer puts every row into a file of its own, whose line end is an empty skippable frame, which
any Zstandard reader passes over. The reader loads the dictionary, walks from frame to frame by their
block headers, decodes one frame per record, and checks the record's headers and lengths. So a reader holds one
archive of bounded size, however many rows a task has written, and nothing goes through the driver.

Of records with equal payloads of ``min_bytes`` or more, the one with the smallest page_id is
the response, the others are revisits without payload. Defined results: NULL html is an
empty payload; rows that repeat the smallest page_id are responses all; NULL ids come last among
equals; a NULL url becomes the record's own identifier.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from itertools import chain
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
LEVEL = 3
DICTIONARY_BYTES = 16 << 10
TRAINING_BYTES = 512 << 10
ARCHIVE_BYTES = 16 << 20
# An empty skippable frame: magic number 0x184D2A50 and length 0.
SEPARATOR = struct.pack("<II", 0x184D2A50, 0).decode("latin-1")
# Record layout.
VERSION = "WARC/1.1"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Record-ID", "WARC-Type", "WARC-Date", "Content-Length")

RECORDS = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
    "target_uri string, payload binary, problem string"
)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    found = identifier.removeprefix("<urn:page:").removesuffix(">")
    return None if found == "none" else int(found)


def write_record(page_id: int | None, url: str | None, payload: bytes, revisit_of: int | None, revisit: bool) -> bytes:
    """One record. A revisit keeps the response's HTTP headers and leaves out the payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    target = record_id(page_id)[1:-1] if url is None else quote(url, safe="%:/?#[]@!$&'()*+,;=~")
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": f"sha1:{digest_of(payload)}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    if revisit:
        headers |= {"WARC-Refers-To": record_id(revisit_of), "WARC-Profile": PROFILE}
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def _headers(block: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = block.decode("utf-8", "replace").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def read_record(record: bytes) -> dict:
    """Fields of a record, with ``problem`` set to the first thing that is wrong with it."""
    found: dict = dict.fromkeys(part.split()[0] for part in RECORDS.split(", "))
    try:
        head, gap, rest = record.partition(b"\r\n\r\n")
        version, headers = _headers(head)
        if not version.startswith("WARC/1.") or not gap:
            raise ValueError("no WARC header")
        missing = [name for name in REQUIRED if name.lower() not in headers]
        if missing:
            raise ValueError(f"missing {', '.join(missing)}")
        length = int(headers["content-length"])
        if len(rest) != length + 4 or not rest.endswith(b"\r\n\r\n"):
            raise ValueError(f"block of {max(len(rest) - 4, 0)} bytes, {length} stated")
        kind = headers["warc-type"]
        if kind not in ("response", "revisit"):
            raise ValueError(f"record type {kind}")
        http, gap, payload = rest[:-4].partition(b"\r\n\r\n")
        stated = int(_headers(http)[1].get("content-length", "-1"))
        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
        found |= {
            "page_id": page_of(headers["warc-record-id"]),
            "payload_bytes": stated,
            "payload_digest": digest,
            "record_type": kind,
            "target_uri": headers.get("warc-target-uri"),
        }
        if kind == "revisit":
            found["refers_to"] = page_of(headers["warc-refers-to"])
            if payload:
                raise ValueError("a revisit with payload")
        else:
            found["payload"] = payload
            if len(payload) != stated:
                raise ValueError(f"payload of {len(payload)} bytes, {stated} stated")
            if digest_of(payload) != digest:
                raise ValueError("payload digest differs")
    except (ValueError, KeyError) as error:
        found["problem"] = str(error) or "unreadable"
    return found


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends, by its header and block headers."""
    if len(data) < at + 8:
        raise ValueError("archive ends within a frame")
    magic, length = struct.unpack_from("<II", data, at)
    if magic & 0xFFFFFFF0 == 0x184D2A50:
        end = at + 8 + length
    elif magic != FRAME_MAGIC:
        raise ValueError(f"no frame at byte {at}")
    else:
        flags = data[at + 4]
        single, checksum = flags >> 5 & 1, flags >> 2 & 1
        size = (1 if single else 0, 2, 4, 8)[flags >> 6]
        at += 5 + (not single) + (0, 1, 2, 4)[flags & 3] + size
        last = False
        while not last:
            if len(data) < at + 3:
                raise ValueError("archive ends within a frame")
            block = int.from_bytes(data[at : at + 3], "little")
            last = bool(block & 1)
            at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        end = at + 4 * checksum
    if end > len(data):
        raise ValueError("archive ends within a frame")
    return end


def read_archive(content: bytes) -> Iterator[dict]:
    """The records of an archive. What can't be decoded gives a row with ``problem`` alone."""
    data, at, reader = memoryview(content), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        try:
            end = frame_end(data, at)
            magic = struct.unpack_from("<I", data, at)[0]
            body = data[at:end]
            if magic == DICTIONARY_MAGIC and at == 0:
                held = bytes(body[8:])
                if held[:4] == struct.pack("<I", FRAME_MAGIC):
                    held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
            elif magic == FRAME_MAGIC:
                yield read_record(reader.decompressobj().decompress(body))
        except (ValueError, zstandard.ZstdError) as error:
            yield read_record(b"") | {"problem": str(error)}
            if not isinstance(error, zstandard.ZstdError):
                return
        at = end


def dictionary_of(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A trained dictionary, or the samples' own bytes where there are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES] or b"WARC/1.1")


def archives(records: Iterator[bytes], archive_bytes: int = ARCHIVE_BYTES) -> Iterator[list[bytes]]:
    """The frames of one archive after the other. The first records, up to ``TRAINING_BYTES`` of
    them, make the dictionary of all."""
    first, size = [], 0
    for record in records:
        first.append(record)
        size += len(record)
        if size >= TRAINING_BYTES:
            break
    if not first:
        return
    trained = dictionary_of(first)
    held = trained.as_bytes()
    head = struct.pack("<II", DICTIONARY_MAGIC, len(held)) + held
    writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
    frames, size = [head], len(head)
    for record in chain(first, records):
        frame = writer.compress(record)
        if len(frames) > 1 and size + len(frame) > archive_bytes:
            yield frames
            frames, size = [head], len(head)
        frames.append(frame)
        size += len(frame)
    yield frames


def with_first_page(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages with ``_first``, the smallest page_id of an equal payload if there are several."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("_payload"))
    rows = rows.withColumn("_key", F.sha1("_payload"))
    large = rows.where(F.octet_length("_payload") >= min_bytes)
    shared = (
        large.groupBy("_key")
        .agg(F.min("page_id").alias("_first"), F.count("*").alias("_copies"))
        .where("_copies > 1")
        .select("_key", "_first", F.lit(True).alias("_shared"))
    )
    return rows.join(shared, "_key", "left").withColumn(
        "_revisit", F.coalesce(F.col("_shared") & (F.col("_first") != F.coalesce("page_id", F.col("_first") - 1)), F.lit(False))
    )


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record for each page into archives under ``path``."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for page, url, payload, first, revisit in zip(*[c.to_pylist() for c in batch.columns]):
                    yield write_record(page, url, payload, first, revisit)

        for frames in archives(records(), archive_bytes):
            yield pa.RecordBatch.from_pydict({"archive": pa.array([b"".join(frames)], pa.binary())})

    rows = with_first_page(pages, min_bytes).select("page_id", "url", "_payload", "_first", "_revisit")
    lines = rows.mapInArrow(whole, "archive binary").select(F.col("archive").cast("string"))
    lines.write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", 1).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under ``path``, with what is wrong with each."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for record in read_archive(content.as_py()):
                    held.append(record)
                    size += len(record["payload"] or b"")
                    if size >= 1 << 22:
                        yield pa.RecordBatch.from_pylist(held, schema=kinds)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=kinds)

    types = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds = pa.schema([(n, types[t]) for n, t in (part.split() for part in RECORDS.split(", "))])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(records, RECORDS)
