"""Web pages as WARC archives, each record a Zstandard frame of its own, all of an archive with one dictionary.

An archive starts with a skippable frame that holds the dictionary, built from the archive's own records (a bounded
share of them, spread evenly); an archive of too few records for one has none. The records follow, each in its own
frame, so that one can be read without the others. Equal payloads of at least `least_bytes` are stored once: the
smallest id is the response, the others are revisits that refer to it.

Spark writes the files: a task makes archives of bounded size, each one row, and the text sink writes one row per
file; its line end is an empty skippable frame, which readers pass over. So a lost executor leaves no half archive.

Null payloads are empty. Rows that share the smallest id are all responses. A null id is never the smallest; it is
written as `none` and read back as null. A null url leaves its header out; control characters in urls are
percent-encoded. An empty table gives no archive. Other columns than page_id, url and html are not read.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DICTIONARY_FRAME, SKIPPABLE = 0x184D2A5D, range(0x184D2A50, 0x184D2A60)
EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0).decode()
ARCHIVE_BYTES, DICTIONARY_BYTES, SAMPLE_BYTES = 32 << 20, 32 << 10, 2 << 20
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def marked(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """page_id, url, payload, digest and the id of the response that a revisit refers to."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"),
                        F.sha2(payload, 256).alias("digest"))
    large = rows.where(F.octet_length("payload") >= least_bytes)
    first = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where(
        "n > 1 and first is not null").drop("n")
    return rows.join(first, "digest", "left").select("page_id", "url", "payload", "digest", F.when(
        ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    name = lambda x: f"<urn:x-page:{'none' if x is None else x}>"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}",
            f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    block = HTTP % len(payload)
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """From records spread over the archive, up to SAMPLE_BYTES of them; None where there are too few."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [x[: 128 << 10] for x in records[::step]], k=256, d=8)
    except zstandard.ZstdError:
        return None


def archive(records: list[bytes]) -> bytes:
    found = dictionary(records)
    out = []
    if found:
        raw = found.as_bytes()
        out = [struct.pack("<II", DICTIONARY_FRAME, len(raw)), raw]
    packer = zstandard.ZstdCompressor(level=3, dict_data=found)
    return b"".join(out + [packer.compress(x) for x in records])


def write(pages: DataFrame, folder: str, least_bytes: int = 100, date: str = "2000-01-01T00:00:00Z",
          archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write the archives of all pages to a new folder; `date` is the time of capture that records carry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                held.append(record(*row, date))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([archive(held)], pa.binary())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([archive(held)], pa.binary())], ["value"])

    rows = marked(pages, least_bytes).mapInArrow(run, "value binary")
    rows.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).option(
        "lineSep", EMPTY_FRAME).text(folder)


def frames(data: bytes) -> Iterator[bytes]:
    """The records of an archive."""
    at, reader, view = 0, zstandard.ZstdDecompressor(), memoryview(data)
    while at < len(data):
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE:
            if magic == DICTIONARY_FRAME:
                reader = zstandard.ZstdDecompressor(
                    dict_data=zstandard.ZstdCompressionDict(data[at + 8 : at + 8 + size]))
            at += 8 + size
            continue
        frame, out = reader.decompressobj(), []
        while not frame.eof:
            fed = view[at : at + 32768]
            if not len(fed):
                raise ValueError("an archive ends inside a record")
            out.append(frame.decompress(fed))
            at += len(fed) - len(frame.unused_data)
        yield b"".join(out)


def parsed(data: bytes) -> tuple:
    """A row of RECORDS; a payload that doesn't have its digest or length is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    size, digest = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda x: None if x is None or x.endswith(":none>") else int(x[len("<urn:x-page:"):-1])
    return (number(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"],
            number(fields.get("WARC-Refers-To")), fields.get("WARC-Target-URI"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """A row of RECORDS for each record of the archives of a folder."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows = [parsed(x) for x in frames(data.as_py())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(run, RECORDS)
