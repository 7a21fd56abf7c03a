"""Zstandard-compressed WARC archives: writer and reader.

An archive starts with a skippable frame that holds the dictionary (trained on the archive's own first
payloads, at most ``SAMPLE_ROWS`` rows and ``SAMPLE_BYTES`` bytes); every record is one further frame. Spark
writes the frames with its text sink: its line separator here is an empty skippable frame, which every
reader passes over, so the files are plain Zstandard streams in any file system that Spark reaches.

The reader takes whole archives of any writer that keeps to one frame per record: it loads the dictionary,
decodes frame by frame, and checks version line, required headers, lengths and digests. A broken record comes
out as a row with ``error`` set; a broken frame ends its archive with such a row.

Cases: a null payload is empty; a null page id or address leaves its header out; equal page ids are allowed
(all rows with the largest id of an equal payload are responses); control characters in addresses are
percent-encoded; an empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_REVISIT_BYTES = 1000
SAMPLE_ROWS = 256
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 32 << 10
ARCHIVE_BYTES = 64 << 20
DATE = "1970-01-01T00:00:00Z"  # the pages carry no time

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"  # skippable frame 0x184D2A50 of length 0
FRAME_MAGIC = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

READ_SCHEMA = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("frame_offset", T.LongType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("error", T.StringType()),
    ]
)


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload (null for revisits), payload_bytes, payload_digest, record_type, refers_to.

    Only digests and ids are grouped; the join that brings payloads and winners together is one adaptive
    execution may split where one payload makes up much of the table.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(bytearray()))
    rows = pages.select("page_id", "url", payload.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")
    )
    firsts = (
        rows.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("_first"))
    )
    revisit = (F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("_first")) & F.col("_first").isNotNull()
    return rows.join(firsts, "payload_digest", "left").select(
        "page_id",
        "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_first")).alias("refers_to"),
    )


def _record(page_id, url, payload, size, digest, kind, refers_to) -> bytes:
    body = payload or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + body
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{sha1}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(records: list[bytes]):
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records) if len(records) >= 16 else None
    except zstandard.ZstdError:  # too little, or all alike
        return None


def write_archives(records: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Archives of about ``archive_bytes`` of records (a longer record ends its archive), one task's after another.

    A task begins a new archive, with a dictionary of its own, where the last one is full; so an archive is bounded
    whatever the size of the partitions, and nothing is shuffled for it.
    """

    def archive(rows: Iterator[bytes]) -> Iterator[bytes]:
        import zstandard

        head, size = [], 0
        for record in itertools.islice(rows, SAMPLE_ROWS):
            head.append(record)
            size += len(record)
            if size >= min(SAMPLE_BYTES, archive_bytes):
                break
        if not head:
            return
        dictionary = _dictionary(head)
        if dictionary is not None:
            raw = zstandard.ZstdCompressor().compress(dictionary.as_bytes())
            yield struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw
        packer = zstandard.ZstdCompressor(level=3, dict_data=dictionary)
        yield from map(packer.compress, head)
        while size < archive_bytes and (record := next(rows, None)) is not None:
            size += len(record)
            yield packer.compress(record)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (_record(*r.values()) for batch in batches for r in batch.to_pylist())
        for nth in itertools.count():
            own, place = archive(rows), 0
            while part := list(itertools.islice(own, 500)):
                columns = [pa.array([nth] * len(part), pa.int64()), pa.array(range(place, place + len(part)), pa.int64()), pa.array(part, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["archive", "place", "frame"])
                place += len(part)
            if place == 0:
                return

    order = ("page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to")
    framed = records.select(*order).mapInArrow(frames, "archive long, place long, frame binary")
    placed = framed.sortWithinPartitions("archive", "place")  # the order the sink asks for, frames in theirs
    placed.select(F.col("frame").cast("string").alias("value"), "archive").write.partitionBy("archive").option("lineSep", EMPTY_FRAME).text(path)


def _frames(data: bytes) -> Iterator[tuple[int, bytes | None, str | None]]:
    """Offset, content and error of each frame that is not skippable; the leading one may hold the dictionary."""
    import zstandard

    dictionary, at = None, 0
    while at + 8 <= len(data):
        magic, length = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if magic == DICTIONARY_MAGIC and at == 0:
                raw = data[8 : 8 + length]
                if raw[:4] == struct.pack("<I", FRAME_MAGIC):
                    raw = zstandard.ZstdDecompressor().decompress(raw)
                dictionary = zstandard.ZstdCompressionDict(raw)
            at += 8 + length
            continue
        worker, content, place = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj(), [], at
        try:
            while not worker.eof and place < len(data):
                content.append(worker.decompress(data[place : place + 65536]))
                place += 65536
        except zstandard.ZstdError as broken:
            yield at, None, f"frame: {broken}"
            return
        if not worker.eof:
            yield at, None, "frame: cut short"
            return
        yield at, b"".join(content), None
        at = min(place, len(data)) - len(worker.unused_data)
    if at < len(data):
        yield at, None, "frame: trailing bytes"


def _page(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(found[1]) if found else None


def _parse(record: bytes) -> dict:
    """The columns of one record; raises ValueError with the fault."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not gap or not re.fullmatch(r"WARC/1\.[01]", version):
        raise ValueError("no WARC header")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"header {name} is missing")
    if not fields["content-length"].isdigit():
        raise ValueError("content-length is no number")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes, content-length {size}")
    http, gap, payload = rest[:size].partition(b"\r\n\r\n")
    inner = {k.lower(): v for k, _, v in (line.partition(": ") for line in http.decode("latin-1").split("\r\n")[1:])}
    if not gap or not inner.get("content-length", "").isdigit():
        raise ValueError("no HTTP header with a length")
    label, _, digest = fields.get("warc-payload-digest", "").partition(":")
    if label != "sha1":
        raise ValueError("no sha1 payload digest")
    digest, kind = base64.b32decode(digest).hex(), fields["warc-type"]
    if kind == "response" and (len(payload) != int(inner["content-length"]) or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("payload does not fit its length or digest")
    if kind == "revisit" and ("warc-refers-to" not in fields or payload):
        raise ValueError("revisit without its target, or with a payload")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "payload_bytes": int(inner["content-length"]),
        "payload_digest": digest,
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload": payload if kind == "response" else None,
    }


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """A row per record of all archives below ``path``; without ``payload`` that column is null."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("archive", pa.string()), ("frame_offset", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("error", pa.string())])
        for batch in batches:
            for k in range(batch.num_rows):
                name, rows = batch.column("path")[k].as_py(), []
                for at, content, error in _frames(batch.column("content")[k].as_py()):
                    row = {"archive": name, "frame_offset": at, "error": error}
                    if content is not None:
                        try:
                            row |= _parse(content)
                        except ValueError as fault:
                            row["error"] = str(fault)
                    if not payload:
                        row["payload"] = None
                    rows.append(row)
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where("length > 0").select("path", "content").mapInArrow(decode, READ_SCHEMA)


def round_trip(pages: DataFrame, path: str) -> DataFrame:
    """Write ``pages`` as archives below ``path``, read them back, fail on any broken record."""
    write_archives(with_revisits(pages), path)
    rows = read_archives(pages.sparkSession, path, payload=False)
    checked = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.col("archive"), F.lit(": "), F.col("error")))).otherwise(F.col("page_id"))
    return rows.select(checked.cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
