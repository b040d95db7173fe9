"""WARC archives compressed with Zstandard: writer and reader.

An archive starts with a skippable frame that holds the dictionary; then comes one frame per record, so that a
record can be decoded without those before it. Archives are written through Spark's text sink, the one sink that
stores bytes as they are on any file system and commits them task by task; its line separator is an empty skippable
frame, which every Zstandard reader passes over. Archives are read as binary files, whole; they are kept small
by the number of records and of bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the formats: magic numbers of skippable frames (the first is the dictionary's) and of a
# dictionary, and the revisit profile.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
DICTIONARY_MAGIC = 0xEC30A437
FRAME_MAGIC = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SEPARATOR = struct.pack("<II", SKIPPABLE[0], 0).decode("ascii")
LEVEL = 6
# Bounds of the dictionary and of the payloads it is trained on (number, and bytes of each).
DICTIONARY_BYTES = 32_768
SAMPLE_ROWS = 512
SAMPLE_BYTES = 16_384
# Records of an archive, and bytes of its frames unless one frame alone has more; a reader holds one archive at a time.
RECORDS_PER_ARCHIVE = 5000
ARCHIVE_BYTES = 128 << 20
# Bytes handed to the decoder at a time.
_FEED = 1 << 16
_SMALL_FEED = 1 << 12


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- writing -----------------------------------------------------------------------------------------------


def train_dictionary(pages: DataFrame, payload: str = "payload") -> bytes:
    """A dictionary from at most SAMPLE_ROWS payloads, chosen by hash, of which the first SAMPLE_BYTES serve.

    Empty if there are too few bytes to train on; archives are then written without one.
    """
    rows = pages.where(F.octet_length(payload) > 0).select(
        F.xxhash64(payload).alias("mark"), F.substring(payload, 1, SAMPLE_BYTES).alias("payload")
    )
    # One payload per slot, found by its hash alone, so that no more than SAMPLE_ROWS of them are ever sent.
    slot = F.pmod(F.shiftright("mark", 16), F.lit(SAMPLE_ROWS))
    chosen = rows.groupBy(slot.alias("slot")).agg(F.min("mark").alias("mark")).select("mark")
    found = rows.join(F.broadcast(chosen), "mark", "left_semi").dropDuplicates(["mark"]).collect()
    sample = [bytes(r["payload"]) for r in sorted(found, key=lambda r: r["mark"])]
    if len(sample) < 8 or sum(map(len, sample)) < 8 * DICTIONARY_BYTES:
        return b""
    return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()


def _header(kind: str, fields: list[tuple[str, str | None]], length: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}"]
    lines += [f"{name}: {value}" for name, value in fields if value is not None]
    return "\r\n".join([*lines, f"Content-Length: {length}", "", ""]).encode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit has the HTTP header only; its Content-Length still tells the payload's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    digest = payload_digest(payload)
    name = "" if page_id is None else str(page_id)
    fields = [
        ("WARC-Record-ID", f"<urn:page:{name}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    return _header("revisit" if revisit else "response", fields, len(block)) + block + b"\r\n\r\n"


def _frames(
    dictionary: bytes, per_archive: int, archive_bytes: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Frames with the number of their archive in the task and their place in it; a dictionary frame has place 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True, write_content_size=True)
        head = struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary if dictionary else None
        task = TaskContext.get().partitionId()
        archive, n, held = -1, per_archive, 0
        for batch in batches:
            out: list[tuple[str, int, bytes]] = []
            for page_id, url, payload, refers_to, revisit in zip(*[c.to_pylist() for c in batch.columns]):
                frame = packer.compress(record_bytes(page_id, url, payload, refers_to, revisit))
                if n >= per_archive or held + len(frame) > archive_bytes:
                    archive, n, held = archive + 1, 0, len(head or b"")
                    if head:
                        out.append((f"{task:06d}-{archive:06d}", 0, head))
                n, held = n + 1, held + len(frame)
                out.append((f"{task:06d}-{archive:06d}", n, frame))
            names, places, frames = zip(*out) if out else ((), (), ())
            columns = [pa.array(names, pa.string()), pa.array(places, pa.int32()), pa.array(frames, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["archive", "place", "frame"])

    return run


def write_archives(
    records: DataFrame,
    path: str,
    dictionary: bytes = b"",
    per_archive: int = RECORDS_PER_ARCHIVE,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write ``records`` (page_id, url, payload, refers_to, revisit) as archives, each in a folder of its own below ``path``.

    An archive ends after ``per_archive`` records, or before the record that would take it over ``archive_bytes``; one larger
    record is an archive by itself. Order within a task is kept. No records give no archives.
    """
    rows = records.select("page_id", "url", "payload", "refers_to", "revisit")
    frames = rows.mapInArrow(_frames(dictionary, per_archive, archive_bytes), "archive string, place int, frame binary")
    placed = frames.sortWithinPartitions("archive", "place")
    sink = placed.select("archive", F.col("frame").cast("string").alias("value")).write
    sink.partitionBy("archive").option("lineSep", SEPARATOR).text(path)


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Records (page_id, url, payload, refers_to, revisit) of ``pages`` (page_id, url, html, …).

    The payload is the html in UTF-8, empty for null. Of the pages with equal payloads of ``least_bytes`` or more the
    largest page_id is the response, and the others revisit it; rows that repeat that id are responses too, and
    rows without an id revisit it. Payloads are told apart by SHA-256 and length.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"),
    )
    rows = rows.withColumns({"_digest": F.sha2("payload", 256), "_bytes": F.octet_length("payload")})
    groups = rows.where(F.col("_bytes") >= least_bytes).groupBy("_digest", "_bytes")
    latest = groups.agg(F.max("page_id").alias("_latest"), F.count(F.lit(1)).alias("_n"))
    joined = rows.join(latest.where("_n > 1").select("_digest", "_bytes", "_latest"), ["_digest", "_bytes"], "left")
    revisit = F.col("_latest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_latest"))
    return joined.select("page_id", "url", "payload", F.when(revisit, F.col("_latest")).alias("refers_to"), revisit.alias("revisit"))


# ---- reading -----------------------------------------------------------------------------------------------


# Bytes of a decoded record that are held at most, and of a frame's header.
MAX_RECORD = 1 << 30
_FRAME_HEAD = 18
# Names of archives: those of the sink here, and the usual ones.
ARCHIVE_NAMES = "*.{txt,zst}"


class ArchiveError(ValueError):
    """What is wrong with an archive or a record."""


def archive_frames(data: bytes, most: int = MAX_RECORD) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of every compressed frame of an archive, one record each.

    The leading skippable frame gives the dictionary, itself plain or compressed; other skippable frames are
    passed over. A frame that says it holds more than ``most`` bytes, or turns out to, ends the archive with an error.
    """
    view, at, known = memoryview(data), 0, None
    while at < len(view):
        if len(view) - at < 8:
            raise ArchiveError(f"{len(view) - at} stray bytes at {at}")
        magic, size = struct.unpack_from("<II", view, at)
        if magic in SKIPPABLE:
            body = bytes(view[at + 8 : at + 8 + size])
            if len(body) < size:
                raise ArchiveError(f"skippable frame at {at} is cut off")
            if at == 0 and magic == DICTIONARY_FRAME:
                known = zstandard.ZstdCompressionDict(_dictionary(body))
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise ArchiveError(f"no frame at {at}")
        start, parts = at, []
        try:
            told = zstandard.get_frame_parameters(view[at : at + _FRAME_HEAD]).content_size
            unsized = told == zstandard.CONTENTSIZE_UNKNOWN
            # A block of some bytes can stand for 128 KB, so without a stated size little is decoded at a time.
            held, step = (0, _SMALL_FEED) if unsized else (told, _FEED)
            decoder = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
            while held <= most and not decoder.eof:
                fed = view[at : at + step]
                if not len(fed):
                    raise ArchiveError(f"frame at {start} is cut off")
                parts.append(decoder.decompress(fed))
                at += len(fed) - len(decoder.unused_data)
                held += len(parts[-1]) if unsized else 0
            if held > most:
                raise ArchiveError(f"frame at {start} holds over {most} bytes")
        except zstandard.ZstdError as problem:
            raise ArchiveError(f"frame at {start}: {problem}") from problem
        yield start, b"".join(parts)


@lru_cache(maxsize=4)
def _dictionary(body: bytes) -> bytes:
    (magic,) = struct.unpack_from("<I", body) if len(body) >= 4 else (0,)
    if magic == FRAME_MAGIC:
        body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
        (magic,) = struct.unpack_from("<I", body) if len(body) >= 4 else (0,)
    if magic != DICTIONARY_MAGIC:
        raise ArchiveError("the first frame holds no dictionary")
    return body


def _fields(lines: list[str], what: str) -> dict[str, str]:
    """Header fields by lower-case name; a line that starts with white space goes on with the one before."""
    out: dict[str, str] = {}
    name = ""
    for line in lines:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
            continue
        name, mark, value = line.partition(":")
        name = name.strip().lower()
        if not mark or not name:
            raise ArchiveError(f"bad {what} header line {line[:60]!r}")
        if name in out and name != "warc-concurrent-to":
            raise ArchiveError(f"{what} header has {name} twice")
        out[name] = value.strip()
    return out


def _length(fields: dict[str, str], what: str) -> int:
    value = fields.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", value):
        raise ArchiveError(f"{what} has no valid Content-Length")
    return int(value)


def parse_record(record: bytes) -> dict:
    """Check and take apart one record; raises ArchiveError.

    Checked are the version line, the required fields, that the block is as long as the header says and is followed
    by two line ends and nothing else, the block's digest, and for a response the payload's length and digest.
    """
    head, mark, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not mark or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise ArchiveError("no WARC header")
    fields = _fields(lines[1:], "record")
    for name in ("warc-record-id", "warc-date", "warc-type"):
        if not fields.get(name):
            raise ArchiveError(f"record has no {name}")
    length = _length(fields, "record")
    block, tail = rest[:length], rest[length:]
    if len(block) < length or tail != b"\r\n\r\n":
        raise ArchiveError(f"block has {len(rest) - 4} bytes, its header says {length}")
    stated = fields.get("warc-block-digest", "")
    if stated.startswith("sha1:") and stated[5:] != payload_digest(block):
        raise ArchiveError("block digest differs")
    kind, payload, size = fields["warc-type"], block, length
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if "application/http" in fields.get("content-type", ""):
        http, mark, payload = block.partition(b"\r\n\r\n")
        if not mark:
            raise ArchiveError("HTTP header does not end")
        inner = _fields(http.decode("utf-8", "replace").split("\r\n")[1:], "HTTP")
        size = _length(inner, "HTTP message") if "content-length" in inner else len(payload)
    if kind == "revisit":
        if not fields.get("warc-profile") or not digest:
            raise ArchiveError("revisit has no profile or payload digest")
        payload = None
    else:
        if size != len(payload):
            raise ArchiveError(f"payload has {len(payload)} bytes, its header says {size}")
        if digest and digest != payload_digest(payload):
            raise ArchiveError("payload digest differs")
        digest = digest or payload_digest(payload)
    return {
        "record_type": kind,
        "record_id": fields["warc-record-id"],
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "payload": payload,
        "payload_bytes": size,
        "payload_digest": digest,
    }


RECORD = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
_ARROW = [
    (f.name, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[f.dataType.simpleString()])
    for f in RECORD.fields
]
# Records in one outgoing batch, and bytes of payload.
_OUT_ROWS, _OUT_BYTES = 1000, 32 << 20


def _batch(rows: list[dict]) -> pa.RecordBatch:
    arrays = [pa.array([r.get(name) for r in rows], kind) for name, kind in _ARROW]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in _ARROW])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[dict] = []
    held = 0
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            place = {"archive": path.as_py(), "offset": 0}
            try:
                for offset, record in archive_frames(content.as_py()):
                    place["offset"] = offset
                    try:
                        rows.append(place | parse_record(record))
                    except ArchiveError as problem:
                        rows.append(place | {"error": str(problem)})
                    held += len(record)
                    if len(rows) >= _OUT_ROWS or held >= _OUT_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
            except ArchiveError as problem:
                rows.append(place | {"error": str(problem)})
    yield _batch(rows)


def read_archives(spark: SparkSession, path: str, names: str = ARCHIVE_NAMES) -> DataFrame:
    """One row per record of all archives in the folder ``path``, and in folders below it, whose names fit the pattern ``names``.

    A record that fails a check, and an archive from the place on where it cannot be read, is a row with ``error``
    and without content. ``payload`` is null for revisits; their ``payload_bytes`` and ``payload_digest``
    are those of the payload they stand for. An empty file has no records.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInArrow(_records, RECORD)


def page_of(record_id: str) -> Column:
    """The page_id in a record id of `record_bytes`; null if there is none."""
    return F.regexp_extract(record_id, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
