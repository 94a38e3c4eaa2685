"""WARC archives in seekable Zstandard bundles.

A bundle is a ``.warc.zst`` file of independent Zstandard frames. A frame holds
whole records, up to ``FRAME_BYTES`` (a larger record has a frame of its own). A
skippable frame at the end is the seek table of the Zstandard seekable format:
the compressed and the plain size of every frame, their number and a magic
number. A plain ``zstd -d`` gives the WARC file; a reader of one record reads the
footer, adds up compressed sizes to the frame's place, and expands that frame
alone. The index maps each record's identifier to (bundle, frame, offset in the
plain frame, length).

A record's payload is the html in UTF-8. Of records with equal payloads the one
with the largest page_id is a ``response``; the others are ``revisit`` records
that refer to it and hold no payload. Payloads are compared by SHA-256 and
length; only digests and ids are shuffled for this, never payloads.

Tasks write bundles under names of their own into the given folder and return
the index rows of what they wrote, so a task that runs again leaves at most an
unlisted file: what the index doesn't list doesn't exist. The folder is any URI
that ``pyarrow.fs`` can open from executors.

Null html is an empty payload; null url writes no target; rows whose page_id is
null count as the smallest and are named ``null``; repeated rows of the largest
page_id are responses each; an empty table gives no bundle and an empty index.
Only page_id, url and html are read, so further columns never clash.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.session import checkpoint_dir

FRAME_BYTES = 1 << 20
#: A task begins a new bundle after so many compressed bytes.
BUNDLE_BYTES = 256 << 20
LEVEL = 3
#: Payloads of fewer bytes are written anew each time.
MIN_REVISIT_BYTES = 0
#: Decisions are joined by broadcast up to so many rows (about 100 bytes each), else by a shuffle.
BROADCAST_ROWS = 100_000
#: A reading task gets about so many frames, whatever the size of the index.
FRAMES_PER_TASK = 32
#: Pages carry no time of their own.
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the Zstandard seekable format and of the WARC format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "record_id string, page_id long, bundle string, frame long, offset long, length long"
_FOOTER = struct.Struct("<IBI")
_ENTRY = struct.Struct("<II")


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page_id: int | None) -> str:
    return f"urn:page:{'null' if page_id is None else page_id}"


def _target(url: str) -> str:
    """The URL with white space and control characters percent-encoded, so that it stays one header line."""
    return "".join(c if c.isprintable() and not c.isspace() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or, with ``refers_to``, a revisit record of the same response without its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_name(page_id)}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_target(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest_of(payload)}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_name(refers_to)}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """(WARC headers by lower-case name, payload) of one record; raises ValueError where its form is broken."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or lines[0] != "WARC/1.1" or not data.endswith(b"\r\n\r\n"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[:-4]
    if int(headers["content-length"]) != len(block):
        raise ValueError(f"record of {len(block)} bytes, its header says {headers['content-length']}")
    return headers, block.partition(b"\r\n\r\n")[2]


class BundleWriter:
    """One bundle: records go to the frame at work, which is compressed on its own when full."""

    def __init__(self, uri: str, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        system, path = opened(uri)
        self.out = system.open_output_stream(path, compression=None)  # not by the file's ending: frames are compressed here
        self.limit, self.size = frame_bytes, 0
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.held: list[bytes] = []
        self.filled = 0

    def add(self, data: bytes) -> tuple[int, int, int]:
        """(frame, offset in the plain frame, length) of the record just added."""
        if self.held and self.filled + len(data) > self.limit:
            self.flush()
        at = (len(self.frames), self.filled, len(data))
        self.held.append(data)
        self.filled += len(data)
        return at

    def flush(self) -> None:
        if self.held:
            packed = self.packer.compress(b"".join(self.held))
            self.out.write(packed)
            self.frames.append((len(packed), self.filled))
            self.size += len(packed)
            self.held, self.filled = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(_ENTRY.pack(*f) for f in self.frames) + _FOOTER.pack(len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()


class BundleReader:
    """Random access to a bundle through its seek table."""

    def __init__(self, uri: str):
        system, path = opened(uri)
        self.source = system.open_input_file(path)
        end = self.source.size()
        self.source.seek(end - _FOOTER.size)
        n, descriptor, magic = _FOOTER.unpack(self.source.read(_FOOTER.size))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{uri} has no seek table")
        entry = _ENTRY.size + (4 if descriptor & 0x80 else 0)  # with a checksum where the top bit says so
        size = n * entry + _FOOTER.size
        self.source.seek(end - size - 8)
        head = struct.unpack("<II", self.source.read(8))
        if head != (SKIPPABLE_MAGIC, size):
            raise ValueError(f"{uri} has a broken seek table")
        table, self.places, at = self.source.read(n * entry), [], 0
        for k in range(n):
            packed, plain = _ENTRY.unpack_from(table, k * entry)
            self.places.append((at, packed, plain))
            at += packed

    def frame(self, k: int) -> bytes:
        """The plain bytes of frame ``k``; no other frame is read."""
        at, packed, plain = self.places[k]
        self.source.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=plain)

    def close(self) -> None:
        self.source.close()


def _bounded(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast where its counted rows are few."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def decided(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, refers_to): the page_id of the response that a row revisits, else null."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"))
    key = F.struct(F.unhex(F.sha2("payload", 256)).alias("h"), F.length("payload").cast("long").alias("n"))
    groups = (rows.select(key.alias("key"), "page_id").groupBy("key").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("copies"))
              .where((F.col("copies") > 1) & (F.col("key.n") >= min_bytes)).select("key", "last").checkpoint())
    d = rows.withColumn("key", key).join(_bounded(groups), "key", "left")
    return d.select("page_id", "url", "payload", F.when(F.coalesce(F.col("page_id") < F.col("last"), F.col("last").isNotNull() & F.col("page_id").isNull()), F.col("last")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` to bundles in ``folder``; the index, one row per record.

    The index is checkpointed: it lists exactly the bundles of the tasks that count.
    """
    checkpoint_dir(pages.sparkSession)
    opened(folder)[0].create_dir(opened(folder)[1], recursive=True)
    root = folder.rstrip("/")

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = name = None
        try:
            for part in parts:
                columns = [part.column(c) for c in ("page_id", "url", "payload", "refers_to")]
                rows = []
                for k in range(part.num_rows):  # one payload at a time, never a batch of them as Python bytes
                    page_id, url, payload, refers_to = (c[k].as_py() for c in columns)
                    if bundle is None:
                        name = f"{uuid.uuid4().hex}.warc.zst"
                        bundle = BundleWriter(f"{root}/{name}", frame_bytes)
                    rows.append((record_name(page_id), page_id, name, *bundle.add(record(page_id, url, payload, refers_to))))
                    if bundle.size >= bundle_bytes:
                        bundle.close()
                        bundle = None
                if rows:
                    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["record_id", "page_id", "bundle", "frame", "offset", "length"])
        finally:
            if bundle is not None:
                bundle.close()

    return decided(pages, min_bytes).mapInArrow(write, INDEX).checkpoint()


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """(record_id, page_id, type, target, refers_to, header_digest, payload): the records that ``index`` lists, read by seeks.

    Every frame that holds a listed record is read and expanded once; filter the
    index to read single records. Raises where a record isn't the one its
    identifier names, or its form is broken.
    """
    root = folder.rstrip("/")
    n_frames = index.select("bundle", "frame").distinct().count()
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-n_frames // FRAMES_PER_TASK))
    # a frame's records: bounded by the bytes of a frame
    frames = index.repartition(tasks, "bundle", "frame").groupBy("bundle", "frame").agg(F.collect_list(F.struct("record_id", "page_id", "offset", "length")).alias("records"))

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = at = None
        for part in parts:
            for bundle, frame, records in zip(*(part.column(c) for c in ("bundle", "frame", "records")), strict=True):
                if bundle.as_py() != at:
                    if reader is not None:
                        reader.close()
                    at = bundle.as_py()
                    reader = BundleReader(f"{root}/{at}")
                plain, rows = reader.frame(frame.as_py()), []
                for r in records.as_py():
                    headers, payload = parsed(plain[r["offset"]:r["offset"] + r["length"]])
                    if headers["warc-record-id"] != f"<{r['record_id']}>":
                        raise ValueError(f"{at}, frame {frame}: {headers['warc-record-id']} in place of {r['record_id']}")
                    kind = headers["warc-type"]
                    refers = headers.get("warc-refers-to", "").strip("<>") or None
                    rows.append((r["record_id"], r["page_id"], kind, headers.get("warc-target-uri"), refers, headers["warc-payload-digest"].removeprefix("sha1:"), payload if kind == "response" else None))
                kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["record_id", "page_id", "type", "target", "refers_to", "header_digest", "payload"])
        if reader is not None:
            reader.close()

    frames = frames.sortWithinPartitions("bundle", "frame")
    return frames.mapInArrow(read, "record_id string, page_id long, type string, target string, refers_to string, header_digest string, payload binary")


def read_pages(index: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), one row per listed record.

    Length and digest of a response are taken from the payload that was read and
    must agree with its header; those of a revisit are its response's.
    """
    page = F.col("refers_to").substr(F.lit(len("urn:page:") + 1), F.length("refers_to")).try_cast("long")

    def measure(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes, digests = [], []
            for payload, head in zip(part.column("payload"), part.column("header_digest").to_pylist(), strict=True):
                data = payload.as_py()
                digest = head if data is None else digest_of(data)
                if digest != head:
                    raise ValueError(f"a payload's digest is {digest}, its header says {head}")
                sizes.append(None if data is None else len(data))
                digests.append(digest)
            yield pa.RecordBatch.from_arrays([part.column("page_id"), pa.array(sizes, pa.int64()), pa.array(digests), part.column("type"), part.column("refers_to")], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    rows = read_records(index, folder).mapInArrow(measure, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to string")
    rows = rows.withColumn("refers_to", page).checkpoint()
    responses, revisits = rows.where("record_type = 'response'"), rows.where("record_type = 'revisit'")
    named = revisits.groupBy("refers_to", "payload_digest").agg(F.count(F.lit(1)).alias("revisits"))
    held = (responses.select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes").join(_bounded(named), ["refers_to", "payload_digest"], "left_semi")
            .groupBy("refers_to", "payload_digest").agg(F.max("payload_bytes").alias("full_bytes")).checkpoint())
    resolved = revisits.join(_bounded(held), ["refers_to", "payload_digest"], "left").withColumn("payload_bytes", F.col("full_bytes"))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(names).unionByName(resolved.select(names))


def fetch(index: DataFrame, folder: str, record_ids: DataFrame) -> DataFrame:
    """The records named by ``record_ids`` (record_id): only the frames that hold them are read."""
    return read_records(index.join(_bounded(record_ids.select("record_id").distinct()), "record_id", "left_semi"), folder)
