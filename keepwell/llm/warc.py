"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames of about ``FRAME_BYTES``; each frame is compressed on its own, so it can be read without
those before it. A bundle ends with a seek table in a skippable frame: the compressed and plain size of every frame, their
number, and a magic number. The index maps a record to its bundle, frame and offset within the plain frame.

Tasks write bundles under names of their own attempt, straight to the shared folder. The index is a Parquet table and lists
the files of the attempts that counted; what a lost attempt left behind is in no index and is never read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from keepwell.llm.shared import pieces, scratch_path, stored

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 128 << 20
#: Packed bytes that a task reads back.
READ_BYTES = 32 << 20
MIN_BYTES = 0
DATE = "2000-01-01T00:00:00Z"

# Fixed values of the WARC 1.1 and of the seekable Zstandard formats.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1

INDEX = "record_id string, page_id long, bundle string, frame int, offset long, length long"
FRAMES = "bundle string, frame int, at long, size long"
RECORDS = (
    "record_id string, page_id long, record_type string, refers_to long, url string, payload_bytes long, "
    "payload_digest string, payload binary"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(*parts) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ':'.join(map(str, parts)))}"


def compose(name: str, page_id: int | None, kind: str, refers_to: int | None, url: str | None, digest: str, payload: bytes, date: str = DATE) -> bytes:
    """One record. A revisit holds the HTTP head only, whose length is that of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = {
        "WARC-Type": kind, "WARC-Record-ID": f"<{name}>", "WARC-Date": date,
        "WARC-Target-URI": quote(url or "", safe=":/?#[]@!$&'()*+,;=%~") or name,
        "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if page_id is not None:
        head["X-Page-Id"] = str(page_id)
    if kind == "revisit":
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<{record_id(digest, refers_to)}>", "X-Refers-To-Page-Id": str(refers_to)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return VERSION + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _fields(lines: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in lines.decode().split("\r\n"))


def parse(frame: bytes, at: int = 0) -> Iterator[tuple[int, dict[str, str], dict[str, str], bytes]]:
    """(offset, record fields, HTTP fields, payload) of the records of a plain frame from ``at`` on."""
    while at < len(frame):
        if not frame.startswith(VERSION, at):
            raise ValueError(f"no record begins at {at}")
        end = frame.index(b"\r\n\r\n", at)
        head = _fields(frame[at + len(VERSION):end])
        block = frame[end + 4:end + 4 + int(head["Content-Length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        yield at, head, _fields(http.partition(b"\r\n")[2]), payload
        at = end + 4 + len(block) + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(file, size: int) -> list[tuple[int, int]]:
    """(offset, compressed size) of every frame, from the end of a bundle."""
    file.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("the bundle has no seek table")
    file.seek(size - 9 - 8 * count)
    entries = struct.iter_unpack("<II", file.read(8 * count))
    frames, at = [], 0
    for packed, _ in entries:
        frames.append((at, packed))
        at += packed
    return frames


class _Bundles:
    """Writes records to the bundles of one task and keeps what the index says about them."""

    def __init__(self, folder: str):
        self.files, self.folder = pyarrow.fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        self.stem = f"bundle-{task.partitionId():06d}-{task.taskAttemptId()}" if task else "bundle"
        self.files.create_dir(self.folder, recursive=True)
        self.compress = zstandard.ZstdCompressor(level=3).compress
        self.number, self.file, self.index = 0, None, []
        self.records, self.plain = [], 0

    def add(self, name: str, page_id: int | None, record: bytes) -> None:
        if self.file is None:
            self.path = f"{self.folder}/{self.stem}-{self.number:04d}.warc.zst"
            self.file, self.sizes, self.written = self.files.open_output_stream(self.path, compression=None), [], 0
            self.number += 1
        self.index.append((name, page_id, self.path, len(self.sizes), self.plain, len(record)))
        self.records.append(record)
        self.plain += len(record)
        if self.plain >= FRAME_BYTES:
            self._end_frame()
            if self.written >= BUNDLE_BYTES:
                self.close()

    def _end_frame(self) -> None:
        packed = self.compress(b"".join(self.records))
        self.file.write(packed)
        self.sizes.append((len(packed), self.plain))
        self.written += len(packed)
        self.records, self.plain = [], 0

    def close(self) -> None:
        if self.file is not None:
            if self.records:
                self._end_frame()
            self.file.write(seek_table(self.sizes))
            self.file.close()
            self.file = None

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.index)) if self.index else [[]] * 6
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        self.index = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in INDEX.split(", ")])


def decide(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``(page_id, url, payload, digest, first)``: of equal payloads the smallest page_id is ``first``.

    Digests and ids alone meet in the grouping by digest, so a payload that a third of the pages share moves as short
    rows that are combined before the shuffle. Payloads move once, by page.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).withColumn(
        "digest", F.sha1("payload")
    )
    slim = stored(
        rows.select("page_id", "digest", (F.length("payload") >= min_bytes).alias("linked")).distinct(), "pages"
    )
    # Stored, so that the join below reads plain rows and a digest with very many pages can be split.
    first = stored(slim.groupBy("digest").agg(F.min("page_id").alias("first")), "first")
    chosen = slim.join(first, "digest").select(
        F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), F.when(F.col("linked"), F.col("first")).alias("first")
    )
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest"))
    return rows.join(chosen.hint("merge"), same).select("page_id", "url", "payload", "digest", "first")


def write(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write one record for every row of ``pages (page_id, url, html)``; returns the stored index of the records.

    Of records with equal payloads of at least ``min_bytes``, those of the smallest page_id are responses and the others
    revisit it. A null html is an empty payload; a null page_id loses against any other and is a response if there is
    none; a null url is replaced by the record's name. Rows that repeat get a record each, with its own name.
    """

    def run(batches):
        out, last, again = _Bundles(folder), None, 0
        for batch in pieces(batches):
            names = ("page_id", "url", "payload", "digest", "first")
            for page_id, url, payload, digest, first in zip(*(batch.column(c).to_pylist() for c in names)):
                digest = base64.b32encode(bytes.fromhex(digest)).decode()
                again = again + 1 if (page_id, digest) == last else 0
                last = page_id, digest
                kind = "response" if first is None or first == page_id else "revisit"
                name = record_id(digest, page_id, out.stem, again) if again else record_id(digest, page_id)
                out.add(name, page_id, compose(name, page_id, kind, first, url, digest, payload))
            yield out.take()
        out.close()

    return stored(decide(pages, min_bytes).mapInArrow(run, INDEX), "warc-index")


def frames(bundles: DataFrame) -> DataFrame:
    """Every frame of the bundles in column ``bundle``, as their seek tables list them."""

    def run(batches):
        for batch in batches:
            rows = []
            for path in batch.column("bundle").to_pylist():
                files, place = pyarrow.fs.FileSystem.from_uri(path)
                with files.open_input_file(place) as file:
                    rows += [(path, k, at, size) for k, (at, size) in enumerate(read_seek_table(file, file.size()))]
            columns = list(zip(*rows)) if rows else [[]] * 4
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["bundle", "frame", "at", "size"])

    return bundles.select("bundle").mapInArrow(run, FRAMES)


def _plain(path: str, at: int, size: int) -> bytes:
    files, place = pyarrow.fs.FileSystem.from_uri(path)
    with files.open_input_file(place) as file:
        file.seek(at)
        return zstandard.ZstdDecompressor().decompressobj().decompress(file.read(size))


def _record(head: dict[str, str], http: dict[str, str], payload: bytes, with_payload: bool) -> tuple:
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = head["WARC-Type"]
    if kind == "response" and base32_sha1(payload) != digest:
        raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
    number = {k: int(head[k]) if k in head else None for k in ("X-Page-Id", "X-Refers-To-Page-Id")}
    return (
        head["WARC-Record-ID"][1:-1], number["X-Page-Id"], kind, number["X-Refers-To-Page-Id"], head["WARC-Target-URI"],
        int(http["Content-Length"]), digest, payload if with_payload else None,
    )


def _records_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in RECORDS.split(", ")])


def read(bundles: DataFrame, with_payload: bool = False) -> DataFrame:
    """All records of the bundles, a task reading whole frames; digests of responses are verified.

    The number of tasks follows the bytes of the frames and not those of their descriptions: one for each ``READ_BYTES``, and for
    few bytes as many as there are frames, up to four for each core.
    """

    def run(batches):
        for batch in batches:
            for path, at, size in zip(*(batch.column(c).to_pylist() for c in ("bundle", "at", "size"))):
                found = parse(_plain(path, at, size))
                yield _records_batch([_record(head, http, payload, with_payload) for _, head, http, payload in found])

    cores = 4 * bundles.sparkSession.sparkContext.defaultParallelism
    listed = stored(frames(bundles.repartition(cores, "bundle")), "frames")
    count, total = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    tasks = max(1, -(-total // READ_BYTES), min(count, cores))
    return listed.repartition(tasks, "bundle", "frame").mapInArrow(run, RECORDS)


def fetch(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records whose ``record_id`` is in ``wanted``, each read from its frame alone."""
    places = index.join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    table = frames(places.select("bundle").distinct())

    def run(batches):
        for batch in batches:
            names = ("bundle", "at", "size", "offset")
            rows = []
            for path, at, size, offset in zip(*(batch.column(c).to_pylist() for c in names)):
                _, head, http, payload = next(parse(_plain(path, at, size), offset))
                rows.append(_record(head, http, payload, True))
            yield _records_batch(rows)

    return places.join(table, ["bundle", "frame"]).mapInArrow(run, RECORDS)


def archive(spark: SparkSession, pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write the pages to bundles (in a new folder of the shared one) and read the archives back, without payloads."""
    index = write(pages, folder or scratch_path(spark, "warc"), min_bytes)
    return read(index.select("bundle").distinct()).drop("payload")

