"""WARC archives in seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each with whole records, and a
skippable frame at the end that lists the frames' sizes.  The index names for
every record its bundle, its frame and its place in the frame's data, so one
record is read with one seek.  Bundles stand in a folder that all executors
reach (local, HDFS or an object store by its URI); a task that is run again
writes new files, and the index holds those of the run that counted.

Payloads are equal when their SHA-1 is; of equal payloads of ``least`` bytes or
more, the record of the largest page id is the response and the others refer to it.

Defined cases: null html is an empty payload; null url an empty target; repeated rows
of the response's page are responses too; a null page id is kept as null and never the
target of a revisit; other columns are ignored.
"""

from __future__ import annotations

import base64
import struct
import uuid
from collections.abc import Callable, Iterator
from hashlib import sha1

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .base import column, shared_path, sized, stored, table, tuned
from .words import pieces

LEAST = 1000
#: Bytes of records in a frame, and of frames in a bundle, before the next begins.
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 256 << 20
LEVEL = 3
# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

INDEX = "page_id long, record_id string, bundle string, frame int, begin int, size int"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a Hadoop-style path."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class Bundle:
    """Writes records to frames, frames to a file and the frames' sizes behind them."""

    def __init__(self, path: str):
        self.path = path
        system, place = _open(path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(place, compression=None)
        self.sizes: list[tuple[int, int]] = []
        self.held: list[bytes] = []
        self.begin = self.written = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, place in the frame's data) of the record."""
        at = len(self.sizes), self.begin
        self.held.append(record)
        self.begin += len(record)
        if self.begin >= FRAME_BYTES:
            self._frame()
        return at

    def _frame(self) -> None:
        data = b"".join(self.held)
        packed = zstandard.ZstdCompressor(level=LEVEL).compress(data)
        self.out.write(packed)
        self.sizes.append((len(packed), len(data)))
        self.written += len(packed)
        self.held, self.begin = [], 0

    def close(self) -> None:
        if self.held:
            self._frame()
        entries = b"".join(struct.pack("<II", *s) for s in self.sizes)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE))
        self.out.close()


class Reader:
    """Reads single frames of a bundle by its seek table."""

    def __init__(self, path: str):
        system, place = _open(path)
        self.file = system.open_input_file(place)
        end = self.file.size()
        self.file.seek(end - 9)
        count, flags, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        entry = 12 if flags & 0x80 else 8
        self.file.seek(end - 9 - count * entry)
        table = self.file.read(count * entry)
        self.places, at = [], 0
        for i in range(count):
            packed, size = struct.unpack_from("<II", table, i * entry)
            self.places.append((at, packed, size))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, size = self.places[number]
        self.file.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=size)

    def close(self) -> None:
        self.file.close()


def record_id(page_id: int | None, url: str, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, refers_url: str = "") -> tuple[str, bytes]:
    """(record id, bytes) of a response, or of a revisit without the payload, which names the response (``refers_to`` at ``refers_url``)."""
    name = record_id(page_id, url, digest)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name}", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {' '.join(url.split())}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to, refers_url, digest)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return name, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes, at: int) -> tuple[dict[str, str], int]:
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}, end + 4


def parse(data: bytes) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """(WARC headers, HTTP headers, payload) of the records in a frame's data."""
    at = 0
    while at < len(data):
        head, at = _headers(data, at)
        end = at + int(head["content-length"])
        http, body = _headers(data, at)
        yield head, http, data[body:end]
        at = end + 4


def _page(urn: str) -> int | None:
    number = urn.strip("<>").split(":")[2]
    return int(number) if number else None


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle: Bundle | None = None
        for batch in batches:
            for part, texts in pieces(batch, "html"):
                rows = []
                for page_id, url, text, digest, refers_to, refers_url in zip(*(column(part, c).to_pylist() for c in ("page_id", "url")), texts.to_pylist(), *(column(part, c).to_pylist() for c in ("digest", "refers_to", "refers_url"))):
                    if bundle is None:
                        bundle = Bundle(f"{folder}/bundle-{uuid.uuid4().hex}.warc.zst")
                    name, data = record(page_id, url or "", text.encode(), digest, refers_to, refers_url or "")
                    frame, begin = bundle.add(data)
                    rows.append((page_id, name, bundle.path, frame, begin, len(data)))
                    if bundle.written >= BUNDLE_BYTES:
                        bundle.close()
                        bundle = None
                if rows:
                    ids, names, paths, frames, begins, sizes = zip(*rows)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids, pa.int64()), pa.array(names), pa.array(paths), pa.array(frames, pa.int32()), pa.array(begins, pa.int32()), pa.array(sizes, pa.int32())],
                        names=["page_id", "record_id", "bundle", "frame", "begin", "size"])
        if bundle is not None:
            bundle.close()
    return run


def write_archives(pages: DataFrame, folder: str, least: int = LEAST) -> DataFrame:
    """Writes a record per page to bundles in ``folder``; the index of the records."""
    tuned(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")) \
        .withColumn("digest", F.sha1(F.col("html").cast("binary")))
    long = rows.where(F.octet_length("html") >= least).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", F.coalesce("url", F.lit("")).alias("url"))).alias("target")).where("n > 1")
    targets = stored(long.select(F.col("digest").alias("of"), F.col("target.page_id").alias("target"), F.col("target.url").alias("refers_url")), "targets")
    named = rows.join(sized(targets, 100, F.octet_length("refers_url")), F.when(F.octet_length("html") >= least, F.col("digest")) == F.col("of"), "left") \
        .withColumn("refers_to", F.when(F.col("page_id").eqNullSafe(F.col("target")), F.lit(None)).otherwise(F.col("target")))
    return stored(named.select("page_id", "url", "html", "digest", "refers_to", "refers_url").mapInArrow(_write(folder), INDEX), "index")


def _each(rows: list[tuple[str, int]], take: Callable[[bytes, int], Iterator[tuple]]) -> Iterator[tuple]:
    """What ``take`` gives for the frames of some (bundle, frame) rows, sorted by bundle."""
    reader, path = None, None
    for i, (bundle, number) in enumerate(rows):
        if bundle != path:
            if reader:
                reader.close()
            reader, path = Reader(bundle), bundle
        yield from take(reader.frame(number), i)
    if reader:
        reader.close()


def read_archives(index: DataFrame) -> DataFrame:
    """All records of the bundles that the index names, read from the archives themselves."""
    tuned(index.sparkSession)

    def take(data: bytes, _: int) -> Iterator[tuple]:
        for head, http, payload in parse(data):
            digest = base64.b32decode(head["warc-payload-digest"].partition(":")[2]).hex()
            revisit = head["warc-type"] == "revisit"
            if not revisit and sha1(payload).hexdigest() != digest:
                raise ValueError(f"{head['warc-record-id']}: the payload is damaged")
            yield _page(head["warc-record-id"]), int(http["content-length"]), digest, head["warc-type"], _page(head["warc-refers-to"]) if revisit else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                rows = list(zip(*(column(batch.slice(lo, 64), c).to_pylist() for c in ("bundle", "frame"))))
                found = list(_each(rows, take))
                ids, sizes, digests, types, targets = zip(*found)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests), pa.array(types), pa.array(targets, pa.int64())],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    frames = index.select("bundle", "frame").distinct()
    # few bytes of index stand for much work: the number of tasks is given, not derived from their size
    return frames.repartition(shuffle_partitions(index.sparkSession), "bundle", F.floor(F.col("frame") / 64)).sortWithinPartitions("bundle", "frame").mapInArrow(run, RECORDS)


def fetch(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """(page_id, record_id, data) of the wanted page ids: one seek a frame, no scan of the bundles."""
    tuned(index.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()

            def take(data: bytes, i: int) -> Iterator[tuple]:
                yield rows[i]["page_id"], rows[i]["record_id"], data[rows[i]["begin"]:rows[i]["begin"] + rows[i]["size"]]
            found = list(_each([(r["bundle"], r["frame"]) for r in rows], take))
            if found:
                ids, names, data = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names), pa.array(data, pa.binary())], names=["page_id", "record_id", "data"])

    ids = wanted.select(F.col("page_id").cast("long").alias("page_id")).distinct()
    return index.join(ids, "page_id").sortWithinPartitions("bundle", "frame").mapInArrow(run, "page_id long, record_id string, data binary")


def op9_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return read_archives(write_archives(pages, shared_path(spark, "warc")))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest, octet_length(encode(coalesce(html, ''))) AS size FROM pages),
t AS (SELECT digest, max(page_id) AS target FROM p WHERE size >= 1000 GROUP BY digest)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN size >= 1000 AND target <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN size >= 1000 AND target <> page_id THEN target END AS refers_to
FROM p LEFT JOIN t USING (digest)
"""
