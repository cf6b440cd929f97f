"""WARC archives with a two-level capture index.

Archives: each task writes one file of WARC/1.1 records, every record a gzip
member of its own. Of records with equal payloads (by SHA-1) the one with the
largest page_id is a response, the others are revisits that refer to it and
hold only the HTTP header.

Index: a capture's key is its URL with the host reversed, then the page_id.
Sorted keys are cut over index parts; a part is a file of gzip blocks of
``BLOCK_LINES`` lines (key, page_id, file, offset, length) and a sparse
directory with each block's first key and place. Only the parts' first keys
(one line per part) come to the driver.

Lookup: keys are sent to the task of their part by binary search over the
parts' first keys, in key order; the task binary-searches the directory,
range-reads and unpacks the block, binary-searches its lines, and so goes from
block to block. The captures found are sorted by file and range-read there.

Files are written below the given folder through Arrow's file systems (local,
HDFS, S3, GCS), under names of their own for each attempt; rows of finished
attempts alone name the files that count, so lost executors leave at most
unused files.

Defined cases: a null html is an empty payload; a null URL has the key ``-``;
a null page_id never is what others refer to, and records of equal payload
without any page_id are all responses; rows that repeat a page_id and payload
are of one kind; an empty table gives no rows; other columns are not read."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bounded, materialise, text_batches
from quarry.session import scratch_path

BLOCK_LINES = 1_000
PART_KEYS = 500_000
LEVEL = 6
_DATE = "1970-01-01T00:00:00Z"  # the pages table has no capture time
_URL = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*:/*([^/?#]*)([^#]*)", re.S)


def file_system(folder: str):
    """Arrow's file system of a folder's URI, and the folder's path in it."""
    from pyarrow import fs
    folder = re.sub(r"^file:/+", "file:///", folder)
    return fs.FileSystem.from_uri(folder)


def url_key(url: str | None) -> str:
    """The URL with reversed host, lower case, without scheme, user and
    fragment; blanks and control characters are percent-encoded."""
    m = _URL.match(url or "")
    if not m:
        key = url or "-"
    else:
        host = m[1].rpartition("@")[2].lower()
        host, colon, port = host.partition(":")
        key = ",".join(reversed(host.split("."))) + (colon + port if port else "") + ")" + (m[2] or "/")
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", key)


def capture_key(url: str | None, page_id: int | None) -> str:
    return f"{url_key(url)} {'-' if page_id is None else page_id}"


def record(url, page_id, digest: str, payload: bytes, refers_to, revisit: bool) -> bytes:
    """One WARC record, not yet packed."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {_DATE}",
            "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url or ""),
            f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of an unpacked record."""
    def fields(text: bytes) -> dict[str, str]:
        return dict(x.split(": ", 1) for x in text.decode().split("\r\n")[1:])

    head, _, rest = data.partition(b"\r\n\r\n")
    warc = fields(head)
    http, _, payload = rest[:int(warc["Content-Length"])].partition(b"\r\n\r\n")
    return warc, fields(http), payload


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages (page_id, url, html); returns the captures, read from
    files: key, page_id, file, offset, length."""
    page = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    page = page.withColumn("sha1", F.sha1("payload"))
    same = (page.groupBy(F.col("sha1").alias("_sha1"))
            .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n"))
    same = bounded(materialise(same, "warc-copies"))
    # beyond the broadcast's bound both sides are shuffled and a hot payload is split
    page = page.join(same, F.col("sha1") == F.col("_sha1"), "left").select(
        "page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("refers_to")),
                                            F.col("refers_to")).alias("refers_to"))

    def run(batches):
        fs, path = file_system(folder)
        name, out, at = f"{uuid.uuid4().hex}.warc.gz", None, 0
        for b in batches:
            rows = []
            for page_id, url, payload, refers_to in zip(*(b.column(k).to_pylist() for k in range(4))):
                if out is None:
                    fs.create_dir(path, recursive=True)
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                packed = gzip.compress(record(url, page_id, _digest(payload), payload, refers_to,
                                              refers_to is not None), LEVEL, mtime=0)
                out.write(packed)
                rows.append((capture_key(url, page_id), page_id, name, at, len(packed)))
                at += len(packed)
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64()),
                 pa.array(cols[4], pa.int64())], names=["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    return materialise(text_batches(page).mapInArrow(
        run, "key string, page_id long, file string, offset long, length long"), "warc-captures")


def write_index(captures: DataFrame, folder: str, part_keys: int = PART_KEYS,
                block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the index of the captures; returns its parts, read from files:
    first_key, blocks (file), directory (file)."""
    parts = max(1, -(-captures.count() // part_keys))

    def run(batches):
        fs, path = file_system(folder)
        name, out, at, pending, places = uuid.uuid4().hex, None, 0, [], []

        def flush(lines):
            nonlocal at
            packed = gzip.compress("".join(f"{x}\n" for x in lines).encode(), LEVEL, mtime=0)
            out.write(packed)
            places.append(f"{lines[0].split(chr(9), 1)[0]}\t{at}\t{len(packed)}\n")
            at += len(packed)

        for b in batches:
            if out is None and b.num_rows:
                fs.create_dir(path, recursive=True)
                out = fs.open_output_stream(f"{path}/{name}.blocks.gz", compression=None)
            pending += ["\t".join(map(str, r)) for r in zip(*(c.to_pylist() for c in b.columns))]
            while len(pending) >= block_lines:
                flush(pending[:block_lines])
                pending = pending[block_lines:]
        if out is not None:
            if pending:
                flush(pending)
            out.close()
            with fs.open_output_stream(f"{path}/{name}.directory", compression=None) as d:
                d.write("".join(places).encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([places[0].split("\t", 1)[0]]), pa.array([f"{name}.blocks.gz"]),
                 pa.array([f"{name}.directory"])], names=["first_key", "blocks", "directory"])

    lines = (captures.select("key", "file", "offset", "length")
             .repartitionByRange(parts, "key").sortWithinPartitions("key", "file", "offset"))
    return materialise(lines.mapInArrow(run, "first_key string, blocks string, directory string"),
                       "warc-parts")


class Part:
    """One index part: its directory, and the block that was read last."""

    def __init__(self, fs, path: str, blocks: str, directory: str):
        with fs.open_input_file(f"{path}/{directory}") as f:
            rows = [x.split(b"\t") for x in f.read().split(b"\n")[:-1]]
        self.first = [r[0] for r in rows]
        self.place = [(int(r[1]), int(r[2])) for r in rows]
        self.file = fs.open_input_file(f"{path}/{blocks}")
        self.at, self.keys, self.lines = -1, [], []

    def _block(self, k: int) -> None:
        if k != self.at:
            at, size = self.place[k]
            self.lines = gzip.decompress(self.file.read_at(size, at)).split(b"\n")[:-1]
            self.keys = [x.split(b"\t", 1)[0] for x in self.lines]
            self.at = k

    def find(self, key: bytes):
        """The index lines of a key, which may go on over several blocks."""
        k = max(0, bisect_left(self.first, key) - 1)
        while k < len(self.first) and self.first[k] <= key:
            self._block(k)
            lo = bisect_left(self.keys, key)
            hi = bisect_right(self.keys, key, lo)
            yield from self.lines[lo:hi]
            k += 1


def lookup(keys: DataFrame, parts: DataFrame, folder: str) -> DataFrame:
    """key, file, offset, length of the captures of the distinct ``keys`` (key)."""
    spark = keys.sparkSession
    heads = [r for r in parts.orderBy("first_key").collect()]  # one row per part
    shared = spark.sparkContext.broadcast([tuple(r) for r in heads])

    def route(batches):
        first = [h[0].encode() for h in shared.value]
        for b in batches:
            ks = b.column(0).to_pylist()
            part = [max(0, bisect_right(first, k.encode()) - 1) for k in ks]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), b.column(0)],
                                             names=["part", "key"])

    def run(batches):
        fs, path = file_system(folder)
        at, part = -1, None
        for b in batches:
            out = []
            for p, key in zip(*(c.to_pylist() for c in b.columns)):
                if p != at:
                    at, part = p, Part(fs, path, *shared.value[p][1:])
                for line in part.find(key.encode()):
                    k, file, offset, length = line.decode().split("\t")
                    out.append((k, file, int(offset), int(length)))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                names=["key", "file", "offset", "length"])

    if not heads:
        return spark.createDataFrame([], "key string, file string, offset long, length long")
    sent = (keys.distinct().mapInArrow(route, "part int, key string")
            .repartitionByRange("part", "key").sortWithinPartitions("part", "key"))
    return sent.mapInArrow(run, "key string, file string, offset long, length long")


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """key, record_type, page_id, refers_to, url, payload_digest, payload_bytes and
    payload (null for revisits) of captures (key, file, offset, length)."""
    schema = ("key string, record_type string, page_id long, refers_to long, url string, "
              "payload_digest string, payload_bytes long, payload binary")

    def number(urn: str | None):
        return int(urn[10:-1]) if urn and urn != "<urn:page:>" else None

    def run(batches):
        fs, path = file_system(folder)
        name, file = None, None
        for b in batches:
            out, size = [], 0
            for key, wanted, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                if wanted != name:
                    name, file = wanted, fs.open_input_file(f"{path}/{wanted}")
                warc, http, payload = parse(zlib.decompress(file.read_at(length, offset), 31))
                digest = warc["WARC-Payload-Digest"].removeprefix("sha1:")
                response = warc["WARC-Type"] == "response"
                if response and (_digest(payload) != digest
                                 or len(payload) != int(http["Content-Length"])):
                    raise ValueError(f"{wanted} at {offset}: the payload is not what was written")
                out.append((key, warc["WARC-Type"], number(warc["WARC-Record-ID"]),
                            number(warc.get("WARC-Refers-To")), warc["WARC-Target-URI"], digest,
                            int(http["Content-Length"]), payload if response else None))
                size += len(payload)
                if size > 16 << 20:
                    yield _batch(out)
                    out, size = [], 0
            yield _batch(out)

    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(),
             pa.binary()]
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def _batch(rows):
        cols = list(zip(*rows)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    sent = (captures.select("key", "file", "offset", "length")
            .repartitionByRange("file", "offset").sortWithinPartitions("file", "offset"))
    return sent.mapInArrow(run, schema)


def page_keys(pages: DataFrame) -> DataFrame:
    """The capture key of every page."""
    def run(batches):
        for b in batches:
            keys = [capture_key(u, p) for p, u in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], names=["key"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url")).mapInArrow(run, "key string")


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write archives and index below ``folder`` (a new one below
    ``spark.checkpoint.dir`` if not given), look every page up, read it back."""
    folder = folder or scratch_path(pages.sparkSession, "llm-warc")
    parts = write_index(write_archives(pages, f"{folder}/archive"), f"{folder}/index")
    found = lookup(page_keys(pages), parts, f"{folder}/index")
    return read_records(materialise(found, "warc-found"), f"{folder}/archive")
