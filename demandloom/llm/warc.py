"""Writing pages as WARC archives, and a splittable reader of such archives.

Each record is a gzip member of its own. Reading tasks get byte ranges: a task looks for the gzip magic number in its range, tries
each candidate by decoding its first bytes, which must be a WARC header, and from the first true member on reads record by
record. It owns the records that start in its range, and reads past the range's end to finish the last one.
Files are reached through pyarrow's file systems, of which the shared folder's scheme must be one.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, looked_up, new_folder, pick

#: Payloads under this many bytes are never revisits.
LEAST = 1000
#: Bytes of a reading task's range, and of one read.
RANGE, READ = 32 << 20, 1 << 20
MAGIC = b"\x1f\x8b\x08"
#: Bytes of raw html for about which an archive is written.
PER_FILE = 64 << 20
DATE = "2000-01-01T00:00:00Z"
URN = "urn:page:"


def place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A null id or url is left out; line breaks in a url are percent-encoded."""
    clean = (url or "").replace("\r", "%0D").replace("\n", "%0A").encode()
    head = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload), b"", b""]
    block = b"\r\n".join(head) + (b"" if revisit else payload)
    lines = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Date: " + DATE.encode()]
    lines.append(b"WARC-Record-ID: <" + f"{URN}{page_id}".encode() + b">" if page_id is not None else b"WARC-Record-ID: <urn:uuid:" + str(uuid.UUID(bytes=hashlib.md5(clean + payload).digest())).encode() + b">")
    if url is not None:
        lines.append(b"WARC-Target-URI: " + clean)
    lines.append(b"WARC-Payload-Digest: sha1:" + base64.b32encode(hashlib.sha1(payload).digest()))
    if revisit:
        lines += [b"WARC-Refers-To: <" + f"{URN}{refers_to}".encode() + b">", b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block), b"", b""]
    return b"\r\n".join(lines) + block + b"\r\n\r\n"


def gzipped(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def decided(pages: DataFrame, least: int = LEAST, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, payload (binary), refers_to: of rows with equal payloads of `least` bytes or more all but those with the largest id refer to it.

    Null html is empty. A null id is less than any other; rows that share the largest id are responses, each.
    """
    rows = pick(pages, page_id, url, html).select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"))
    # Only payloads that may be revisits have a digest here; the others, however many are empty, meet nobody in the join.
    rows = rows.withColumn("digest", F.when(F.octet_length("payload") >= least, F.sha2("payload", 256)))
    shared = cut(rows.where("digest is not null").groupBy(F.col("digest").alias("shared")).agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1"))
    return looked_up(rows, "digest", shared, "shared", "n").select("page_id", "url", "payload", F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))


def write(pages: DataFrame, folder: str | None = None, per_file: int = PER_FILE, least: int = LEAST, page_id: str = "page_id", url: str = "url", html: str = "html") -> str:
    """Writes one record per row of pages below folder (a new one in the shared folder if None), which is returned.

    Each task writes files of its own and renames them when whole, so that a task that runs again replaces what it wrote.
    An empty table writes no archive.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    system, path = place(folder)
    system.create_dir(path, recursive=True)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, task = place(folder), TaskContext.get()
        stream, number, held, names, size = None, 0, 0, [], []

        def close() -> None:
            nonlocal stream, number, held
            stream.close()
            final = f"{own[1]}/part-{task.partitionId():06d}-{number:04d}.warc.gz"
            own[0].move(f"{final}.{task.taskAttemptId()}.tmp", final)
            names.append(final), size.append(held)
            stream, number, held = None, number + 1, 0

        for b in batches:
            for i, u, p, r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if stream is None:
                    stream = own[0].open_output_stream(f"{own[1]}/part-{task.partitionId():06d}-{number:04d}.warc.gz.{task.taskAttemptId()}.tmp", compression=None)
                held += len(p)
                stream.write(gzipped(record(i, u, p, r, r is not None)))
                if held > per_file:
                    close()
        if stream is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(size, pa.int64())], ["path", "bytes"])

    decided(pages, least, page_id, url, html).mapInArrow(each, "path string, bytes long").agg(F.sum("bytes")).collect()
    return folder


def ranges(spark: SparkSession, folder: str, size: int = RANGE) -> DataFrame:
    """path, start, end: the byte ranges of the archives in a folder, one row for each task."""
    system, path = place(folder)
    rows = [(f.path, at, min(f.size, at + size)) for f in system.get_file_info(fs.FileSelector(path, recursive=True)) if f.is_file and f.path.endswith(".warc.gz") for at in range(0, f.size, size)]
    return spark.createDataFrame(rows, "path string, start long, end long").repartition(max(1, len(rows)))


def starts_record(data: bytes) -> bool:
    """If a gzip member that holds a WARC record starts here."""
    try:
        return zlib.decompressobj(31).decompress(data, 64).startswith(b"WARC/1.")
    except zlib.error:
        return False


def members(file, start: int, end: int) -> Iterator[bytes]:  # noqa: ANN001
    """The records whose members start in the range, decompressed."""
    total = file.size()

    def first(at: int) -> int | None:
        while at < end:
            data = file.read_at(min(READ + 512, total - at), at)
            k = data.find(MAGIC)
            while 0 <= k < READ and at + k < end:
                if starts_record(data[k : k + 512]) or len(data) - k < 512 and starts_record(file.read_at(min(512, total - at - k), at + k)):
                    return at + k
                k = data.find(MAGIC, k + 1)
            at += READ
        return None

    at = first(start)
    held, ahead = b"", at  # held: bytes from at on; ahead: where the next read begins
    while at is not None and at < end:
        z, parts, used = zlib.decompressobj(31), [], 0
        data = held
        while not z.eof:
            if not data:
                data = file.read_at(min(READ, total - ahead), ahead)
                ahead += len(data)
                if not data:
                    raise EOFError("an archive ends within a record")
            used += len(data)
            parts.append(z.decompress(data))
            data = b""
        held = z.unused_data
        at += used - len(held)
        if out := b"".join(parts):
            yield out
        if at < end and at < total and not (held or file.read_at(min(3, total - at), at)).startswith(MAGIC[: len(held) or 3][:3]):
            at = first(at)  # something else lies between members
            held, ahead = b"", at


def parsed(data: bytes) -> dict | None:
    """Fields of a record; None if it isn't a response or revisit."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:]))
    kind = fields.get(b"warc-type", b"").decode()
    if kind not in ("response", "revisit"):
        return None
    block = block[: int(fields[b"content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:])).get(b"content-length")
    own = lambda name: int(v[len(URN) + 1 : -1]) if (v := fields.get(name, b"")).startswith(f"<{URN}".encode()) else None
    digest = base64.b32decode(fields[b"warc-payload-digest"].removeprefix(b"sha1:")).hex() if b"warc-payload-digest" in fields else None
    if kind == "response" and digest not in (None, hashlib.sha1(payload).hexdigest()):
        raise ValueError("a payload doesn't have its digest")
    return {"page_id": own(b"warc-record-id"), "url": fields[b"warc-target-uri"].decode() if b"warc-target-uri" in fields else None, "record_type": kind, "refers_to": own(b"warc-refers-to"), "payload": payload if kind == "response" else None, "payload_bytes": int(length) if length is not None else len(payload), "payload_digest": digest}


SCHEMA = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string"


def read(spark: SparkSession, folder: str, size: int = RANGE) -> DataFrame:
    """One row per response or revisit record of the archives in a folder; payload is null for revisits, whose length and digest are those of the full payload."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
        for b in batches:
            for path, start, end in zip(*(c.to_pylist() for c in b.columns), strict=True):
                rows, held = [], 0
                with place(folder)[0].open_input_file(path) as file:
                    for data in members(file, start, end):
                        if (row := parsed(data)) is not None:
                            rows.append(row)
                            held += len(data)
                        if held > 1 << 24:
                            yield pa.RecordBatch.from_pylist(rows, types)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, types)

    return ranges(spark, folder, size).mapInArrow(each, SCHEMA)
