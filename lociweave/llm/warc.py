"""WARC archives: a writer of one gzip member per record and a splittable reader.

Archives are written by tasks into a folder that all executors share, each under a hidden name
that is renamed when it is complete; a task that runs again writes the same bytes. The reader
cuts archives into byte ranges. A task looks for gzip magic in its range, takes a place for the
start of a record only if a member decodes from there and begins with a WARC header, and owns
the records that start inside its range, reading past its end to finish the last one.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
#: Bytes of an archive that one reading task scans, and that are read or inflated at a time.
SPLIT_BYTES, BLOCK = 32 << 20, 1 << 20
#: Reading tasks at most; beyond it a task takes several ranges.
MOST_TASKS = 100_000
DATE = "2000-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_name(page_id: int | None, sequence: str) -> str:
    """Record id of a page. Pages without an id get one of their own."""
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{sequence}>"


def clean(value: str | None) -> str:
    """A header value: line ends and other control characters percent-coded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value or "")


def encode_record(headers: list[tuple[str, str]], body: bytes) -> bytes:
    """One record as a gzip member. The same input gives the same bytes."""
    lines = "".join(f"{k}: {clean(v)}\r\n" for k, v in headers).encode()
    raw = b"".join([VERSION, lines, f"Content-Length: {len(body)}\r\n\r\n".encode(), body, b"\r\n\r\n"])
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(raw) + squeeze.flush()


def parse_headers(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines if ":" in line)}


class Archive:
    """Bytes of a shared file by position, read in blocks."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size

    def at(self, place: int, length: int) -> bytes:
        self.source.seek(place)
        return self.source.read(max(0, min(length, self.size - place)))


def decode_member(archive: Archive, place: int) -> tuple[dict[str, str], bytes, int] | None:
    """Headers, body and end of the record whose member starts at ``place``; None if none does.

    The header is decoded first, from as little of the member as it needs; the rest only if it
    is one, however long it is. A member that starts as a record but is damaged, or whose header
    does not end, raises an error.
    """
    inflate, parts, seen, head, length = zlib.decompressobj(31), [], bytearray(), None, 0
    at, waiting = place, b""
    while not inflate.eof:
        if not waiting:
            waiting = archive.at(at, 4096 if head is None else BLOCK)
            at += len(waiting)
        if not waiting:
            if head is None and not seen:
                return None
            raise ValueError(f"the record at byte {place} breaks off")
        try:
            got = inflate.decompress(waiting, 1024 if head is None else BLOCK)
        except zlib.error as error:
            if head is None and not seen:
                return None
            raise ValueError(f"the record at byte {place} is damaged") from error
        waiting = inflate.unconsumed_tail
        if head is not None:
            parts.append(got)
            continue
        searched = max(0, len(seen) - 3)
        seen += got
        if not VERSION.startswith(seen[: len(VERSION)]):
            return None
        end = seen.find(b"\r\n\r\n", searched)
        if end >= 0:
            try:
                head = parse_headers(bytes(seen[:end]))
                length = int(head["content-length"])
            except (UnicodeDecodeError, KeyError, ValueError):
                return None
            parts.append(bytes(seen[end + 4 :]))
        elif inflate.eof:
            if len(seen) < len(VERSION):
                return None
            raise ValueError(f"the header of the record at byte {place} does not end")
    body = b"".join(parts)
    if head is None or body[length:] != b"\r\n\r\n":
        raise ValueError(f"the record at byte {place} has the wrong length")
    return head, body[:length], at - len(inflate.unused_data)


def records_in(archive: Archive, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(place, headers, body) of the records that start in [start, end)."""
    place = start
    while place < end:
        block = archive.at(place, min(BLOCK, end - place) + len(MAGIC) - 1)
        found = block.find(MAGIC)
        if found < 0:
            place += BLOCK
            continue
        place += found
        if place >= end:
            return
        record = decode_member(archive, place)
        if record is None:
            place += 1
            continue
        yield place, record[0], record[1]
        place = record[2]


def shared_file_system(path: str):
    """(file system, path on it) of a URI; a plain path is on a file system that is mounted."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def with_revisits(pages: DataFrame, id_col: str, payload: str, least_bytes: int) -> DataFrame:
    """Adds ``_digest`` (payload) and ``_refers``: the smallest id with that payload where the row
    is a revisit of it, else null."""
    marked = pages.withColumn("_digest", F.sha1(payload))
    large = marked.filter(F.length(payload) >= least_bytes)
    first = large.groupBy("_digest").agg(F.min(id_col).alias("_first"))
    joined = marked.join(first, "_digest", "left")
    repeats = (F.length(payload) >= least_bytes) & ~F.col(id_col).eqNullSafe(F.col("_first"))
    return joined.withColumn("_refers", F.when(repeats, F.col("_first"))).drop("_first")


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """Writes one record per row below ``folder`` and returns the list of archives (path, bytes).

    Payload: the html in UTF-8; null is empty. Of rows with equal payloads of at least
    ``least_bytes`` bytes that with the smallest id is a response, the others revisit it and hold
    no payload; rows that share that smallest id are all responses, as are rows with equal
    payloads of which none has an id. Null urls are empty. An empty table may give no archive.
    """
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    records = with_revisits(rows, "id", "payload", least_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}.warc.gz"
        system, base = shared_file_system(folder)
        system.create_dir(base, recursive=True)
        draft = posixpath.join(base, f".{name}.{context.taskAttemptId()}")
        size = count = 0
        with system.open_output_stream(draft) as out:
            for batch in batches:
                for i in range(batch.num_rows):
                    page, url, body, refers = (batch.column(c)[i].as_py() for c in ("id", "url", "payload", "_refers"))
                    own = str(uuid.uuid5(uuid.NAMESPACE_URL, f"{folder}/{name}/{count}"))
                    headers = [
                        ("WARC-Type", "response" if refers is None else "revisit"),
                        ("WARC-Record-ID", record_name(page, own)),
                        ("WARC-Date", DATE),
                        ("WARC-Target-URI", url or ""),
                        ("WARC-Payload-Digest", "sha1:" + sha1_base32(body)),
                        ("Payload-Length", str(len(body))),
                    ]
                    if refers is not None:
                        headers += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_name(refers, ""))]
                        body = b""
                    size += out.write(encode_record(headers, body))
                    count += 1
        if count:
            system.move(draft, posixpath.join(base, name))
            yield pa.RecordBatch.from_arrays(
                [pa.array([folder.rstrip("/") + "/" + name]), pa.array([size], pa.int64())], names=["path", "bytes"]
            )
        else:
            system.delete_file(draft)

    return records.select("id", "url", "payload", "_refers").mapInArrow(run, "path string, bytes long")


RECORD = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("place", T.LongType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def read_archives(archives: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """Every record of the archives (path, bytes), one row each.

    ``payload`` is null for revisits and where ``with_payload`` is off; ``payload_bytes`` and
    ``digest`` (bare base32 SHA-1) are of the full payload either way. The digest of a payload
    that is there is computed from it; a mismatch with its header is an error, as is a member
    that starts as a record and does not decode.
    """
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    ranges = archives.filter("bytes > 0").select("path", "bytes", F.explode(starts).alias("start"))
    # a range is a few bytes as a row and much work as a task, so the number of tasks is fixed here
    total = archives.agg(F.sum(F.ceil(F.col("bytes") / split_bytes)).alias("n")).first()["n"]
    spread = ranges.repartition(min(int(total or 1), MOST_TASKS), "path", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=RECORD.names
            )

        for batch in batches:
            for path, size, start in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "start")), strict=True):
                system, place_of = shared_file_system(path)
                with system.open_input_file(place_of) as source:
                    for place, head, body in records_in(Archive(source, size), start, min(size, start + split_bytes)):
                        digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
                        kind = head.get("warc-type", "")
                        if kind == "revisit":
                            payload, length = None, int(head["payload-length"])
                        else:
                            payload, length = body, len(body)
                            if sha1_base32(body) != digest:
                                raise ValueError(f"{path}: the payload at byte {place} is not what its digest says")
                        rows.append(
                            (path, place, head["warc-record-id"], kind, head.get("warc-target-uri"),
                             head.get("warc-refers-to"), digest, length, payload if with_payload else None)
                        )
                        held += len(payload or b"") if with_payload else 0
                        if len(rows) >= 2_000 or held >= 16 * BLOCK:
                            held = 0
                            yield flush()
        if rows:
            yield flush()

    return spread.select("path", "bytes", "start").mapInArrow(run, RECORD)


def page_of(record_id: F.Column) -> F.Column:
    """The page id in a record id; null for a page without one."""
    return F.expr(f"try_cast(regexp_extract({record_id}, '^<urn:page:(-?[0-9]+)>$', 1) as bigint)")


def round_trip(pages: DataFrame, folder: str, materialise, least_bytes: int = 0, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Writes ``pages`` as archives below ``folder``, reads them back and reports every record:
    page_id, payload_bytes, payload_digest, record_type and refers_to.

    The list of archives is written by ``materialise`` before anything is read.
    """
    archives = materialise(write_archives(pages, folder, least_bytes=least_bytes), "archives")
    return read_archives(archives, split_bytes, with_payload=False).select(
        page_of("record_id").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        page_of("refers_to").alias("refers_to"),
    )


def archive_folder(spark: SparkSession) -> str:
    """A fresh folder for archives in the session's shared folder."""
    from lociweave.session import scratch_path

    return scratch_path(spark, "warc")
