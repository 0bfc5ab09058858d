"""WARC archives: writing, reading, and resolving repeated payloads to revisit records.

Archives are ``.warc.gz`` files, one gzip member per record, in a folder that all executors share.
A task writes a file under a name of its own and returns a row per record (path, offset, length
and the headers' facts). These rows are the manifest, written as a table: a file that no manifest
row names (from a lost or repeated task) is not part of the archive.

Resolution shuffles headers only: the manifest is grouped by payload digest, the decisions join it
back, and each task copies the records of whole source files in order, so payloads go from archive
to archive without a shuffle.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotledger.llm.common import scratch_dir, written

MANIFEST = ("path string, offset long, length long, record_id string, page_id long, uri string, "
            "record_type string, payload_bytes long, payload_digest string, refers_to long, date string")
FILE_RECORDS = 2000
TASK_BYTES = 128 << 20  # of compressed archives that a task reads
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest32: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest32}')}>"


def _clean(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, uri: str | None, payload: bytes | None, size: int, digest32: str,
           original: tuple[int | None, str, str | None, str] | None = None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """The bytes of a response record, or of a revisit of ``original`` (page_id, record id, uri, date)."""
    http = _HTTP.format(size).encode()
    block = http if original else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if original else 'response'}",
            f"WARC-Record-ID: {record_id(page_id, digest32)}", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{digest32}", f"WARC-Block-Digest: sha1:{digest(block)}",
            "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
            f"X-Payload-Length: {size}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if uri is not None:
        head.append(f"WARC-Target-URI: {_clean(uri)}")
    if original:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {original[1]}", f"WARC-Refers-To-Date: {original[3]}"]
        if original[2] is not None:
            head.append(f"WARC-Refers-To-Target-URI: {_clean(original[2])}")
        if original[0] is not None:
            head.append(f"X-Refers-To-Page-ID: {original[0]}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers with lower-case names, payload) of one record; the digest of its block is checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    if fields["warc-block-digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"damaged record {fields['warc-record-id']}")
    return fields, block.partition(b"\r\n\r\n")[2]


def _number(value: str | None) -> int | None:
    return None if value is None else int(value)


def _facts(fields: dict[str, str]) -> tuple:
    return (fields["warc-record-id"], _number(fields.get("x-page-id")), fields.get("warc-target-uri"),
            fields["warc-type"], int(fields["x-payload-length"]),
            fields["warc-payload-digest"].removeprefix("sha1:"), _number(fields.get("x-refers-to-page-id")), fields["warc-date"])


class _Writer:
    """Writes records to files of one task and gives their manifest rows, a file's at a time."""

    def __init__(self, folder: str):
        self.fs, self.root = pa.fs.FileSystem.from_uri(folder)
        self.folder, self.file, self.rows = folder, None, []
        self.fs.create_dir(self.root, recursive=True)

    def add(self, data: bytes, facts: tuple) -> None:
        if self.file is None:
            self.name, self.at = f"{uuid.uuid4().hex}.warc.gz", 0
            self.file = self.fs.open_output_stream(f"{self.root}/{self.name}", compression=None)
        press = zlib.compressobj(3, zlib.DEFLATED, 31)
        member = press.compress(data) + press.flush()
        self.file.write(member)
        self.rows.append((f"{self.folder}/{self.name}", self.at, len(member), *facts))
        self.at += len(member)

    def full(self) -> bool:
        return len(self.rows) >= FILE_RECORDS

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.file is not None:
            self.file.close()
            yield _batch(self.rows)
            self.file, self.rows = None, []


_ARROW = pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in
                    (x.split() for x in MANIFEST.split(", "))])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


def _read(path: str, spans: list[tuple[int, int]]) -> Iterator[bytes]:
    fs, name = pa.fs.FileSystem.from_uri(path)
    with fs.open_input_file(name) as file:
        for offset, length in spans:
            file.seek(offset)
            yield zlib.decompress(file.read(length), 31)


def _runs(path: list[str], offset: list[int], length: list[int]) -> Iterator[tuple[int, bytes]]:
    """(index, record) of the spans; a file is opened once for those that follow one another."""
    at = 0
    while at < len(path):
        end = at
        while end < len(path) and path[end] == path[at]:
            end += 1
        yield from enumerate(_read(path[at], list(zip(offset[at:end], length[at:end]))), at)
        at = end


def write_archives(pages: DataFrame, folder: str, date: str | None = None) -> DataFrame:
    """Writes a response record per row of ``pages`` (page_id, url, html) and returns the manifest.

    The payload is the html in UTF-8, empty for null. Null ids and urls leave their header out.
    Rows that repeat an id are records of their own. ``date`` is the records' date, by default now.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Writer(folder)
        for batch in batches:
            for page_id, uri, html in zip(*(c.to_pylist() for c in batch.columns)):
                payload = html or b""
                sha = digest(payload)
                data = record(page_id, uri, payload, len(payload), sha, date=date)
                out.add(data, (record_id(page_id, sha), page_id, uri, "response", len(payload), sha, None, date))
                if out.full():
                    yield from out.close()
        yield from out.close()

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.col("html").cast("binary"))
    return written(rows.mapInArrow(write, MANIFEST), f"{folder}-manifest")


def _by_file(manifest: DataFrame) -> DataFrame:
    """Spans by file and place, in as many tasks as the archives' bytes ask for: a count by the bytes
    of the manifest would leave them to one."""
    total, files = manifest.agg(F.sum("length"), F.approx_count_distinct("path")).first()
    spread = min(files, 2 * manifest.sparkSession.sparkContext.defaultParallelism)
    tasks = max(1, spread, -(-(total or 0) // TASK_BYTES))
    return manifest.repartition(tasks, "path").sortWithinPartitions("path", "offset")


def headers(manifest: DataFrame) -> DataFrame:
    """Reads the records that a manifest names back from the archives: their own headers, with
    digest and size recomputed from the payload of every response."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, offset, length = (c.to_pylist() for c in batch.columns)
            rows = []
            for k, data in _runs(path, offset, length):
                fields, payload = parsed(data)
                facts = _facts(fields)
                if facts[3] == "response" and (len(payload), digest(payload)) != facts[4:6]:
                    raise ValueError(f"damaged payload in {facts[0]}")
                rows.append((path[k], offset[k], length[k], *facts))
            if rows:
                yield _batch(rows)

    return _by_file(manifest.select("path", "offset", "length")).mapInArrow(read, MANIFEST)


def resolve_revisits(manifest: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Writes deduplicated archives with fresh headers to ``folder``; returns their manifest.

    Of the records whose payloads are equal and have at least ``min_bytes`` bytes, that with the
    largest page_id (then the largest path and offset) is the response and the others revisit it.
    Smaller payloads all stay responses. A record without page_id is smaller than all others.
    """
    found = written(headers(manifest))
    place = F.struct(F.coalesce(F.col("page_id"), F.lit(-(2**63))), "path", "offset")
    firsts = written(found.where(F.col("payload_bytes") >= min_bytes)
                     .groupBy("payload_digest", "payload_bytes")
                     .agg(F.max(F.struct(place.alias("place"), "page_id", "record_id", "uri", "date")).alias("first"))
                     .select("payload_digest", "payload_bytes", "first.*"))
    decided = found.join(
        firsts.select("payload_digest", "payload_bytes", F.col("page_id").alias("first_page"),
                      F.col("record_id").alias("first_record"), F.col("uri").alias("first_uri"), F.col("date").alias("first_date"),
                      F.col("place").alias("first_place")),
        ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("first_place").isNotNull() & (F.col("first_place") != place)
    plan = written(decided.select("path", "offset", "length", "first_page", "first_uri", "first_date",
                                  F.when(revisit, F.col("first_record")).alias("first_record")))

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Writer(folder)
        for batch in batches:
            path, offset, length, pages, uris, dates, firsts = (c.to_pylist() for c in batch.columns)
            for k, data in _runs(path, offset, length):
                fields, payload = parsed(data)
                rid, page_id, uri, _, size, sha, _, date = _facts(fields)
                original = (pages[k], firsts[k], uris[k], dates[k]) if firsts[k] else None
                facts = (rid, page_id, uri, "revisit" if original else "response", size, sha, pages[k] if original else None, date)
                out.add(record(page_id, uri, payload, size, sha, original, date), facts)
                if out.full():
                    yield from out.close()
        yield from out.close()

    return written(_by_file(plan).mapInArrow(copy, MANIFEST), f"{folder}-manifest")


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages to archives, archives to deduplicated archives, and those read back.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to, url, and the
    record's place. An empty table gives no archives and an empty result.
    """
    folder = scratch_dir(pages.sparkSession)
    manifest = write_archives(pages, f"{folder}/raw")
    done = resolve_revisits(manifest, f"{folder}/deduplicated", min_bytes)
    return headers(done).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                F.col("uri").alias("url"), "path", "offset", "length")
