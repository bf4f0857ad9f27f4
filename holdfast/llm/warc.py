"""WARC archives: writing, reading, and resolving repeated payloads to revisit records.

Archives are gzip files with one member a record. ``write_archives`` writes a response
record for every row and returns the records' headers as a table. ``resolve`` shuffles
these headers by payload digest, finds the original of each repeated payload and joins
the others to it. ``rewrite_archives`` reads every archive next to the decisions on its
records and writes it anew: originals with their payload, repeats as revisit records with
fresh headers and no payload. Payloads never pass through a shuffle.

An archive holds at most ``ARCHIVE_BYTES`` (plus one record) and ``ARCHIVE_RECORDS``, so a
task that rewrites one has a bounded number of decisions in memory.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.store import open_folder, stored, work_folder
from holdfast.operators.joins import lookup

ARCHIVE_BYTES, ARCHIVE_RECORDS = 16 << 20, 20_000
LEAST_BYTES = 1_000  # smaller payloads are never replaced
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
TASKS = 2_000  # at most so many partitions of archives

_HEADERS = "file string, offset bigint, record_id string, page_id bigint, payload_bytes bigint, payload_digest string"
_RECORDS = (
    "record_id string, page_id bigint, url string, record_type string, payload_bytes bigint, "
    "payload_digest string, refers_to_id string, payload binary"
)


class _Writer:
    """Writes records into archives of bounded size."""

    def __init__(self, folder: str):
        self.folder = folder
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        self.stream, self.written, self.records, self.file = None, 0, 0, ""

    def add(self, fields: dict[str, str], block: bytes) -> tuple[str, int]:
        """Append a record; its file and offset."""
        if self.stream and (self.written >= ARCHIVE_BYTES or self.records >= ARCHIVE_RECORDS):
            self.close()
        if not self.stream:
            self.file = f"{self.folder}/{uuid.uuid4().hex}.warc.gz"
            system, path = open_folder(self.file)
            self.stream = system.open_output_stream(path, compression=None)
            self.written = self.records = 0
        fields = fields | {"Content-Length": str(len(block))}
        head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        data = packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n")
        data += packer.flush()
        offset = self.written
        self.stream.write(data)
        self.written += len(data)
        self.records += 1
        return self.file, offset

    def close(self) -> None:
        if self.stream:
            self.stream.close()
            self.stream = None


def _http(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def _fields(kind: str, record_id: str, page_id: int | None, url: str | None, digest: str) -> dict[str, str]:
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<{record_id}>",
        "WARC-Date": DATE,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
    }
    if url is not None:
        fields["WARC-Target-URI"] = quote(url, safe="%!#$&'()*+,/:;=?@[]~")
    if page_id is not None:
        fields["Holdfast-Page-ID"] = str(page_id)
    return fields


def _members(file: str) -> Iterator[tuple[int, bytes]]:
    """Offset and content of every gzip member, one at a time."""
    system, path = open_folder(file)
    with system.open_input_stream(path, compression=None) as stream:
        offset, used, unpacker, parts = 0, 0, zlib.decompressobj(31), []
        chunk = stream.read(1 << 20)
        while chunk:
            parts.append(unpacker.decompress(chunk))
            used += len(chunk) - len(unpacker.unused_data)
            if unpacker.eof:
                yield offset, b"".join(parts)
                chunk = unpacker.unused_data
                offset, unpacker, parts = used, zlib.decompressobj(31), []
            else:
                chunk = b""
            chunk = chunk or stream.read(1 << 20)
        if parts:
            raise ValueError(f"{file} ends within a record")


def _parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def write_archives(pages: DataFrame, payload: str = "html") -> DataFrame:
    """Write a response record for every row; the headers of all records as a table.

    Null ids and urls are left out of the record; a null payload is empty. Repeated
    rows are records of their own.
    """
    folder = work_folder(pages.sparkSession, "archives")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(folder)
        for batch in batches:
            rows = []
            for page_id, url, text in zip(*(batch.column(i) for i in range(3))):
                page_id, url, text = page_id.as_py(), url.as_py(), text.as_py()
                data = text if isinstance(text, bytes) else (text or "").encode()
                digest, record_id = hashlib.sha1(data).hexdigest(), uuid.uuid4().urn
                fields = _fields("response", record_id, page_id, url, digest)
                at = writer.add(fields, _http(len(data)) + data)
                rows.append((*at, record_id, page_id, len(data), digest))
            yield _batch(rows, _HEADERS)
        writer.close()

    sent = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), payload)
    return stored(sent.mapInArrow(write, _HEADERS), "archive-headers")


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.strip().split(" ") for f in ddl.split(",")]
    columns = list(zip(*rows)) or [()] * len(fields)
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)]
    return pa.record_batch(arrays, names=[name for name, _ in fields])


def resolve(headers: DataFrame) -> DataFrame:
    """Add ``original_id``: null for responses, for repeats the record they refer to.

    Of equal payloads of ``LEAST_BYTES`` and more the record with the largest page id
    (null is smallest; ties by record id) is the original. The groups are reduced on the
    map side, and the join back can split a digest that many records share.
    """
    large = headers.filter(F.col("payload_bytes") >= LEAST_BYTES)
    originals = (
        large.groupBy("payload_digest")
        .agg(F.max(F.struct("page_id", "record_id")).alias("o"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("payload_digest", F.col("o.record_id").alias("original_id"))
    )
    joined = lookup(headers, originals, ["payload_digest"])
    is_original = F.col("original_id") == F.col("record_id")
    return joined.withColumn("original_id", F.when(~is_original, F.col("original_id")))


def rewrite_archives(resolved: DataFrame) -> DataFrame:
    """Write every archive anew by the decisions of :func:`resolve`; a table of files."""
    folder = work_folder(resolved.sparkSession, "deduplicated")
    archives = resolved.agg(F.count_distinct("file")).first()[0]

    def rewrite(decisions: pa.Table) -> pa.Table:
        writer, files = _Writer(folder), {}
        original = dict(zip(decisions["offset"].to_pylist(), decisions["original_id"].to_pylist()))
        source = decisions["file"][0].as_py()
        for offset, member in _members(source):
            fields, block = _parsed(member)
            digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
            page_id = fields.get("Holdfast-Page-ID")
            fresh = _fields(
                "revisit" if original[offset] else "response",
                fields["WARC-Record-ID"].strip("<>"),
                page_id and int(page_id),
                fields.get("WARC-Target-URI"),
                digest,
            )
            if original[offset]:
                fresh |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<{original[offset]}>"}
                block = block[: block.index(b"\r\n\r\n") + 4]
            file, _ = writer.add(fresh, block)
            files[file] = files.get(file, 0) + 1
        writer.close()
        return pa.table({"file": list(files), "records": pa.array(files.values(), pa.int64())})

    decisions = resolved.select("file", "offset", "original_id")
    spread = decisions.repartition(max(1, min(TASKS, archives)), "file")
    return stored(spread.groupBy("file").applyInArrow(rewrite, "file string, records bigint"), "archive-files")


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the archives that ``files`` lists in its column ``file``.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload, for revisit
    records too. A response whose payload does not have its digest is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows, size = [], 0
                for _, member in _members(file):
                    rows.append(_record(*_parsed(member), payloads))
                    size += len(member) if payloads else 200
                    if size > 4 << 20:
                        yield _batch(rows, _RECORDS)
                        rows, size = [], 0
                yield _batch(rows, _RECORDS)

    tasks = max(1, min(TASKS, files.count()))
    found = files.select("file").repartition(tasks).mapInArrow(read, _RECORDS)
    return found if payloads else found.drop("payload")


def _record(fields: dict[str, str], block: bytes, payloads: bool) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind, refers = fields["WARC-Type"], fields.get("WARC-Refers-To")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    page_id = fields.get("Holdfast-Page-ID")
    return (
        fields["WARC-Record-ID"].strip("<>"),
        page_id and int(page_id),
        fields.get("WARC-Target-URI"),
        kind,
        length,
        digest,
        refers and refers.strip("<>"),
        payload if payloads and kind == "response" else None,
    )


def with_originals(records: DataFrame) -> DataFrame:
    """Join revisit records to their responses: adds ``refers_to``, the response's page id.

    All columns but the payload are kept. They are written first: Spark knows the size
    of a table, but not that of what a Python reader returns, and would broadcast it.
    """
    headers = stored(records.drop("payload"), "record-headers")
    responses = headers.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")
    )
    return lookup(headers, responses, ["refers_to_id"])
