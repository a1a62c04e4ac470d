"""WARC archives: a writer with revisit records, and a splittable reader (8).

Each record is a gzip member of its own. A reading task gets a byte range of a file; it looks for
gzip's magic bytes, takes a candidate for a member only if it decodes to a WARC header, and owns the
records that start inside its range, reading past its end to finish the last one. After a record it
goes on where the member ended. So a file of any size is read by many tasks, and no index is kept.

Writing tasks name their files by chance and report them; readers open reported files only, so what
a lost or repeated attempt left behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.workspace import scratch_path, settle

# Payloads from this size on are written once, and referred to by their copies.
LEAST_REVISIT = 1000

# A task starts another file beyond this size.
FILE_BYTES = 1 << 30

# Bytes of a file that one task looks for records in.
RANGE_BYTES = 32 << 20

CHUNK = 1 << 20
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BATCH_BYTES = 4 << 20


def with_roles(pages: DataFrame) -> DataFrame:
    """`pages(page_id, url, html)` as records: with payload, its size and digest, and their role.

    Of equal payloads of `LEAST_REVISIT` bytes or more the one with the largest `page_id` is the
    response, and the others are revisits that refer to it. A null html is an empty payload. Rows
    that share the largest id are all responses, and so are rows without id that only meet such.
    """
    records = pages.select(
        "page_id",
        "url",
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    ).select(
        "*",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
    )
    large = records.where(F.col("payload_bytes") >= LEAST_REVISIT)
    keepers = large.groupBy("payload_digest").agg(
        F.max("page_id").alias("keeper"), F.count("*").alias("n")
    )
    # digests only, and only those that occur again; written, so that Spark knows how many
    keepers = settle(keepers.where("n > 1").select("payload_digest", "keeper"), "keepers")
    own = F.coalesce(F.col("page_id") == F.col("keeper"), F.col("keeper").isNull())
    revisit = ~own & (F.col("payload_bytes") >= LEAST_REVISIT)
    return (
        records.join(keepers, "payload_digest", "left")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisit, F.col("keeper")))
        .drop("keeper")
    )


def _member(row: dict) -> bytes:
    """One record, compressed. Control characters and blanks of a URL are percent-encoded."""
    payload, digest = row["payload"], bytes.fromhex(row["payload_digest"])
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if row["record_type"] == "response" else b"")
    number = "" if row["page_id"] is None else row["page_id"]
    head = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": f"<urn:page:{number}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha1:{base64.b32encode(digest).decode()}",
        "X-Payload-Length": row["payload_bytes"],
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": len(block),
    }
    if row["url"] is not None:
        url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"])
        head["WARC-Target-URI"] = url
    if row["record_type"] == "revisit":
        head["WARC-Profile"] = PROFILE
        head["WARC-Refers-To"] = f"<urn:page:{row['refers_to']}>"
    lines = "".join(f"{name}: {value}\r\n" for name, value in head.items())
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    record = VERSION + lines.encode() + b"\r\n" + block + b"\r\n\r\n"
    return packer.compress(record) + packer.flush()


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write `with_roles` records as WARC files in `folder`; `path, n_records, n_bytes` of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pafs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        out, name, written, count = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            columns = [[f"{folder}/{name}"], [count], [written]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["path", "n_records", "n_bytes"]
            )

        for batch in batches:
            for i in range(len(batch)):
                if out is None:
                    name, written, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                member = _member({c: batch.column(c)[i].as_py() for c in batch.schema.names})
                out.write(member)
                written, count = written + len(member), count + 1
                if written >= file_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return settle(
        records.mapInArrow(run, "path string, n_records bigint, n_bytes bigint"), "archives"
    )


class _Source:
    """A file read forward in chunks, from any place on."""

    def __init__(self, file, at: int):
        self.file, self.at, self.held = file, at, b""
        file.seek(at)

    def more(self) -> bool:
        chunk = self.file.read(CHUNK)
        self.held += chunk
        return bool(chunk)

    def skip(self, count: int) -> None:
        self.held, self.at = self.held[count:], self.at + count


def _decoded(source: _Source) -> tuple[bytes, int] | None:
    """The record whose member starts where the source stands, and the member's size.

    None if what starts there does not decode to a WARC record.
    """
    unpacker, parts, used = zlib.decompressobj(31), [], 0
    checked = False
    while not unpacker.eof:
        if used == len(source.held) and not source.more():
            return None
        piece = source.held[used : used + (CHUNK if checked else 4096)]
        used += len(piece)
        try:
            parts.append(unpacker.decompress(piece))
        except zlib.error:
            return None
        if not checked and sum(map(len, parts)) >= len(VERSION):
            parts = [b"".join(parts)]
            if not parts[0].startswith(b"WARC/"):
                return None
            checked = True
    return (b"".join(parts), used - len(unpacker.unused_data)) if checked else None


def records_in(file, start: int, stop: int) -> Iterator[bytes]:
    """The records of a WARC file whose members start in `[start, stop)`."""
    source = _Source(file, start)
    while source.at < stop:
        found = source.held.find(MAGIC)
        if found < 0:
            # the magic may begin in the last two bytes held
            source.skip(max(0, len(source.held) - 2))
            if not source.more():
                return
            continue
        source.skip(found)
        if source.at >= stop:
            return
        record = _decoded(source)
        if record is None:
            source.skip(1)
            continue
        yield record[0]
        source.skip(record[1])


def parsed(record: bytes) -> dict:
    """The columns of one record; of a response, size and digest are those of its payload."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    number = re.compile(r"<urn:page:(-?\d+)>")
    page, other = (number.fullmatch(fields.get(k, "")) for k in ("WARC-Record-ID", "WARC-Refers-To"))
    row = {
        "page_id": int(page[1]) if page else None,
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "refers_to": int(other[1]) if other else None,
    }
    if row["record_type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        return row | {
            "payload_bytes": len(payload),
            "payload_digest": hashlib.sha1(payload).hexdigest(),
            "payload": payload,
        }
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    return row | {
        "payload_bytes": int(fields["X-Payload-Length"]),
        "payload_digest": digest.hex(),
        "payload": None,
    }


def read_archives(
    spark: SparkSession, files: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True
) -> DataFrame:
    """Every record of `files(path, n_bytes)`, in no order; a revisit's payload is null."""
    ranges = files.where("n_bytes > 0").select(
        "path", F.explode(F.expr(f"sequence(0L, n_bytes - 1, {range_bytes}L)")).alias("start")
    )
    total = files.agg(F.sum(F.ceil(F.col("n_bytes") / range_bytes))).first()[0] or 1
    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
            ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
        ]
        + [("payload", pa.binary())] * payloads
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.to_pylist():
                system, path = pafs.FileSystem.from_uri(place["path"])
                rows, size = [], 0
                with system.open_input_file(path) as file:
                    start = place["start"]
                    for record in records_in(file, start, start + range_bytes):
                        rows.append(parsed(record))
                        size += len(record)
                        if size >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return ranges.repartition(int(total)).mapInArrow(
        run,
        "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
        "payload_digest string" + ", payload binary" * payloads,
    )


def archived(pages: DataFrame, payloads: bool = True) -> DataFrame:
    """`pages` written as WARC files below the session's shared folder and read back.

    A row per row of `pages`, repeated ones included; no pages give no rows.
    """
    spark = pages.sparkSession
    files = write_archives(with_roles(pages), scratch_path(spark, "warc"))
    return read_archives(spark, files, payloads=payloads)
