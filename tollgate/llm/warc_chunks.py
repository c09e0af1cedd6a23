"""WARC archives written from pages, and read back as a chunked record table.

Writing: pages with equal payloads (SHA-1 and length) of at least ``min_bytes``
share one response record, that of the largest ``page_id``; the others are
revisit records that refer to it and carry no payload.  Each task writes one
archive in the shared folder, each record a gzip member, a payload slice by slice.

Reading: an archive is streamed, and a record becomes rows of record identifier
and chunk number, each with the running byte count and the running SHA-1 of the
payload so far; a record is never held whole.  The last chunk's digest is the
payload's and is compared with the header.

Defined cases: a null html is an empty payload; a null ``page_id`` gets a response
record of its own and reads back as null; rows repeated with one ``page_id`` and
payload each get a record of the type that id has; an empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.llm.common import arrow_schema, materialise
from tollgate.llm.files import open_file, whole_file
from tollgate.session import scratch_path

CHUNK = 64 * 1024
LEVEL = 5  # of the compression
DATE = "2000-01-01T00:00:00Z"  # fixed, so that a retried task writes the same bytes


def base32_of_hex(column) -> F.Column:
    """Upper-case base32 of a 40-digit hex digest: 5 hex digits are 4 of base32."""
    return F.concat(
        *(
            F.translate(
                F.lpad(F.conv(F.substring(column, 5 * i + 1, 5), 16, 32), 4, "0"),
                "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
            )
            for i in range(8)
        )
    )


def decide(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, payload_digest, payload_bytes, record_type, refers_to`` per
    distinct page and payload.  Only digests are shuffled; the copies of one
    payload are reduced to one row per task first."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    each = pages.where("page_id is not null").select(
        "page_id",
        base32_of_hex(F.sha1(F.encode(payload, "utf-8"))).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    each = materialise(each, "page-digests").distinct()
    largest = (
        each.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("first"))
    )
    refers = F.when(F.col("first") != F.col("page_id"), F.col("first"))
    return each.join(largest, ["payload_digest", "payload_bytes"], "left").select(
        "page_id",
        "payload_digest",
        "payload_bytes",
        F.when(refers.isNull(), "response").otherwise("revisit").alias("record_type"),
        refers.alias("refers_to"),
    )


def record_id(page_id: int | None, part: int, n: int) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:page:none:{part}-{n}>"


def write_record(out, head: dict[str, str], payload: bytes, chunk: int = CHUNK) -> None:
    """A record as a gzip member of its own, the payload slice by slice."""
    zipped = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items())
    out.write(zipped.compress((lines + f"Content-Length: {len(payload)}\r\n\r\n").encode()))
    view = memoryview(payload)
    for at in range(0, len(payload), chunk):
        out.write(zipped.compress(view[at : at + chunk]))
    out.write(zipped.compress(b"\r\n\r\n") + zipped.flush())


class Unzipped:
    """A stream of gzip members, read as the bytes that they hold."""

    def __init__(self, stream):
        self.stream, self.member, self.raw = stream, None, b""

    def read(self, n: int) -> bytes:
        while True:
            if not self.raw:
                self.raw = self.stream.read(CHUNK)
                if not self.raw:
                    if self.member is not None and not self.member.eof:
                        raise ValueError("the archive ends inside a member")
                    return b""
            if self.member is None or self.member.eof:
                self.member = zlib.decompressobj(31)
            out = self.member.decompress(self.raw, n)
            self.raw = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            if out:
                return out


def write_archives(pages: DataFrame, min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write the archives; returns the manifest ``path, n_records``."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    pages = pages.select("page_id", "url", "html")
    marked = pages.join(decide(pages, min_bytes), "page_id", "left")
    own = F.coalesce(F.octet_length("html"), F.lit(0))
    # One id with several payloads: each row keeps the decision of its own payload.
    marked = marked.where(
        F.col("payload_digest").isNull()
        | (
            (F.col("payload_bytes") == own)
            & (F.col("payload_digest") == base32_of_hex(F.sha1(F.encode(F.coalesce("html", F.lit("")), "utf-8"))))
        )
    ).select("page_id", "url", F.when(F.coalesce("record_type", F.lit("response")) == "response", F.col("html")).alias("html"),
             "record_type", "refers_to", "payload_digest", "payload_bytes")

    def write(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        first = next(batches, None)
        if first is None:
            return
        path, n, batch = f"{folder}/pages-{part:06d}.warc.gz", 0, first
        with whole_file(path) as out:
            while batch is not None:
                for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                    page, url, html, kind, refers, digest, size = row
                    payload = (html or "").encode()
                    if digest is None:  # no page_id: decided here, as a response
                        kind, size = "response", len(payload)
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    head = {
                        "WARC-Type": kind,
                        "WARC-Record-ID": record_id(page, part, n),
                        "WARC-Date": DATE,
                        "WARC-Target-URI": (url or "").replace("\r", "%0D").replace("\n", "%0A"),
                        "Content-Type": "text/html; charset=utf-8",
                        "WARC-Payload-Digest": f"sha1:{digest}",
                    }
                    if kind == "revisit":
                        head |= {
                            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                            "WARC-Refers-To": record_id(refers, 0, 0),
                            "X-Payload-Length": str(size),
                        }
                        payload = b""
                    write_record(out, head, payload)
                    n += 1
                batch = next(batches, None)
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], ["path", "n_records"])

    return materialise(marked.mapInArrow(write, "path string, n_records long"), "warc-files")


def read_records(stream, chunk: int = CHUNK) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """(headers, payload slices) of each record; slices must be consumed before
    the next record.  Nothing longer than ``chunk`` is held."""
    buffer = bytearray()

    def line() -> bytes | None:
        while (at := buffer.find(b"\r\n")) < 0:
            more = stream.read(chunk)
            if not more:
                if buffer:
                    raise ValueError("the archive ends inside a header")
                return None
            buffer.extend(more)
        out = bytes(buffer[:at])
        del buffer[: at + 2]
        return out

    def body(left: int) -> Iterator[bytes]:
        while left:
            if not buffer:
                more = stream.read(min(chunk, left + 4))
                if not more:
                    raise ValueError("the archive ends inside a record")
                buffer.extend(more)
            part = bytes(buffer[: min(left, chunk)])
            del buffer[: len(part)]
            left -= len(part)
            yield part

    while True:
        version = line()
        if version is None:
            return
        if version == b"":
            continue  # the blank lines after a record
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a record: {version[:40]!r}")
        head = {}
        while (text := line()) != b"":
            if text is None:
                raise ValueError("the archive ends inside a header")
            name, _, value = text.decode().partition(":")
            head[name] = value.strip()
        yield head, body(int(head["Content-Length"]))


_CHUNKS = (
    "record_id string, record_type string, url string, refers_to string, header_digest string, header_bytes long, "
    "archive string, record_no long, chunk_no long, n_bytes long, last boolean, bytes_so_far long, "
    "digest_so_far string, data binary"
)


def read_chunks(manifest: DataFrame, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunked record table of the archives of a manifest: one row per
    chunk, at least one per record.  ``with_data=False`` leaves the bytes out."""

    schema = T.StructType.fromDDL(_CHUNKS)

    def run(batches):
        target = arrow_schema(schema)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                with open_file(path) as stream:
                    for number, (head, slices) in enumerate(read_records(Unzipped(stream), chunk)):
                        digest, so_far, k = hashlib.sha1(), 0, 0
                        part = next(slices, b"")
                        while True:
                            following = next(slices, None)
                            digest.update(part)
                            so_far += len(part)
                            rows.append(
                                (
                                    head["WARC-Record-ID"], head["WARC-Type"], head.get("WARC-Target-URI"),
                                    head.get("WARC-Refers-To"), head.get("WARC-Payload-Digest", "").removeprefix("sha1:"),
                                    int(head.get("X-Payload-Length", head["Content-Length"])), path, number, k, len(part),
                                    following is None, so_far, base64.b32encode(digest.digest()).decode(),
                                    part if with_data else None,
                                )
                            )
                            held += len(part) if with_data else 200
                            if held > 8 << 20:
                                yield pa.RecordBatch.from_pydict(dict(zip(target.names, zip(*rows))), schema=target)
                                rows, held = [], 0
                            if following is None:
                                break
                            part, k = following, k + 1
                if rows:
                    yield pa.RecordBatch.from_pydict(dict(zip(target.names, zip(*rows))), schema=target)

    files = manifest.select("path")
    parts = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(parts, "path").mapInArrow(run, schema)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record: the last chunk has the payload's size and digest.  A
    response whose digest or size is not that of its header is an error."""
    page = F.regexp_extract("record_id", r"^<urn:page:(-?\d+)>$", 1)
    refers = F.regexp_extract("refers_to", r"^<urn:page:(-?\d+)>$", 1)
    revisit = F.col("record_type") == "revisit"
    whole = revisit | ((F.col("digest_so_far") == F.col("header_digest")) & (F.col("bytes_so_far") == F.col("header_bytes")))
    return chunks.where("last").select(
        F.when(page != "", page.cast("long")).alias("page_id"),
        F.when(revisit, F.col("header_bytes")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        F.when(whole, F.when(revisit, F.col("header_digest")).otherwise(F.col("digest_so_far")))
        .otherwise(F.raise_error(F.concat(F.lit("damaged record "), F.col("record_id"))))
        .alias("payload_digest"),
        "record_type",
        F.when(revisit & (refers != ""), refers.cast("long")).alias("refers_to"),
    )
