"""Token ids in files under a canonical, length-limited Huffman code.

``count_ids`` counts ids over all documents; ``code_lengths`` limits the code by
package-merge; codes are canonical, so a file needs only the lengths.  Each
file holds a range of documents in ascending ``doc_id`` order as independent
blocks with a checkpoint (a bit offset) every ``STEP`` ids: a block decodes
from its checkpoints in parallel, one table look-up per id.

File: magic, lengths (deflated), then blocks.  A block has a header (documents,
ids, checkpoints, payload bytes, crc32 of the payload), its documents' ids and
token counts, the checkpoints and the payload.  A document longer than a block
goes on in the next one; no more than a block is in memory.

Texts are tokenised once, into a table of ids that the counts and the files are
made from.

Defined cases: null and empty texts have only the end id; null ``doc_id``s come
first and read back as null; repeated ids and rows each keep their place (ties by
a checksum of the ids); an empty table gives no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.llm.common import arrow_schema, byte_slices, materialise, worker_turn
from tollgate.llm.files import open_file, whole_file
from tollgate.session import scratch_path

LIMIT = 20  # bits of the longest code
STEP = 128  # ids between checkpoints
BLOCK_IDS = 1 << 18
MAGIC = b"HUFFIDS1"
#: Ids of a file, on average, at most.
FILE_IDS = 1 << 27
_HEAD = struct.Struct("<IIIII")
_NULL_ID = -(2**63)

#: A tokenizer: texts to little-endian 32-bit ids, made in the worker.
Encode = Callable[[list], list]


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Code length of each id (0: not used), by package-merge."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n == 0:
        return lengths
    if n == 1:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} ids don't fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.int64)
    merged, levels = weight, []
    is_item = np.ones(n, bool)
    for _ in range(limit):
        levels.append(is_item)
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weight, pairs])
        at = np.argsort(both, kind="stable")
        merged, is_item = both[at], at < n
    take = 2 * n - 2
    depth = np.zeros(n, np.int64)
    for is_item in reversed(levels):
        items = int(is_item[:take].sum())
        depth[:items] += 1
        take = 2 * (take - items)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    if len(order):
        bits = lengths[order].astype(np.int64)
        span = np.int64(1) << (LIMIT - bits)
        codes[order] = ((np.cumsum(span) - span) >> (LIMIT - bits)).astype(np.uint64)
    return codes


def decoding_table(lengths: np.ndarray) -> np.ndarray:
    """For each LIMIT-bit prefix: id << 8 | code length."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    span = np.int64(1) << (LIMIT - lengths[order].astype(np.int64))
    table = np.zeros(1 << LIMIT, np.int64)
    filled = np.repeat((order.astype(np.int64) << 8) | lengths[order], span)
    table[: len(filled)] = filled
    return table


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bits of the ids, most significant first, and the bit offset of each id."""
    bits = lengths[ids].astype(np.int64)
    end = np.cumsum(bits)
    start = end - bits
    total = int(end[-1]) if len(end) else 0
    words = total // 32 + 2
    placed = codes[ids] << (64 - (start & 31) - bits).astype(np.uint64)
    at = start >> 5
    # Bits don't overlap, so sums of 32-bit halves are exact in doubles.
    out = np.bincount(at, (placed >> np.uint64(32)).astype(np.float64), words)
    out += np.bincount(at + 1, (placed & np.uint64(0xFFFFFFFF)).astype(np.float64), words)
    return out.astype(np.uint64).astype(">u4").tobytes()[: (total + 7) // 8], start


def segment_starts(sizes: np.ndarray) -> np.ndarray:
    """Places of the ids that begin a segment: every STEP-th of each part."""
    segments = -(-sizes // STEP)
    of = np.repeat(np.arange(len(sizes)), segments)
    number = np.arange(len(of)) - np.repeat(np.cumsum(segments) - segments, segments)
    return (np.cumsum(sizes) - sizes)[of] + STEP * number


def unpack(payload: bytes, sizes: np.ndarray, checkpoints: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The ids of parts of ``sizes`` ids, from their checkpoints, all segments side
    by side."""
    data = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint32)
    # The 32 bits that start at each byte.
    windows = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    at = checkpoints.astype(np.int64)
    out = np.zeros((len(at), STEP), np.uint32)
    last = len(payload) * 8
    segments = -(-sizes // STEP)
    # Ids of each segment: STEP, but for the last of a part.
    count = np.full(len(at), STEP, np.int64)
    ends = np.cumsum(segments)[sizes > 0] - 1
    count[ends] = (sizes - (segments - 1) * STEP)[sizes > 0]
    for k in range(int(count.max(initial=0))):
        entry = table[(windows[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(32 - LIMIT)]
        out[:, k] = entry >> 8
        at += entry & 255
        np.minimum(at, last, out=at)
    return out[np.arange(STEP) < count[:, None]]


class BlockWriter:
    def __init__(self, out, lengths: np.ndarray):
        self.out, self.lengths, self.codes = out, lengths, canonical_codes(lengths)
        self.docs: list[int] = []
        self.more: list[bool] = []
        self.parts: list[np.ndarray] = []
        self.held = 0
        table = zlib.compress(lengths.tobytes())
        out.write(MAGIC + struct.pack("<II", len(lengths), len(table)) + table)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """A document, in parts where it goes over a block's end."""
        at = 0
        while True:
            part = ids[at : at + BLOCK_IDS - self.held]
            at += len(part)
            self.docs.append(_NULL_ID if doc_id is None else doc_id)
            self.more.append(at < len(ids))
            self.parts.append(part)
            self.held += len(part)
            if self.held >= BLOCK_IDS:
                self.flush()
            if at >= len(ids):
                return

    def flush(self) -> None:
        if not self.docs:
            return
        sizes = np.array([len(p) for p in self.parts])
        payload, start = pack(np.concatenate(self.parts), self.lengths, self.codes)
        points = start[segment_starts(sizes)].astype("<u4")
        counts = (sizes | (np.array(self.more, np.int64) << 31)).astype("<u4")  # the top bit: goes on
        self.out.write(_HEAD.pack(len(self.docs), self.held, len(points), len(payload), zlib.crc32(payload)))
        for column in (np.array(self.docs, "<i8"), counts, points):
            self.out.write(column.tobytes())
        self.out.write(payload)
        self.docs, self.more, self.parts, self.held = [], [], [], 0


def read_blocks(stream) -> Iterator[tuple[int | None, np.ndarray, bool]]:
    """(doc_id, ids, more to come) pieces in file order."""

    def take(n: int) -> bytes:
        raw = stream.read(n)
        if len(raw) != n:
            raise ValueError("the file ends inside a block")
        return raw

    if take(len(MAGIC)) != MAGIC:
        raise ValueError("not a file of this format")
    symbols, size = struct.unpack("<II", take(8))
    lengths = np.frombuffer(zlib.decompress(take(size)), np.uint8)
    if len(lengths) != symbols:
        raise ValueError("the code table is damaged")
    table = decoding_table(lengths)
    while head := stream.read(_HEAD.size):
        n_docs, n_ids, n_checkpoints, n_payload, crc = _HEAD.unpack(head)
        docs, counts = np.frombuffer(take(8 * n_docs), "<i8"), np.frombuffer(take(4 * n_docs), "<u4")
        checkpoints, payload = np.frombuffer(take(4 * n_checkpoints), "<u4"), take(n_payload)
        if zlib.crc32(payload) != crc:
            raise ValueError("a block is damaged")
        sizes = (counts & 0x7FFFFFFF).astype(np.int64)
        if sizes.sum() != n_ids or n_checkpoints != (-(-sizes // STEP)).sum():
            raise ValueError("a block is damaged")
        ids = unpack(payload, sizes, checkpoints, table)
        at = 0
        for doc, n, more in zip(docs.tolist(), sizes.tolist(), (counts >> 31).tolist()):
            yield (None if doc == _NULL_ID else doc), ids[at : at + n], bool(more)
            at += n


def tokenise(docs: DataFrame, make_encode: Callable[[], Encode], size: int, end_id: int) -> DataFrame:
    """``doc_id, ids`` with the end id, in 16 bits where the ids allow, as a table in
    the shared folder: texts are tokenised once.  Besides a row per document there is one
    per task, without ids: the ids that it used, and how often (``used, n``)."""
    kind = _kind(size)
    names = ["doc_id", "ids", "used", "n"]

    def run(batches):
        worker_turn(__name__)
        encode, end = make_encode(), np.array([end_id], kind).tobytes()
        total = np.zeros(size, np.int64)
        for batch in batches:
            for some in byte_slices(batch, "text"):
                ids = [np.frombuffer(raw, "<u4").astype(kind).tobytes() + end for raw in encode(some.column("text").to_pylist())]
                total += np.bincount(np.frombuffer(b"".join(ids), kind), minlength=size)
                none = pa.nulls(len(ids), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(ids, pa.binary()), none, none], names)
        used = np.flatnonzero(total)
        if len(used):
            one = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (used, total[used])]
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), *one], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, ids binary, used array<long>, n array<long>"
    )
    return materialise(rows, "ids", compression="zstd")


def _kind(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def count_ids(tokens: DataFrame, size: int) -> np.ndarray:
    """Occurrences of each id in all documents, from the tasks' counts.  The result has
    ``size`` numbers, whatever the input."""
    parts = tokens.where("ids is null").select(F.explode(F.arrays_zip("used", "n")).alias("c"))
    counts = np.zeros(size, np.int64)
    for r in parts.groupBy(F.col("c.used").alias("id")).agg(F.sum("c.n").alias("n")).collect():  # at most ``size`` rows
        counts[r["id"]] = r["n"]
    return counts


def write_files(tokens: DataFrame, folder: str, lengths: np.ndarray, size: int, files: int) -> DataFrame:
    """Write one file per range of ``doc_id``; returns the manifest ``part, path,
    n_docs, n_ids``."""
    shared = tokens.sparkSession.sparkContext.broadcast(lengths)  # a byte per id
    kind = _kind(size)

    def write(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        batch = next(batches, None)
        if batch is None:
            return
        path, n_docs, n_ids = f"{folder}/ids-{part:06d}.huf", 0, 0
        with whole_file(path) as out:
            writer = BlockWriter(out, shared.value)
            while batch is not None:
                for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                    ids = np.frombuffer(raw, kind)
                    writer.add(doc, ids)
                    n_docs, n_ids = n_docs + 1, n_ids + len(ids)
                batch = next(batches, None)
            writer.flush()
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([path]), pa.array([n_docs], pa.int64()), pa.array([n_ids], pa.int64())],
            ["part", "path", "n_docs", "n_ids"],
        )

    order = ["doc_id", F.crc32("ids")]
    ordered = tokens.where("ids is not null").select("doc_id", "ids").repartitionByRange(files, *order).sortWithinPartitions(*order)
    written = ordered.mapInArrow(write, "part int, path string, n_docs long, n_ids long")
    return materialise(written, "id-files")


def read_documents(spark, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` read back from the files of a
    manifest (a row per file reaches the driver, for the starts)."""
    rows = sorted(manifest.collect(), key=lambda r: r["part"])
    starts, at = [], 0
    for r in rows:
        starts.append((r["path"], at))
        at += r["n_ids"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not starts:
        return spark.createDataFrame([], schema)
    files = spark.createDataFrame(starts, "path string, first long")

    def run(batches):
        target = arrow_schema(out_schema)
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist()):
                done: list[tuple] = []
                with open_file(path) as stream:
                    n = crc = 0
                    for doc, ids, more in read_blocks(stream):
                        crc, n = zlib.crc32(ids.astype("<u4").tobytes(), crc), n + len(ids)
                        if not more:
                            done.append((doc, first, n, crc))
                            first, n, crc = first + n, 0, 0
                        if len(done) >= 10_000:
                            yield pa.RecordBatch.from_pydict(dict(zip(target.names, zip(*done))), schema=target)
                            done = []
                if done:
                    yield pa.RecordBatch.from_pydict(dict(zip(target.names, zip(*done))), schema=target)

    out_schema = T.StructType.fromDDL(schema)
    return files.repartitionByRange(len(starts), "path").mapInArrow(run, out_schema)


def store_ids(docs: DataFrame, make_encode: Callable[[], Encode], size: int, end_id: int = 0, files: int | None = None) -> DataFrame:
    """Tokenise, count, code, write, and return the manifest.  ``size`` is one more
    than the largest id."""
    spark = docs.sparkSession
    tokens = tokenise(docs, make_encode, size, end_id)
    counts = count_ids(tokens, size)
    lengths = code_lengths(counts)
    if not files:  # a file is written by one task: its size is bounded
        files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(counts.sum()) // FILE_IDS))
    return write_files(tokens, scratch_path(spark, "token-ids"), lengths, size, files)
