"""Helpers shared by the operators: table reading, scratch tables, bounded
samples, and Arrow-batch mapping with a cache that lives in the worker."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.session import scratch_path

_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of an Arrow batch between Spark and a Python worker.
ARROW_BYTES = 4 << 20

#: ASCII white space; words are runs of anything else.
SPACES = " \t\n\v\f\r"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers: once per context, as a zip
    in the shared folder that Spark hands to every executor.  Operators run their
    functions by reference, so that a worker's caches outlive a task.

    Also bounds the Arrow batches of a session in bytes, unless it has a bound of its own:
    by rows alone, a batch of long texts is as large as its texts are."""
    if spark.conf.get(_ARROW_BYTES, None) in (None, "67108864b"):  # its default
        spark.conf.set(_ARROW_BYTES, str(ARROW_BYTES))
    context = spark.sparkContext
    if getattr(context, "_tollgate_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    zipped = io.BytesIO()
    with zipfile.ZipFile(zipped, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    target = f"{scratch_path(spark, 'code')}/{os.path.basename(root)}.zip"
    path = context._jvm.org.apache.hadoop.fs.Path(target)
    stream = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    stream.write(bytearray(zipped.getvalue()))
    stream.close()
    context.addPyFile(path.toUri().toString() if "://" in target else target)
    context._tollgate_shipped = True


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str, batch_rows: int | None = None, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to a fresh folder under the shared directory and read it
    back: cuts the lineage with files every executor can reach.
    ``batch_rows`` bounds the rows of an Arrow batch while it is written (for
    rows that carry large binaries)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with arrow_batches(spark, batch_rows):
        df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int | None):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if rows is None:
        yield
        return
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Bytes of a column (texts) that an operator turns into Python objects at a time.
BATCH_BYTES = 8 << 20


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in order, cut so that a slice holds at most ``limit`` bytes of a
    string or binary column, or a single row."""
    rows, values = batch.num_rows, batch.column(column)
    if values.get_total_buffer_size() <= limit:  # the usual case
        if rows:
            yield batch
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < rows:
        done = int(ends[start - 1]) if start else 0
        stop = max(int(np.searchsorted(ends, done + limit, "right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def map_batches(
    df: DataFrame,
    fn: Callable[..., dict | list],
    schema: str | T.StructType,
    *args,
) -> DataFrame:
    """Apply ``fn(columns, *args)`` to every Arrow batch of ``df``.

    ``columns`` maps names to Python lists; ``fn`` returns a dict of column
    name to list or array, in the order of ``schema``.  Narrow: no shuffle, one
    batch in memory at a time, of ``BATCH_BYTES`` of text at most (or one row)."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    owner = fn.__module__
    long = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    heaviest = "text" if "text" in long else long[0] if long else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_turn(owner)
        target = arrow_schema(schema)
        for batch in batches:
            for some in byte_slices(batch, heaviest) if heaviest else (batch,):
                if some.num_rows:
                    out = fn({n: some.column(i).to_pylist() for i, n in enumerate(some.schema.names)}, *args)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], type=f.type) for f in target], schema=target
                    )

    return df.mapInArrow(run, schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def hashed_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """The ``rows`` rows with the smallest hash of ``key``: a bounded sample
    that does not depend on partitioning (per-partition top-k, then a merge of
    the winners)."""
    return df.withColumn("_order", F.xxhash64(key)).orderBy("_order", key).limit(rows).drop("_order")


class WordCache(dict):
    """Results by word, kept while a worker lives: made by ``make`` when first asked
    for, in two generations of at most about ``limit`` bytes each.  Nothing is ever
    wrong for being evicted.  Words longer than ``LONGEST`` are made anew each time."""

    LONGEST = 200
    #: Bytes of an entry besides twice its word's length: two objects, and a slot.
    ENTRY = 190

    def __init__(self, make: Callable, limit: int, old: "WordCache | None" = None):
        self.make, self.limit, self.old, self.held = make, limit, old, 0

    def __missing__(self, word):
        got = self.old.get(word) if self.old is not None else None
        if got is None:
            got = self.make(word)
        size = len(word)
        if size <= self.LONGEST:
            self[word] = got
            self.held += self.ENTRY + 2 * size
        return got

    def keep(self, word, got) -> None:
        self[word] = got
        self.held += self.ENTRY + 2 * len(word)

    def missing(self, words) -> list:
        """Those of the words that neither generation has; the old one's are taken over."""
        old, out = self.old, []
        for w in words:
            if w not in self:
                hit = old.get(w) if old is not None else None
                if hit is None:
                    out.append(w)
                else:
                    self.keep(w, hit)
        return out

    def room(self) -> "WordCache":
        """The cache to go on with: between texts, a full generation becomes the old one."""
        if self.held <= self.limit:
            return self
        self.old = None
        return WordCache(self.make, self.limit, self)


_STATE: dict = {}


def worker_turn(owner: str) -> None:
    """Called by every operator's function in a worker: what another operator kept
    there (tokenizers, databases, caches) is dropped, and its memory given back."""
    if _STATE.get("owner") != owner:
        _STATE.clear()
        _STATE["owner"] = owner
        trim_memory()


def worker_state(key, make: Callable):
    """What the operator whose turn it is keeps in this worker under ``key``, made when
    first asked for."""
    if key not in _STATE:
        _STATE[key] = make()
    return _STATE[key]


def trim_memory() -> None:
    """Give unused memory back to the system, where the C library can."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass
