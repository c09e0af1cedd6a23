"""One huge JSON array, read by many tasks.

The ``multiLine`` reader gives a file to one task.  Here Spark's text source splits the
file as it splits any text, with ``}`` as the line end, so a task gets the pieces that
begin in its byte range.  Where records begin and end depends on what came before:
whether a piece begins inside a string, and how many braces are open.  That is a prefix
scan:

1. per byte range: the parity of its quotes, and its change of brace depth if it
   begins outside a string, and if inside (a few numbers a range);
2. running sums over the ranges of a file give the state at each range's start;
3. each task follows its pieces from that state and gives whole records, and the
   fragments of a record that crosses the range's edges; fragments of one record,
   over however many ranges, are joined (only they are shuffled).

The records' text is parsed with the declared schema, as the other readers do.  Quotes,
braces and brackets inside strings, escaped quotes and any white space are followed; line
ends too.  An element that is not an object is left out.  A file that is no JSON gives
rows of nulls, or none.  Records come in no order.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tollgate.operators.mediation import decode
from tollgate.schemas import RAW_CDR
from tollgate.session import scratch_path

_ESCAPED = re.compile(r"\\.", re.S)
#: Characters of records that a task hands on at a time.
_OUT_CHARS = 4 << 20
_EDGES = {"head": 0, "middle": 1, "tail": 2}


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text between closing braces, in order within a byte range."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def _at_quotes(piece: str) -> list[str]:
    """The piece split at its quotes that are not escaped: every second part is
    inside a string.  Escapes are blanked out, so lengths hold."""
    return (_ESCAPED.sub("__", piece) if "\\" in piece else piece).split('"')


def _python_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _summary(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: parity of quotes, and change of depth from either state."""
    for (file, start), rows in itertools.groupby(_python_rows(batches), key=lambda r: r[:2]):
        inside, depth = 0, [0, 0]
        for *_, piece in rows:
            parts = _at_quotes(piece)
            for state in (0, 1):
                outside = parts[(inside + state) % 2 :: 2]
                depth[state] += sum(p.count("{") for p in outside)
            inside = (inside + len(parts) - 1) % 2
            depth[inside] -= 1  # the brace behind it is outside strings in one of the states
        yield pa.RecordBatch.from_pydict(
            {"file": [file], "start": [start], "parity": [inside], "outside": [depth[0]], "within": [depth[1]]}
        )


def range_states(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, in_string, depth`` at the start of each byte range: one row per
    range, as many as the scan has splits."""
    found = _pieces(spark, path).mapInArrow(
        _summary, "file string, start long, parity long, outside long, within long"
    )
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    parity = F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2
    known = found.withColumn("in_string", parity == 1)
    change = F.when(F.col("in_string"), F.col("within")).otherwise(F.col("outside"))
    known = known.withColumn("change", change)
    return known.select("file", "start", "in_string", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"))


def follow(pieces: Iterable[str], in_string: bool, depth: int) -> Iterator[tuple[str, str]]:
    """(kind, text) from the state at the first piece: whole records; ``head``, the end
    of a record that began before; ``tail``, the beginning of one that goes on;
    ``middle``, a part of one that does both."""
    held: list[str] = []
    began = depth == 0  # the record that is held began here
    for piece in pieces:
        opened, found, at = 0, depth > 0, 0
        for k, part in enumerate(_at_quotes(piece)):
            if (k % 2 == 0) != in_string:  # outside strings
                if not found and "{" in part:
                    opened, found = at + part.index("{"), True
                depth += part.count("{")
            at += len(part) + 1
        in_string ^= k % 2 == 1
        if not depth:
            continue  # between records
        held.append(piece[opened:] + "}")
        if not in_string:
            depth -= 1
            if not depth:
                yield ("record" if began else "head"), "".join(held)
                held, began = [], True
    if depth:
        yield ("tail" if began else "middle"), "".join(held)


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def packed(rows):
        return pa.RecordBatch.from_pydict(dict(zip(("file", "start", "kind", "value"), map(list, zip(*rows)))))

    ready, size = [], 0
    for (file, start, in_string, depth), rows in itertools.groupby(_python_rows(batches), key=lambda r: r[:4]):
        for kind, text in follow((r[4] for r in rows), in_string, depth):
            ready.append((file, start, kind, text))
            size += len(text)
            if size > _OUT_CHARS:
                yield packed(ready)
                ready, size = [], 0
    if ready:
        yield packed(ready)


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the text of each object in the arrays of ``path``.

    Runs the two passes (the states, and the records into a table under the shared
    folder), so that a record's fragments are found without reading the file again.  The
    states are broadcast: one small row per split of the scan, of which Spark's driver
    keeps one object each anyway."""
    states = F.broadcast(range_states(spark, path))
    placed = _pieces(spark, path).join(states, ["file", "start"]).select("file", "start", "in_string", "depth", "value")
    made = scratch_path(spark, "array-records")
    found = placed.mapInArrow(_records, "file string, start long, kind string, value string")
    whole = F.col("kind") == "record"
    found.withColumn("whole", whole).write.partitionBy("whole").parquet(made)
    stored = spark.read.schema("file string, start long, kind string, value string, whole boolean").parquet(made)
    place = F.create_map(*[F.lit(v) for item in _EDGES.items() for v in item])[F.col("kind")]
    parts = stored.filter(~F.col("whole")).select("file", "start", place.alias("place"), "value")
    # Each tail begins a record; at most two fragments per range are sorted here.
    order = Window.partitionBy("file").orderBy("start", "place")
    numbered = parts.withColumn("no", F.sum((F.col("place") == _EDGES["tail"]).cast("int")).over(order))
    joined = numbered.groupBy("file", "no").agg(
        F.sort_array(F.collect_list(F.struct("start", "place", "value"))).alias("parts")  # one record's
    )
    crossing = joined.select(F.array_join(F.col("parts.value"), "").alias("value"))
    return stored.filter("whole").select("value").unionByName(crossing)


def read_json_array(spark: SparkSession, path: str, schema: StructType = RAW_CDR) -> DataFrame:
    """Rows of the objects of the JSON arrays in ``path``, with a declared schema."""
    return decode(array_records(spark, path), schema)
