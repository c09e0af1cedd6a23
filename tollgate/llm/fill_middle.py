"""Fill-in-middle transformation over UTF-8 texts.

A text's tokens are runs of ASCII letters, and every other code point by itself.
Two cuts between tokens, drawn from a hash of the document's id, part it into
prefix, middle and suffix, which are written with three marks in one of two
orders; some documents stay plain.

Texts are never decoded.  Tokens are found on the bytes, in blocks, so cuts come
as byte offsets.  A *sparse exception index* records only where multibyte
characters begin and how many bytes they have beyond one; a binary search
(``searchsorted``) in it converts a byte offset to a code-point offset or back,
and an ASCII span costs nothing: its offsets differ by a constant.

Defined results: a null text counts as empty; an empty text and one that contains a
mark stay plain.  A null ``doc_id`` hashes as an empty number.  Repeated rows give
equal rows.  Extra columns are ignored.  Texts of any length are cut whole; besides the
text a task holds a block's masks and the index of its multibyte characters.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import byte_slices, ship_package, worker_turn

MARKS = ("<P>", "<S>", "<M>")
_BLOCK = 1 << 20


class ExceptionIndex:
    """Code-point and byte offsets of one UTF-8 text, from its multibyte characters
    alone: where each begins, and the excess bytes up to and with it."""

    def __init__(self, data: np.ndarray):
        at, extra = [], []
        for start in range(0, len(data), _BLOCK):
            block = data[start : start + _BLOCK]
            lead = np.flatnonzero(block >= 0xC0)
            if len(lead):
                first = block[lead]
                at.append(lead + start)
                extra.append(1 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0))
        self.at = np.concatenate(at) if at else np.zeros(0, np.int64)  # byte offsets
        self.excess = np.cumsum(np.concatenate(extra)) if extra else np.zeros(0, np.int64)

    def code_points(self, byte: int) -> int:
        """Code points before the byte offset of a character."""
        k = int(np.searchsorted(self.at, byte))  # multibyte characters that begin before it
        return byte - (int(self.excess[k - 1]) if k else 0)

    def byte(self, code_point: int) -> int:
        """Byte offset of a code point."""
        if not len(self.at):
            return code_point
        # The k-th multibyte character is code point at[k] less the excess before it.
        points = self.at - np.concatenate([[0], self.excess[:-1]])
        k = int(np.searchsorted(points, code_point))
        return code_point + (int(self.excess[k - 1]) if k else 0)


def _token_starts(data: np.ndarray):
    """(block offset, mask of the bytes at which a token begins), block by block."""
    before = False
    for start in range(0, len(data), _BLOCK):
        block = data[start : start + _BLOCK]
        letter = ((block | 0x20) - np.uint8(97)) < 26
        inside = letter.copy()  # a letter after a letter
        inside[1:] &= letter[:-1]
        inside[0] &= before
        before = bool(letter[-1])
        yield start, ~inside & ((block & 0xC0) != 0x80)


def count_tokens(data: np.ndarray) -> int:
    return sum(int(np.count_nonzero(mask)) for _, mask in _token_starts(data))


def byte_cuts(data: np.ndarray, tokens: list[int]) -> list[int]:
    """Byte offsets at which the given numbers of tokens end (falling short: the end)."""
    out, seen = [len(data)] * len(tokens), 0
    for start, mask in _token_starts(data):
        here = int(np.count_nonzero(mask))
        wanted = [i for i, t in enumerate(tokens) if seen <= t < seen + here]
        if wanted:
            at = np.flatnonzero(mask)
            for i in wanted:
                out[i] = start + int(at[tokens[i] - seen])
        seen += here
    return out


def _draws(doc_id: Column, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, seed: int = 1, percent: int = 90, spm_percent: int = 20, marks: tuple[str, str, str] = MARKS
) -> DataFrame:
    """``docs(doc_id, text)`` to ``doc_id, n, form, prefix_chars, middle_chars,
    output``: ``percent`` of the documents are cut, ``spm_percent`` of those with the suffix
    first.  ``n`` counts tokens, the lengths code points (null if plain)."""
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    h = _draws(F.col("doc_id"), seed)
    marked = reduce(or_, [F.contains(text, F.lit(m)) for m in marks])
    plain = (text == "") | marked | (h[2] % 100 >= percent)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    drawn = docs.select("doc_id", text.alias("text"), h[0].alias("h1"), h[1].alias("h2"), form.alias("form"))
    p, s, m = (mark.encode() for mark in marks)

    def cut(data: bytes, form: str, h1: int, h2: int):
        raw = np.frombuffer(data, np.uint8)
        n = count_tokens(raw)
        if form == "plain":
            return n, None, None, data
        first, second = byte_cuts(raw, sorted((h1 % (n + 1), h2 % (n + 1))))
        index = ExceptionIndex(raw)
        chars = index.code_points(first), index.code_points(second)
        prefix, middle, suffix = data[:first], data[first:second], data[second:]
        parts = (p, prefix, s, suffix, m, middle) if form == "psm" else (s, suffix, p, prefix, m, middle)
        return n, chars[0], chars[1] - chars[0], b"".join(parts)

    def run(batches):
        worker_turn(__name__)
        for batch in batches:
            for some in byte_slices(batch, "text"):
                texts = some.column("text").cast(pa.binary()).to_pylist()
                forms = some.column("form")
                made = list(map(cut, texts, forms.to_pylist(), some.column("h1").to_pylist(), some.column("h2").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("doc_id"), pa.array([r[0] for r in made], pa.int64()), forms,
                        pa.array([r[1] for r in made], pa.int64()), pa.array([r[2] for r in made], pa.int64()),
                        pa.array([r[3] for r in made], pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return drawn.mapInArrow(
        run, f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def rebuild(output: bytes, form: str, marks: tuple[bytes, bytes, bytes]) -> bytes:
    """The text, from its output and form alone.  No text contains a mark, and no
    mark's end begins a mark, so the first match of each is the written one."""
    if form == "plain":
        return output
    p, s, m = marks
    first, second = (p, s) if form == "psm" else (s, p)
    a = output.index(second, len(first))
    b = output.index(m, a + len(second))
    one, two, middle = output[len(first) : a], output[a + len(second) : b], output[b + len(m) :]
    return one + middle + two if form == "psm" else two + middle + one


def restore(formatted: DataFrame, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """Adds ``restored``, the text rebuilt from ``output`` and ``form``."""
    from pyspark.sql import types as T

    raw = tuple(mark.encode() for mark in marks)

    def run(batches):
        worker_turn(__name__)
        for batch in batches:
            for some in byte_slices(batch, "output"):
                texts = some.column("output").cast(pa.binary()).to_pylist()
                made = [rebuild(t, f, raw) for t, f in zip(texts, some.column("form").to_pylist())]
                restored = pa.array(made, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*some.columns, restored], names=[*some.schema.names, "restored"])

    schema = T.StructType([*formatted.schema.fields, T.StructField("restored", T.StringType())])
    return formatted.mapInArrow(run, schema)
