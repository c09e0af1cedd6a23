"""Best-fit packing of documents into sequences under several capacities.

A piece has a demand vector: tokens, one document, and the cost of attention
within it (its length squared).  A sequence has a capacity for each.  Pieces come
in falling order; each goes to the open sequence, feasible in every dimension,
that a rule prefers: ``norm`` leaves the smallest weighted norm of the
residual vector (best fit), ``dot`` takes the sequence whose residual vector has
the largest weighted cosine with the demand.

Documents are cut only when longer than a sequence.  Pieces are dealt by a hash
to shards of about ``SHARD`` rows, packed side by side; full pieces need no
packing.  A shard's few sequences that stay under ``REPACK`` of the
capacity are packed again together with those of other shards, in shards again, so
a shard's rest is not lost.

Defined cases: null and empty texts are one piece, the end id; a null
``doc_id`` stays null; repeated rows are each packed; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import map_batches, materialise

SHARD = 5_000
REPACK = 0.98


@dataclass(frozen=True)
class Capacity:
    """Most tokens, documents and attention cost of a sequence, and the weights
    of the three (in units of their capacities)."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.02, 0.02)
    rule: str = "norm"


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece, sequences numbered from 0.  Raises for
    a piece that fits no empty sequence."""
    caps = np.array([capacity.tokens, capacity.documents, capacity.attention], float)
    weights = np.array(capacity.weights)
    lengths = np.asarray(lengths, np.int64)
    n = len(lengths)
    sequence, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if n == 0:
        return sequence, offset
    demand = np.stack([lengths, np.ones(n, np.int64), lengths * lengths], 1) / caps
    if (demand > 1).any():
        raise ValueError("a piece exceeds a sequence's capacity")
    least = demand.min(0)
    # Open sequences: residual vectors, tokens used, number.
    residual, used, number = np.zeros((n, 3)), np.zeros(n, np.int64), np.zeros(n, np.int64)
    opened = made = 0
    for k, i in enumerate(np.lexsort((np.arange(n), -(demand @ weights)))):
        want = demand[i]
        free = residual[:opened]
        fits = np.flatnonzero((free[:, 0] >= want[0] - 1e-12) & (free[:, 1] >= want[1] - 1e-12) & (free[:, 2] >= want[2] - 1e-12))
        if len(fits):
            if capacity.rule == "dot":
                r = free[fits]
                at = fits[np.argmax((r * want) @ weights / np.sqrt((r * r) @ weights))]
            else:
                left = free[fits] - want
                at = fits[np.argmin((left * left) @ weights)]
        else:
            at = opened
            residual[at], used[at], number[at] = 1.0, 0, made
            opened, made = opened + 1, made + 1
        sequence[i], offset[i] = number[at], used[at]
        residual[at] -= want
        used[at] += lengths[i]
        if residual[at, 0] < least[0] - 1e-12 or (k & 1023) == 1023:
            # Sequences too full for any piece are closed.
            full = (residual[:opened] < least - 1e-12).any(1)
            keep = np.flatnonzero(~full)
            m = len(keep)
            residual[:m], used[:m], number[:m] = residual[keep], used[keep], number[keep]
            opened = m
    return sequence, offset


def cut(ids: bytes, tokens: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's little-endian ids."""
    out = []
    view, n = memoryview(ids), len(ids) // 4
    for piece, start in enumerate(range(0, n, tokens)):
        end = min(n, start + tokens)
        out.append((piece, start, end - start, zlib.crc32(view[4 * start : 4 * end])))
    return out


def pieces_of(docs: DataFrame, make_encode: Callable, tokens: int, end_id: int) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every whole text; narrow."""
    end = np.array([end_id], "<u4").tobytes()

    def run(cols):
        out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
        encode = make_encode()
        for doc, ids in zip(cols["doc_id"], encode(cols["text"])):
            for row in cut(ids + end, tokens):
                for k, v in zip(out, (doc, *row)):
                    out[k].append(v)
        return out

    return map_batches(
        docs.select("doc_id", "text"), run, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


_PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _pack_shards(pieces: DataFrame, rows: int, capacity: Capacity, turn: int) -> DataFrame:
    """Pack shards of about SHARD rows; sequence ids are distinct over turns."""
    shards = max(1, math.ceil(rows / SHARD))

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "piece", "start", "ids_crc32"], kind="stable")
        sequence, offset = best_fit(frame["length"].to_numpy(), capacity)
        base = (turn << 60) + (int(key[0]) << 28)
        return frame.drop(columns="shard").assign(sequence_id=base + sequence, offset=offset)

    dealt = pieces.withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(turn), "doc_id", "piece", "ids_crc32"), F.lit(shards))
    )
    return dealt.groupBy("shard").applyInPandas(run, _PACKED)


def pack_documents(docs: DataFrame, make_encode: Callable, end_id: int = 0, capacity: Capacity = Capacity()) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``."""
    longest = min(capacity.tokens, math.isqrt(capacity.attention))
    pieces = materialise(pieces_of(docs, make_encode, longest, end_id), "pieces")
    columns = pieces.columns
    full = pieces.where(F.col("length") == capacity.tokens)
    # A full piece is a sequence by itself.
    alone = full.withColumn("sequence_id", (F.lit(3) * F.lit(1 << 60)) + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    rest = pieces.where(F.col("length") < capacity.tokens)
    rows = rest.count()
    first = materialise(_pack_shards(rest, rows, capacity, 1), "packed")
    if rows <= SHARD:
        return alone.unionByName(first)
    fill = first.groupBy("sequence_id").agg(F.sum("length").alias("tokens"))
    low = fill.where(F.col("tokens") < int(REPACK * capacity.tokens)).select("sequence_id")
    low = materialise(low, "underfull")
    again = materialise(first.join(low, "sequence_id", "left_semi").select(*columns), "repack")
    second = _pack_shards(again, again.count(), capacity, 2)
    return alone.unionByName(first.join(low, "sequence_id", "left_anti").select(*first.columns)).unionByName(second)
