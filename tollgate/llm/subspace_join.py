"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine at least ``c`` are at squared distance at most
``2 - 2c``.  After a fixed random rotation the coordinates are split into blocks,
and the squared distance into the blocks' shares: some block has no more than its
budget, in proportion to its dimensions.  So two vectors are candidates in a block
when their distance in that subspace is within the budget, and the union over the
blocks holds every link.

Each block is a range join: vectors are laid in strips along the block's first
coordinate, as wide as the block's radius, and only vectors of one label in the same
or the next strip meet.  A strip is cut by a hash into chunks of about ``CHUNK``
vectors, and chunk meets chunk in a task, so no task holds a whole strip.
Candidates are verified with the original vectors in double precision; a pair is
counted in the first block that has it.  A task returns link counts and a spanning
forest of its links, not pairs.

Equal vectors of one label are one class: its members link with each other, and the
class meets others once.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components, and vectors with a null label, link with nothing; vectors of other
lengths than a vector don't link with it; a null ``vec_id`` stays null and links with
nothing; repeated rows of a ``vec_id`` count as one vector each.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.llm.common import map_batches, materialise
from tollgate.llm.graph import connected_components

CHUNK = 1500


def rotation(dims: int, seed: int = 5) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed + dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def block_edges(dims: int, blocks: int) -> list[tuple[int, int]]:
    """Contiguous blocks of nearly equal size."""
    blocks = max(1, min(blocks, dims))
    cuts = [round(i * dims / blocks) for i in range(blocks + 1)]
    return list(zip(cuts, cuts[1:]))


def budgets(dims: int, blocks: int, cosine: float) -> np.ndarray:
    """Squared-distance budget of each block, with slack for rounding."""
    total = max(0.0, 2 - 2 * cosine) + 1e-9
    return np.array([total * (b - a) / dims for a, b in block_edges(dims, blocks)]) + 1e-12


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, safely for tiny and huge components."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def usable(v) -> bool:
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v) and any(c != 0 for c in v)


def links_within(a: np.ndarray, b: np.ndarray, block: int, blocks: int, cosine: float):
    """Index pairs (i in a, j in b) first found in ``block`` and verified."""
    dims = a.shape[1]
    edges, budget, turn = block_edges(dims, blocks), budgets(dims, blocks, cosine), rotation(dims)
    ua, ub = unit(a), unit(b)
    ra, rb = ua @ turn, ub @ turn
    lo, hi = edges[block]
    x, y = ra[:, lo:hi], rb[:, lo:hi]
    near = (x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T) <= budget[block] + 1e-12
    i, j = np.nonzero(near)
    keep = np.ones(len(i), bool)
    for k, (lo, hi) in enumerate(edges[: block + 1]):
        for at in range(0, len(i), 200_000):
            some = slice(at, at + 200_000)
            d = ra[i[some], lo:hi] - rb[j[some], lo:hi]
            within = (d * d).sum(1) <= budget[k]
            keep[some] &= within if k == block else ~within
    i, j = i[keep], j[keep]
    good = np.zeros(len(i), bool)
    for at in range(0, len(i), 100_000):
        some = slice(at, at + 100_000)
        good[some] = (ua[i[some]] * ub[j[some]]).sum(1) >= cosine
    return i[good], j[good]


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that keep the connectivity of all given ones."""
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = find(x), find(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            out.append((x, y))
    return out


def _strips(cols, blocks, cosine):
    """One row per class and block: its strip along the block's first coordinate."""
    out = {k: [] for k in ("rep", "n", "label", "embedding", "block", "strip", "dims")}
    by_dims: dict = {}
    for k, v in enumerate(cols["embedding"]):
        by_dims.setdefault(len(v), []).append(k)
    for dims, rows in by_dims.items():
        turned = unit(np.array([cols["embedding"][k] for k in rows], np.float64)) @ rotation(dims)
        radius = np.sqrt(budgets(dims, blocks, cosine))
        for block, (lo, _) in enumerate(block_edges(dims, blocks)):
            # A little wider than the radius, so that rounding loses nothing.
            strip = np.floor(turned[:, lo] / (radius[block] * (1 + 1e-6) + 1e-9)).astype(int)
            out["rep"] += [cols["rep"][k] for k in rows]
            out["n"] += [cols["n"][k] for k in rows]
            out["label"] += [cols["label"][k] for k in rows]
            out["embedding"] += [cols["embedding"][k] for k in rows]
            out["block"] += [block] * len(rows)
            out["strip"] += strip.tolist()
            out["dims"] += [dims] * len(rows)
    return out


def _join_chunks(frame: pd.DataFrame, blocks: int, cosine: float) -> pd.DataFrame:
    """Counts and a forest of the links of one pair of chunks."""
    first = frame[frame["side"] == 0].sort_values("rep", kind="stable")
    second = frame[frame["side"] == 1].sort_values("rep", kind="stable")
    empty = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64), "links": np.zeros(0, np.int64)})
    own = bool(frame["own"].iloc[0])
    if own:
        second = first
    if not len(first) or not len(second):
        return empty
    block = int(frame["block"].iloc[0])
    x, y = np.stack(first["embedding"].to_numpy()).astype(np.float64), np.stack(second["embedding"].to_numpy()).astype(np.float64)
    ids, others = first["rep"].to_numpy(), second["rep"].to_numpy()
    n, m = first["n"].to_numpy(), second["n"].to_numpy()
    i, j = links_within(x, y, block, blocks, cosine)
    if own:
        once = i < j
        i, j = i[once], j[once]
    if not len(i):
        return empty
    total: dict = {}
    for where, weights, at in ((ids, np.bincount(i, m[j], len(ids)), 0), (others, np.bincount(j, n[i], len(others)), 1)):
        for rep, w in zip(where.tolist(), weights.tolist()):
            if w:
                total[rep] = total.get(rep, 0) + int(w)
    tree = forest(ids[i], others[j])
    rows = [(a, b, 0) for a, b in tree] + [(a, a, w) for a, w in total.items()]
    return pd.DataFrame(rows, columns=["a", "b", "links"])


def near_vectors(vectors: DataFrame, cosine: float = 0.93, blocks: int = 4) -> DataFrame:
    """``vectors(vec_id, embedding, label)`` to ``vec_id, n_links, component_id,
    kept``, one row per vector."""
    vectors = vectors.select("vec_id", "embedding", "label")
    name = dict(vectors.dtypes)["embedding"]
    good = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.coalesce(F.size("embedding") > 0, F.lit(False))
        & F.coalesce(
            F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf))), F.lit(False)
        )
        & F.coalesce(F.exists("embedding", lambda c: c != 0), F.lit(False))
    )
    # Adding 0.0 makes negative zeros equal to zeros.
    key = F.transform("embedding", lambda c: c + F.lit(0.0).cast(T.FloatType() if "float" in name else T.DoubleType()))
    classes = (
        vectors.where(good)
        .groupBy("label", key.alias("embedding"))
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    )
    classes = materialise(classes, "vector-classes")
    wide = map_batches(
        classes, _strips, f"rep long, n long, label {dict(classes.dtypes)['label']}, embedding {name}, block int, strip int, dims int",
        blocks, cosine,
    )
    cell = ["label", "dims", "block", "strip"]
    wide = materialise(wide, "strips")
    sizes = wide.groupBy(*cell).agg(F.greatest(F.lit(1), F.ceil(F.count("*") / F.lit(CHUNK))).cast("int").alias("chunks"))
    sizes = materialise(sizes, "strip-sizes")
    previous = sizes.withColumn("strip", F.col("strip") + 1).withColumnRenamed("chunks", "chunks_before")
    following = sizes.withColumn("strip", F.col("strip") - 1).withColumnRenamed("chunks", "chunks_after")
    placed = (
        wide.join(sizes, cell).join(previous, cell, "left").join(following, cell, "left")
        .withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    )

    def task(other_strip, mine, other, side, own=F.lit(False)):
        """The unit in which this row meets chunk ``other`` of a strip."""
        return F.struct(
            other_strip.alias("strip"), mine.alias("i"), other.alias("j"), F.lit(side).alias("side"), own.alias("own")
        )

    strip, chunk = F.col("strip"), F.col("chunk")
    none = F.lit(None).cast("array<struct<strip:int,i:int,j:int,side:int,own:boolean>>")
    empty = F.coalesce(none, F.array().cast("array<struct<strip:int,i:int,j:int,side:int,own:boolean>>"))

    def others(count):
        return F.when(count > 0, F.sequence(F.lit(0), count - 1))

    within = F.transform(
        others(F.col("chunks")),
        lambda k: F.when(k < chunk, task(strip * 2, k, chunk, 1))
        .when(k > chunk, task(strip * 2, chunk, k, 0))
        .otherwise(task(strip * 2, chunk, chunk, 0, F.lit(True))),
    )
    ahead = F.coalesce(F.transform(others(F.col("chunks_after")), lambda k: task(strip * 2 + 1, chunk, k, 0)), empty)
    behind = F.coalesce(F.transform(others(F.col("chunks_before")), lambda k: task(strip * 2 - 1, k, chunk, 1)), empty)
    units = placed.select("rep", "n", "embedding", "label", "dims", "block", F.explode(F.concat(within, ahead, behind)).alias("u")).select(
        "rep", "n", "embedding", "label", "dims", "block", "u.*"
    )

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        return _join_chunks(frame, blocks, cosine)

    found = materialise(
        units.groupBy("label", "dims", "block", "strip", "i", "j").applyInPandas(join, "a long, b long, links long"), "vector-links"
    )
    counts = found.where("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    component = connected_components(found.where("a <> b").select("a", "b"), "vectors").withColumnRenamed("id", "rep")
    by_class = (
        classes.join(counts, "rep", "left").join(component, "rep", "left")
        .select(
            "label", "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    linked = (
        vectors.where(good).withColumn("embedding", key).join(by_class, ["label", "embedding"])
        .select("vec_id", "n_links", "component_id")
    )
    alone = vectors.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
