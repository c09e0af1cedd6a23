"""Embedding whitening by weighted multiplicity covariance.

1. Each entry ``c`` becomes the whole number ``floor(scale * c) + shift``.  Equal
   x-vectors are one *group* with a count (map-side combine first, so that copies
   that make up a third of the rows are one row per task).
2. One pass over the groups gives ``n`` and the exact sums ``S`` per dimension, one
   more the covariance: a weighted GEMM ``C' (w * C)`` of the centred rows of each
   task.  A task gives one number per entry, which Spark sums: the driver holds
   ``D * D`` numbers, whatever the rows.
3. Its eigenvectors whiten each distinct vector once; the rows join their group
   back by the digest of x.  Groups that hold more than a thousandth of all rows
   (fewer than 1,000 of them, so their broadcast is bounded) are joined apart:
   no task of the shuffled join gets more than a thousandth of the rows for one key.

Defined results: rows whose vector is null, empty, holds null or non-finite entries,
or entries whose x is beyond 2^53, are left out; so are vectors of another length
than that of most rows (the shortest of ties).  A null ``vec_id`` and repeated rows are rows like
others.  Components without variance (eigenvalue within rounding of zero) can't be
whitened and have no rows: with one vector, or equal vectors only, the result is
empty, as it is for an empty table.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import materialise, ship_package

#: Share of all rows from which a group is joined by broadcast: fewer than 1,000 groups.
HOT_SHARE = 1_000
_EXACT = 2**53


@dataclass
class Whitening:
    """A fitted transform: count, sums per dimension, components and their variance."""

    n: int
    sums: list[int]
    components: np.ndarray  # (dimensions, components), unit columns
    values: np.ndarray  # eigenvalues, falling
    trace: float

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``n * x - S`` exactly (64-bit where it fits, else Python integers), and
        ``x - S / n`` in double precision from it."""
        return centred(x, self.n, self.sums)


def centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    largest = max(int(np.abs(x).max()) * n if x.size else 0, max(map(abs, sums), default=0))
    if largest < 2**62:
        exact = x * n - np.array(sums, np.int64)
    else:
        exact = x.astype(object) * n - np.array(sums, object)
    return exact, exact.astype(np.float64) / n


def squares(exact: np.ndarray) -> list[int]:
    """Sum of squares of each row, exactly."""
    if exact.dtype != object and (not exact.size or float(np.abs(exact).max()) ** 2 * exact.shape[1] < 2**62):
        return (exact * exact).sum(1).tolist()
    return [sum(int(v) * int(v) for v in row) for row in exact]


def quantised(vectors: DataFrame, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """``vec_id, x`` of the vectors that can be used."""
    limit = float(_EXACT // scale // 2)

    def whole(c: Column) -> Column:
        return F.floor(c.cast("double") * F.lit(float(scale))) + F.lit(shift)

    usable = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(limit)))
    return (
        vectors.select("vec_id", "embedding")
        .where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & usable)
        .select("vec_id", F.transform("embedding", whole).alias("x"))
    )


def digest(x: str = "x") -> Column:
    """The key by which rows find their group: SHA-256 of the numbers."""
    return F.unhex(F.sha2(F.array_join(F.col(x).cast("array<string>"), ","), 256))


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    values = batch.column(name).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, -1)


def summed(rows: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray], kind: str) -> list:
    """The sum over all batches of the flat arrays that ``part`` gives, one number per
    entry: a task sends one array, Spark adds the tasks' entries.  ``kind`` is
    ``double`` or ``decimal(38,0)`` (exact)."""
    entries = pa.float64() if kind == "double" else pa.decimal128(38, 0)

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                one = part(batch)
                total = one if total is None else total + one
        if total is not None:
            values = total.tolist() if kind == "double" else [Decimal(int(v)) for v in total]
            yield pa.RecordBatch.from_arrays([pa.array([values], pa.list_(entries))], names=["v"])

    parts = rows.mapInArrow(run, f"v array<{kind}>")
    total = parts.select(F.posexplode("v").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"))
    return [r.v for r in sorted(total.collect(), key=lambda r: r.at)]  # one row per entry of the array


def distinct_vectors(rows: DataFrame, weights: str = "count") -> DataFrame:
    """``key, x, copies, weight`` of each distinct x-vector; ``weight`` is what it
    counts in the fit: its rows (``count``) or 1 (``one``)."""
    if weights not in ("count", "one"):
        raise ValueError(f"unknown weights {weights!r}")
    groups = rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))
    weight = F.col("copies") if weights == "count" else F.lit(1).cast("long")
    found = materialise(groups.select(digest().alias("key"), "x", "copies", weight.alias("weight")), "whitening-groups")
    length = found.groupBy(F.size("x").alias("d")).agg(F.sum("copies").alias("n")).orderBy(F.desc("n"), "d").first()
    return found.where(F.size("x") == (length.d if length else 0))


def fit_whitening(groups: DataFrame, components: int = 32) -> Whitening | None:
    """The transform of the weighted groups; None without rows."""

    def count_and_sums(batch):
        x, w = _matrix(batch, "x"), batch.column("weight").to_numpy()
        # A batch's rows times the largest entry may pass 64 bits: whole numbers of any size.
        small = float(np.abs(x).max()) * float(w.sum()) < 2**62
        sums = (x * w[:, None]).sum(0) if small else (x.astype(object) * w[:, None].astype(object)).sum(0)
        return np.concatenate([[int(w.sum())], sums]).astype(object)

    total = [int(v) for v in summed(groups.select("x", "weight"), count_and_sums, "decimal(38,0)")]
    if not total:
        return None
    n, sums = total[0], total[1:]
    size = len(sums)

    def products(batch):
        rows = centred(_matrix(batch, "x"), n, sums)[1]
        return (rows.T @ (rows * batch.column("weight").to_numpy()[:, None])).ravel()

    cov = np.array(summed(groups.select("x", "weight"), products, "double")).reshape(size, size) / n
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    order = np.argsort(-values, kind="stable")[: min(components, size)]
    values, vectors = values[order], vectors[:, order]
    usable = values > max(values.max(initial=0.0), 0.0) * size * np.finfo(float).eps
    values, vectors = values[usable], vectors[:, usable]
    # Either sign is right; the largest entry is made positive, so that reruns agree.
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return Whitening(n, sums, vectors, values, float(np.trace(cov)))


def whiten_groups(groups: DataFrame, model: Whitening) -> DataFrame:
    """``key, copies, weight, deviation, z`` of each distinct vector."""
    shared = groups.sparkSession.sparkContext.broadcast(model)  # D * components numbers

    def run(batches):
        model = shared.value
        scale = model.components / np.sqrt(model.values)
        for batch in batches:
            if not batch.num_rows:
                continue
            exact, centre = model.centred(_matrix(batch, "x"))
            z = centre @ scale
            offsets = np.arange(0, z.size + 1, max(z.shape[1], 1), dtype=np.int32)
            if not z.shape[1]:
                offsets = np.zeros(batch.num_rows + 1, np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), batch.column("copies"), batch.column("weight"),
                    pa.array([Decimal(v) for v in squares(exact)], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(z.ravel())),
                ],
                names=["key", "copies", "weight", "deviation", "z"],
            )

    schema = "key binary, copies long, weight long, deviation decimal(38,0), z array<double>"
    return materialise(groups.select("key", "copies", "weight", "x").mapInArrow(run, schema), "whitened")


def identity_error(whitened: DataFrame, n: int) -> float:
    """The largest absolute entry of the whitened vectors' covariance less the
    identity, measured over the fit list."""

    def sums(batch):
        return (_matrix(batch, "z") * batch.column("weight").to_numpy()[:, None]).sum(0)

    mean = np.array(summed(whitened.select("z", "weight"), sums, "double")) / n

    def products(batch):
        rows = _matrix(batch, "z") - mean
        return (rows.T @ (rows * batch.column("weight").to_numpy()[:, None])).ravel()

    cov = np.array(summed(whitened.select("z", "weight"), products, "double")).reshape(len(mean), len(mean)) / n
    return float(np.abs(cov - np.eye(len(mean))).max(initial=0.0))


def whiten(
    vectors: DataFrame, components: int = 32, weights: str = "count", scale: int = 64, shift: int = 1_000_000
) -> DataFrame:
    """``vectors(vec_id, embedding)`` to one row per usable vector and component:
    ``vec_id, component, n, deviation`` (exact, ``decimal(38,0)``)``, whitened,
    explained, identity_error``."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = quantised(vectors, scale, shift)
    groups = distinct_vectors(rows, weights)
    model = fit_whitening(groups, components)
    schema = (
        "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    )
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    whitened = whiten_groups(groups, model)
    error = identity_error(whitened, model.n)
    # Every row's share is counted in rows, whatever the weights of the fit.
    total = model.n if weights == "count" else whitened.agg(F.sum("copies")).first()[0]
    hot = F.col("copies") * HOT_SHARE > total
    keyed = rows.select("vec_id", digest().alias("key"))
    fields = ["key", "deviation", "z"]
    by_hot = keyed.join(F.broadcast(whitened.where(hot).select(*fields)), "key", "left")  # under HOT_SHARE rows
    rest = by_hot.where(F.col("z").isNull()).select("vec_id", "key").join(
        whitened.where(~hot).select(*fields).hint("merge"), "key"
    )
    joined = by_hot.where(F.col("z").isNotNull()).select("vec_id", *fields).unionByName(rest.select("vec_id", *fields))
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    return joined.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
