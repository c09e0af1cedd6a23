"""Quality rules with an isolation forest on the rule statistics.

``rule_stats`` counts, over each whole text, the base rules (words, symbols,
repeated lines, repeated three-word windows) and further shares.  A forest of
random axis-parallel splits (``IsolationForest``) is grown on the statistics
of the labelled documents: each tree from a random subset of its own, as the
method has it, drawn from all of them.  Anomalous documents have short
paths.  The threshold is calibrated on the scores of all labelled rows, to part
good from bad ones while it rejects at most ``max_reject`` of the good.  Both use
only rows that pass the base rules, as the forest decides only among those.
Statistics, draws, scores and the threshold's sums are Spark jobs; the driver gets
the trees' rows and sums per range of scores.

Defined cases: null text counts as empty; an empty text has no words and fails
the base rule; a null ``doc_id`` is kept as a null; repeated rows each give a
row; with no labelled rows (or none labelled good) only the base rule rejects.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.llm.common import SPACES, arrow_schema, map_batches, materialise, worker_turn

SYMBOLS = "#*$%&|<>"
#: The driver itself draws the trees' rows from up to so many labelled rows; from more,
#: Spark draws them.
HELD_ROWS = 4096
#: Ranges of scores that the threshold is looked for in, side by side.
SCORE_RANGES = 128
#: Trees, and rows that each is grown from.  With few rows a tree seldom holds several
#: of a cluster of like bad documents, which would hide one another (masking).
TREES, TREE_ROWS = 400, 32

_UPPER = bytes(range(65, 91))
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What the forest splits on: shares only, so that a long or short document is
#: not an anomaly by its size.
FEATURES = [
    "word_length", "symbols_per_word", "repeat_share", "upper_share", "distinct_share", "top_word_share",
    "marks_per_word",
]


def repeated_words(words: list) -> int:
    """Positions covered by a three-word window that occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if len(ids) < 1 << 21:
        keys = (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:]
    else:
        pairs = np.unique(codes[:-1] * len(ids) + codes[1:], return_inverse=True)[1]
        keys = pairs[:-1] * len(ids) + codes[2:]
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


def rule_stats(text: str | None) -> tuple[list[int], list[float]]:
    """The base counts, and the statistics that the forest splits on."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    word_chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    seen: set = set()
    dup = 0
    for line in raw.split(b"\n"):
        if line.strip():
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    repeated = repeated_words(words)
    letters = len(raw) - len(raw.translate(None, _LETTERS))
    upper = len(raw) - len(raw.translate(None, _UPPER))
    counts = Counter(words)
    per = max(n, 1)
    features = [
        word_chars / per, symbols / per, repeated / per, upper / max(letters, 1), len(counts) / per,
        max(counts.values(), default=0) / per,
        (text.count("!") + text.count("?")) / per,
    ]
    return [n, word_chars, symbols, dup, repeated], features


def base_fails(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def _expected_path(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (n - 1) / safe, np.where(n == 2, 1.0, 0.0))


@dataclass
class IsolationForest:
    """Trees as arrays over nodes (children of ``i``: ``2i+1``, ``2i+2``)."""

    feature: np.ndarray  # (trees, nodes), -1 at a leaf
    split: np.ndarray
    path: np.ndarray  # path length that ends at a leaf
    rows: int

    @classmethod
    def fit(cls, x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 7) -> "IsolationForest":
        rng = np.random.default_rng(seed)
        rows = min(rows, len(x))
        return cls.grow((x[rng.choice(len(x), rows, replace=False)] for _ in range(trees)), trees, rows, rng)

    @classmethod
    def grow(cls, drawn, trees: int, rows: int, rng: np.random.Generator) -> "IsolationForest":
        """One tree from each of the ``drawn`` sets of ``rows`` rows."""
        depth = max(1, math.ceil(math.log2(max(rows, 2))))
        nodes = 2 ** (depth + 1) - 1
        feature = np.full((trees, nodes), -1, np.int32)
        split = np.zeros((trees, nodes))
        path = np.zeros((trees, nodes))
        for t, part in enumerate(drawn):
            at = {0: part}
            for node in range(nodes):
                part = at.pop(node, None)
                if part is None:
                    continue
                level = (node + 1).bit_length() - 1
                low, high = (part.min(0), part.max(0)) if len(part) else (None, None)
                usable = np.flatnonzero(high > low) if len(part) > 1 else []
                if level == depth or len(usable) == 0:
                    path[t, node] = level + float(_expected_path(len(part)))
                    continue
                f = rng.choice(usable)
                cut = rng.uniform(low[f], high[f])
                feature[t, node], split[t, node] = f, cut
                left = part[:, f] <= cut
                at[2 * node + 1], at[2 * node + 2] = part[left], part[~left]
        return cls(feature, split, path, rows)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly in 0..1: short mean paths score high."""
        x = np.asarray(x, float)
        if not len(x):
            return np.zeros(0)
        total, every = np.zeros(len(x)), np.arange(len(x))
        for feature, split, path in zip(self.feature, self.split, self.path):
            node = np.zeros(len(x), np.int64)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[every, np.maximum(f, 0)] > split[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += path[node]
        return 2.0 ** (-total / len(self.feature) / max(float(_expected_path(self.rows)), 1e-9))


@dataclass
class QualityModel:
    forest: IsolationForest | None
    threshold: float

    def rejects(self, features) -> np.ndarray:
        if self.forest is None:
            return np.zeros(len(features), bool)
        return self.score(features) > self.threshold

    def score(self, features) -> np.ndarray:
        if self.forest is None:
            return np.zeros(len(features))
        return self.forest.score(np.asarray(features, float))


def calibrate(scored: DataFrame, max_reject: float) -> float:
    """``scored``: number of ``good`` and ``bad`` rows by distinct ``score``.  Of the
    thresholds that reject at most ``max_reject`` of the good rows, the one with
    most bad rows less good rows above it (in shares), half-way between the scores
    that it parts; 1.0 (nothing above) when no threshold rejects more bad rows than
    good ones.  Exact: running sums within ranges of scores, after those of all
    higher ranges."""
    bounds = sorted(set(scored.approxQuantile("score", [k / SCORE_RANGES for k in range(1, SCORE_RANGES)], 0.5 / SCORE_RANGES)))
    below = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("score"))) if bounds else F.lit(0)
    ranged = scored.withColumn("range", below)
    sums = ranged.groupBy("range").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.min("score").alias("least"))
    good = bad = 0
    above: dict = {}  # by range: good and bad rows in higher ranges, and the least score there
    least = None
    for r in sorted(sums.collect(), key=lambda r: -r["range"]):
        above[r["range"]] = good, bad, least
        good, bad, least = good + r["good"], bad + r["bad"], r["least"]
    if not good or not bad:
        return 1.0
    # In ranges below these, more of the good are lost by each threshold.
    usable = {k: v for k, v in above.items() if v[0] / good <= max_reject}

    def higher(i: int, kind: str):
        pairs = [F.lit(x) for k, v in usable.items() for x in (k, v[i])]
        return F.create_map(*pairs)[F.col("range")].cast(kind)

    falling = Window.partitionBy("range").orderBy(F.desc("score"))
    before = falling.rowsBetween(Window.unboundedPreceding, -1)
    best = (
        ranged.where(F.col("range").isin(list(usable)))
        .select(
            "score",
            F.coalesce(F.lag("score").over(falling), higher(2, "double")).alias("above"),
            ((F.coalesce(F.sum("good").over(before), F.lit(0)) + higher(0, "long")) / good).alias("lost"),
            ((F.coalesce(F.sum("bad").over(before), F.lit(0)) + higher(1, "long")) / bad).alias("caught"),
        )
        .where("above is not null")
        .withColumn("gain", F.col("caught") - F.col("lost"))
        .where((F.col("lost") <= max_reject) & (F.col("gain") > 0))
        .orderBy(F.desc("gain"), "score")
        .limit(1)
        .collect()
    )
    return (best[0]["score"] + best[0]["above"]) / 2 if best else 1.0


def _mixed(x: np.ndarray) -> np.ndarray:
    """Numbers of 64 bits, scrambled one by one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draw_rows(labelled: DataFrame, trees: int, size: int, seed: int) -> list[np.ndarray]:
    """Per tree, ``size`` of all rows at random without replacement (fewer if there are
    no more), each by its ``n`` as weight: those with the smallest exponential variates,
    which hash a row's key with the tree's.  No matter how the rows are dealt."""
    salts = np.random.default_rng(seed).integers(0, 1 << 63, trees, np.uint64)

    def smallest(batches):
        import pyarrow as pa

        worker_turn(__name__)
        tree, order, key = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        x = np.zeros((0, len(FEATURES)))
        limit = np.full(trees, np.inf)
        for batch in batches:
            keys = batch.column("key").to_numpy()
            weights = batch.column("n").to_numpy()
            rows = batch.column("features").flatten().to_numpy().reshape(-1, len(FEATURES))
            for i in range(0, len(keys), 512):
                some = keys[i : i + 512].astype(np.uint64)
                u = ((_mixed(_mixed(some)[:, None] ^ salts) >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53
                variate = -np.log(u) / weights[i : i + 512, None]
                at, t = np.nonzero(variate <= limit)
                tree, order = np.append(tree, t), np.append(order, variate[at, t])
                key, x = np.append(key, keys[i + at]), np.vstack([x, rows[i + at]])
                by = np.lexsort((key, order, tree))
                tree = tree[by]
                rank = np.arange(len(tree)) - np.searchsorted(tree, tree)
                first = rank < size
                tree, by, rank = tree[first], by[first], rank[first]
                order, key, x = order[by], key[by], x[by]
                full = rank == size - 1
                limit[tree[full]] = order[full]
        if len(tree):
            columns = [pa.array(tree), pa.array(order), pa.array(key), pa.array(list(x), target.field("features").type)]
            yield pa.RecordBatch.from_arrays(columns, schema=target)

    schema = T.StructType.fromDDL("tree long, variate double, key long, features array<double>")
    target = arrow_schema(schema)
    keyed = labelled.select(F.xxhash64("doc_id", "features").alias("key"), "n", "features")
    first = Window.partitionBy("tree").orderBy("variate", "key")
    chosen = keyed.mapInArrow(smallest, schema).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= size)
    drawn: list = [[] for _ in range(trees)]
    for r in sorted(chosen.select("tree", "rank", "features").collect()):  # trees * size rows
        drawn[r["tree"]].append(r["features"])
    return [np.array(x) for x in drawn]


def fit_quality(
    docs: DataFrame, labels: DataFrame, max_reject: float = 0.005, trees: int = TREES, held_rows: int = HELD_ROWS
) -> QualityModel:
    """Grow and calibrate on all labelled documents.  Texts are read in a narrow pass;
    their statistics alone are joined with the labels and stored.  Up to ``held_rows``
    rows, the driver draws the trees' rows itself."""

    def stats(cols):
        rows = [rule_stats(t) for t in cols["text"]]
        return {
            "doc_id": cols["doc_id"],
            "failed": [base_fails(base[0], base[4]) for base, _ in rows],
            "features": [features for _, features in rows],
        }

    marks = labels.select("doc_id", "quality").where("doc_id is not null and quality is not null").dropDuplicates(["doc_id"])
    named = docs.select("doc_id", "text").where("doc_id is not null")
    labelled = (
        map_batches(named, stats, "doc_id long, failed boolean, features array<double>")
        .where("not failed")
        .join(marks.hint("shuffle_hash"), "doc_id")  # labels grow with the documents: no broadcast
        .groupBy("doc_id", "quality", "features")
        .agg(F.count("*").alias("n"))
    )
    labelled = materialise(labelled, "quality-stats")
    rows, distinct = labelled.agg(F.sum("n"), F.count("*")).first()
    if not rows:
        return QualityModel(None, 1.0)
    if rows <= held_rows:
        held = labelled.orderBy("doc_id", "features").collect()
        forest = IsolationForest.fit(np.repeat(np.array([r["features"] for r in held]), [r["n"] for r in held], axis=0), trees)
    else:
        drawn = draw_rows(labelled, trees, TREE_ROWS, seed=7)
        forest = IsolationForest.grow(drawn, trees, min(TREE_ROWS, distinct), np.random.default_rng(7))
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def score(cols):
        return {"score": shared.value.score(np.array(cols["features"])), "quality": cols["quality"], "n": cols["n"]}

    good = F.col("quality") == 1
    scored = (
        map_batches(labelled.select("features", "quality", "n"), score, "score double, quality int, n long")
        .groupBy("score")
        .agg(F.sum(F.when(good, F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(good, 0).otherwise(F.col("n"))).alias("bad"))
    )
    return QualityModel(forest, calibrate(materialise(scored, "quality-scores"), max_reject))


def judge_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Per document: the base counts, the anomaly score and the verdict.  One
    narrow pass over the whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # trees: bounded by the fit's parameters

    def judge(cols):
        model = shared.value
        stats = [rule_stats(t) for t in cols["text"]]
        base = np.array([s[0] for s in stats], np.int64)
        features = np.array([s[1] for s in stats])
        failed = np.array([base_fails(b[0], b[4]) for b in base])
        out = {"doc_id": cols["doc_id"], **{n: base[:, i] for i, n in enumerate(BASE)}}
        score = model.score(features)
        kept = ~failed & ~((score > model.threshold) if model.forest is not None else np.zeros(len(base), bool))
        return out | {"base_failed": failed, "kept": kept, "anomaly": score}

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in BASE) + ", base_failed boolean, kept boolean, anomaly double"
    return map_batches(docs.select("doc_id", "text"), judge, schema)


def keep_quality(docs: DataFrame, model: QualityModel, columns: list[str]) -> DataFrame:
    """The kept documents themselves, with ``columns``: the same verdict as a
    filter in one narrow pass."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        worker_turn(__name__)
        for batch in batches:
            stats = [rule_stats(t) for t in batch.column("text").to_pylist()]
            if not stats:
                continue
            bad = shared.value.rejects(np.array([s[1] for s in stats]))
            keep = [not b and not base_fails(s[0][0], s[0][4]) for s, b in zip(stats, bad)]
            yield batch.filter(pa.array(keep))

    chosen = docs.select(*columns)
    return chosen.mapInArrow(run, chosen.schema)
