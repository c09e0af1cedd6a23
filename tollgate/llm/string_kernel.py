"""Toxicity by a gapped subsequence string kernel, Nyström landmarks and a
support vector machine.

A *unit* is a white-space token, or a run of three or more single characters
set apart by spaces ("s p e l l e d").  The kernel of two units counts their
common three-letter subsequences within ``SPAN`` positions, each weighted by
``DECAY`` per position it stretches over, so gaps and inserted characters
lower a match without losing it; characters that are not letters only make
gaps.  Landmark units give the Nyström map; a squared-hinge SVM is trained in
it on the units of labelled documents' sentences.  A label marks a document,
not a word, so training is multi-instance: the positive instances are each
toxic document's most telling units, chosen anew after every fit.

The trained function is linear in the subsequence features, so it folds
into one table ``G`` over letter triples; scoring a text costs a few look-ups per
character, whatever the number of landmarks.  A small logistic model maps a
document's highest unit scores and the number and share of positive ones to 0..1; it is
calibrated on cross-fitted scores.

Defined cases: null and empty texts have no unit and get the score of that
evidence (near 0); with no labelled rows of both classes every score is 0;
a null ``doc_id`` is never held out; repeated rows are scored each.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import hashed_sample, map_batches, worker_turn

LETTERS = 64  # code 0 is "no letter"
SPAN, DECAY = 6, 0.8
MAX_UNIT = 64  # letters that a unit's norm distinguishes
#: The training sample: at most so many labelled documents of each class, with
#: texts of at most so many characters.
MAX_PER_CLASS = 1500
MAX_FIT_CHARS = 20_000

_ACCENTED = "àâäáãåçéèêëíìîïñóòôöõúùûüýß"


def _code_table() -> np.ndarray:
    """Codes of characters below U+0250: a-z, common accented letters, and the
    rest of the letters spread over the last codes."""
    table = np.zeros(0x250, np.int64)
    for i in range(26):
        table[ord("a") + i] = 1 + i
    for i, c in enumerate(_ACCENTED):
        table[ord(c)] = 27 + i
    for i in range(0x250):
        if table[i] == 0 and chr(i).isalpha():
            table[i] = 54 + i % 10
    return table


_CODES = _code_table()
_PAIRS = [(g1, g2) for g2 in range(2, SPAN + 1) for g1 in range(1, g2)]


def codes_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of a text, and the unit number of each character (-1 on the
    white space between units)."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    low = points < 0x250
    codes = np.where(low, _CODES[np.where(low, points, 0)], np.where((points >= 0x2000) & (points < 0x2100), 0, 54 + points % 10))
    space = (points == 32) | ((points >= 9) & (points <= 13)) | (points == 0xA0)
    inside = ~space
    start = inside & np.concatenate(([True], space[:-1])) if len(points) else inside
    token = np.cumsum(start) - 1
    starts = np.flatnonzero(start)
    if not len(starts):
        return codes, np.full(len(points), -1)
    lengths = np.bincount(token[inside], minlength=len(starts))
    single = (lengths == 1) & (codes[starts] > 0)
    # Runs of three or more single letters become one unit.
    edge = np.flatnonzero(np.diff(np.concatenate(([0], single.view(np.int8), [0]))))
    joined = np.zeros(len(starts), bool)
    for a, b in zip(edge[::2], edge[1::2]):
        if b - a >= 3:
            joined[a + 1 : b] = True
    unit = np.cumsum(~joined) - 1
    of = unit[np.maximum(token, 0)]
    return codes, np.where(inside, of, -1)


def norms() -> np.ndarray:
    """Norm of a unit of n letters, all subsequences distinct."""
    n = np.arange(MAX_UNIT + 1)
    total = sum(np.maximum(n - g2, 0) * DECAY ** (2 * g2) for _, g2 in _PAIRS)
    return np.sqrt(np.maximum(total, DECAY**4))


_NORMS = norms()


def unit_norms(codes, unit, n_units) -> np.ndarray:
    letters = np.bincount(unit[(codes > 0) & (unit >= 0)], minlength=n_units)
    return _NORMS[np.minimum(letters, MAX_UNIT)]


def triples(codes: np.ndarray, unit: np.ndarray):
    """(unit, triple index, weight) arrays of all subsequences."""
    for g2 in range(2, SPAN + 1):
        if len(codes) <= g2:
            return
        at = np.flatnonzero((unit[:-g2] == unit[g2:]) & (unit[g2:] >= 0) & (codes[:-g2] > 0) & (codes[g2:] > 0))
        ends = codes[at] * (LETTERS * LETTERS) + codes[at + g2]
        for g1 in range(1, g2):
            middle = codes[at + g1]
            some = middle > 0
            yield unit[at[some]], (ends + middle * LETTERS)[some], DECAY**g2


def unit_scores(text: str, table: np.ndarray) -> np.ndarray:
    """Kernel part of the decision function for every unit of a text."""
    codes, unit = codes_of(text)
    n = int(unit.max(initial=-1)) + 1
    total = np.zeros(n)
    for u, index, weight in triples(codes, unit):
        total += weight * np.bincount(u, table[index], minlength=n)
    return total / unit_norms(codes, unit, n)


def features_of(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse normalised features (row, triple, value) of single units, which
    hold two characters or more and no white space."""
    codes, owner = codes_of("\n".join(units))
    if int(owner.max(initial=-1)) + 1 != len(units):
        raise ValueError("a unit is empty or holds white space")
    norm = unit_norms(codes, owner, len(units))
    parts = [(u, i, np.full(len(u), w)) for u, i, w in triples(codes, owner)]
    if not parts:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    row, index, value = (np.concatenate(x) for x in zip(*parts))
    key, where = np.unique(row * LETTERS**3 + index, return_inverse=True)
    value = np.bincount(where, value)
    row, index = key // LETTERS**3, key % LETTERS**3
    return row, index, value / norm[row]


def kernel(units: list[str], landmarks: tuple, m: int) -> np.ndarray:
    """Kernel values of units against ``m`` landmarks given by their features."""
    lrow, lindex, lvalue = landmarks
    used, column = np.unique(lindex, return_inverse=True)
    dense = np.zeros((len(used), m))
    dense[column, lrow] = lvalue
    out = np.zeros((len(units), m), np.float32)
    for at in range(0, len(units), 500):
        row, index, value = features_of(units[at : at + 500])  # sorted by row
        place = np.searchsorted(used, index)
        hit = (place < len(used)) & (used[np.minimum(place, len(used) - 1)] == index) if len(used) else np.zeros(len(index), bool)
        if hit.any():
            first = np.flatnonzero(np.diff(row[hit], prepend=-1))
            out[row[hit][first] + at] = np.add.reduceat(value[hit, None] * dense[place[hit]], first)
    return out


def fit_svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 30) -> np.ndarray:
    """Squared-hinge linear SVM with a bias, by Newton steps on the margin set."""
    x = np.hstack([z, np.ones((len(z), 1))])
    w = np.zeros(x.shape[1])
    eye = ridge * len(y) * np.eye(x.shape[1])
    eye[-1, -1] = 1e-9
    active = np.ones(len(y), bool)
    for _ in range(rounds):
        xa, wa = x[active], weight[active]
        w = np.linalg.solve((xa * wa[:, None]).T @ xa + eye, (xa * wa[:, None]).T @ y[active])
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    pen = ridge * np.eye(x.shape[1])
    pen[-1, -1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + pen, x.T @ (y - p) - pen @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


_SENTENCE = re.compile(r"[.!?\n]+(?=\s|$)")


def document_units(text: str) -> set[str]:
    """Distinct units of a document's sentences, lower-cased, without
    marks at their ends."""
    out = set()
    for sentence in _SENTENCE.split(text.lower()):
        for token in sentence.split():
            token = token.strip(".,;:!?#*$%&|<>()[]\"'")
            if 3 <= len(token) <= MAX_UNIT:
                out.add(token)
    return out


def evidence(scores: np.ndarray) -> list[float]:
    """What the calibration sees of a document."""
    top = np.sort(scores)[::-1][:3]
    top = np.clip(np.concatenate([top, np.full(3 - len(top), -1.0)]), -1.0, 0.6)
    positive, strong = int((scores > 0).sum()), int((scores > 0.3).sum())
    return [*top, math.log1p(positive), math.log1p(strong), math.log1p(1000 * strong / (len(scores) + 20))]


@dataclass
class ToxicityModel:
    table: np.ndarray  # score of each letter triple
    bias: float
    logistic: np.ndarray | None

    def score(self, text: str | None) -> float:
        if self.logistic is None:
            return 0.0
        x = evidence(unit_scores(text or "", self.table) + self.bias)
        return float(1 / (1 + math.exp(-min(30.0, max(-30.0, float(np.dot(self.logistic[:-1], x) + self.logistic[-1]))))))


def train_units(bags: list[set[str]], y: np.ndarray, landmarks: int = 200, rounds: int = 4, seed: int = 11):
    """The multi-instance SVM: returns the triple table and the bias."""
    rng = np.random.default_rng(seed)
    pos, neg = {}, {}
    for bag, label in zip(bags, y):
        into = pos if label else neg
        for u in bag:
            into[u] = into.get(u, 0) + 1
    n1, n0 = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    odds = {u: math.log((c + 0.25) / n1) - math.log((neg.get(u, 0) + 0.25) / n0) for u, c in pos.items()}
    telling = sorted(odds, key=lambda u: (-odds[u] * math.sqrt(pos[u]), u))[: landmarks // 2]
    ordinary = sorted(neg, key=lambda u: (-neg[u], u))
    common = ordinary[: landmarks // 4]
    other = [ordinary[i] for i in rng.choice(len(ordinary), min(len(ordinary), landmarks // 4), replace=False)] if ordinary else []
    marks = list(dict.fromkeys(telling + common + other))
    feats = features_of(marks)
    own = kernel(marks, feats, len(marks))
    values, vectors = np.linalg.eigh(own + 1e-6 * np.eye(len(marks)))
    root = vectors / np.sqrt(np.maximum(values, 1e-6))  # Nystrom map: kernel row times this
    vocabulary = sorted(set(pos) | set(neg))
    if len(vocabulary) > 20_000:  # ordinary units beyond this add nothing but time
        keep = set(telling) | {u for u in pos if pos[u] > 1} | {u for u in neg if neg[u] > 1}
        spare = [u for u in vocabulary if u not in keep]
        keep |= {spare[i] for i in rng.choice(len(spare), min(len(spare), max(0, 20_000 - len(keep))), replace=False)}
        vocabulary = sorted(keep)
    index = {u: i for i, u in enumerate(vocabulary)}
    z = kernel(vocabulary, feats, len(marks)) @ root.astype(np.float32)
    bag_ids = [np.array([index[u] for u in bag if u in index], int) for bag in bags]
    prior = np.array([odds.get(u, -3.0) for u in vocabulary])
    score, w = prior, None
    for turn in range(rounds):
        hits, hard = [], []
        for ids, label in zip(bag_ids, y):
            if not len(ids):
                continue
            best = ids[np.argsort(-score[ids], kind="stable")[:3]]
            if label:
                take = best[(prior[best] > 0.5) & ((score[best] > -0.5) | (turn == 0))]
                hits += [*take]
            elif turn:
                hard += [*best]
        chosen = np.unique(np.array(hits, int))
        if not len(chosen):
            break
        counts = np.bincount(np.array(hits, int), minlength=len(vocabulary))[chosen]
        against = rng.choice(len(vocabulary), min(len(vocabulary), 8000), replace=False)
        against = np.union1d(against, np.unique(np.array(hard, int)))
        against = against[prior[against] < 0]
        # Each positive also with a character inserted between its letters.
        apart = kernel([".".join(vocabulary[i]) for i in chosen], feats, len(marks)) @ root
        x = np.vstack([z[chosen], apart, z[against]])
        t = np.concatenate([np.ones(2 * len(chosen)), -np.ones(len(against))])
        weights = np.concatenate([np.sqrt(counts), np.sqrt(counts) / 2, np.ones(len(against))])
        weights[: 2 * len(chosen)] *= len(against) / (3 * weights[: 2 * len(chosen)].sum())
        w = fit_svm(x, t, weights)
        score = z @ w[:-1] + w[-1]
    table = np.zeros(LETTERS**3)
    if w is None:
        return table, -1.0
    beta = root @ w[:-1]
    np.add.at(table, feats[1], feats[2] * beta[feats[0]])
    return table, float(w[-1])


def train(texts: list[str], y: np.ndarray) -> ToxicityModel:
    """Cross-fitted calibration, then the model on all rows."""
    y = np.asarray(y, int)
    if not len(y) or y.min() == y.max():
        return ToxicityModel(np.zeros(LETTERS**3), -1.0, None)
    bags = [document_units(t) for t in texts]
    fold = np.arange(len(y)) % 2
    seen = np.zeros((len(y), 6))
    for f in (0, 1):
        fit = np.flatnonzero(fold != f)
        table, bias = train_units([bags[i] for i in fit], y[fit])
        for i in np.flatnonzero(fold == f):
            seen[i] = evidence(unit_scores(texts[i], table) + bias)
    logistic = fit_logistic(seen, y)
    table, bias = train_units(bags, y)
    return ToxicityModel(table.astype(np.float32), bias, logistic)


def held_out(doc_id):
    """Remainder 1 of crc32 of the id's text by 3, as a Column."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = MAX_PER_CLASS) -> ToxicityModel:
    """Train on at most ``per_class`` toxic and as many clean labelled documents
    that are not held out (smallest hashes of doc_id)."""
    usable = labels.select("doc_id", "toxic").where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("doc_id")
    ).dropDuplicates(["doc_id"])
    chosen = hashed_sample(usable.where("toxic = 1"), F.col("doc_id"), per_class).unionByName(
        hashed_sample(usable.where("toxic = 0"), F.col("doc_id"), per_class)
    )
    rows = (
        docs.select("doc_id", "text")
        .where(F.length("text") <= MAX_FIT_CHARS)
        .join(F.broadcast(chosen), "doc_id")  # at most 2 * per_class rows of two columns
        .orderBy("doc_id", "text")
        .limit(2 * per_class)
        .collect()
    )
    return train([r.text for r in rows], np.array([r.toxic for r in rows], int))


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text; narrow."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one float per letter triple: 1 MB

    def score(cols):
        got = [shared.value.score(t) for t in cols["text"]]
        return {
            "doc_id": cols["doc_id"],
            "held_out": [d is not None and zlib.crc32(b"%d" % d) % 3 == 1 for d in cols["doc_id"]],
            "score": got,
            "predicted": [int(s >= threshold) for s in got],
        }

    return map_batches(docs.select("doc_id", "text"), score, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: ToxicityModel, columns: list[str], threshold: float = 0.7) -> DataFrame:
    """The documents that score below the threshold, with ``columns``; narrow."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        worker_turn(__name__)
        for batch in batches:
            yield batch.filter(pa.array([shared.value.score(t) < threshold for t in batch.column("text").to_pylist()], pa.bool_()))

    chosen = docs.select(*columns)
    return chosen.mapInArrow(run, chosen.schema)
