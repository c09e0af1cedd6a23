"""Near-duplicate documents by fast similarity sketches.

A sketch has ``COORDS`` coordinates.  In round ``i`` every shingle is hashed
to one coordinate with a value in ``[i, i + 1)``; a coordinate keeps its
smallest value.  After ``COORDS`` rounds a last round sends every shingle
to all coordinates, so that each one fills; rounds stop as soon as all
are full, so a long document needs one or two.  Two sets agree in a
coordinate with probability equal to their Jaccard similarity, and agreement
concentrates as with independent coordinates.

``BANDS`` bands of ``ROWS`` coordinates give the buckets.  Candidates are
verified on the full shingle sets.  Equal sets are one class from the start.
Buckets are then joined in rounds: a leader by hash is compared with the
members of other components (a star, not all pairs), first in a few bands, then
in all.  In the buckets that are in several components after that, the
members outside the largest one are compared with all others (in large
buckets block by block, without a row per pair), so no link between components
is lost.  A one-bit-per-coordinate summary screens
pairs before the sets are fetched.  A bucket's rows are never gathered: every
step is an aggregation or a join that Spark can split.

At similarity 0.8 a pair shares no bucket with probability
(1 - 0.8^5)^32 = 3e-6, and fails the screen (six standard deviations) with less
than 1e-8.

Defined cases: null, empty or blank texts have no shingles and link with
nothing; one word is a shingle by itself; a null ``doc_id`` is a row of its own
with a null component; repeated rows with one ``doc_id`` share its component.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import WordCache, map_batches, materialise, worker_state
from tollgate.llm.graph import connected_components

BANDS, ROWS = 32, 5
COORDS = BANDS * ROWS
#: Bands that each round of stars looks at.
STAR_ROUNDS = (6, BANDS, BANDS)
#: Pairs across components up to which a bucket is compared pair by pair, and
#: members of a block in larger ones.
FEW_PAIRS, BLOCK = 100, 256
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_EMPTY = np.uint64(_MASK)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift), vectorised."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX1
        x = (x ^ (x >> np.uint64(27))) * _MIX2
        return x ^ (x >> np.uint64(31))


def seed(i: int) -> np.uint64:
    return np.uint64((i + 1) * _STEP & _MASK)


def shingle_set(text: str | None, width: int, cache: dict | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of the text
    with A-Z lower-cased; with fewer words, of the whole word sequence."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if cache is None:
        cache = {}
    digest = xxhash.xxh3_64_intdigest
    keep = cache.keep if isinstance(cache, WordCache) else cache.__setitem__
    for w in set(words):
        if w not in cache:
            keep(w, digest(w))
    h = np.fromiter((cache[w] for w in words), np.uint64, len(words))
    width = min(width, len(words))
    key = np.full(len(words) - width + 1, width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            key = mix(key + h[k : len(words) - width + 1 + k] + seed(k))
    return np.unique(key)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Sketches of non-empty sets, one row each, all sets round by round."""
    n = len(sets)
    out = np.full(n * COORDS, _EMPTY, np.uint64)
    sizes = np.array([len(s) for s in sets])
    owner, element = np.repeat(np.arange(n), sizes), np.concatenate(sets) if n else np.zeros(0, np.uint64)
    low = np.uint64((1 << 55) - 1)
    for i in range(COORDS + 1):
        if i < COORDS:
            h = mix(element + seed(i))
            coord, value = (h >> np.uint64(32)) % np.uint64(COORDS), mix(h ^ seed(COORDS + i)) & low
            at = owner * COORDS + coord.astype(np.int64)
            open_ = out[at] >= np.uint64(i) << np.uint64(55)
            np.minimum.at(out, at[open_], value[open_] | (np.uint64(i) << np.uint64(55)))
        else:  # the last round: every element to every coordinate still empty
            for c in range(COORDS):
                value = mix(element + seed(3 * COORDS + c)) & low
                at = owner * COORDS + c
                open_ = out[at] >= np.uint64(i) << np.uint64(55)
                np.minimum.at(out, at[open_], value[open_] | (np.uint64(i) << np.uint64(55)))
        unfilled = (out.reshape(n, COORDS) == _EMPTY).any(1)
        if not unfilled.any():
            break
        stay = unfilled[owner]
        owner, element = owner[stay], element[stay]
    return out.reshape(n, COORDS)


def bands_and_bits(sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (the band number is mixed in) and the one-bit summary as
    signed 64-bit words."""
    n = len(sketch)
    key = np.zeros((n, BANDS), np.uint64)
    parts = sketch.reshape(n, BANDS, ROWS)
    with np.errstate(over="ignore"):
        for r in range(ROWS):
            key = mix(key + parts[:, :, r] + seed(r))
        key = mix(key + np.arange(BANDS, dtype=np.uint64) * np.uint64(_STEP))
    bits = (mix(sketch) & np.uint64(1)).astype(np.uint8)
    words = -(-COORDS // 64)
    padded = np.zeros((n, words * 64), np.uint8)
    padded[:, :COORDS] = bits
    return key.view(np.int64), np.packbits(padded, axis=1).view(">u8").astype(np.uint64).view(np.int64)


def most_differing_bits(percent: int) -> int:
    """Bits in which two sketches of sets at the least similarity may differ,
    with six standard deviations of slack."""
    p = (1 - percent / 100) / 2
    return min(COORDS, math.ceil(COORDS * p + 6 * math.sqrt(COORDS * p * (1 - p))))


#: Bytes of word hashes that a worker keeps, at most (and those of one batch's words).
CACHE_BYTES = 24 << 20


def _sketch_columns(cols, width):
    import hashlib

    words = worker_state("words", lambda: WordCache(None, CACHE_BYTES))
    if words.held > words.limit:
        words.clear()
        words.held = 0
    sets = [shingle_set(t, width, words) for t in cols["text"]]
    full = [i for i, s in enumerate(sets) if len(s)]
    bands, bits = [None] * len(sets), [None] * len(sets)
    for start in range(0, len(full), 256):
        some = full[start : start + 256]
        b, w = bands_and_bits(sketches([sets[i] for i in some]))
        for k, i in enumerate(some):
            bands[i], bits[i] = b[k], w[k]
    return {
        "doc_id": cols["doc_id"],
        "n_shingles": [len(s) for s in sets],
        # Texts without shingles get a key each, so that they don't meet in one task.
        "set_key": [
            hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else b"no shingles %d" % (d or 0)
            for d, s in zip(cols["doc_id"], sets)
        ],
        "bands": bands,
        "bits": bits,
    }


def _set_columns(cols, width):
    return {
        "doc_id": cols["doc_id"],
        "shingles": [shingle_set(t, width, {}).tobytes() for t in cols["text"]],
    }


def _verified(cols, percent):
    out = []
    left, last = None, None
    for a, sa, sb in zip(cols["a"], cols["sa"], cols["sb"]):
        if a != last:
            left, last = np.frombuffer(sa, np.uint64), a
        right = np.frombuffer(sb, np.uint64)
        both = len(np.intersect1d(left, right, assume_unique=True))
        out.append(100 * both >= percent * (len(left) + len(right) - both))
    keep = np.array(out, bool)
    return {"a": np.array(cols["a"])[keep], "b": np.array(cols["b"])[keep]}


def _sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """``doc_id, shingles`` of the documents with the given ids."""
    texts = docs.join(ids.hint("shuffle_hash"), "doc_id", "left_semi")
    sets = map_batches(texts, _set_columns, "doc_id long, shingles binary", width).dropDuplicates(["doc_id"])
    return materialise(sets, "shingle-sets", batch_rows=1000)


def verify_pairs(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets are similar enough."""
    both = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b").join(
        sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a"
    )
    return materialise(map_batches(both, _verified, "a long, b long", percent), "links", batch_rows=500)


def _screen(a: str, b: str, most: int):
    words = -(-COORDS // 64)
    differing = sum(
        (F.bit_count(F.col(f"{a}.bits")[i].bitwiseXOR(F.col(f"{b}.bits")[i])) for i in range(words)), F.lit(0)
    )
    return differing <= most


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs(doc_id, text)`` to one row per document: ``doc_id, n_shingles,
    component_id, kept``.  Documents with ``100 * intersection >= percent *
    union`` of their shingle sets are linked; a component's smallest id is kept."""
    docs = docs.select("doc_id", "text")
    sketched = materialise(
        map_batches(
            docs, _sketch_columns,
            "doc_id long, n_shingles long, set_key binary, bands array<long>, bits array<long>", width,
        ),
        "sketches",
    )
    # One class per distinct set; its smallest doc_id stands for it.
    classes = (
        sketched.where("n_shingles > 0 and doc_id is not null")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("rep"))
    )
    reps = materialise(
        sketched.where("n_shingles > 0").join(classes, "set_key").where("doc_id = rep")
        .groupBy("rep").agg(F.first("bands").alias("bands"), F.first("bits").alias("bits")),
        "classes",
    )
    most = most_differing_bits(percent)
    members = reps.select("rep", F.posexplode("bands").alias("band", "bucket"))
    buckets = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    shared = materialise(members.join(buckets, "bucket"), "members")  # only buckets with two members or more
    # Sets of the documents that can be in a pair, from one more read of their texts.
    sets = _sets(docs, shared.select(F.col("rep").alias("doc_id")).distinct(), width)
    bits = reps.select("rep", "bits")

    component = reps.select(F.col("rep").alias("id"), F.col("rep").alias("component"))
    for turn, last_band in enumerate(STAR_ROUNDS):
        part = shared.where(F.col("band") < last_band)
        component = _merge(sets, _stars(part, component, turn), bits, component, most, percent)
    inside = materialise(_mixed(shared, component), "mixed")
    few = F.col("n") * F.col("outside") <= FEW_PAIRS
    links = verify_pairs(sets, materialise(screened(_pairs_across(inside.where(few)), bits, most), "pairs"), percent)
    component = _joined(
        component, _between(links, component).unionByName(_blocks_across(sets, inside.where(~few), percent))
    )

    by_class = classes.join(component.select(F.col("id").alias("rep"), "component"), "rep").select("set_key", "component")
    return (
        sketched.select("doc_id", "n_shingles", "set_key")
        .join(by_class, "set_key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _merge(sets, pairs, bits, component, most, percent) -> DataFrame:
    """Components after the verified ones of ``pairs`` have been added."""
    pairs = materialise(screened(pairs, bits, most), "pairs")
    if pairs.isEmpty():
        return component
    return _joined(component, _between(verify_pairs(sets, pairs, percent), component))


def _between(links: DataFrame, component: DataFrame) -> DataFrame:
    """Links of documents as links of their components."""
    a = component.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    b = component.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    return links.join(a, "a").join(b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))


def _joined(component: DataFrame, between: DataFrame) -> DataFrame:
    up = connected_components(between, "dedup").select(F.col("id").alias("component"), F.col("component").alias("up"))
    return materialise(
        component.join(up, "component", "left").select("id", F.coalesce("up", "component").alias("component")), "components"
    )


def _placed(shared: DataFrame, component: DataFrame) -> DataFrame:
    return shared.join(component.select(F.col("id").alias("rep"), "component"), "rep").select("bucket", "rep", "component")


def _stars(shared: DataFrame, component: DataFrame, turn: int) -> DataFrame:
    """In each bucket of several components a leader by hash, paired with
    the members of other components."""
    placed = _placed(shared, component)
    by_hash = F.struct(F.xxhash64(F.lit(turn), "bucket", "rep").alias("h"), F.col("rep"), F.col("component"))
    leaders = (
        placed.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min(by_hash).alias("lead"))
        .where("low <> high")
        .select("bucket", F.col("lead.rep").alias("leader"), F.col("lead.component").alias("of"))
    )
    return (
        placed.join(leaders, "bucket")
        .where("component <> of")
        .select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b"))
        .distinct()
    )


def screened(pairs: DataFrame, bits: DataFrame, most: int) -> DataFrame:
    return (
        pairs.join(bits.select(F.col("rep").alias("b"), F.struct("bits").alias("y")), "b")
        .join(bits.select(F.col("rep").alias("a"), F.struct("bits").alias("x")), "a")
        .where(_screen("x", "y", most))
        .select("a", "b")
    )


def _mixed(shared: DataFrame, component: DataFrame) -> DataFrame:
    """Members of the buckets that are in several components, with the bucket's
    largest component, its size ``n`` and the number of members ``outside`` it."""
    placed = _placed(shared, component)
    parts = placed.groupBy("bucket", "component").agg(F.count("*").alias("size"))
    buckets = (
        parts.groupBy("bucket")
        .agg(F.count("*").alias("parts"), F.sum("size").alias("n"), F.max(F.struct("size", "component")).alias("top"))
        .where("parts > 1")
        .select("bucket", "n", (F.col("n") - F.col("top.size")).alias("outside"), F.col("top.component").alias("largest"))
    )
    return placed.join(buckets, "bucket")


def _pairs_across(inside: DataFrame) -> DataFrame:
    """Pairs of one bucket in different components; each has an end outside the
    largest one.  For buckets with few such pairs."""
    outside = inside.where("component <> largest")
    return (
        inside.alias("m")
        .join(outside.alias("o"), "bucket")
        .where(
            (F.col("m.component") != F.col("o.component"))
            & ((F.col("m.component") == F.col("m.largest")) | (F.col("m.rep") < F.col("o.rep")))
        )
        .select(F.least("m.rep", "o.rep").alias("a"), F.greatest("m.rep", "o.rep").alias("b"))
        .distinct()
    )


def _blocks_across(sets: DataFrame, inside: DataFrame, percent: int) -> DataFrame:
    """The same comparison for buckets with many pairs, block by block: chunks of
    the members outside the largest component meet chunks of all members, and a
    task gives the links between components that it finds, not pairs."""
    chunks = [F.ceil(F.col(c) / F.lit(BLOCK)).cast("int") for c in ("n", "outside")]
    dealt = inside.withColumns({"members": chunks[0], "others": chunks[1], "key": F.xxhash64("rep")})
    mine = F.pmod("key", F.col("members")).cast("int")
    other = F.pmod("key", F.col("others")).cast("int")
    columns = ["bucket", "rep", "component"]
    units = dealt.select(
        *columns, F.lit(False).alias("out"), mine.alias("j"), F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("i")
    ).unionByName(
        dealt.where("component <> largest").select(
            *columns, F.lit(True).alias("out"), other.alias("i"), F.explode(F.sequence(F.lit(0), F.col("members") - 1)).alias("j")
        )
    )
    units = units.join(sets.withColumnRenamed("doc_id", "rep"), "rep")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        return _compare_block(frame, percent)

    return materialise(units.groupBy("bucket", "i", "j").applyInPandas(compare, "a long, b long").distinct(), "block-links")


def _compare_block(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    frame = frame.sort_values("rep", kind="stable")
    members, others = frame[~frame["out"]], frame[frame["out"]]
    found: set = set()
    if len(members) and len(others):
        sets = [np.frombuffer(b, np.uint64) for b in members["shingles"]]
        sizes = np.array([len(x) for x in sets])
        known, codes = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        of = members["component"].to_numpy()
        for own, blob in zip(others["component"].tolist(), others["shingles"]):
            mine = np.frombuffer(blob, np.uint64)
            has = np.isin(known, mine, assume_unique=True)
            both = np.add.reduceat(has[codes].astype(np.int64), starts)
            close = (100 * both >= percent * (sizes + len(mine) - both)) & (of != own)
            found |= {(min(own, c), max(own, c)) for c in np.unique(of[close]).tolist()}
    return pd.DataFrame(sorted(found), columns=["a", "b"], dtype="int64")
