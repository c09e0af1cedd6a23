"""Encoders, packing, id files and token counts."""

import hashlib
import io
import itertools
import random
import struct
import time
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_frames import awkward, documents, prose

from tollgate.llm import duckdb_bpe as B
from tollgate.llm import huffman_ids as H
from tollgate.llm import tokens
from tollgate.llm import trie_counts as C
from tollgate.llm import vector_packing as V

RANKS = P.path("byte_bpe_50k.tiktoken")
BYTES = P.path("byte_bpe_50k.json")
WORDS = P.path("word_bpe_49k.json")

HARD = [
    "  a   b \n c\n \n  d\t\t e ", "x" * 2000, "=" * 900 + " y", "héllo wörld 　 中文字符测试 \x00 null", "it's we'll  'S don'T",
    "a\x1c b", " lead", "trail ", "tab\t x", "<|endoftext|> q <|startoftext|>", "Straße İstanbul ΣΑΣ Σ", "é decomposed",
    "\x85 \xa0   　 x", "½ ² ①2 a1b22 __x--y 1,234.5", "\r\n\r\n end\r", "qz" * 300 + "é" * 100,
]
TEXTS = HARD + [t or "" for _, t in awkward()]


def le(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def library(path):
    return Tokenizer.from_file(path)  # as it is: its own added tokens are ids of their own


@pytest.fixture(scope="module")
def reference():
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.read_ranks(RANKS), special_tokens={})
    return enc.encode_ordinary


def test_chunks_join_to_the_text():
    for t in TEXTS:
        assert "".join(tokens.chunks(t)) == t


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab'sΣÉ 1.\n\t ́中", max_size=30))
def test_cached_ids_equal_whole_text_ids(text):
    for path, enc in ((BYTES, tokens.library_encoder(BYTES, P.PATTERN)), (WORDS, tokens.word_end_encoder(WORDS))):
        assert np.frombuffer(enc.ids([text])[0], "<u4").tolist() == library_of(path).encode(text, add_special_tokens=False).ids


_LIBRARY = {}


def library_of(path):
    if path not in _LIBRARY:
        _LIBRARY[path] = library(path)
    return _LIBRARY[path]


def test_library_ids_of_hard_texts():
    for path, enc in ((BYTES, tokens.library_encoder(BYTES, P.PATTERN)), (WORDS, tokens.word_end_encoder(WORDS))):
        got = enc.ids(TEXTS + [None])
        assert got[-1] == b""
        for text, ids in zip(TEXTS, got):
            assert np.frombuffer(ids, "<u4").tolist() == library_of(path).encode(text, add_special_tokens=False).ids, text[:40]


def test_duckdb_encoding_equals_tiktoken_and_decodes(spark, reference):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (500, None), (3, TEXTS[3])]
    out = B.encode_digests(documents(spark, rows), RANKS, P.PATTERN).collect()
    assert len(out) == len(rows)
    texts = dict(rows)
    for r in out:
        ids = reference(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(le(ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    whole = B.encode_documents(documents(spark, rows[:5]), RANKS, P.PATTERN).collect()
    assert all(bytes(r.decoded) == texts[r.doc_id].encode() for r in whole)
    assert B.encode_digests(documents(spark, []), RANKS, P.PATTERN).count() == 0


@pytest.mark.parametrize("size", [1, 2, 5, 48])
def test_blocks_of_any_size_join_to_the_same_ids(reference, monkeypatch, size):
    bpe = B.encoder(RANKS, P.PATTERN)
    rng = random.Random(1)
    words = ["".join(rng.choice("aeinorstl") for _ in range(rng.randrange(1, 40))) for _ in range(200)]
    words += ["aaaa" * 9, "banana" * 5, "ab" * 300, "é中" * 40] + [w * 30 for w in ("abc", "tion", "ingrest", "x" * 31, "qzj")]
    words += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(700)) for _ in range(20)]
    monkeypatch.setattr(B, "BLOCK", size)
    monkeypatch.setattr(B, "QUERY_ROWS", 3000)
    assert [B.unpacked(x) for x in bpe.encode_words(words)] == [reference(w) for w in words]


def test_blocks_that_never_settle_grow_together(reference, monkeypatch):
    monkeypatch.setattr(B, "BLOCK", 3)
    monkeypatch.setattr(B, "TURNS", 0)
    bpe = B.encoder(RANKS, P.PATTERN)
    words = ["internationalisation" * 4, "abcabcab" * 20]
    assert [B.unpacked(x) for x in bpe.encode_words(words)] == [reference(w) for w in words]


def long_words(n):
    rng = random.Random(2)
    letters = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    return {"random": letters, "one": "a" * n, "period": ("etaoinshrdlucmfwypvbgkjqxzetaon" * (n // 31 + 1))[:n]}


@pytest.mark.parametrize("kind", ["random", "one", "period"])
def test_a_word_of_a_million_letters_is_encoded_in_time(kind):
    word = long_words(1_000_000)[kind]
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.read_ranks(RANKS), special_tokens={})
    bpe = B.encoder(RANKS, P.PATTERN)
    at = time.time()
    (ids,) = bpe.chunks.ids([word])
    assert time.time() - at < 60
    part = 20_000  # the library takes minutes for all of it: its ids of the beginning, but for the last ones
    want = enc.encode_ordinary(word[:part])[:-40]
    assert np.frombuffer(ids, "<u4")[: len(want)].tolist() == want
    assert b"".join(p for _, p in bpe.decode([ids])) == word.encode()


def test_a_word_of_a_million_letters_is_counted_in_time():
    counter = C.TrieCounter(C.sentencepiece_pieces(P.path("piece_bpe_32k.model")))
    word = long_words(1_000_000)["random"]
    at = time.time()
    ((words, tokens_, score),) = counter.counts([word])
    assert time.time() - at < 60 and words == 1 and score < 0 < tokens_
    some = word[:3_000]
    assert counter.chain(some) == counter.score([some])[0]


def test_every_code_point_is_split_as_the_libraries_do(reference):
    """All code points below U+3000, and a share of those beyond."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % (7 if c < 0x20000 else 97) == 0)]
    encoders = ((BYTES, tokens.library_encoder(BYTES, P.PATTERN)), (WORDS, tokens.word_end_encoder(WORDS)))
    split, find = B.splitter(P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.read_ranks(RANKS), special_tokens={})
    for at in range(0, len(points), 4000):
        texts = [f"a{c}b {c}'s 1{c}2 {c}{c} x.{c}!" for c in map(chr, points[at : at + 4000])]
        for path, enc in encoders:
            want = library_of(path).encode_batch(texts, add_special_tokens=False)
            for text, ids, w in zip(texts, enc.ids(texts), want):
                assert np.frombuffer(ids, "<u4").tolist() == w.ids, text
        for text in texts[::5]:
            assert [i for p in split(text) for i in find._core_bpe.encode_single_piece(p.encode())] == reference(text), text


def test_decoding_a_document_longer_than_a_query(monkeypatch, reference):
    monkeypatch.setattr(B, "DECODE_IDS", 100)
    bpe = B.encoder(RANKS, P.PATTERN)
    ids = [le(reference(t)) for t in TEXTS]
    out = [b""] * len(ids)
    for i, part in bpe.decode(ids):
        out[i] += part
    assert out == [t.encode() for t in TEXTS]


# -- packing -----------------------------------------------------------------
def check_packing(rows, encode, capacity):
    """Every id of every document is packed once, in order, under the capacities."""
    by_seq, by_doc = {}, {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity.tokens and len(places) <= capacity.documents
        assert sum(n * n for _, n in places) <= capacity.attention
    return by_doc, by_seq


def test_packing_covers_whole_documents(spark, monkeypatch):
    monkeypatch.setattr(V, "SHARD", 60)
    rng = random.Random(2)
    rows = [(100 + i, prose(rng, rng.choice([1, 5, 40, 300, 900]))) for i in range(150)] + awkward()
    df = documents(spark, rows)
    out = V.pack_documents(df, lambda: tokens.word_end_encoder(WORDS).ids, end_id=0).collect()
    by_doc, by_seq = check_packing(out, None, V.Capacity())
    total = 0
    for doc, text in {d: t for d, t in rows}.items():
        ids = library_of(WORDS).encode(text or "", add_special_tokens=False).ids + [0]
        times = sum(d == doc for d, _ in rows)
        pieces = by_doc[doc]
        assert len(pieces) == times * -(-len(ids) // 2048) or doc is None
        total += times * len(ids)
        if doc is not None:
            for p in pieces:
                part = ids[p.start : p.start + p.length]
                assert p.start == 2048 * p.piece and p.length == len(part) == min(2048, len(ids) - p.start)
                assert p.ids_crc32 == zlib.crc32(le(part))
    assert sum(r.length for r in out) >= total
    at_once = V.best_fit(np.array([r.length for r in out]), V.Capacity())[0].max() + 1
    assert len(by_seq) <= at_once + 6  # a few more in shards of 60 pieces than in one
    assert V.pack_documents(documents(spark, []), lambda: tokens.word_end_encoder(WORDS).ids).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_respects_every_capacity(rule):
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 600, 800)
    for cap in (V.Capacity(1024, 3, 1024**2, rule=rule), V.Capacity(1024, 99, 500_000, rule=rule), V.Capacity(600, 2, 10**6, rule=rule)):
        seq, off = V.best_fit(lengths, cap)
        for s in range(seq.max() + 1):
            at = np.flatnonzero(seq == s)
            at = at[np.argsort(off[at])]
            assert (off[at] == np.cumsum(lengths[at]) - lengths[at]).all()
            assert lengths[at].sum() <= cap.tokens and len(at) <= cap.documents and (lengths[at] ** 2).sum() <= cap.attention
    seq, _ = V.best_fit(lengths, V.Capacity(1024, 1024, 1024**2, rule=rule))
    assert seq.max() + 1 <= -(-lengths.sum() // 1024) * 1.03
    with pytest.raises(ValueError):
        V.best_fit(np.array([5000]), V.Capacity(1024))


# -- id files ------------------------------------------------------------------
def plain_huffman_cost(counts):
    import heapq

    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        x = heapq.heappop(heap) + heapq.heappop(heap)
        cost += x
        heapq.heappush(heap, x)
    return cost


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=60))
def test_code_lengths_are_optimal_and_complete(counts):
    counts = np.array(counts)
    lengths = H.code_lengths(counts).astype(int)
    used = lengths[counts > 0]
    assert (lengths[counts == 0] == 0).all()
    if len(used) > 1:
        assert sum(2.0**-used) == 1.0
        assert (counts * lengths).sum() == plain_huffman_cost(counts)  # 20 bits don't bind here
    elif len(used):
        assert used[0] == 1


def test_length_limit_is_kept():
    counts = np.array([int(1.7**i) + 1 for i in range(45)])
    for limit in (6, 8, 12):
        lengths = H.code_lengths(counts, limit).astype(int)
        assert lengths.max() <= limit and sum(2.0**-lengths) <= 1.0
    with pytest.raises(ValueError):
        H.code_lengths(np.ones(100, int), 6)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=700), st.integers(0, 10))
def test_pack_and_unpack(ids, skew):
    ids = np.array([i // (1 + skew) for i in ids], np.uint32)
    lengths = H.code_lengths(np.bincount(ids, minlength=301))
    payload, start = H.pack(ids, lengths, H.canonical_codes(lengths))
    for sizes in ([len(ids)], [0, len(ids) // 3, 0, len(ids) - len(ids) // 3]):
        sizes = np.array(sizes)
        points = start[H.segment_starts(sizes)].astype("<u4")
        assert H.unpack(payload, sizes, points, H.decoding_table(lengths)).tolist() == ids.tolist()


#: A lambda, as workers cannot import a test module.
make_encode = lambda: tokens.library_encoder(BYTES, P.PATTERN).ids


def test_blocks_round_trip_when_documents_span_them(monkeypatch):
    monkeypatch.setattr(H, "BLOCK_IDS", 50)
    rng = np.random.default_rng(7)
    docs = [(None, []), (1, [5]), (2, rng.integers(0, 90, 500)), (2, rng.integers(0, 90, 500)), (3, rng.integers(0, 3, 50)), (4, [7] * 101)]
    docs = [(d, np.array(ids, np.uint32)) for d, ids in docs]
    lengths = H.code_lengths(np.bincount(np.concatenate([i for _, i in docs]), minlength=90))
    out = io.BytesIO()
    writer = H.BlockWriter(out, lengths)
    for d, ids in docs:
        writer.add(d, ids)
    writer.flush()
    got, held = [], []
    for d, ids, more in H.read_blocks(io.BytesIO(out.getvalue())):
        held += ids.tolist()
        if not more:
            got.append((d, held))
            held = []
    assert got == [(d, ids.tolist()) for d, ids in docs]


def test_id_files_round_trip(spark):
    rows = [(i * 3, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (9, "again"), (9, "again"), (-5, "negative")]
    rows += [(60, "long and twice " * 900)] * 2
    df = documents(spark, rows).repartition(5)
    manifest = H.store_ids(df, make_encode, 50_257, files=4)
    out = H.read_documents(spark, manifest).collect()
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in out))
    want = {}
    for d, t in rows:
        ids = library_of(BYTES).encode(t or "", add_special_tokens=False).ids + [0]
        want.setdefault(d, []).append((len(ids), zlib.crc32(le(ids))))
    at, last = 0, None
    for start, doc, n, crc in got:
        assert start == at and (n, crc) in want[doc]
        want[doc].remove((n, crc))
        assert last is None or (doc is not None and last <= doc)
        at, last = at + n, doc
    assert not any(want.values())
    assert H.read_documents(spark, H.store_ids(documents(spark, []), make_encode, 50_257)).count() == 0


def test_a_damaged_block_is_an_error(spark, tmp_path):
    manifest = H.store_ids(documents(spark, [(1, "some text")]), make_encode, 50_257, files=1)
    path = manifest.collect()[0]["path"].removeprefix("file:")
    raw = bytearray(open(path, "rb").read())
    raw[-1] ^= 1
    bad = tmp_path / "bad.huf"
    bad.write_bytes(raw)
    with open(bad, "rb") as f, pytest.raises(ValueError, match="damaged"):
        list(H.read_blocks(f))


# -- token counts ----------------------------------------------------------------
def plain_best(word, pieces):
    """Best segmentation by enumerating all cuts."""
    best = None
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, start = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(word[start:i])
                start = i
        parts.append(word[start:])
        score = n = 0
        for p in parts:
            if p in pieces:
                score, n = score + pieces[p], n + 1
            elif len(p) == 1:
                size = len(p.encode())
                score, n = score + C.BYTE_SCORE * size, n + size
            else:
                break
        else:
            best = max(best or (-1e9, 0), (score, -n))
    return best[0], -best[1]


def test_trie_scores_equal_enumeration():
    pieces = {"a": -2.0, "b": -2.5, "ab": -3.0, "abc": -6.5, "c": -4.0, "bc": -4.5, C.MARK: -3.0, C.MARK + "a": -4.0}
    rng = random.Random(5)
    words = sorted({C.MARK + "".join(rng.choice("abcé") for _ in range(rng.randrange(0, 8))) for _ in range(150)})
    got = C.TrieCounter(pieces).score(words)
    for w, (score, n) in zip(words, got):
        want = plain_best(w, pieces)
        assert score == pytest.approx(want[0]) and n == want[1], w


def test_token_counts_of_awkward_rows(spark):
    path = P.path("piece_bpe_32k.model")
    out = C.count_tokens(documents(spark, awkward()), path).collect()
    assert len(out) == len(awkward())
    by = {r.doc_id: r for r in out}
    assert (by[1].n_words, by[1].n_tokens) == (by[2].n_words, by[2].n_tokens) == (by[3].n_words, by[3].n_tokens) == (0, 0)
    pieces = C.sentencepiece_pieces(path)
    for d in (4, 6, 8):
        text = dict(awkward())[d]
        assert by[d].n_words == len(text.split())
        plain = [plain_best(C.MARK + w, pieces) for w in text.split() if len(w) < 12]
        if len(plain) == by[d].n_words:
            assert by[d].n_tokens == sum(n for _, n in plain)
    assert C.count_tokens(documents(spark, []), path).count() == 0
