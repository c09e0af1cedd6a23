"""Byte-level BPE encoding and decoding by recursive queries in DuckDB, run
inside each partition's task.

Rows are (word, position, token, next token).  A step joins them with the merge
table, takes each word's leftmost pair of least rank, contracts it, and goes on
with the words that changed, until no word has a pair to merge.  Words that are tokens
themselves need no step.  Decoding joins (document, position, id) rows with the
vocabulary and concatenates by an ordered aggregate.

A word is contracted in blocks of ``BLOCK`` bytes, so the steps don't grow with it.
Encodings of neighbouring blocks join to that of the whole when the last token of one
and the first of the next are the encoding of their joined bytes: a sequence of tokens
is an encoding exactly when all neighbours in it are.  Where they are not, the two blocks
are contracted together and cut again at a token's edge near their middle; blocks that
still don't fit after ``TURNS`` rounds grow together.

Each worker holds one in-memory database with a memory limit, one thread and no folder
for spilled data, and caches words (``tokens.ChunkEncoder``).  Null and empty texts have no
ids; a null ``doc_id`` stays null; repeated rows each give a row; words of any length are
encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tollgate.llm.common import map_batches, worker_state
from tollgate.llm.tokens import ChunkEncoder, pack, unproven

#: Bytes of a word that are contracted together, and rounds in which blocks are cut anew.
BLOCK, TURNS = 48, 12
#: Rows that the steps of an encoding query may make; ids per decoding query.
QUERY_ROWS, DECODE_IDS = 2_000_000, 200_000
#: Bytes of a generation of cached chunks and words, of which a worker has two: a word
#: that is not cached costs a share of a query.
CACHE_BYTES = (64 << 20, 96 << 20)

_LAST = """
SELECT word, list(tok ORDER BY pos) AS ids
FROM steps JOIN (SELECT word, max(it) AS it FROM steps GROUP BY word) USING (word, it)
GROUP BY word
"""

ENCODE_SQL = (
    """
WITH RECURSIVE steps(word, it, pos, tok, nxt, nxtpos) AS (
  SELECT word, 0, pos, tok, lead(tok) OVER w, lead(pos) OVER w
  FROM start WINDOW w AS (PARTITION BY word ORDER BY pos)
  UNION ALL
  SELECT s.word, s.it + 1, s.pos,
         CASE WHEN s.pos = b.pos THEN b.rank ELSE s.tok END,
         CASE WHEN s.pos = b.pos THEN b.after WHEN s.nxtpos = b.pos THEN b.rank ELSE s.nxt END,
         CASE WHEN s.pos = b.pos THEN b.afterpos ELSE s.nxtpos END
  FROM steps s JOIN (
    SELECT word, (best >> 20)::INTEGER AS rank, (best & 1048575)::INTEGER AS pos, gone, after, afterpos
    FROM (
      SELECT word, min(key) AS best, arg_min(nxtpos, key) AS gone
      FROM (SELECT word, nxtpos, (rank::BIGINT << 20) + pos AS key
            FROM steps JOIN merges ON pair = (tok::BIGINT << 20) + nxt)
      GROUP BY word
    ) JOIN (SELECT word, pos AS gone, nxt AS after, nxtpos AS afterpos FROM steps) USING (word, gone)
  ) b USING (word)
  WHERE s.pos <> b.gone
)"""
    + _LAST
)

DECODE_SQL = """
SELECT doc, list(bytes ORDER BY pos) AS parts FROM ids JOIN vocabulary USING (id) GROUP BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def splitter(pattern: str):
    """``findall`` of the pattern with tiktoken's idea of letters and numbers: for code
    points in which it and the ``regex`` package may differ, tiktoken itself is asked
    for their class, and a character of that class stands in while the text is split."""
    import regex
    import tiktoken

    find, odd = regex.compile(pattern), unproven()
    single = {bytes([b]): b for b in range(256)}

    def matches(name: str, c: str) -> bool:
        return bool(tiktoken.Encoding(name, pat_str=name, mergeable_ranks=single, special_tokens={}).encode_ordinary(c))

    classes = [(r"\p{L}", "a"), (r"\p{N}", "1"), (r"\s", "\t")]
    stands: dict[int, str] = {}

    def split(text: str) -> list[str]:
        if text.isascii() or not odd.search(text):
            return find.findall(text)
        for c in set(odd.findall(text)):
            if ord(c) not in stands:
                stands[ord(c)] = next((s for name, s in classes if matches(name, c)), "*")
        return [text[m.start() : m.end()] for m in find.finditer(text.translate(stands))]

    return split


def unpacked(ids: bytes) -> list[int]:
    return np.frombuffer(ids, "<u4").tolist()


class DuckBPE:
    """A database with the merge table of a rank file."""

    def __init__(self, path: str, pattern: str, memory: str = "256MB"):
        import duckdb

        self.ranks = read_ranks(path)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.byte_rank = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs, merged = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append((left << 20) + right)
                    merged.append(rank)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": memory, "temp_directory": ""})
        self._load("merges", pa.table({"pair": pa.array(pairs, pa.int64()), "rank": pa.array(merged, pa.int32())}))
        self._load(
            "vocabulary",
            pa.table({"id": pa.array(list(self.ranks.values()), pa.int32()), "bytes": pa.array(list(self.ranks), pa.binary())}),
        )
        self.chunks = ChunkEncoder(splitter(pattern), self.encode_words, CACHE_BYTES)

    def _load(self, name: str, table: pa.Table) -> None:
        self.db.register("incoming", table)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def _query(self, view: str, table: pa.Table, sql: str) -> pa.Table:
        self.db.register(view, table)
        try:
            return self.db.sql(sql).to_arrow_table()
        finally:
            self.db.unregister(view)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word, in order."""
        raw = [w.encode() for w in words]
        long = [i for i, r in enumerate(raw) if len(r) > BLOCK and r not in self.ranks]
        if not long:
            known = self._contracted(raw)
            return [known[r] for r in raw]
        blocks = {i: [raw[i][k : k + BLOCK] for k in range(0, len(raw[i]), BLOCK)] for i in long}
        whole = [r for i, r in enumerate(raw) if i not in blocks]
        known = self._contracted(whole + [b for parts in blocks.values() for b in parts])
        out = [b"" if i in blocks else known[r] for i, r in enumerate(raw)]
        settled = self._settled([[(b, unpacked(known[b])) for b in parts] for parts in blocks.values()])
        for i, ids in zip(blocks, settled):
            out[i] = pack(ids)
        return out

    def _contracted(self, parts: list[bytes]) -> dict[bytes, bytes]:
        """Packed ids of each distinct byte string, contracted as a whole."""
        ranks = self.ranks
        out = {part: pack([ranks[part]]) if part else b"" for part in parts if part in ranks or not part}
        todo = [part for part in dict.fromkeys(parts) if part not in out]
        at = 0
        while at < len(todo):
            end, rows = at, 0
            while end < len(todo) and (end == at or rows + len(todo[end]) ** 2 // 2 <= QUERY_ROWS):
                rows += len(todo[end]) ** 2 // 2
                end += 1
            some = todo[at:end]
            got = self._query("start", self._start(some), ENCODE_SQL)
            ids = got.column("ids").combine_chunks()
            flat = ids.flatten().to_numpy().astype("<u4").tobytes()
            edge = ((ids.offsets.to_numpy() - ids.offsets[0].as_py()) * 4).tolist()
            for w, a, b in zip(got.column("word").to_pylist(), edge, edge[1:]):
                out[some[w]] = flat[a:b]
            at = end
        return out

    def _settled(self, words: list[list[tuple[bytes, list]]]) -> list[list]:
        """Ids of words given in blocks and their ids: every edge between blocks is
        checked, and moved where it cuts a token of the whole."""
        fits: dict[tuple, bool] = {}
        for turn in itertools.count():
            edges = {(a[1][-1], b[1][0]) for blocks in words for a, b in zip(blocks, blocks[1:])} - fits.keys()
            joined = {pair: self.tokens[pair[0]] + self.tokens[pair[1]] for pair in edges}
            known = self._contracted(list(joined.values()))
            fits.update((pair, known[both] == pack(list(pair))) for pair, both in joined.items())
            wrong = [self._apart(blocks, fits) for blocks in words]
            if not any(wrong):
                return [[i for _, ids in blocks for i in ids] for blocks in words]
            known = self._contracted([blocks[k][0] + blocks[k + 1][0] for blocks, at in zip(words, wrong) for k in at])
            words = [
                self._moved(blocks, set(at), known, turn < TURNS) if at else blocks for blocks, at in zip(words, wrong)
            ]

    @staticmethod
    def _apart(blocks: list, fits: dict) -> list[int]:
        """Blocks that don't fit their next one, no two of them neighbours."""
        out: list[int] = []
        for k in range(len(blocks) - 1):
            if not fits[(blocks[k][1][-1], blocks[k + 1][1][0])] and (not out or out[-1] < k - 1):
                out.append(k)
        return out

    def _moved(self, blocks: list, at: set[int], known: dict, cut: bool) -> list:
        """The blocks with each one of ``at`` and its next contracted together."""
        out, k = [], 0
        while k < len(blocks):
            if k not in at:
                out.append(blocks[k])
                k += 1
                continue
            both = blocks[k][0] + blocks[k + 1][0]
            ids = unpacked(known[both])
            ends = list(itertools.accumulate(len(self.tokens[i]) for i in ids))
            if cut and len(ids) > 1:
                n = min(range(1, len(ids)), key=lambda n: abs(2 * ends[n - 1] - len(both)))
                out += [(both[: ends[n - 1]], ids[:n]), (both[ends[n - 1] :], ids[n:])]
            else:
                out.append((both, ids))
            k += 2
        return out

    def _start(self, raw: list[bytes]) -> pa.Table:
        sizes = np.array([len(b) for b in raw])
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        tok = self.byte_rank[np.frombuffer(b"".join(raw), np.uint8)]
        return pa.table(
            {
                "word": np.repeat(np.arange(len(raw), dtype=np.int32), sizes),
                "pos": (np.arange(len(tok)) - first + 1).astype(np.int32),
                "tok": tok,
            }
        )

    def decode(self, ids: list[bytes]):
        """Yields (index, bytes) pieces in order, a bounded number of ids at a time."""
        rows: list[tuple[int, np.ndarray]] = []
        held = 0
        for i, raw in enumerate(ids):
            whole = np.frombuffer(raw, "<u4")
            for at in range(0, len(whole), DECODE_IDS):
                part = whole[at : at + DECODE_IDS]
                if held and held + len(part) > DECODE_IDS:
                    yield from self._decode(rows)
                    rows, held = [], 0
                rows.append((i, part))
                held += len(part)
        if rows:
            yield from self._decode(rows)

    def _decode(self, rows):
        sizes = np.array([len(p) for _, p in rows])
        table = pa.table(
            {
                "doc": np.repeat(np.arange(len(rows), dtype=np.int32), sizes),
                "pos": np.arange(sizes.sum(), dtype=np.int32),
                "id": np.concatenate([p for _, p in rows]).astype(np.int32),
            }
        )
        got = self._query("ids", table, DECODE_SQL)
        parts = dict(zip(got.column("doc").to_pylist(), got.column("parts")))
        for k, (i, _) in enumerate(rows):
            values = parts[k].values
            edge = np.frombuffer(values.buffers()[1], np.int32, len(values) + values.offset + 1)
            start, end = int(edge[values.offset]), int(edge[values.offset + len(values)])
            yield i, values.buffers()[2].slice(start, end - start).to_pybytes()


def encoder(path: str, pattern: str) -> DuckBPE:
    """One database per worker and rank file."""
    return worker_state((path, pattern, "duckdb"), lambda: DuckBPE(path, pattern))


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids binary, decoded binary``: ids as little-endian unsigned 32-bit
    integers, and the bytes they decode to; narrow."""

    def run(cols):
        bpe = encoder(path, pattern)
        ids = bpe.chunks.ids(cols["text"])
        parts: list[list[bytes]] = [[] for _ in ids]
        for i, piece in bpe.decode(ids):
            parts[i].append(piece)
        return {"doc_id": cols["doc_id"], "ids": ids, "decoded": [b"".join(p) for p in parts]}

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, ids binary, decoded binary")


def encode_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """As ``encode_documents``, reduced to digests where the ids are made."""

    def run(cols):
        bpe = encoder(path, pattern)
        ids = bpe.chunks.ids(cols["text"])
        digests = [hashlib.sha256() for _ in ids]
        for i, piece in bpe.decode(ids):
            digests[i].update(piece)
        return {
            "doc_id": cols["doc_id"],
            "n_tokens": [len(b) // 4 for b in ids],
            "ids_sha256": [hashlib.sha256(b).hexdigest() for b in ids],
            "decoded_sha256": [d.hexdigest() for d in digests],
        }

    return map_batches(
        docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
