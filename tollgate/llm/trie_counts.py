"""Token counts under a unigram model, by dynamic programming over a trie.

The model's pieces and scores come from a public vocabulary file.  A
pre-token is a white-space word with the word mark in front.  Distinct new
pre-tokens are inserted in a trie; a depth-first walk computes, per node, the best
score of a segmentation of its prefix and the number of tokens in it, once for
all words that share the prefix, and stores both at terminal nodes.  Ties go to
fewer tokens.  A character without a piece costs its UTF-8 bytes, as tokens.

Counts are cached per worker by word.  Words of any length are scored whole, the longer
ones one by one.  Null, empty and blank texts have no words and no
tokens; a null ``doc_id`` stays null; repeated rows each give a row.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame

from tollgate.llm.common import WordCache, map_batches, worker_state
from tollgate.llm.tokens import groups

MARK = "▁"
#: Log score of a byte of a character that has no piece.
BYTE_SCORE = -20.0
#: Longer words share no trie: a node for each of their characters would be held.
LONG_WORD = 1_000
#: Bytes of a generation of cached words, of which a worker has two.
CACHE_BYTES = 80 << 20


class TrieCounter:
    """``pieces``: piece -> log score."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.cache = WordCache(None, CACHE_BYTES)

    def insert(self, words: list[str]) -> dict:
        """The trie of the words: nested dicts by character, a word's
        number under the empty string."""
        root: dict = {}
        for number, word in enumerate(words):
            node = root
            for c in word:
                node = node.setdefault(c, {})
            node[""] = number
        return root

    def score(self, words: list[str]) -> list[tuple[float, int]]:
        """(best score, tokens) of each distinct word."""
        out: list = [(0.0, 0)] * len(words)
        pieces, longest = self.pieces, self.longest
        best: list[float] = [0.0]  # by prefix length along the current path
        tokens: list[int] = [0]
        path = ""  # words here have ``LONG_WORD`` characters at most
        stack = [iter(self.insert(words).items())]
        while stack:
            step = next(stack[-1], None)
            if step is None:
                stack.pop()
                if path:
                    path = path[:-1]
                    best.pop()
                    tokens.pop()
                continue
            symbol, below = step
            if symbol == "":
                out[below] = (best[-1], tokens[-1])
                continue
            path += symbol
            n = len(path)
            top, count = -math.inf, 0
            for start in range(max(0, n - longest), n):
                score = pieces.get(path[start:])
                if score is not None:
                    total = best[start] + score
                    if total > top or (total == top and tokens[start] + 1 < count):
                        top, count = total, tokens[start] + 1
            if symbol not in pieces:
                size = len(symbol.encode("utf-8", "surrogatepass"))
                total = best[n - 1] + BYTE_SCORE * size
                if total > top:
                    top, count = total, tokens[n - 1] + size
            best.append(top)
            tokens.append(count)
            stack.append(iter(below.items()))
        return out

    def _extended(self, window: str, best, tokens) -> tuple[float, int]:
        """Best score and tokens of a prefix that ends in ``window``, from those of
        all shorter prefixes (the last ones of ``best`` and ``tokens``)."""
        top, count = -math.inf, 0
        pieces, size = self.pieces, len(window)
        for start in range(size):
            score = pieces.get(window[start:])
            if score is not None:
                total = best[start - size] + score
                if total > top or (total == top and tokens[start - size] + 1 < count):
                    top, count = total, tokens[start - size] + 1
        symbol = window[-1]
        if symbol not in pieces:
            cost = len(symbol.encode("utf-8", "surrogatepass"))
            total = best[-1] + BYTE_SCORE * cost
            if total > top:
                top, count = total, tokens[-1] + cost
        return top, count

    def chain(self, word: str) -> tuple[float, int]:
        """Score and tokens of one long word, whose trie would be a chain: only the
        prefixes that a piece can reach back to are held."""
        best, tokens = deque([0.0], self.longest), deque([0], self.longest)
        for n in range(1, len(word) + 1):
            top, count = self._extended(word[max(0, n - self.longest) : n], best, tokens)
            best.append(top)
            tokens.append(count)
        return best[-1], tokens[-1]

    def counts(self, texts: list[str | None]) -> list[tuple[int, int, float]]:
        """(words, tokens, log score) of each text."""
        out = []
        for some in groups(texts):
            out += self._counts(some)
        return out

    def _counts(self, texts):
        self.cache = self.cache.room()
        parts = [t.split() if t else [] for t in texts]
        need: set = set()
        need.update(*parts)
        new = self.cache.missing(need)
        known = self.cache
        for word in new:
            if len(word) > LONG_WORD:
                known.keep(word, self.chain(MARK + word))
        new_short = [w for w in new if len(w) <= LONG_WORD]
        for at in range(0, len(new_short), 50_000):  # bounds the trie
            some = new_short[at : at + 50_000]
            for word, got in zip(some, self.score([MARK + w for w in some])):
                known.keep(word, got)
        out = []
        for words in parts:
            got = [known[w] for w in words]
            out.append((len(words), sum(g[1] for g in got), math.fsum(g[0] for g in got)))
        for w in new:
            if len(w) > known.LONGEST:
                del known[w]
        return out


def sentencepiece_pieces(path: str) -> dict[str, float]:
    """Pieces of a model file with Zipf log scores by their rank: the file's
    own scores of a merge vocabulary are ranks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [
        (i, model.id_to_piece(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    order = sorted(normal, key=lambda x: (-model.get_score(x[0]), x[0]))
    return {piece: -math.log(rank + 2.0) for rank, (_, piece) in enumerate(order)}


def counter(key: str, load: Callable[[str], dict]) -> TrieCounter:
    return worker_state(key, lambda: TrieCounter(load(key)))


def count_tokens(docs: DataFrame, path: str, load: Callable[[str], dict] = sentencepiece_pieces) -> DataFrame:
    """``doc_id, n_words, n_tokens, log_score`` of every whole text; narrow."""

    def run(cols):
        got = counter(path, load).counts(cols["text"])
        return {
            "doc_id": cols["doc_id"],
            "n_words": [g[0] for g in got],
            "n_tokens": [g[1] for g in got],
            "log_score": [round(g[2], 6) for g in got],
        }

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_words long, n_tokens long, log_score double")
