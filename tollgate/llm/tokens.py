"""Token ids of whole texts through a word cache.

Byte-level and word-end tokenizers split a text into *pre-tokens* by a
pattern before they merge.  No pre-token spans the place before a space that
follows a non-space character, so a text can be cut there into chunks, each
chunk encoded once per worker, and the ids joined.  Chunks that are not
cached are split by the pattern, and only pre-tokens not cached go to the
tokenizer.  The ids are those of encoding the whole text with the library.

Two kinds of text go through the library's own whole-text call instead: those that
contain one of its added tokens (``<|endoftext|>``), which it takes out before anything
else, and those with a code point outside ``proven``: the libraries and the
``regex`` package follow different versions of Unicode, and differ in what they take for
a letter only where Python's tables have no character (yet), or beyond U+FFFF.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from collections.abc import Callable

import numpy as np

from tollgate.llm.common import WordCache, worker_state

_EDGE = re.compile(r"(?<=\S)(?= )")
_SPACE_BEFORE_SPACE = re.compile(r"\s ")
#: Bytes of a generation of an encoder's caches, of which it has two: chunks, words.
CACHE_BYTES = (40 << 20, 8 << 20)
_GROUP_CHARS = 1_000_000  # characters of the texts that are cut at a time


def unproven() -> re.Pattern:
    """Matches a code point in which the libraries may differ: one without a
    character in Python's Unicode tables, or beyond U+FFFF."""
    known = [not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn" for c in range(0x10000)]
    edges = np.flatnonzero(np.diff(np.array([False, *known, False]).view(np.int8)))
    spans = "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2]))
    return re.compile(f"[^{spans}]")


def groups(texts: list) -> list[list]:
    """Texts in order, in groups of about ``_GROUP_CHARS`` characters."""
    out, size = [[]], 0
    for t in texts:
        if size > _GROUP_CHARS:
            out.append([])
            size = 0
        out[-1].append(t)
        size += len(t or "")
    return out


def chunks(text: str) -> list[str]:
    """Cut before each space that follows a non-space; joined, the text."""
    if "\0" in text or _SPACE_BEFORE_SPACE.search(text):
        return _EDGE.split(text)
    return text.replace(" ", "\0 ").split("\0")


class ChunkEncoder:
    """``split(chunk)`` gives pre-tokens, ``encode(pretokens)`` their packed ids."""

    def __init__(
        self, split: Callable[[str], list[str]], encode: Callable[[list[str]], list], cache_bytes: tuple[int, int] = CACHE_BYTES
    ):
        self.split, self.encode = split, encode
        self.chunks, self.words = (WordCache(None, n) for n in cache_bytes)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null counts as empty."""
        out: list[bytes] = []
        for some in groups(texts):
            out += self._ids(some)
        return out

    def _ids(self, texts: list[str | None]) -> list[bytes]:
        self.chunks, self.words = self.chunks.room(), self.words.room()
        parts = [chunks(t) if t else [] for t in texts]
        need: set = set()
        need.update(*parts)
        missing = self.chunks.missing(need)
        pre = [self.split(c) for c in missing]
        wanted: set = set()
        wanted.update(*pre)
        new = self.words.missing(wanted)
        known, words = self.chunks, self.words
        for word, ids in zip(new, self.encode(new) if new else ()):
            words.keep(word, ids)
        for c, p in zip(missing, pre):
            known.keep(c, b"".join(map(words.__getitem__, p)))
        out = [b"".join(map(known.__getitem__, p)) for p in parts]
        for cache, used in ((known, missing), (words, new)):
            for w in used:
                if len(w) > cache.LONGEST:
                    del cache[w]
        return out


def byte_characters() -> dict[int, str]:
    """The printable character that byte-level models use for each byte: itself
    for printable Latin-1, the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(spare)) for b in range(256)}


def _load(path: str):
    """A tokenizer file: (whole-text encoder, model step of one pre-token, test
    for texts that only the whole-text encoder takes)."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    model, table = tokenizer.model, byte_characters()
    shown = [table[b] for b in range(256)].__getitem__
    added = sorted(t.content for t in tokenizer.get_added_tokens_decoder().values())
    # Whether an added token may be in a text: its first two marks are looked for.
    marks = sorted({t[:2] for t in added})
    odd = unproven().search

    def whole(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    def needs_whole(text: str) -> bool:
        return any(m in text for m in marks) or (not text.isascii() and odd(text) is not None)

    tokenize, space = model.tokenize, table[32]

    def step(word: str) -> list[int]:
        if word.isascii() and word.isalnum():
            mapped = word  # printable ASCII stands for itself
        elif word[0] == " " and word.isascii() and word[1:].isalnum():
            mapped = space + word[1:]
        else:
            mapped = "".join(map(shown, word.encode()))
        return [t.id for t in tokenize(mapped)]

    return whole, step, needs_whole


_PACK = [struct.Struct(f"<{n}I").pack for n in range(33)]


def pack(ids: list[int]) -> bytes:
    return _PACK[len(ids)](*ids) if len(ids) < 33 else struct.pack(f"<{len(ids)}I", *ids)


_MARKS = frozenset(".,;:!?")
_RARE_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
_RARE_ASCII = "".join(c for c in _RARE_SPACES if c.isascii())


def spacing(text: str) -> tuple[bool, bool]:
    """Whether every space follows a character that is not white space, so that the
    text may be cut before each (and no null character is there, which stands for a line
    feed in the chunks); and whether, besides, every line feed stands alone between
    characters that are not white space, and is a pre-token."""
    if "  " in text or "\n " in text or "\0" in text:
        return False, False
    rare = [c for c in (_RARE_ASCII if text.isascii() else _RARE_SPACES) if c in text]
    if rare:
        return not any(c + " " in text for c in rare), False
    return True, "\n\n" not in text and " \n" not in text


class LibraryEncoder:
    """Whole-text ids of a byte-level file: the text is cut before spaces, and each
    distinct word goes through the pattern and the library's model once."""

    def __init__(self, path: str, find: Callable[[str], list[str]], cache_bytes: tuple[int, int] = CACHE_BYTES):
        self.whole, self.step, self.needs_whole = _load(path)
        self.find = find
        self.spaced = WordCache(self._spaced, cache_bytes[0])  # chunks, without the space in front
        self.words = WordCache(lambda w: pack(self.step(w)), cache_bytes[1])  # pre-tokens

    def _spaced(self, word: str) -> bytes:
        if word.isalpha():
            return pack(self.step(" " + word))
        if word[:1] == "\0":  # stands for a line feed, with no space in front
            return self.words["\n"] + self._chunk(word[1:])
        if word[-1:] in _MARKS and word[:-1].isalpha():
            return self.spaced[word[:-1]] + self.words[word[-1]]
        return self._chunk(" " + word)

    def _chunk(self, chunk: str) -> bytes:
        return b"".join([self.spaced[p[1:]] if p[0] == " " and p[1:].isalpha() else self.words[p] for p in self.find(chunk)])

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null counts as empty."""
        out = []
        for text in texts:
            self.words, self.spaced = self.words.room(), self.spaced.room()
            if not text:
                out.append(b"")
            elif self.needs_whole(text):
                out.append(pack(self.whole(text)))
            else:
                out.append(self._cut(text))
        return out

    def _cut(self, text: str) -> bytes:
        at_spaces, at_lines = spacing(text)
        if not at_spaces:
            return b"".join(map(self._chunk, _EDGE.split(text)))
        first, *rest = (text.replace("\n", " \0") if at_lines else text).split(" ")
        ids = b"".join(map(self.spaced.__getitem__, rest))
        return self._chunk(first) + ids if first else ids


class WordEndEncoder:
    """Whole-text ids of a lower-casing file with word ends, which drops white
    space.  Words that composition or a final sigma could change go through the
    library whole."""

    def __init__(self, path: str, find: Callable[[str], list[str]], cache_bytes: tuple[int, int] = CACHE_BYTES):
        self.whole, self.step, self.needs_whole = _load(path)
        self.find = find
        self.chunks = WordCache(self._chunk, cache_bytes[0])
        self.words = WordCache(lambda w: pack(self.step(w)), cache_bytes[1])  # lower-cased pre-tokens

    def _chunk(self, chunk: str) -> bytes:
        if not chunk.isascii() and ("\u03a3" in chunk or not unicodedata.is_normalized("NFC", chunk)):
            return pack(self.whole(chunk))
        low = chunk.lower()
        if low.isalpha():  # held once: here, or as the lower-cased chunk
            return self.chunks[low] if low != chunk else pack(self.step(low))
        if low[-1:] in _MARKS and low[:-1].isalpha():
            return self.chunks[low[:-1]] + self.words[low[-1]]
        return b"".join(map(self.words.__getitem__, self.find(low)))

    def ids(self, texts: list[str | None]) -> list[bytes]:
        out = []
        for text in texts:
            self.words, self.chunks = self.words.room(), self.chunks.room()
            if not text:
                out.append(b"")
            elif self.needs_whole(text):
                out.append(pack(self.whole(text)))
            else:
                # White space is dropped, whichever it is.
                out.append(b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" "))))
        return out


def library_encoder(path: str, pattern: str, cache_bytes: tuple[int, int] = CACHE_BYTES) -> LibraryEncoder:
    """The ``tokenizers`` library's encoder of a byte-level file, kept in the worker.
    ``pattern`` is the file's own."""
    import regex

    return worker_state((path, pattern), lambda: LibraryEncoder(path, regex.compile(pattern).findall, cache_bytes))


def word_end_encoder(path: str, cache_bytes: tuple[int, int] = CACHE_BYTES) -> WordEndEncoder:
    """The library's encoder of a lower-casing file with word ends, kept in the worker."""
    import regex

    pattern = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
    return worker_state((path, "words"), lambda: WordEndEncoder(path, regex.compile(pattern).findall, cache_bytes))
