"""Token ids as bytes (little-endian unsigned 32-bit), by the tokenizers library.

Both public vocabularies split a text at spaces before they merge bytes, so a text's ids are those of its
space-separated chunks in a row. Each distinct chunk is encoded once and kept in a bounded cache. Texts that hold the
literal of an added token (<|endoftext|>) are encoded whole.
"""

from __future__ import annotations

import os
import re
import sys
import types
import unicodedata
from array import array

#: Bytes of a worker's cache of chunks. A chunk that alone is larger is not kept.
CACHE_BYTES = 64 << 20

END_ID = 1
END_BYTES = END_ID.to_bytes(4, "little")

#: A space before white space or the end, and one with white space (or the start) before it as well: only there do
#: chunks depend on their neighbours.
_SUSPECT = re.compile(r" (?:\s|$)")
_RUN = re.compile(r"(?:\s|^) (?:\s|$)")


def _worker_caches() -> dict[tuple[str, bool], _Chunks]:
    """Caches that outlive a task: a Python worker runs many, and functions sent by value keep no globals."""
    return vars(sys.modules.setdefault("_chunk_caches", types.ModuleType("_chunk_caches"))).setdefault("caches", {})


#: The byte-level alphabet, a printable character for each byte.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
BYTE_LETTERS = {b: chr(b) if b in _PRINTABLE else chr(256 + _OTHERS.index(b)) for b in range(256)}


class _Chunks(dict):
    """Ids of chunks, made when first asked for. When half of the cache is full it becomes the older half; the former older
    half goes, but for what was asked for since."""

    def __init__(self, tokenizer, keep_space: bool):
        super().__init__()
        self.tokenizer = tokenizer
        self.bytes, self.most_bytes = 0, CACHE_BYTES
        self.marks: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.prefix = " " if keep_space else ""
        added = [x.content for x in tokenizer.get_added_tokens_decoder().values()]
        self.added = added if keep_space else [x.lower() for x in added]

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def word(self, letters: str) -> bytes:
        """A chunk of letters only is one word of the vocabulary's splitting rule: straight to the merges."""
        text = letters
        if not self.prefix:
            if letters.isascii():
                text = letters.lower()
            else:
                text = "".join(c.lower() for c in unicodedata.normalize("NFC", letters))
            if not text.isalpha():
                return self.whole(letters)
        text = (self.prefix + text).encode().decode("latin-1").translate(BYTE_LETTERS)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(text)]).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        found = self.older.pop(chunk, None)
        if found is not None:
            pass
        elif not chunk:
            found = self.whole(self.prefix)
        elif chunk.isalpha():
            found = self.word(chunk)
        elif chunk[-1] in ".," and chunk[:-1].isalpha() and (self.prefix or chunk[:-1].lower().isalpha()):
            found = self[chunk[:-1]] + self._mark(chunk[-1])
        else:
            found = self.whole(self.prefix + chunk)
        # Three objects of about 50 bytes each besides their contents.
        cost = len(chunk) + len(found) + 150
        if self.bytes + cost > self.most_bytes // 2:
            self.older = dict(self)
            self.clear()
            self.bytes = 0
        if cost <= self.most_bytes // 2:
            self[chunk] = found
            self.bytes += cost
        return found

    def _mark(self, mark: str) -> bytes:
        """A mark after letters has no space of its own."""
        return self.marks.get(mark) or self.marks.setdefault(mark, self.whole(mark))


class ChunkEncoder:
    """Encodes texts chunk by chunk.

    keep_space: whether a chunk owns the space before it (byte-level vocabularies) or spaces are dropped.
    cache_bytes: the cache never grows beyond this; results do not depend on it.
    """

    def __init__(self, path: str, keep_space: bool, cache_bytes: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.keep_space = keep_space
        caches = _worker_caches()
        if (path, keep_space) not in caches:
            caches[path, keep_space] = _Chunks(Tokenizer.from_file(path), keep_space)
        self.cache = caches[path, keep_space]
        self.cache.most_bytes = CACHE_BYTES if cache_bytes is None else cache_bytes

    def encode_one(self, text: str | None) -> bytes:
        if not text:
            return b""
        # An added token's literal has an id of its own, and one in capitals has none but would gain it in lower case.
        folded = text if self.keep_space else text.lower()
        if any(x in folded for x in self.cache.added):
            return self.cache.whole(text)
        if not self.keep_space:
            if "\u03a3" not in text and unicodedata.is_normalized("NFC", text):
                text = folded  # fewer distinct chunks; the sigma's lower case depends on its place
            return b"".join(map(self.cache.__getitem__, text.replace("\n", " ").split(" ")))
        if _SUSPECT.search(text) and _RUN.search(text):
            return self.cache.whole(text)
        first, *rest = text.split(" ")
        return (self.cache.whole(first) if first else b"") + b"".join(map(self.cache.__getitem__, rest))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of every whole text, without an end id. A null text has none."""
        return [self.encode_one(x) for x in texts]


def batched(texts: list[str | None], most_chars: int = 4_000_000):
    """Runs of texts of at most so many characters (one text at least), as slices."""
    start, total = 0, 0
    for i, x in enumerate(texts):
        n = len(x) if x else 0
        if i > start and total + n > most_chars:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(texts):
        yield slice(start, len(texts))
