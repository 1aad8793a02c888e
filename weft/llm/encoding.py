"""Whole-text encoding with a public tokenizer file.

The word-level BPE file drops white space, so no token spans it and a text's
ids are the ids of its word parts one after another. Tasks keep a bounded
dictionary of parts already encoded by the library: natural text repeats its
words, so most parts cost one lookup. A test compares the
result with the library's own encoding of the whole text on random Unicode.
"""

from __future__ import annotations

import re
import struct

import numpy as np
from pyspark.sql import SparkSession

DEFAULT_TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Entries of a Python worker's dictionary of encoded word parts (about 70 MB).
CACHE_ENTRIES = 400_000
#: Longer parts are not kept.
KEPT_CHARS = 64

# Separators Python splits on but the tokenizer's \s does not know.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_SPACE = re.compile("[ \t\n\r\x0b\x0c\x85\xa0  -     　]+")
# Texts whose normal form is plain lower case: no decomposed or special characters, no special token.
_PLAIN = re.compile("[\t-\r -;=-~À-ÖØ-öø-ÿ]*")
# The file's own word pattern, restricted to those characters.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer file as text (its size is a constant of the vocabulary),
    so that executors need no copy of the file at the driver's path."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(DEFAULT_TOKENIZER)
    with open(path, encoding="utf-8") as f:
        return f.read()


def broadcast_tokenizer(spark: SparkSession, path: str | None = None):
    return spark.sparkContext.broadcast(tokenizer_json(path))


def chunks(text: str) -> list[str]:
    """White-space separated chunks by the tokenizer's idea of white space."""
    if _ODD_SPACE.search(text):
        return [c for c in _SPACE.split(text) if c]
    return text.split()


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE's printable letter for each byte."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: chr(b) for b in keep} | {b: chr(0x100 + i) for i, b in enumerate(x for x in range(256) if x not in set(keep))}


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian uint32 bytes."""
    return struct.pack(f"<{len(ids)}I", *ids)


class _Parts(dict):
    """Normalised word part -> its ids as little-endian uint32 bytes."""

    def __init__(self, model):
        self.model, self.letters = model, _byte_letters()

    def __missing__(self, part: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        ids = _packed([t.id for t in self.model.tokenize(letters)])
        if len(part) < KEPT_CHARS:
            self[part] = ids
        return ids


class _Words:
    """Encodes texts part by part; other than plain chunks go to the library."""

    def __init__(self, tokenizer):
        self.tokenizer, self.parts = tokenizer, _Parts(tokenizer.model)

    def ids(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text):
            return b"".join(map(self.parts.__getitem__, _PARTS.findall(text.lower())))
        return b"".join(map(self._chunk, chunks(text)))

    def _chunk(self, chunk: str) -> bytes:
        if _PLAIN.fullmatch(chunk):
            return b"".join(map(self.parts.__getitem__, _PARTS.findall(chunk.lower())))
        if (known := self.parts.get(chunk)) is None:
            known = _packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
            if len(chunk) < KEPT_CHARS and chunk != chunk.lower():
                self.parts[chunk] = known
        return known


def drops_space(tokenizer) -> bool:
    """Whether white space never reaches a token, so that chunks are independent."""
    probe = tokenizer.encode("a \n\t b", add_special_tokens=False).ids
    alone = [i for c in "ab" for i in tokenizer.encode(c, add_special_tokens=False).ids]
    return probe == alone


def is_word_bpe(tokenizer) -> bool:
    """Whether the file normalises and splits as ``_PARTS`` assumes (checked on
    a probe); other files take the library's whole-text path."""
    if not drops_space(tokenizer):
        return False
    probe = "Don't STOP,we'LL(re)2x42 éÀß!?... 'sa it's"
    return _Words(tokenizer).ids(probe) == _packed(tokenizer.encode(probe, add_special_tokens=False).ids)


class Encoder:
    """Encodes whole texts; one per Python worker, see ``encoder``."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.words = _Words(self.tokenizer) if is_word_bpe(self.tokenizer) else None

    def ids(self, text: str | None) -> bytes:
        """Ids of the whole text (null: empty) as little-endian uint32 bytes."""
        if not text:
            return b""
        if self.words is not None:
            return self.words.ids(text)
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)


    def groups(self, text: str | None):
        """Runs of neighbouring tokens of the whole text: first and one past
        the last character, number of tokens, and a function that gives the
        character spans of the tokens of run ``i``. Runs are the word parts
        where those are known, else single tokens."""
        if self.words is not None and _PLAIN.fullmatch(text or ""):
            lower, parts = (text or "").lower(), self.words.parts
            found = list(_PARTS.finditer(lower))
            starts = np.fromiter((m.start() for m in found), np.int64, len(found))
            ends = np.fromiter((m.end() for m in found), np.int64, len(found))
            counts = np.fromiter((len(parts[m.group()]) // 4 for m in found), np.int64, len(found))

            def inside(i: int) -> list[tuple[int, int]]:
                at = int(starts[i])
                return [(at + a, at + b) for a, b in self.tokenizer.encode(found[i].group(), add_special_tokens=False).offsets]

            return starts, ends, counts, inside
        offsets = self.tokenizer.encode(text or "", add_special_tokens=False).offsets
        spans = np.asarray(offsets, np.int64).reshape(-1, 2)
        return spans[:, 0], spans[:, 1], np.ones(len(spans), np.int64), lambda i: [offsets[i]]


_ENCODERS: dict[int, Encoder] = {}


def encoder(spec: str) -> Encoder:
    """The worker's encoder for a tokenizer file, kept between tasks."""
    key = hash(spec)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]
