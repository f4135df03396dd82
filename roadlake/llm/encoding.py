"""Token ids of texts, exactly as the tokenizers library gives them, at the cost of distinct words.

The library's pre-tokenizer cuts a text into parts that are encoded independently. Texts are cut here at
places where it always cuts, and the ids of each distinct part are remembered per worker, so the library encodes a
part once instead of at every occurrence. Texts with characters beyond those for which the
cuts are written out, or with a special token, are handed to the library whole.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

from roadlake.llm.common import kept


#: Characters beyond these, for which the cuts below are not written out, go the library's way.
_PLAIN = re.compile("[^\t-\r -~\xa0-įı-ſ]")
# Classes of those characters, and the two pre-tokenizers' patterns over them.
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_BLANK = "\t-\r \xa0"
_BYTE_LEVEL = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_BLANK}{_LETTER}{_NUMBER}]+"
    f"|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"
)
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_BLANK}{_LETTER}{_NUMBER}]+")
#: Without any of these, blanks of a text are single spaces and line feeds.
_ODD_BLANKS = ("  ", " \n", "\n ", "\n\n", "\t", "\v", "\f", "\r", "\xa0")


def byte_level_parts(text: str) -> list[str]:
    """Parts of a plain text between which the byte-level pre-tokenizer always cuts.

    It cuts before a single space and on both sides of a single line feed, so only other blanks need the pattern.
    """
    if any(b in text for b in _ODD_BLANKS):
        return _BYTE_LEVEL.findall(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")


def word_parts(text: str) -> list[str]:
    """Parts of a plain text for the pre-tokenizer of words, which drops blanks and ignores case."""
    return text.lower().split()


def shown_bytes() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_table(vocabulary: dict[str, int]) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary."""
    byte_of = shown_bytes()
    table = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        known = all(c in byte_of for c in token)
        table[i] = bytes(byte_of[c] for c in token) if known else token.encode()
    return table


def as_bytes(ids: Iterable[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    return np.asarray(ids, dtype="<u4").tobytes()


class _Ids(dict):
    """Ids of parts as bytes, filled on demand; long parts are not kept."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, part: str) -> bytes:
        ids = self.encoder.tokens(part)
        ids = ids.tobytes() if sys.byteorder == "little" and ids.itemsize == 4 else as_bytes(ids)
        if len(part) < self.encoder.long:
            if len(self) >= self.encoder.remembered:
                self.clear()
            self[part] = ids
        return ids


class Encoder:
    """Encodes texts with the byte-level BPE tokenizer of a JSON definition; special tokens are not added."""

    #: Parts that are remembered, and characters of pre-tokens that are handed to ``of_long`` and not remembered.
    remembered, long = 1_000_000, 1024

    def __init__(self, definition: str):
        self.of_long = self.merged
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        parsed = json.loads(definition)
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        assert all(t.startswith("<|") for t in self.special)
        words = parsed["normalizer"] is not None
        self.cut, self.pre_token = (word_parts, _WORDS) if words else (byte_level_parts, _BYTE_LEVEL)
        self.shown = {b: c for c, b in shown_bytes().items()}
        self.merges = self.tokenizer.model.tokenize
        self.ids = _Ids(self)

    def library(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [as_bytes(e.ids) for e in encoded]

    def tokens(self, part: str) -> array:
        """Ids of one part: the merges of each of its pre-tokens, whose bytes are written as characters."""
        ids = array("I")
        for token in self.pre_token.findall(part):
            ids.extend(self.merged(token) if len(token) < self.long else self.of_long(token))
        return ids

    def merged(self, token: str) -> list[int]:
        """Ids of one pre-token."""
        if not (token.isascii() and token.isalnum()):
            token = token.encode().decode("latin-1").translate(self.shown)
        return [t.id for t in self.merges(token)]

    def parts(self, text: str) -> list[str] | None:
        """The parts that are encoded independently; None when only the library knows them."""
        if "<|" in text or _PLAIN.search(text):  # the first is how special tokens begin
            return None
        return self.cut(text)

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers; a null text is empty."""
        texts = [t or "" for t in texts]
        cut = [self.parts(t) for t in texts]
        other = [i for i, own in enumerate(cut) if own is None]
        rest = dict(zip(other, self.library([texts[i] for i in other])))
        at = self.ids.__getitem__
        return [rest[i] if own is None else b"".join(map(at, own)) for i, own in enumerate(cut)]


def encoder(definition: str) -> Encoder:
    """The encoder of a definition, kept between tasks."""
    return kept(("encoder", definition), lambda: Encoder(definition))


def runs(sizes: Iterable[int | None], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose sizes add up to about ``most``, at least one item each; no size counts as 0."""
    start, total, n = 0, 0, 0
    for n, size in enumerate(sizes, start=1):
        total += size or 0
        if total >= most:
            yield start, n
            start, total = n, 0
    if start < n:
        yield start, n


def unsplit_tokenizer(definition: str) -> Tokenizer:
    """The tokenizer's merges alone: a text is one piece, however it looks."""
    bare = Tokenizer.from_str(definition)
    bare.no_truncation()
    bare.no_padding()
    bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    bare.encode_special_tokens = True
    return bare
