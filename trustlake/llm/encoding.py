"""Texts as token ids by a public tokenizer, with the ids of recurring pieces remembered.

Both vocabularies cut a text into pieces before any merge is tried, so a text's ids are those of its pieces in turn. Where
every character of a text is one whose class is settled (Latin letters, ASCII, common punctuation), the pieces are cut
here and only pieces not seen lately go through the tokenizers library's model; any other text goes through the library
whole, and so does one that holds a marker of the vocabulary (``<|endoftext|>``), which gets the marker's own id as by the
library's default. What is remembered changes the speed, never the ids.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Callable
from functools import cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

from tokenizers import Tokenizer  # noqa: E402

if array("I").itemsize != 4 or sys.byteorder != "little":
    raise ImportError("ids are exchanged as the machine's own unsigned integers, which must be 32-bit little-endian")

#: Pieces in a generation of those that a worker remembers.
PIECES = 500_000
#: Longer pieces are not remembered, so that entries bound bytes, too.
PIECE_LENGTH = 64
#: Bytes per id in memory and in what tasks exchange.
ID = np.dtype("<u4")

# How the two kinds of vocabulary cut a text before merging; L, N, P and S stand for letters, digits, other
# visible characters and white space.
BYTE_LEVEL = " ?[L]+|'s|'t|'re|'ve|'m|'ll|'d| ?[N]+| ?[P]+|[S]+(?![LNP])|[S]+"
WORD_LEVEL = "[L]+|'s|'t|'re|'ve|'m|'ll|'d|[N]|[P]+"
# end of fixed values

_SETTLED = [*range(0x250), *range(0x2010, 0x2028), *range(0x2030, 0x2050)]
#: Lower-cased, these are not settled, or are several characters of which one is not.
_ODD = {c for c in _SETTLED if not {ord(char) for char in chr(c).lower()} <= set(_SETTLED)}


def _class(kind: str) -> str:
    """The settled characters of a kind, as the inside of a character class."""

    def is_kind(code: int) -> bool:
        char, category = chr(code), unicodedata.category(chr(code))[0]
        space = char in "\t\n\v\f\r \x85\xa0"
        return {"L": category == "L", "N": category == "N", "S": space}.get(kind, not space and category not in "LN")

    codes = [c for c in _SETTLED if c not in _ODD and is_kind(c)]
    return "".join(re.escape(chr(c)) for c in codes)


@cache
def _patterns() -> tuple[re.Pattern, dict[str, re.Pattern]]:
    classes = {kind: _class(kind) for kind in "LNPS"}

    def filled(pattern: str) -> re.Pattern:
        return re.compile("".join(classes.get(part, part) for part in re.split("([LNPS])", pattern)))

    unsettled = re.compile(f"[^{''.join(classes.values())}]")
    return unsettled, {"byte": filled(BYTE_LEVEL), "word": filled(WORD_LEVEL)}


def _kind(definition: dict) -> str | None:
    """Which of the two known ways of cutting a tokenizer file asks for, if any."""
    before, normal = definition.get("pre_tokenizer") or {}, definition.get("normalizer") or {}
    added = definition.get("added_tokens", [])
    if not all(token["special"] and not token["normalized"] for token in added) or definition["model"].get("dropout"):
        return None
    if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not normal:
        return "byte"
    steps = [s.get("type") for s in before.get("pretokenizers", [])]
    changes = [s.get("type") for s in normal.get("normalizers", [])]
    if steps == ["Split", "ByteLevel"] and changes == ["NFC", "Replace", "Lowercase"]:
        pattern = before["pretokenizers"][0]["pattern"].get("Regex", "")
        known = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        return "word" if pattern == known and not before["pretokenizers"][1].get("use_regex") else None
    return None


class Remembered(dict):
    """What a function gives for a text, remembered in two generations: a full one replaces the one before."""

    def __init__(self, make: Callable[[str], bytes], size: int) -> None:
        self.make, self.size = make, size
        self.before: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        if len(text) > PIECE_LENGTH:
            return self.make(text)
        value = self.before.get(text)
        if value is None:
            value = self.make(text)
        if len(self) >= self.size:
            self.before = dict(self)
            self.clear()
        self[text] = value
        return value


@cache
def _byte_letters() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies: visible Latin-1 ones for themselves, others from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(256 + place) for place, b in enumerate(hidden)}


class Encoder:
    """Token ids by one tokenizer file; the ids of pieces are remembered, and only new ones go through the library's model.

    With ``markers_as_text`` a marker in a text is cut and merged like other text, else it gets its own id.
    """

    def __init__(self, path: str, markers_as_text: bool = True) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = markers_as_text
        self.model = self.tokenizer.model
        definition = json.loads(self.tokenizer.to_str())
        self.kind = _kind(definition)
        self.markers = [] if markers_as_text else [token["content"] for token in definition.get("added_tokens", [])]
        self.unsettled, patterns = _patterns()
        self.cut = patterns.get(self.kind)
        self.piece_ids = Remembered(self._merged, PIECES)

    def _merged(self, piece: str) -> bytes:
        letters = piece.encode().decode("latin-1").translate(_byte_letters())
        return array("I", [token.id for token in self.model.tokenize(letters)]).tobytes()

    def ids(self, text: str) -> bytes:
        """A text's ids as little-endian unsigned 32-bit integers."""
        if self.cut is None or self.unsettled.search(text) or any(marker in text for marker in self.markers):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        pieces = self.cut.findall(text.lower() if self.kind == "word" else text)
        return b"".join(map(self.piece_ids.__getitem__, pieces))


@cache
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file, with the library's default for markers."""
    return Encoder(path, markers_as_text=False)
