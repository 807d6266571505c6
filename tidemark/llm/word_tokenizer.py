"""Ids of a lower-casing word vocabulary (byte pairs with word ends).

The vocabulary splits texts into runs of letters, single digits, runs of other
characters and English contractions, never across white space. Texts of plain
Latin letters are split in numpy and go through the same vocabulary as ranks, a
space behind each part standing for its end. In other texts this is done by
white-space-separated chunk, and a chunk with any other character goes through
``tokenizers`` itself. A test compares the ids with those of whole texts.
"""

from __future__ import annotations

import json
import unicodedata
from itertools import chain

import numpy as np

CHUNKS = 300_000  # chunks kept before the table starts anew
LONGEST = 1000  # characters of a part that the ranks encode quickly
_LETTER, _NUMBER, _OTHER, _SPACE, _UNSURE = range(5)
#: Code points below this have settled classes, lower case and composed forms.
_LATIN = 0x250
_BLANK = np.uint16(32)


def _class_of(code: int) -> int:
    char = chr(code)
    if char in "\t\n\x0b\x0c\r ":
        return _SPACE
    if char.isspace():  # white space to some libraries only, or not to all
        return _UNSURE
    return {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(char)[0], _OTHER)


_CLASS = np.full(1 << 16, _UNSURE, np.uint8)
_CLASS[:_LATIN] = [_class_of(c) for c in range(_LATIN)]
_SINGLE = np.isin(np.arange(1 << 16), [ord(c) for c in "stmd"])
_PAIRS = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]


def split_parts(text: str) -> str | None:
    """Lower-cased parts of a text, each followed by a space; None if a
    character is not plain Latin, or a part very long."""
    codes = np.frombuffer(text.lower().encode("utf-16-le", "surrogatepass"), np.uint16)
    kind = _CLASS[codes]
    if not len(codes):
        return ""
    if (kind == _UNSURE).any():
        return None
    starts = kind == _NUMBER
    starts[0] = True
    starts[1:] |= kind[1:] != kind[:-1]
    starts &= kind != _SPACE
    quotes = np.flatnonzero(starts & (codes == ord("'")))
    if len(quotes):
        ahead = np.concatenate([codes, [0, 0, 0]])
        one, two = ahead[quotes + 1], ahead[quotes + 2]
        size = np.where(_SINGLE[one], 2, 0)
        for a, b in _PAIRS:
            size[(one == a) & (two == b)] = 3
        for at, n in zip(quotes[size > 0].tolist(), size[size > 0].tolist()):
            starts[at + 1 : at + n] = False
            if at + n < len(codes) and kind[at + n] != _SPACE:
                starts[at + n] = True
    first = np.flatnonzero(starts)
    kept = kind != _SPACE
    rank = np.cumsum(kept)  # characters kept up to each
    if len(first) and np.diff(np.append(rank[first] - 1, rank[-1])).max() > LONGEST:
        return None
    out = np.full(rank[-1] + len(first), _BLANK, np.uint16)
    out[(rank + np.cumsum(starts) - 2)[kept]] = codes[kept]
    return out.tobytes().decode("utf-16-le")


def _byte_of() -> dict[str, int]:
    """The printable character that stands for each byte in such vocabularies."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordTokenizer(dict):
    """As a table: the ids of a chunk."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as lines:
            spec = json.load(lines)
        special = [t["content"] for t in spec["added_tokens"]]
        self.marks = {s[:2] for s in special}
        self.size = max([*spec["model"]["vocab"].values(), *[t["id"] for t in spec["added_tokens"]]]) + 1
        suffix = spec["model"]["end_of_word_suffix"]
        byte_of = _byte_of()
        ranks = {}
        for token, rank in spec["model"]["vocab"].items():
            if token not in special:
                ends = token.endswith(suffix) and token != suffix
                body = bytes(byte_of[c] for c in (token[: -len(suffix)] if ends else token))
                ranks[body + b" " * ends] = rank
        self.ranked = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary

    def _plain(self, text: str) -> list[int] | None:
        if any(m in text for m in self.marks):
            return None
        parts = split_parts(text)
        return None if parts is None else self.ranked(parts)

    def __missing__(self, chunk: bytes) -> list[int]:
        if len(self) >= CHUNKS:
            self.clear()
        text = chunk.decode()
        ids = self._plain(text)
        if ids is None:
            ids = self.slow.encode(text, add_special_tokens=False).ids
        self[chunk] = ids
        return ids

    def encode(self, text: bytes) -> np.ndarray:
        ids = self._plain(text.decode())
        if ids is None:
            ids = list(chain.from_iterable(map(self.__getitem__, text.split())))
        return np.array(ids, np.int64)
