"""Words of Arrow text columns as 64-bit hashes, in bulk.

A text's UTF-8 bytes are read straight from the Arrow buffers. A word's hash is
a polynomial over its bytes, taken from prefix sums, so no word becomes a
Python object. Work goes through pieces of about ``PIECE`` bytes and at most
``PIECE_ROWS`` rows at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
#: Rows of a piece, so that what is kept for each stays small as well.
PIECE_ROWS = 1024
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX1, _MIX2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_seeded = np.random.default_rng(20240229)
_CODE = _seeded.integers(1, 2**63, 256, dtype=np.uint64)
_STEP = _seeded.integers(1, 2**63, 64, dtype=np.uint64) | _U(1)
_powers: dict[str, np.ndarray] = {}

_byte = np.arange(256)
_space = (_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D))
_upper = (_byte >= 0x41) & (_byte <= 0x5A)
_alnum = ((_byte >= 0x30) & (_byte <= 0x39)) | _upper | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)
LOWER = np.where(_upper, _byte + 32, _byte)
#: (is the byte part of a word, its code): A-Z lowered; words split at ASCII
#: white space, or at every ASCII character that is no letter or digit;
#: ``BY_CASE`` splits like the first and keeps A-Z apart from a-z.
BY_SPACE = (~_space, _CODE[LOWER])
BY_CASE = (~_space, _CODE)
BY_ALNUM = (_alnum, _CODE[LOWER])


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(30))
    h = h * _MIX1
    h ^= h >> _U(27)
    h = h * _MIX2
    h ^= h >> _U(31)
    return h


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        size = max(n, 2 * PIECE)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, _U(base))
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


class Words:
    """Words of a run of texts: ``hash``, byte ``start`` and ``end`` of each, and
    ``first`` (the words of text i are ``first[i]:first[i + 1]``)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, rule: tuple[np.ndarray, np.ndarray] = BY_SPACE):
        inside, code = rule
        n = len(data)
        self.offsets = offsets
        is_word = np.zeros(n + 1, bool)
        is_word[:n] = inside[data]
        opens = is_word[:n].copy()
        opens[1:] &= ~is_word[: n - 1]
        closes = is_word[:n] & ~is_word[1:]
        cuts = offsets[(offsets > 0) & (offsets < n)]
        opens[cuts] = is_word[cuts]
        closes[cuts - 1] = is_word[cuts - 1]
        self.start, self.end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        up, self._down = _power_tables(n + 1)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(code[data] * up[:n], out=self._sums[1:])
        self.hash = self.part(self.start, self.end)
        self.first = np.searchsorted(self.start, offsets)

    def part(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._down[start] + (end - start).astype(np.uint64))

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of every ``k`` words in a row within a text, and the bounds
        per text; ``runs[j]`` of text i begins at its word ``j``."""
        return runs(self.hash, self.first, k)


def runs(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.maximum(np.diff(first) - (k - 1), 0)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    if not len(hashes) or not bounds[-1]:
        return np.zeros(0, np.uint64), bounds
    whole = np.zeros(max(len(hashes) - k + 1, 0), np.uint64)
    for j in range(k):
        whole += hashes[j : len(hashes) - k + 1 + j] * _STEP[j % 64] ** _U(j // 64 + 1)
    at = np.arange(bounds[-1]) + np.repeat(first[:-1] - bounds[:-1], sizes)
    return mix(whole[at]), bounds


def pieces(column: pa.Array, piece: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into (row from, row to, bytes, offsets), each about
    ``piece`` bytes or one text. NULL is an empty text."""
    # batches are large blocks; the system's allocator gives them back at once
    if pa.default_memory_pool().backend_name != "system":
        pa.set_memory_pool(pa.system_memory_pool())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = min(n, at + PIECE_ROWS, max(at + 1, int(np.searchsorted(offsets, offsets[at] + piece, "right")) - 1))
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def long_array(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A list<int64> column from flat values and row bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64)))
