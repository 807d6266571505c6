"""Benchmark passages in documents, by embedded edit distance.

Item and document are sequences of words (runs of letters and digits, A-Z
lowered). An item of n words may have ``most`` = 20 % of n edits. It is cut into
``most + 1`` parts of equal length: whatever the edits are, one part at least is
left as it is (each edit spoils one part), so parts are looked up and recall
does not depend on the item's length. The CGK random walk copies a sequence and
stays on a word or moves on as a random bit for (step, word) says; the walk over
a part, held at its last word, is its key. Windows of the parts' lengths are
walked at every word of a text, all together, one array operation a step.

Windows that share a key with a part are aligned with the whole item. Those with
fewer of the item's words around them than any match has are left out (a count
over hashed pairs of item and word, which can only be too high), and the exact
edit distance decides on the others. So the result is all of the brute force.

The benchmark is sent to the tasks in blocks of at most ``BLOCK_WORDS`` words,
one pass over the documents for each.

Defined results: NULL and empty texts and items match nothing; items shorter
than ``MIN_ITEM`` words match only word for word, at any place of a text;
repeated items are reported each; repeated rows are reported each; an empty
table on either side gives no match; NULL keys are kept as NULL; extra columns
stay in ``clean_documents`` and are ignored in ``find_leaks``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import BY_ALNUM, Words, mix, pieces

MIN_ITEM = 8
SIMILARITY = 0.8
BLOCK_WORDS = 200_000
LONGEST = 16  # words of a part that make its key
HITS = 1 << 18  # pairs of window and part that are looked at together
_WALK = np.uint64(np.random.default_rng(20250303).integers(1, 2**63) | 1)
_U = np.uint64


def most_edits(words: int, similarity: float) -> int:
    """Edits that an item may have."""
    return int(words * (1 - similarity) + 1e-9) if words >= MIN_ITEM else 0


def window_of(words: int, similarity: float) -> int:
    """Words of an item's parts that make their keys."""
    return max(1, min(LONGEST, words // (most_edits(words, similarity) + 1)))


def walk_keys(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Keys of the windows of ``size`` words that begin at ``starts``: 3 * size
    steps of the walk, held at the last word of the window."""
    coin = mix(words * _WALK)
    at, last = starts, starts + size - 1
    key = np.full(len(starts), _U(size))
    for step in range(3 * size):
        key = (key ^ words[at]) * _U(0x9E3779B97F4A7C15)
        key ^= key >> _U(29)
        at = np.minimum(at + ((coin[at] >> _U(step % 64)) & _U(1)).astype(np.int64), last)
    return key


def edit_distances(item: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edit distance of ``item`` to any part of each row of ``spans``, and
    where that part ends (the first such place)."""
    rows, width = spans.shape
    line = np.zeros((rows, width + 1), np.int32)
    slope = np.arange(width + 1, dtype=np.int32)
    for word in item:
        fresh = np.empty_like(line)
        fresh[:, 0] = line[:, 0] + 1
        np.minimum(line[:, :-1] + (spans != word), line[:, 1:] + 1, out=fresh[:, 1:])
        # insertions: a running minimum along the row
        line = np.minimum.accumulate(fresh - slope, axis=1) + slope
    return line.min(axis=1), line.argmin(axis=1)


class Index:
    """Keys of the parts of all items of a block, and the exact check."""

    def __init__(self, items: list[tuple[int, str]], similarity: float):
        self.similarity = similarity
        texts = pa.array([t or "" for _, t in items], pa.string())
        self.ids, self.items = [], []
        for lo, hi, data, offsets in pieces(texts):
            words = Words(data, offsets, BY_ALNUM)
            for i in range(hi - lo):
                own = words.hash[words.first[i] : words.first[i + 1]]
                if len(own):
                    self.ids.append(items[lo + i][0])
                    self.items.append(own)
        self.sizes = np.array([len(w) for w in self.items], np.int64)
        self.most = np.array([most_edits(n, similarity) for n in self.sizes.tolist()], np.int64)
        windows = np.array([window_of(n, similarity) for n in self.sizes.tolist()], np.int64)
        flat = np.concatenate([np.zeros(0, np.uint64), *self.items])
        first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.parts = {}  # by window size: sorted keys, their items, words of the item before the part
        for size in np.unique(windows).tolist():
            mine = np.flatnonzero(windows == size)
            n = self.most[mine] + 1
            owner = np.repeat(mine, n)
            shift = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * (self.sizes[owner] // (self.most[owner] + 1))
            key = walk_keys(flat, first[owner] + shift, size)
            order = np.argsort(key, kind="stable")
            sieve = np.zeros(1 << 16, bool)
            sieve[(key & _U(0xFFFF)).astype(np.int64)] = True
            self.parts[size] = key[order], owner[order], shift[order], sieve
        # hashed (item, word); eight bits or more for each, so most others are told apart
        self.pairs = np.zeros(1 << max(10, int(8 * len(flat)).bit_length()), bool)
        self.pairs[self._pair(np.repeat(np.arange(len(self.items)), self.sizes), flat)] = True

    def _pair(self, item: np.ndarray, word: np.ndarray) -> np.ndarray:
        return ((word ^ item.astype(np.uint64) * _U(0x9E3779B97F4A7C15)) * _WALK >> _U(20)).astype(np.int64) & (len(self.pairs) - 1)

    def _candidates(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Distinct (item, text, word where the item would begin), those with
        enough words of the item in reach."""
        counts = np.diff(first)
        left = np.repeat(first[1:], counts) - np.arange(len(words))
        found = [np.zeros((0, 3), np.int64)]
        for size, (keys, owner, shift, sieve) in self.parts.items():
            begin = np.flatnonzero(left >= size)
            key = walk_keys(words, begin, size)
            maybe = sieve[(key & _U(0xFFFF)).astype(np.int64)]
            begin, key = begin[maybe], key[maybe]
            lo = np.searchsorted(keys, key, "left")
            n = np.searchsorted(keys, key, "right") - lo
            begin, lo, n = begin[n > 0], lo[n > 0], n[n > 0]
            total = np.cumsum(n)
            for at in range(0, int(total[-1]) if len(total) else 0, HITS):
                hit = np.arange(at, min(at + HITS, total[-1]))
                row = np.searchsorted(total, hit, "right")
                hit = lo[row] + hit - (total[row] - n[row])
                text = np.searchsorted(first, begin[row], "right") - 1
                found.append(self._likely(words, first, np.unique(np.stack([owner[hit], text, begin[row] - shift[hit]], axis=1), axis=0)))
        return np.unique(np.concatenate(found), axis=0)

    def _likely(self, words: np.ndarray, first: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Candidates with at least as many words of the item around as a match leaves."""
        out = []
        at = 0
        n = self.sizes[found[:, 0]]
        most = self.most[found[:, 0]]
        lo = np.maximum(found[:, 2] - most, first[found[:, 1]])
        hi = np.minimum(found[:, 2] + n + most, first[found[:, 1] + 1])
        width = hi - lo
        total = np.cumsum(width)
        while at < len(found):
            to = max(at + 1, int(np.searchsorted(total, total[at] + 4 * HITS)))
            w = width[at:to]
            ends = np.cumsum(w)
            place = np.arange(ends[-1]) + np.repeat(lo[at:to] - (ends - w), w)
            own = self.pairs[self._pair(np.repeat(found[at:to, 0], w), words[place])]
            count = np.add.reduceat(own.astype(np.int64), ends - w)
            out.append(found[at:to][count >= (n - most)[at:to]])
            at = to
        return np.concatenate(out) if out else found

    def matches(self, texts: Words) -> list[tuple[int, int, int, int]]:
        """Per text and item the best match: (text, item, distance, last word)."""
        best: dict[tuple[int, int], tuple[int, int]] = {}
        if not self.parts or not len(texts.hash):
            return []
        found = self._candidates(texts.hash, texts.first)
        cuts = np.flatnonzero(np.diff(found[:, 0])) + 1
        for group in np.split(found, cuts) if len(found) else []:
            item = self.items[group[0, 0]]
            most = int(self.most[group[0, 0]])
            around = np.arange(-most, len(item) + most)
            rows = max(1, 4 * HITS // len(around))
            for k in range(0, len(group), rows):
                text, begin = group[k : k + rows, 1], group[k : k + rows, 2]
                at = begin[:, None] + around
                inside = (at >= texts.first[text][:, None]) & (at < texts.first[text + 1][:, None])
                spans = np.where(inside, texts.hash[np.clip(at, 0, len(texts.hash) - 1)], _U(0))
                # a match leaves all but ``most`` words of the item in place
                enough = np.isin(spans, item).sum(axis=1) >= len(item) - most
                if not enough.any():
                    continue
                dist, end = edit_distances(item, spans[enough])
                last = at[enough, 0] + end - 1 - texts.first[text[enough]]
                for t, d, e in zip(text[enough].tolist(), dist.tolist(), last.tolist()):
                    if d <= most and (d, e) < best.get((t, int(group[0, 0])), (most + 1, 0)):
                        best[(t, int(group[0, 0]))] = (d, e)
        return [(t, i, d, e) for (t, i), (d, e) in sorted(best.items())]


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[int, str]]]:
    block, words = [], 0
    for row in benchmark.select(item, text).toLocalIterator():
        block.append((row[0], row[1]))
        words += len((row[1] or "").split()) + 1
        if words >= BLOCK_WORDS:
            yield block
            block, words = [], 0
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", similarity: float = SIMILARITY) -> DataFrame:
    """(key, item, distance, n_item_words, last_word): each row's best match of
    each item with an edit distance of at most ``1 - similarity`` of its words."""
    kinds = docs.schema[key].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    schema = f"key {kinds[0]}, item {kinds[1]}, distance int, n_item_words int, last_word long"
    out = None
    for block in _blocks(benchmark, item, text):
        part = docs.select(F.col(key), F.col(text)).mapInArrow(_finder(block, similarity, kinds), schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.withColumnsRenamed({"key": key, "item": item})


def _finder(block, similarity, kinds):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(block, similarity)
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(1)):
                found = index.matches(Words(data, offsets, BY_ALNUM))
                if found:
                    rows = pa.array([lo + t for t, *_ in found])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(rows),
                            pa.array([index.ids[i] for _, i, *_ in found]),
                            pa.array([d for *_, d, _ in found], pa.int32()),
                            pa.array([len(index.items[i]) for _, i, *_ in found], pa.int32()),
                            pa.array([e for *_, e in found], pa.int64()),
                        ],
                        names=["key", "item", "distance", "n_item_words", "last_word"],
                    )

    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", similarity: float = SIMILARITY) -> DataFrame:
    """Rows of ``docs`` without any match, all columns as they are. No shuffle."""
    at = docs.columns.index(text)
    for block in _blocks(benchmark, item, "text"):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            index = Index(block, similarity)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for lo, _, data, offsets in pieces(batch.column(at)):
                    for t, *_ in index.matches(Words(data, offsets, BY_ALNUM)):
                        clean[lo + t] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
