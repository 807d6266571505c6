"""Repeated passages by sparse suffix arrays.

Words are hashed, and only suffixes that begin at a minimiser are kept: the
position of the smallest hash of ``GRAM`` words among any ``SPAN`` positions in
a row. The choice depends on the content alone, so copies of a passage keep the
same suffixes. Kept suffixes are sorted, each is compared with its neighbours
from other texts in that order, and the match is extended left and right.

``SPAN + GRAM - 1`` words are half the least match. So the first half of any
repeated passage of ``MIN_WORDS`` words holds a kept suffix with at least the
other half of it behind, and suffixes whose next ``HALF`` words occur in one
text only can be dropped by a count of their hashes. The others get their words
(``LEFT`` before, ``RIGHT`` after) and are range-partitioned and sorted by them,
once by what follows and once by what precedes. Ranges are cut by the whole sort
key, which ends in the text and the position: a passage with any number of copies
spreads over many tasks, and neighbours stay neighbours. Each range is compared by
itself, and the runs at its edge with those of the next one in a second step.

Equal texts are one text here: it is sorted once, and all its rows are reported
as copies. Texts are told apart by their 64-bit hash.

Defined results: NULL, empty and shorter texts have no passages; rows with
equal texts repeat each other, whatever their keys; a repeat inside one text
only does not count; NULL keys are reported like others; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.words import Words, long_array, pieces, runs
from tidemark.session import settle

MIN_WORDS = 50
HALF = MIN_WORDS // 2
GRAM = 8
SPAN = HALF - GRAM + 1
LEFT, RIGHT = HALF, MIN_WORDS
WIDTH = LEFT + RIGHT
#: Bytes of suffix records that one sorting task should hold.
RANGE_BYTES = 32 << 20
_RECORD = "tid long, half long, at long, before binary, after binary"
_COLUMNS = ["tid", "half", "at", "before", "after"]


def _minimisers(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Positions of the smallest of every ``SPAN`` values in a row, by text."""
    n = len(values)
    if n < SPAN:
        return np.zeros(0, np.int64)
    least = np.arange(n)
    width = 1
    while width < SPAN:  # smallest of 2, 4, ... and at last SPAN positions
        step = min(width, SPAN - width)
        a, b = least[: len(least) - step], least[step:]
        least = np.where(values[b] < values[a], b, a)
        width += step
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return np.unique(least[text[: len(least)] == text[SPAN - 1 :]])


def _suffixes(texts: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word positions of the kept suffixes, hashes of their first ``HALF``
    words, and the bounds per text."""
    grams, bounds = runs(texts.hash, texts.first, GRAM)
    picked = _minimisers(grams, bounds)
    text = np.searchsorted(bounds, picked, "right") - 1
    word = picked - bounds[text] + texts.first[text]
    fits = word + HALF <= texts.first[text + 1]
    word, text = word[fits], text[fits]
    halves, hbounds = runs(texts.hash, texts.first, HALF)
    key = halves[word - texts.first[text] + hbounds[text]] if len(word) else np.zeros(0, np.uint64)
    return word, key, np.searchsorted(text, np.arange(len(texts.first)))


def suffix_hashes(texts: DataFrame) -> DataFrame:
    """(tid, n_words, halves) for every row of (tid, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(1)):
                words = Words(data, offsets)
                _, keys, bounds = _suffixes(words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(words.first)), long_array(keys, bounds)],
                    names=["tid", "n_words", "halves"],
                )

    return texts.select("tid", "text").mapInArrow(run, "tid long, n_words long, halves array<long>")


def suffix_records(texts: DataFrame) -> DataFrame:
    """The suffixes asked for with the words around them.

    ``texts`` has (tid, text, halves); words are four bytes of their hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column(2)
            for lo, hi, data, offsets in pieces(batch.column(1)):
                words = Words(data, offsets)
                word, keys, bounds = _suffixes(words)
                short = words.hash.astype(np.uint32)
                for i in range(hi - lo):
                    own = slice(bounds[i], bounds[i + 1])
                    ask = asked[lo + i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    here = np.isin(keys[own], ask)
                    at, key = word[own][here], keys[own][here]
                    if not len(at):
                        continue
                    begin, end = words.first[i], words.first[i + 1]
                    # zero stands for what lies beyond the text and matches nothing
                    padded = np.zeros(end - begin + WIDTH, ">u4")
                    padded[LEFT : LEFT + end - begin] = np.maximum(short[begin:end], 1)
                    around = np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[at - begin]
                    before = [x.tobytes() for x in np.ascontiguousarray(around[:, :LEFT][:, ::-1])]
                    after = [x.tobytes() for x in np.ascontiguousarray(around[:, LEFT:])]
                    tid = np.full(len(at), batch.column(0)[lo + i].as_py(), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tid), pa.array(key.view(np.int64)), pa.array(at - begin), pa.array(before, pa.binary()), pa.array(after, pa.binary())],
                        names=_COLUMNS,
                    )

    return texts.select("tid", "text", "halves").mapInArrow(run, _RECORD)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u4").reshape(-1, width)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    same = (a == b) & (a != 0)
    return np.where(same.all(axis=1), a.shape[1], (~same).argmax(axis=1))


def _matches(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches with the nearest suffixes of other texts before and after."""
    tid, at = rows.column("tid").to_numpy(), rows.column("at").to_numpy()
    after, before = _matrix(rows.column("after"), RIGHT), _matrix(rows.column("before"), LEFT)
    n = len(tid)
    change = np.flatnonzero(tid[1:] != tid[:-1]) + 1
    begin, end = np.concatenate([[0], change]), np.concatenate([change, [n]])
    run = np.searchsorted(begin, np.arange(n), "right") - 1
    hits = []
    for other in (begin[run] - 1, np.where(end[run] < n, end[run], -1)):
        ok = np.flatnonzero(other >= 0)
        right, left = _common(after[ok], after[other[ok]]), _common(before[ok], before[other[ok]])
        enough = right + left >= MIN_WORDS
        hits.append((tid[ok][enough], at[ok][enough] - left[enough], at[ok][enough] + right[enough]))
    return tuple(np.concatenate(x) for x in zip(*hits))


def match_spans(records: DataFrame) -> DataFrame:
    """(tid, begin, end) in words: matches of neighbours in both orders. Those with
    the longest match behind them are neighbours by what follows, those with the
    longest match before them by what precedes."""
    records = settle(records, "suffixes")
    ranges = max(1, -(-records.count() * (WIDTH * 4 + 64) // RANGE_BYTES))
    return _neighbours(records, ranges, "after", "before").unionByName(_neighbours(records, ranges, "before", "after"))


def _neighbours(records: DataFrame, ranges: int, near: str, far: str) -> DataFrame:
    """Matches of neighbours in the order of half, words ``near`` and ``far``, text
    and position. Ranges are cut by the same columns, so that neighbours in the
    order are in one range, or at the edges of two that follow each other."""
    order = ["half", near, far, "tid", "at"]
    schema = f"{_RECORD}, begin long, end long, range int, side string"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks().select(_COLUMNS)
        tid, n = rows.column("tid").to_numpy(), rows.num_rows
        hit, begin, end = _matches(rows)
        other = np.flatnonzero(tid != tid[0])
        head = other[0] + 1 if len(other) else n  # the first run and one row behind it
        other = np.flatnonzero(tid != tid[-1])
        tail = other[-1] if len(other) else 0
        part = TaskContext.get().partitionId()
        for side, some in (("", None), ("head", rows.slice(0, head)), ("tail", rows.slice(tail))):
            count = len(hit) if some is None else some.num_rows
            number, text = pa.nulls(count, pa.int64()), pa.nulls(count, pa.binary())
            columns = [pa.array(hit), number, number, text, text, pa.array(begin), pa.array(end)] if some is None else [*some.columns, number, number]
            columns += [pa.array(np.full(count, part, np.int32)), pa.array([side] * count, pa.string())]
            yield from pa.table(columns, names=[*_COLUMNS, "begin", "end", "range", "side"]).to_batches()

    # ranges come in order of their number, whatever becomes of empty ones
    scanned = settle(records.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(scan, schema), "scanned")
    inner = scanned.filter("side = ''").select("tid", "begin", "end")
    # one row per range
    follows = scanned.filter("side = 'tail'").select("range").distinct()
    follows = follows.withColumn("next", F.lead("range").over(Window.orderBy("range")))
    tails = scanned.filter("side = 'tail'").withColumn("edge", F.col("range"))
    heads = scanned.filter("side = 'head'").join(follows.select(F.col("next").alias("range"), F.col("range").alias("edge")), "range")
    edges = tails.select(*_COLUMNS, "edge").unionByName(heads.select(*_COLUMNS, "edge"))

    def across(rows: pa.Table) -> pa.Table:
        words = np.concatenate([_matrix(rows.column(c), RIGHT if c == "after" else LEFT) for c in (near, far)], axis=1)
        place = np.lexsort([rows.column("at").to_numpy(), rows.column("tid").to_numpy(), *words.T[::-1], rows.column("half").to_numpy()])
        tid, begin, end = _matches(rows.take(pa.array(place)))
        return pa.table([pa.array(tid), pa.array(begin), pa.array(end)], names=["tid", "begin", "end"])

    return inner.unionByName(edges.groupBy("edge").applyInArrow(across, "tid long, begin long, end long"))


def _merge(spans: DataFrame) -> DataFrame:
    """Unite overlapping spans of a text."""
    by_begin = Window.partitionBy("tid").orderBy("begin", "end")
    reach = F.max("end").over(by_begin.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.distinct().withColumn("_new", F.coalesce(F.col("begin") > reach, F.lit(True)).cast("int"))
    numbered = marked.withColumn("_island", F.sum("_new").over(by_begin.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("tid", "_island").agg(F.min("begin").alias("begin"), F.max("end").alias("end")).drop("_island")


def repeated_passages(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, begin, end, n_words): passages of at least ``MIN_WORDS`` words that
    also stand in another row's text. ``begin`` and ``end`` count words."""
    docs = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("tid")).filter(F.col("text").isNotNull())
    hashes = settle(suffix_hashes(docs).filter(F.col("n_words") >= MIN_WORDS).dropDuplicates(["tid"]), "hashes")
    # the smallest key of a text and the number of its rows, from narrow rows
    texts = settle(docs.groupBy("tid").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies")), "texts")
    halves = hashes.select("tid", F.explode("halves").alias("half"))
    # stored, so that the join has a plain shuffle on both sides and a half of very
    # many texts is split
    known = settle(halves.groupBy("half").agg(F.min("tid").alias("t0"), F.max("tid").alias("t1")).filter("t0 <> t1").select("half"), "halves")
    wanted = halves.join(known, "half").groupBy("tid").agg(F.collect_set("half").alias("halves"))
    wanted = wanted.join(texts.select("tid", "rep"), "tid")
    chosen = docs.join(wanted, "tid").filter(F.col("key").eqNullSafe(F.col("rep"))).select("tid", "text", "halves")
    spans = match_spans(suffix_records(chosen))
    whole = hashes.join(texts.filter("copies > 1"), "tid").select("tid", F.lit(0).cast("long").alias("begin"), F.col("n_words").alias("end"))
    merged = _merge(spans.unionByName(whole))
    return docs.select("key", "tid").join(merged, "tid").select(F.col("key").alias(key), "begin", "end", (F.col("end") - F.col("begin")).alias("n_words"))
