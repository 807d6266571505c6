"""Recurring lines by a log-template tree.

A line's words lead through a tree of fixed depth: the number of words, then
the leading words; words with a digit are variable everywhere. Only a leaf that
lines of ``MIN_DOCS`` texts reach can hold a recurring template, so a first count
of one number per line leaves a small part of all lines. Inside a leaf, lines
share a template if they agree on all positions of one of these sets, and the
other positions are its variable fields:

* from ``LONG`` words on, the positions behind the leading words are cut into
  four blocks: any two blocks (so that fields within two blocks may vary, a name
  of several words too), the even ones or the odd ones (scattered fields);
* from ``SHORT`` words on, all positions but one; below that, all.

So at least half of the words of two such lines are the same at the same places.
A line has a key per set. Keys are counted as sums of per-document sets: a
common line is one row per task before the shuffle, and no leaf is gathered.

A template recurs if it stands in at least ``MIN_DOCS`` documents, where equal
texts count once, and so do near copies: what copies share is their text, for
near-duplicate removal to choose from. Near copies are told by a small sketch of
the text (``BINS`` minima of one permutation of its word shingles): texts that
share a band are compared with the first of their bucket, and those that agree
on ``ALIKE`` of the sketch are linked. Lines of recurring templates are dropped in
every document, however much of it they make.

Defined results: NULL texts stay NULL and empty ones empty; lines without a
word are never dropped; repeated rows are treated alike; a text of recurring
lines only becomes empty; an empty table gives an empty result; columns other
than the text (and the counts added) stay as they are, NULL keys included.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import free_name
from tidemark.llm.components import connected
from tidemark.llm.words import BY_CASE, Words, long_array, mix, pieces
from tidemark.session import settle

MIN_DOCS = 3
LEADING = 2  # depth of the tree below the word count
SHORT, LONG = 4, 8
BLOCKS = 4
BINS, BANDS, BAND_BINS = 64, 8, 4
SHINGLE = 5
ALIKE = 0.7
#: Texts of a task remembered to pass over their copies.
REMEMBERED = 100_000
#: Longs of the filter by which lines of rare leaves are left out before they move.
SLOTS = 1 << 18
_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
_VARIABLE = _U(0x5851F42D4C957F2D)
_PAIRS = list(combinations(range(BLOCKS), 2))
_MOST = len(_PAIRS) + 2  # keys of a long line


class LineKeys:
    """Keys of the lines of a run of texts, in bulk: per line with a word its
    ``text`` and ``line`` number there, ``leaf`` and keys (those of line i are
    ``keys[bounds[i]:bounds[i + 1]]``)."""

    def __init__(self, words: Words, data: np.ndarray, offsets: np.ndarray):
        digits = np.concatenate([[0], np.cumsum((data >= 0x30) & (data <= 0x39))])
        h = np.where(digits[words.end] > digits[words.start], _VARIABLE, words.hash)
        ends = np.concatenate([[0], np.cumsum(data == 0x0A)])  # line ends before each byte
        per_text = np.diff(words.first)
        text = np.repeat(np.arange(len(per_text)), per_text)
        line = ends[words.start] - ends[offsets[text]]
        opens = np.ones(len(h), bool)
        opens[1:] = (text[1:] != text[:-1]) | (line[1:] != line[:-1])
        first = np.flatnonzero(opens)
        n = np.diff(np.append(first, len(h)))
        self.text, self.line = text[first], line[first]
        place = np.arange(len(h)) - np.repeat(first, n)
        term = mix(h + mix(place.astype(np.uint64) * _GOLD))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(term)])
        even = np.concatenate([np.zeros(1, np.uint64), np.cumsum(np.where(place % 2 == 0, term, _U(0)))])
        rest = first + np.minimum(LEADING, n)
        last = first + n
        self.leaf = mix(total[rest] - total[first] + mix(n.astype(np.uint64)))
        count = np.where(n < SHORT, 1, np.where(n < LONG, n - LEADING, _MOST))
        self.bounds = np.concatenate([[0], np.cumsum(count)])
        self.keys = np.zeros(self.bounds[-1], np.uint64)

        def put(lines: np.ndarray, number: int, sums: np.ndarray) -> None:
            self.keys[self.bounds[lines] + number] = mix(self.leaf[lines] + mix(sums + _U(number + 1)))

        exact = np.flatnonzero(n < SHORT)
        put(exact, 0, total[last[exact]] - total[rest[exact]])
        for left_out in range(LEADING, LONG - 1):
            some = np.flatnonzero((n >= SHORT) & (n < LONG) & (n > left_out))
            put(some, left_out - LEADING, total[last[some]] - total[rest[some]] - term[first[some] + left_out])
        many = np.flatnonzero(n >= LONG)
        cut = [rest[many] + (n[many] - LEADING) * b // BLOCKS for b in range(BLOCKS + 1)]
        blocks = [total[b] - total[a] for a, b in zip(cut, cut[1:])]
        for number, (a, b) in enumerate(_PAIRS):
            put(many, number, blocks[a] + blocks[b])
        evens = even[last[many]] - even[rest[many]]
        put(many, len(_PAIRS), evens)
        put(many, len(_PAIRS) + 1, total[last[many]] - total[rest[many]] - evens)


def sketches(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(sketch, has): per text the minima of its shingles by bin; an empty bin
    takes over the next one's. Texts without a shingle have none."""
    shingles, bounds = words.runs(SHINGLE)
    texts = len(bounds) - 1
    owner = np.repeat(np.arange(texts), np.diff(bounds))
    out = np.full(texts * BINS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(out, owner * BINS + (shingles >> _U(58)).astype(np.int64), shingles)
    out = out.reshape(texts, BINS)
    empty = out == np.iinfo(np.uint64).max
    has = ~empty.all(axis=1)
    filled, step = out.copy(), 0
    while empty[has].any():
        step += 1
        take = empty & ~np.roll(out == np.iinfo(np.uint64).max, -step, axis=1)
        filled[take] = mix(np.roll(out, -step, axis=1)[take] + _U(step))
        empty &= ~take
    return filled, has


def _tid(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _keyed(df: DataFrame, text: str) -> DataFrame:
    """Per text: its id, leaf, number and keys of each line, bands and sketch.
    Copies of a text within a task are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            new = []
            for i, tid in enumerate(ids):
                if tid not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(tid)
                    new.append(i)
            if len(new) < len(ids):
                batch = batch.take(pa.array(new, pa.int64()))
            for lo, hi, data, offsets in pieces(batch.column(1)):
                words = Words(data, offsets, BY_CASE)
                lines = LineKeys(words, data, offsets)
                own = np.searchsorted(lines.text, np.arange(hi - lo + 1)).astype(np.int32)
                keys = long_array(lines.keys, lines.bounds)
                sketch, has = sketches(words)
                bands = np.zeros((hi - lo, BANDS), np.uint64)
                for b in range(BANDS):
                    for j in range(BAND_BINS):
                        bands[:, b] = mix(bands[:, b] + sketch[:, b * BAND_BINS + j] + _U(b + 1))
                low = (sketch & _U(0xFFFF)).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.ListArray.from_arrays(pa.array(own), pa.array(lines.leaf.view(np.int64))),
                        pa.ListArray.from_arrays(pa.array(own), pa.array(lines.line.astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(own), keys),
                        long_array(bands[has].ravel(), np.concatenate([[0], np.cumsum(np.where(has, BANDS, 0))])),
                        pa.array([s.tobytes() if h else None for s, h in zip(low, has)], pa.binary()),
                    ],
                    names=["tid", "leaves", "lines", "keys", "bands", "sketch"],
                )

    rows = df.select(_tid(F.col(text)).alias("tid"), F.col(text)).filter("tid is not null")
    return rows.mapInArrow(run, "tid binary, leaves array<long>, lines array<int>, keys array<array<long>>, bands array<long>, sketch binary")


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, BINS) for i in (2, 3))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array((a == b).mean(axis=1) >= ALIKE))


def copy_classes(texts: DataFrame) -> DataFrame:
    """(node, root) of near copies among stored ``texts`` (g, bands, sketch)."""
    banded = texts.select("g", F.explode("bands").alias("band"))
    firsts = banded.groupBy("band").agg(F.min("g").alias("b"), F.max("g").alias("_last")).filter("b < _last").select("band", "b")
    pairs = banded.join(firsts, "band").filter("g <> b").select(F.col("g").alias("a"), "b").distinct()
    one, other = (texts.select(F.col("g").alias(n), F.col("sketch").alias(f"s{n}")) for n in ("a", "b"))
    met = pairs.join(one, "a").join(other, "b").select("a", "b", "sa", "sb")
    return connected(met.mapInArrow(_alike, "a long, b long"))


def may_hold(rows: DataFrame, key: str, members: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``key`` (a hash) is none of
    ``members``; no other is lost. The members are bits of ``SLOTS`` longs, which
    are sent to the rows, so that few of them move when they meet the members."""
    slot, bit = f"shiftrightunsigned({key}, 6) & {SLOTS - 1}", f"cast({key} & 63 as int)"
    bits = members.groupBy(F.expr(slot).alias("_slot")).agg(F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("_bits"))
    met = rows.withColumn("_slot", F.expr(slot)).join(F.broadcast(bits), "_slot")
    return met.filter(F.getbit("_bits", F.expr(bit)) == 1).drop("_slot", "_bits")


def recurring_lines(df: DataFrame, text: str, min_docs: int = MIN_DOCS) -> DataFrame:
    """(tid, drop): numbers of the lines with a recurring template, by text."""
    keyed = settle(_keyed(df, text), "line_keys")
    often = keyed.select(F.explode(F.array_distinct("leaves")).alias("leaf")).groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    # such keys are stored, so that their joins have a plain shuffle on both sides
    # and a key of very many lines is split
    often = settle(often.filter(F.col("n") >= min_docs).select("leaf"), "leaves")
    lines = keyed.select("tid", F.explode(F.arrays_zip("leaves", "lines", "keys")).alias("x"))
    lines = lines.select("tid", F.col("x.leaves").alias("leaf"), F.col("x.lines").alias("line"), F.col("x.keys").alias("keys"))
    inside = may_hold(lines, "leaf", often).join(often, "leaf")
    # copies of a text in several tasks are one from here on; it goes by a short number
    inside = inside.groupBy("tid").agg(F.collect_set(F.struct("line", "keys")).alias("lines"))
    inside = settle(inside.select(F.monotonically_increasing_id().alias("n"), "tid", "lines"), "leaf_lines")
    shared = inside.select(F.explode(F.array_distinct(F.flatten("lines.keys"))).alias("key"))
    shared = shared.groupBy("key").agg(F.count(F.lit(1)).alias("texts")).filter(F.col("texts") >= min_docs)
    shared = settle(shared.select("key"), "shared_keys")
    each = inside.select("n", F.explode("lines").alias("x")).select("n", F.col("x.line").alias("line"), F.explode("x.keys").alias("key"))
    hits = settle(each.join(shared, "key"), "line_hits")
    wanted = inside.select("n", "tid").join(hits.select("n").distinct(), "n", "left_semi")
    texts = keyed.filter("sketch is not null").select("tid", "bands", "sketch").join(wanted, "tid")
    # the first of a bucket is told by a hash of the text, so that every run has the same
    name = F.xxhash64("tid").alias("g")
    texts = settle(texts.dropDuplicates(["tid", "n"]).select("n", name, "bands", "sketch"), "line_texts")
    classes = texts.select("n", "g").join(copy_classes(texts).withColumnRenamed("node", "g"), "g").select("n", "root")
    alone = F.when(F.col("root").isNull(), F.col("n")).alias("alone")
    stands = hits.join(classes, "n", "left").select("key", "root", alone).distinct()
    known = stands.groupBy("key").agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") >= min_docs).select("key")
    known = settle(known, "recurring_keys")
    found = hits.join(known, "key").groupBy("n").agg(F.sort_array(F.collect_set("line")).alias("drop"))
    return inside.select("n", "tid").join(found, "n").select("tid", "drop")


def drop_templates(df: DataFrame, text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """``df`` without recurring lines, plus n_lines and n_dropped (which replace
    columns of that name)."""
    tid, drop = free_name(df, "text_id"), free_name(df, "drop_lines")
    found = recurring_lines(df, text, min_docs).select(F.col("tid").alias(tid), F.col("drop").alias(drop))
    joined = df.withColumn(tid, _tid(F.col(text))).join(found, tid, "left")
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda x, i: ~F.array_contains(drop, i))
    cut = F.col(drop).isNotNull()
    added = {
        "n_lines": F.coalesce(F.size(lines), F.lit(0)),
        "n_dropped": F.when(cut, F.size(drop)).otherwise(0),
        text: F.when(cut, F.array_join(kept, "\n")).otherwise(F.col(text)),
    }
    return joined.withColumns(added).drop(tid, drop)
