"""How filters of a cascade act on each other: a Gray-code walk over subsets.

Every document fails some of the filters, which is a mask of five bits. Per
part (a language), documents are counted by mask: 32 cells whatever the input.
The walk visits all 32 subsets of filters by toggling one filter at a time. Each
cell keeps a counter of the active filters it fails; when the counter leaves or
reaches zero, the cell leaves or joins the running survivors. The survivors of
the 32 states are stored, and what a step of any of the 120 orders removes is a
difference of two states. The walk is vectorised over the parts of a batch and
runs on executors, so the number of parts is not bounded either.

Filters (words are maximal runs of ``[^\\x20\\x09-\\x0D]``): A under
``MIN_WORDS`` words; B distinct words under ``MIN_DISTINCT`` percent; C capital
letters over ``MAX_CAPITALS`` percent of the code points; D a character of
``SYMBOLS``; E the text stands at a smaller key, anywhere in the table.

Defined results: a NULL text is an empty one; a NULL part is the part ''; a row
with a NULL key never fails E and has no label, and its key is not smaller than
any; rows with the same key and text do not fail E by each other; repeated rows
count each; labels of a key are joined by "any row says 1"; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import BY_CASE, Words, pieces
from tidemark.session import settle

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, SYMBOLS = 100, 80, 10, b"#$%&*|"
STATES = 1 << len(FILTERS)
COUNTS = ["n", "good", "toxic"]
RESULT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"

_byte = np.arange(256)
_capital = (_byte >= 0x41) & (_byte <= 0x5A)
_leads = (_byte & 0xC0) != 0x80  # the first byte of a code point
_symbol = np.isin(_byte, np.frombuffer(SYMBOLS, np.uint8))


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def text_masks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits 0 to 3 (filters A to D) of each text of a piece."""
    words = Words(data, offsets, BY_CASE)
    n = np.diff(words.first)
    owner = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((words.hash, owner))
    h, o = words.hash[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    distinct = np.bincount(o[new], minlength=len(n))
    fails = [
        n < MIN_WORDS,
        100 * distinct < MIN_DISTINCT * n,
        100 * _per_text(_capital[data], offsets) > MAX_CAPITALS * _per_text(_leads[data], offsets),
        _per_text(_symbol[data], offsets) > 0,
    ]
    return sum(f.astype(np.int32) << i for i, f in enumerate(fails))


def mask_texts(df: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """(key, part, mask, digest) per row; equal texts have equal digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(3)):
                columns = [batch.column(i).slice(lo, hi - lo) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(text_masks(data, offsets), pa.int32())], names=["key", "part", "digest", "mask"])

    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(key).cast("long").alias("key"),
        F.coalesce(F.col(part), F.lit("")).alias("part"),
        F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest"),
        body.alias("body"),
    )
    return rows.mapInArrow(run, "key long, part string, digest binary, mask int")


def count_cells(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail.

    Documents of equal text differ only in filter E, so copies fold before they
    meet: first by key, then by text, part and labels into one row that carries
    its count and, for its smallest key, the rows there. A text of any number
    of copies thus reaches the comparison of smallest keys as a few rows.
    """
    marks = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("key")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    said = [F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    marked = mask_texts(df, key, text, part).join(marks, "key", "left").select("key", "part", "digest", "mask", *said)
    same = ["digest", "mask", "part", "good", "toxic"]
    by_key = marked.groupBy("key", *same).agg(F.count(F.lit(1)).alias("n"))
    folded = by_key.groupBy(*same).agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("key").isNotNull(), F.struct("key", "n"))).alias("least"), F.sum(F.when(F.col("key").isNull(), F.col("n"))).alias("keyless")
    )
    folded = settle(folded, "texts")
    first = folded.groupBy("digest").agg(F.min("least.key").alias("first"))
    here = F.when(F.col("least.key") == F.col("first"), F.col("least.n")).otherwise(0) + F.coalesce("keyless", F.lit(0))
    split = folded.join(first, "digest").withColumn("own", here)
    late = 1 << FILTERS.index("E")
    cells = F.explode(
        F.array(
            F.struct(F.col("mask"), F.col("own").alias("n")),
            F.struct((F.col("mask") + late).alias("mask"), (F.col("n") - F.col("own")).alias("n")),
        )
    ).alias("cell")
    flat = split.select("part", "good", "toxic", cells).select("part", "good", "toxic", "cell.*")
    return flat.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


def walk_subsets(cells: np.ndarray) -> np.ndarray:
    """Survivors of every subset of filters; ``cells`` is (parts, masks, counts).

    The Gray code changes one filter a step, so only the cells that fail it are
    touched.
    """
    states = np.empty_like(cells)
    fails = [np.flatnonzero(np.arange(STATES) >> f & 1) for f in range(len(FILTERS))]
    active = np.zeros(STATES, np.int64)
    running = cells.sum(axis=1)
    subset = 0
    states[:, subset] = running
    for step in range(1, STATES):
        f = (step & -step).bit_length() - 1
        subset ^= 1 << f
        hit = fails[f]
        if subset >> f & 1:
            active[hit] += 1
            running = running - cells[:, hit[active[hit] == 1]].sum(axis=1)
        else:
            active[hit] -= 1
            running = running + cells[:, hit[active[hit] == 0]].sum(axis=1)
        states[:, subset] = running
    return states


def steps_of(states: np.ndarray) -> list[tuple[str, int, np.ndarray]]:
    """(order, step, seven columns of the parts) for all orders, as differences
    of two states."""
    k, full = len(FILTERS), STATES - 1
    n = states[:, :, 0]
    shapley = np.zeros((len(states), k), np.int64)
    for f in range(k):
        for s in range(STATES):
            if not s >> f & 1:
                size = s.bit_count()
                shapley[:, f] += factorial(size) * factorial(k - 1 - size) * (n[:, s] - n[:, s | 1 << f])
    out = []
    for order in permutations(range(k)):
        before = 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            lost = states[:, before] - states[:, after]
            failing = n[:, 0] - n[:, 1 << f]
            alone = n[:, full ^ 1 << f] - n[:, full]
            columns = np.stack([n[:, after], lost[:, 0], failing - lost[:, 0], alone, lost[:, 1], lost[:, 2], shapley[:, f]])
            out.append(("".join(FILTERS[i] for i in order), step, columns))
            before = after
    return out


def audit(cells: DataFrame) -> DataFrame:
    """The 600 rows of every part from its cells."""
    at = [F.sum(F.when(F.col("mask") == m, F.col(c)).otherwise(0)) for m in range(STATES) for c in COUNTS]
    parts = cells.groupBy("part").agg(F.array(*at).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                some = batch.slice(lo, 64)
                m = some.num_rows
                grid = some.column(1).flatten().to_numpy(zero_copy_only=False).reshape(m, STATES, len(COUNTS))
                steps = steps_of(walk_subsets(grid))
                values = np.concatenate([c for _, _, c in steps], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0).take(pa.array(np.tile(np.arange(m), len(steps)))),
                        pa.array([o for o, _, _ in steps for _ in range(m)]),
                        pa.array([s for _, s, _ in steps for _ in range(m)], pa.int32()),
                        *[pa.array(v) for v in values],
                    ],
                    names=[f.split()[0] for f in RESULT.split(", ")],
                )

    return parts.mapInArrow(run, RESULT)


def audit_filters(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Per part, order and step: what the step keeps, removes and loses."""
    return audit(count_cells(df, labels, key, text, part))
