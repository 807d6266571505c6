"""Packing by lexical retrieval: windows of documents that share rare words.

A document is its token ids and an end id. Whole windows of a long document are
sequences of their own; what is left, shorter than a window, is an item. Each
item goes to the shard of one of its tokens, the one that weighs most for how
often its document has it and how late it stands in the vocabulary, where entries
are the rarer the later. A token that very many items have in common is spread
over as many shards as its items fill. A shard builds
an inverted index with BM25 weights (document counts and mean length are those
of the whole table). A seed asks the index with its own tokens; the unused items
that answer best follow it until the window is full. The last of them is cut
there, and its rest is the next seed, so every window is full. A shard's last
window is cut into sequences whose lengths are powers of two: nothing is padded.

What reaches the driver are sums by token, at most one row for each id of the
vocabulary.

Defined results: NULL and empty texts are the end id alone; repeated rows are
packed one by one; NULL keys are kept; an empty table gives an empty result;
extra columns are ignored. Equal scores go by the order of rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.word_tokenizer import WordTokenizer
from tidemark.llm.words import pieces
from tidemark.session import settle

SEQUENCE = 2048
END_ID = 1
SHARD_TOKENS = 1 << 19
K1, B = 1.2, 0.75  # the usual constants of BM25
MOST_TASKS = 16_384
NEAREST = 32  # neighbours sorted at first; the others follow if these do not fill a window

_tokenizers: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def public_vocabulary(name: str = "word_bpe_49k") -> str:
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json")


def id_bytes(size: int) -> str:
    """How ids are stored between stages: two bytes each if that is enough."""
    return "<u2" if size <= 1 << 16 else "<u4"


def tokenize(df: DataFrame, key: str, text: str, vocabulary: str, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Rows (kind, key, row, start, length, ids_crc32, doc_tokens, route, ids): 0 a
    whole window, 1 an item with its token for a shard and its ids, 2 (one a
    task) the number of the task's documents that hold each token."""
    kind = df.schema[key].dataType.simpleString()
    schema = f"kind int, key {kind}, row long, start long, length long, ids_crc32 long, doc_tokens long, route long, ids binary"
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _tokenizer(vocabulary)
        stored = id_bytes(words.size)
        row = TaskContext.get().partitionId() << 40
        holds = np.zeros(words.size, np.int64)
        late = np.log1p(np.arange(words.size))
        keys = None
        for batch in batches:
            keys = batch.column(0)
            for lo, hi, data, offsets in pieces(batch.column(1)):
                raw = data.tobytes()
                at, kinds, start, length, crc, whole, routes, kept = [], [], [], [], [], [], [], []
                for i in range(hi - lo):
                    ids = words.encode(raw[offsets[i] : offsets[i + 1]])
                    token, count = np.unique(ids, return_counts=True)
                    holds[token] += 1
                    # a document's item goes by all of its tokens
                    route = int(token[np.argmax(late[token] * count / (count + K1))]) if len(token) else words.size
                    ids = np.append(ids, END_ID)
                    for a in range(0, len(ids), sequence):
                        part = ids[a : a + sequence]
                        full = len(part) == sequence
                        at.append(lo + i)
                        kinds.append(0 if full else 1)
                        start.append(a)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.astype("<u4").tobytes()))
                        whole.append(len(ids))
                        routes.append(None if full else route)
                        kept.append(None if full and not with_ids else part.astype(stored).tobytes())
                columns = [pa.array(kinds, pa.int32()), keys.take(pa.array(at, pa.int64())), pa.array(np.arange(row, row + len(at)))]
                columns += [pa.array(c, pa.int64()) for c in (start, length, crc, whole, routes)]
                row += len(at)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.binary())], names=names)
        if keys is not None:
            none = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([2], pa.int32()), pa.nulls(1, keys.type), *[none] * 6, pa.array([holds.tobytes()], pa.binary())], names=names)

    return df.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def token_documents(tokens: DataFrame, size: int) -> np.ndarray:
    """Documents of the whole table that hold each token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for held in batch.column(0).to_pylist():
                total += np.frombuffer(held, np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["token", "n"])

    sums = tokens.filter("kind = 2").select("ids").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for r in sums.collect():  # at most one row for each id of the vocabulary
        out[r["token"]] = r["n"]
    return out


class Index:
    """BM25 postings of items: for every token its items and their weights."""

    def __init__(self, items: list[np.ndarray], idf: np.ndarray, mean: float):
        n = len(items)
        owner = np.repeat(np.arange(n), [len(i) for i in items])
        token = np.concatenate(items) if n else np.zeros(0, np.int64)
        code, count = np.unique(token * n + owner if n else token, return_counts=True)
        token, self.owner = np.divmod(code, max(n, 1))
        length = np.array([len(i) for i in items], np.float64)
        scale = K1 * (1 - B + B * length / max(mean, 1e-9))
        self.weight = idf[token] * count * (K1 + 1) / (count + scale[self.owner])
        self.first = np.searchsorted(token, np.arange(len(idf) + 1))
        self.n = n

    def scores(self, tokens: np.ndarray) -> np.ndarray:
        spans = [slice(a, b) for a, b in zip(self.first[tokens].tolist(), self.first[tokens + 1].tolist()) if a < b]
        if not spans:
            return np.zeros(self.n)
        owners = np.concatenate([self.owner[s] for s in spans])
        return np.bincount(owners, np.concatenate([self.weight[s] for s in spans]), self.n)


def best_first(scores: np.ndarray, used: np.ndarray) -> Iterator[int]:
    """Unused items by falling score, those without a score left out."""
    scores = np.where(used, 0.0, scores)
    some = np.flatnonzero(scores > 0)
    if len(some) > 4 * NEAREST:
        bound = np.partition(scores[some], -NEAREST)[-NEAREST]
        near = some[scores[some] >= bound]
        yield from near[np.argsort(-scores[near], kind="stable")].tolist()
        some = some[scores[some] < bound]
    yield from some[np.argsort(-scores[some], kind="stable")].tolist()


def fill_windows(items: list[np.ndarray], lengths: list[int], idf: np.ndarray, mean: float, sequence: int = SEQUENCE) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (item, from, to). ``items`` are tokens to search by,
    ``lengths`` what each item takes. All windows but the last few are full, and
    those have a power of two of tokens."""
    index = Index(items, idf, mean)
    used = np.zeros(len(items), bool)
    windows: list[list[tuple[int, int, int]]] = []
    rest, later = None, 0

    def next_unused() -> int | None:
        nonlocal later
        while later < len(items) and used[later]:
            later += 1
        return later if later < len(items) else None

    def answers(seed: int) -> Iterator[int]:
        yield from best_first(index.scores(np.unique(items[seed])), used)
        while (i := next_unused()) is not None:  # these share no token with the seed
            yield i

    while True:
        if rest is None:
            first = next_unused()
            if first is None:
                return windows
            rest = (first, 0)
        seed, begin = rest
        rest = None
        used[seed] = True
        window, room = [(seed, begin, lengths[seed])], sequence - (lengths[seed] - begin)
        if room:
            for i in answers(seed):
                used[i] = True
                cut = min(room, lengths[i])
                window.append((i, 0, cut))
                room -= cut
                if cut < lengths[i]:
                    rest = (i, cut)
                if not room:
                    break
        if room:
            return windows + powers_of_two(window)
        windows.append(window)


def powers_of_two(window: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """A window cut into sequences whose lengths are powers of two."""
    total = sum(b - a for _, a, b in window)
    out, left = [], list(reversed(window))
    for bit in reversed(range(total.bit_length())):
        room = total & 1 << bit
        if room:
            out.append([])
        while room:
            i, a, b = left.pop()
            cut = min(b, a + room)
            out[-1].append((i, a, cut))
            room -= cut - a
            if cut < b:
                left.append((i, cut, b))
    return out


def pack_documents(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    sequence: int = SEQUENCE,
    shard_tokens: int = SHARD_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """Per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset
    and, if asked for, the ids."""
    vocabulary = vocabulary or public_vocabulary()
    size = WordTokenizer(vocabulary).size
    stored = id_bytes(size)
    spark = df.sparkSession
    tokens = settle(tokenize(df, key, text, vocabulary, sequence, with_ids), "tokens")
    items = tokens.filter("kind = 1").drop("kind")
    holds = token_documents(tokens, size)
    starts, lengths = F.count(F.when(F.col("start") == 0, 1)), F.avg(F.when(F.col("kind") == 1, F.col("length")))
    documents, mean = tokens.filter("kind < 2").agg(starts, lengths).first()
    idf, mean = np.log1p((documents - holds + 0.5) / (holds + 0.5)), mean or 1.0

    # One row for each id of the vocabulary. The routes stand on a line of all
    # tokens; a route's items lie evenly over its part of it.
    loads = sorted((r["route"], r["n"]) for r in items.groupBy("route").agg(F.sum("length").alias("n")).collect())
    begin = np.cumsum([0, *[n for _, n in loads]]).tolist()
    shards = max(1, -(-begin[-1] // shard_tokens))
    line = spark.createDataFrame([(r, b, n) for (r, n), b in zip(loads, begin)], "route long, begin long, load long")
    share = F.shiftrightunsigned(F.xxhash64("row"), 11).cast("double") / 2.0**53
    shard = F.floor((F.col("begin") + share * F.col("load")) / shard_tokens).cast("long")
    placed = items.join(F.broadcast(line), "route").select("key", "row", "start", "doc_tokens", "ids", shard.alias("shard"))

    own = f"key {df.schema[key].dataType.simpleString()}"
    result = f"{own}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids
    names = [f.split()[0] for f in result.split(", ")]

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        ids = [np.frombuffer(raw, stored).astype(np.int64) for raw in table.column("ids").to_pylist()]
        first = table.column("start").to_numpy()
        number = int(table.column("shard")[0].as_py()) << 32
        at, start, length, crc, sequence_id, offset, kept = [], [], [], [], [], [], []
        # the end id says nothing about a text
        for window in fill_windows([i[:-1] for i in ids], [len(i) for i in ids], idf, mean, sequence):
            filled = 0
            for i, a, b in window:
                at.append(i)
                start.append(first[i] + a)
                length.append(b - a)
                crc.append(zlib.crc32(ids[i][a:b].astype("<u4").tobytes()))
                sequence_id.append(number)
                offset.append(filled)
                kept.append(ids[i][a:b].astype(stored).tobytes())
                filled += b - a
            number += 1
        rows = pa.array(at, pa.int64())
        columns = [table.column("key").take(rows), *[pa.array(c, pa.int64()) for c in (start, length, crc)], table.column("doc_tokens").take(rows)]
        columns += [pa.array(c, pa.int64()) for c in (sequence_id, offset)] + [pa.array(kept, pa.binary())] * with_ids
        return pa.Table.from_arrays(columns, names=names)

    # a task takes its shards one after the other
    dealt = placed.repartition(min(shards, MOST_TASKS), "shard").groupBy("shard").applyInArrow(fill, result)
    alone = tokens.filter("kind = 0").select(
        "key", "start", "length", "ids_crc32", "doc_tokens", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *["ids"] * with_ids
    )
    return dealt.unionByName(alone).withColumnRenamed("key", key)
