"""Best-fit packing of tokenised documents, in a tree of merges.

A document is its token ids and an end id; one that is longer than a sequence
is cut into full pieces behind a shorter first one. Pieces are dealt to leaves
of bounded size. A leaf packs best-fit decreasing and closes every sequence
that nothing can be added to. After best fit at most one sequence of a leaf is
up to half full, and two others never fit together, so only that one and the
``HOSTS`` emptiest others go on: as items of the next round, where
``FAN_IN`` leaves meet, until one node is left.

Defined results: NULL and empty texts are the end id alone; repeated rows are
packed one by one; NULL keys are kept; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import pieces
from tidemark.session import settle

SEQUENCE = 1024
END_ID = 2
LEAF_PIECES = 40_000
FAN_IN = 16
HOSTS = 32
_HUGE_RUN = 2000  # characters without white space, or of white space alone

_tokenizers: dict = {}


class ByteTokenizer:
    """Ids of a byte-level vocabulary given as a ``tokenizers`` file.

    The same vocabulary as ranks (``ranks``: a file of base64 token and rank)
    encodes several times faster and gives equal ids. Texts with the spelling
    of a special token, or with very long words, take the first way.
    """

    def __init__(self, path: str, ranks: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks and pattern:
            import base64

            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> list[int]:
        plain = self.fast is not None and not any(s in text for s in self.special)
        if plain and len(text) > _HUGE_RUN:
            plain = max(map(len, text.split()), default=len(text)) <= _HUGE_RUN and " " * _HUGE_RUN not in text and "\n" * _HUGE_RUN not in text
        return self.fast.encode_ordinary(text) if plain else self.slow.encode(text, add_special_tokens=False).ids


def public_tokenizer(name: str = "byte_bpe_50k") -> tuple[str, str | None, str | None]:
    """Paths and pattern of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN


def tokenize(df: DataFrame, key: str, text: str, vocabulary: tuple, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: key, piece, start, length, ids_crc32, row (a
    number of the piece that is unique in the table) and, if asked for, ids."""
    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long, row long" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _tokenizers:
            _tokenizers[vocabulary] = ByteTokenizer(*vocabulary)
        encode = _tokenizers[vocabulary].encode
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi, _, _ in pieces(batch.column(1)):
                at, piece, start, length, crc, kept = [], [], [], [], [], []
                for i, body in enumerate(batch.column(1).slice(lo, hi - lo).to_pylist()):
                    ids = np.array([*encode(body or ""), END_ID], "<u4")
                    cuts = [0, *range(len(ids) % sequence or sequence, len(ids) + 1, sequence)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        at.append(lo + i)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[a:b].tobytes()))
                        if with_ids:
                            kept.append(ids[a:b].astype(np.int32))
                columns = [
                    batch.column(0).take(pa.array(at, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                    pa.array(np.arange(row, row + len(at))),
                ]
                row += len(at)
                if with_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=["key", "piece", "start", "length", "ids_crc32", "row", *["ids"] * with_ids])

    return df.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, sequence: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best-fit decreasing: bin and offset of every item, and the fill of bins."""
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []  # rooms that some bin has, sorted
    fill: list[int] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        k = bisect_left(rooms, n)
        if k < len(rooms):
            room = rooms[k]
            b = by_room[room].pop()
            if not by_room[room]:
                del rooms[k]
        else:
            room, b = sequence, len(fill)
            fill.append(0)
        where[i], offset[i] = b, fill[b]
        fill[b] += n
        left = room - n
        if left:
            own = by_room.setdefault(left, [])
            if not own:
                rooms.insert(bisect_left(rooms, left), left)
            own.append(b)
    return where, offset, fill


def _still_open(fill: list[int], sequence: int) -> np.ndarray:
    """Bins worth another round: those up to half full, and the emptiest hosts."""
    full = np.array(fill)
    emptiest = np.argsort(full, kind="stable")[: HOSTS + int((2 * full <= sequence).sum())]
    out = np.zeros(len(full), bool)
    out[emptiest] = full[emptiest] < sequence
    return out


def _pack_node(number: str, item: str):
    """Pack one node's items; bins get numbers unique over all nodes."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), (item, "ascending")])
        lengths = table.column("length").to_numpy()
        where, offset, fill = best_fit(lengths)
        still = _still_open(fill, SEQUENCE)
        base = int(table.column(number)[0].as_py()) << 32
        return (
            table.append_column("bin", pa.array(base + where))
            .append_column("offset", pa.array(offset))
            .append_column("fill", pa.array(np.array(fill)[where]))
            .append_column("open", pa.array(still[where]))
        )

    return run


def pack(pieces_: DataFrame, leaf_pieces: int = LEAF_PIECES) -> DataFrame:
    """``pieces_`` (length and a unique row) with sequence_id and offset."""
    count = pieces_.count()
    leaves = max(1, -(-count // leaf_pieces))
    dealt = pieces_.withColumn("node", F.pmod(F.xxhash64("row"), F.lit(leaves)))
    packed = settle(
        dealt.groupBy("node").applyInArrow(_pack_node("node", "row"), _plus(dealt, "bin long, offset long, fill long, open boolean")), "packed"
    )
    bins = packed.filter("open").groupBy("bin", "node").agg(F.max("fill").alias("length"))
    moves = None
    level, nodes = 1, leaves
    while nodes > 1:
        nodes = -(-nodes // FAN_IN)
        items = bins.select(F.col("bin").alias("item"), "length", F.floor(F.col("node") / FAN_IN).cast("long").alias("node"))
        # numbers of the level's bins lie above those of all levels below
        items = items.withColumn("number", F.col("node") + F.lit(level * (1 << 26)))
        joined = settle(
            items.groupBy("node").applyInArrow(_pack_node("number", "item"), _plus(items, "bin long, offset long, fill long, open boolean")), "merged"
        )
        step = joined.select(F.col("item").alias("bin"), F.col("bin").alias("to"), F.col("offset").alias("shift"))
        if moves is None:
            moves = step
        else:
            higher = step.select(F.col("bin").alias("to"), F.col("to").alias("root"), F.col("shift").alias("more"))
            moves = settle(
                moves.join(higher, "to", "left").select(
                    "bin", F.coalesce("root", "to").alias("to"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift")
                ),
                "moves",
            )
        bins = joined.filter("open").groupBy("bin", "node").agg(F.max("fill").alias("length"))
        level += 1
    if moves is None:
        return packed.withColumn("sequence_id", F.col("bin")).drop("node", "bin", "fill", "open")
    # a few rows for each leaf; closed sequences are not looked up
    moved = packed.filter("open").join(moves, "bin", "left")
    moved = moved.withColumn("sequence_id", F.coalesce("to", "bin")).withColumn("offset", F.col("offset") + F.coalesce("shift", F.lit(0)))
    closed = packed.filter("not open").withColumn("sequence_id", F.col("bin"))
    names = [*pieces_.columns, "offset", "sequence_id"]
    return closed.select(*names).unionByName(moved.select(*names))


def _plus(df: DataFrame, more: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", " + more


def pack_documents(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: tuple | None = None, with_ids: bool = False) -> DataFrame:
    """Per piece: key, piece, start, length, ids_crc32, sequence_id, offset."""
    tokens = settle(tokenize(df, key, text, vocabulary or public_tokenizer(), SEQUENCE, with_ids), "pieces")
    return pack(tokens).drop("row").withColumnRenamed("key", key)
