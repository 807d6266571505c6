"""A prefix trie of conversations in shards of flat, perfectly hashed tables.

A node is a distinct sequence of first turns. It is named by a 128-bit digest:
two polynomial sums over the turns' hashes, so the digest of a prefix follows
from sums of any cut of a conversation and no conversation, however long, has
to be in one task. Four steps, each of whose results is a stored table:

1. Turns are range-sorted by conversation and place, and get running sums;
   what enters a range is one row per range.
2. Conversations are rebuilt from their base's first turns and their own later
   ones by arithmetic on those sums (``rebuild``); a row is a conversation and a
   depth, with the digests of the node and of its parent.
3. Rows fold into nodes: members, the smallest member, members that end there.
4. Every node counts for all nodes above it. A node's smallest member passes
   through all of these, so the node is dealt to that conversation's shard,
   where the whole path is. A shard enumerates its distinct digests, gives them
   slots by a minimal perfect hash, verifies each slot by the digest stored in
   it, scatters counts into flat arrays and adds them up through the array of
   parent slots, deepest first. Sums of a node over all shards are its own.

Shards hold conversations by hash, cut into bands of ``BAND`` turns; what lies
below a band enters it as one row. Their number follows the rows, so a shard is
bounded whatever share of rows one node or conversation has.

Defined results: rows without a conversation id are left out; NULL role and
text are empty; a NULL turn comes first; turns of equal number go by role, then
text (by their first ``NAMED`` characters, then by a hash of the whole); repeated
rows are repeated turns; an empty table gives an empty result, and else there is
always a root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.perfect_hash import PerfectHash
from tidemark.llm.words import mix
from tidemark.session import settle

FAMILY = 5  # conversations that share the first one's turns
HEAD = 8  # most turns taken over
NAMED = 256  # characters of role and text that order turns of equal number
RANGE_ROWS = 200_000
SHARD_ROWS = 200_000
BAND = 4096
ID_BLOCK = 10  # bits of an id within one block of an ends list
_U = np.uint64
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_DEPTHS = (_U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F))
_LOW = 1 << 12


def powers(base: int, e: np.ndarray) -> np.ndarray:
    """``base`` to each power ``e``, modulo 2**64."""

    def table(b: int, n: int) -> np.ndarray:
        steps = np.full(n + 1, _U(b))
        steps[0] = 1
        return np.multiply.accumulate(steps)

    if not len(e):
        return np.zeros(0, np.uint64)
    low, high = e % _LOW, e // _LOW
    return table(base, _LOW)[low] * table(pow(base, _LOW, 1 << 64), int(high.max()))[high]


def digest(sums: np.ndarray, depth: np.ndarray, lane: int) -> np.ndarray:
    return mix(sums + depth.astype(np.uint64) * _DEPTHS[lane])


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _sums(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return _longs(batch, name).view(np.uint64)


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns.values()], names=list(columns))


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places and running sums of the conversations of one sorted range."""
    part = TaskContext.get().partitionId()
    first = last = None
    at, carry = 0, [_U(0), _U(0)]
    for batch in batches:
        conv = _longs(batch, "conv_id")
        if not len(conv):
            continue
        first = conv[0] if first is None else first
        if conv[0] != last:
            at, carry = 0, [_U(0), _U(0)]
        new = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        size = np.diff(np.append(new, len(conv)))
        entry = np.zeros(len(new), np.int64)
        entry[0] = at
        place = np.arange(len(conv)) - np.repeat(new - entry, size) + 1
        sums, before = [], []
        for lane, base in enumerate(_BASES):
            term = _sums(batch, f"w{lane}") * powers(base, place)
            total = np.cumsum(term)
            enters = np.zeros(len(new), np.uint64)
            enters[1:] = total[new[1:] - 1]
            enters[0] -= carry[lane]
            total = total - np.repeat(enters, size)
            sums.append(total)
            before.append(total - term)
        last, at, carry = conv[-1], int(place[-1]), [s[-1] for s in sums]
        yield _batch(
            part=np.full(len(conv), part, np.int64), opens=conv == first, conv_id=conv, pos=place, size=_longs(batch, "size"),
            p0=sums[0], p1=sums[1], q0=before[0], q1=before[1],
        )


_TURNS = "conv_id long, pos long, size long, p0 long, p1 long, q0 long, q1 long"


def ordered_turns(df: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(conv_id, pos, size, p0, p1, q0, q1): every turn's place in its
    conversation, text bytes, and sums up to it and up to the one before."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = df.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring(role, 1, NAMED).alias("r"),
        F.substring(text, 1, NAMED).alias("t"),
        F.xxhash64(role, text).alias("w0"),
        F.xxhash64(F.lit(1), F.md5(text), role).alias("w1"),
        F.octet_length(text).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // range_rows))
    # the row number only parts turns that are the same in all else
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), *map(F.col, ("r", "t", "w0", "w1", "row"))]
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv_id", "w0", "w1", "size")
    stored = settle(ranged.mapInArrow(_running, f"part long, opens boolean, {_TURNS}"), "turns")
    state = F.struct("conv_id", "pos", "p0", "p1")
    ends = stored.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.when(F.col("opens"), state)).alias("head"), F.max(state).alias("tail"))
    # one row per range
    enters, before = {}, None
    for r in sorted(ends.collect(), key=lambda r: r["part"]):
        goes_on = before is not None and before[0] == r["first"]
        if goes_on:
            enters[r["part"]] = before[1:]
        before = tuple(r["tail"])
        if goes_on and r["tail"]["conv_id"] == r["first"]:
            n, *sums = enters[r["part"]]
            wrapped = [(s + pow(b, n, 1 << 64) * p) % (1 << 64) for b, s, p in zip(_BASES, sums, before[2:])]
            before = (before[0], n + before[1], *wrapped)
    enters = {p: (n, *[s % (1 << 64) for s in sums]) for p, (n, *sums) in enters.items()}

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, opens = _longs(batch, "part"), batch.column(1).to_numpy(zero_copy_only=False)
            out = {n: _longs(batch, n).copy() for n in ("conv_id", "pos", "size")} | {n: _sums(batch, n).copy() for n in ("p0", "p1", "q0", "q1")}
            for p in np.unique(part[opens]).tolist():
                if p in enters:
                    at = np.flatnonzero((part == p) & opens)
                    n, *sums = enters[p]
                    out["pos"][at] += n
                    for lane, base in enumerate(_BASES):
                        for name in (f"p{lane}", f"q{lane}"):
                            out[name][at] = out[name][at] * _U(pow(base, n, 1 << 64)) + _U(sums[lane])
            yield _batch(**out)

    return stored.mapInArrow(shift, _TURNS)


def taken_over(conv_id: Column) -> Column:
    """Turns a conversation takes over from the first of its family."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(HEAD + 1)).cast("long")


_PATHS = "conv_id long, depth long, k0 long, k1 long, up0 long, up1 long, size long, ends boolean"


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        depth, back = _longs(batch, "pos") - _longs(batch, "back"), _longs(batch, "back")
        keys = {}
        for lane, base in enumerate(_BASES):
            scale = powers(pow(base, -1, 1 << 64), back)
            for name, sums, d in (("k", "p", depth), ("up", "q", depth - 1)):
                total = _sums(batch, f"own{lane}")
                total = _sums(batch, f"base{lane}") + (_sums(batch, f"{sums}{lane}") - total) * scale
                keys[f"{name}{lane}"] = digest(total, d, lane)
        yield _batch(
            conv_id=_longs(batch, "conv_id"), depth=depth, k0=keys["k0"], k1=keys["k1"], up0=keys["up0"], up1=keys["up1"],
            size=_longs(batch, "size"), ends=depth == _longs(batch, "total"),
        )


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(paths, lengths): a row per rebuilt conversation and depth, and every
    conversation's rebuilt number of turns."""
    turn = F.struct("pos", "size", "p0", "p1", "q0", "q1")
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("n"), F.sort_array(F.collect_list(F.when(F.col("pos") <= HEAD, turn))).alias("head"))
    convs = settle(convs, "heads")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("head").alias("lead"))
    taken = F.least(taken_over(F.col("conv_id")), F.coalesce(F.size("lead"), F.lit(0)).cast("long"))

    def total(head: str, n: str, lane: int) -> Column:
        return F.when(F.col(n) > 0, F.get(F.col(head), (F.col(n) - 1).cast("int"))[f"p{lane}"]).otherwise(F.lit(0).cast("long"))

    known = (
        convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
        .join(bases, "base", "left")
        .withColumns({"skip": taken_over(F.col("conv_id")), "taken": taken})
        .withColumn("total", F.col("taken") + F.greatest(F.col("n") - F.col("skip"), F.lit(0)))
    )
    zero = F.lit(0).cast("long")
    lead = known.filter("taken > 0").select(
        "conv_id", "total", zero.alias("back"), F.explode(F.slice("lead", 1, F.col("taken").cast("int"))).alias("x"),
        *[zero.alias(f"{s}{i}") for s in ("base", "own") for i in (0, 1)],
    ).select("x.*", "conv_id", "total", "back", "base0", "base1", "own0", "own1")
    moves = known.filter("n > skip").select(
        "conv_id", "total", (F.col("skip") - F.col("taken")).alias("back"),
        *[total("lead", "taken", i).alias(f"base{i}") for i in (0, 1)],
        *[total("head", "skip", i).alias(f"own{i}") for i in (0, 1)],
    )
    own = turns.filter(F.col("pos") > taken_over(F.col("conv_id"))).join(moves, "conv_id")
    paths = settle(lead.unionByName(own).mapInArrow(_paths, _PATHS), "paths")
    return paths, settle(known.select("conv_id", "total"), "lengths")


_SHARE = "k0 long, k1 long, n_children long, n_leaves long, saved_tokens long"


def accumulate(table: pa.Table, band: int = BAND) -> pa.Table:
    """What one shard's nodes add to each of its digests.

    Rows: digest, parent's digest, depth, kind (0 a path, 1 a node owned here, 2
    what lies below a band), saved tokens and leaves to add.
    """
    col = {n: table.column(n).to_numpy() for n in ("k0", "k1", "up0", "up1", "depth", "kind", "saved", "leaves")}
    keys = [np.concatenate([col[f"k{i}"], col[f"up{i}"]]).view(np.uint64) for i in (0, 1)]
    n = len(col["depth"])
    real = np.concatenate([np.ones(n, bool), (col["kind"] < 2) & (col["depth"] > 0)])  # a root has no parent
    keys = [k[real] for k in keys]
    seed = _U(0)
    while True:  # until no two digests share a code
        codes = mix(keys[0] ^ mix(keys[1] + seed))
        table_ = PerfectHash(np.unique(codes))
        slot = table_.slots(codes)
        stored = [np.zeros(table_.size, np.uint64) for _ in keys]
        for s, k in zip(stored, keys):
            s[slot] = k
        if all((s[slot] == k).all() for s, k in zip(stored, keys)):
            break
        seed += _U(1)
    own = slot[:n]
    above = np.full(n, -1, np.int64)
    above[real[n:]] = slot[n:]
    depth = np.zeros(table_.size, np.int64)
    linked = above >= 0
    depth[above[linked]] = col["depth"][linked] - 1
    depth[own] = col["depth"]
    children, leaves, saved = (np.zeros(table_.size, np.int64) for _ in range(3))
    nodes = (col["kind"] == 1) & linked
    np.add.at(children, above[nodes], 1)
    np.add.at(leaves, own, col["leaves"])
    np.add.at(saved, own, col["saved"])
    # a band's top is not added to the turn above, where it comes as kind 2
    parent = np.full(table_.size, -1, np.int64)
    inside = linked & ((col["depth"] == 1) | ((col["depth"] - 1) % band > 0))
    parent[own[inside]] = above[inside]
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        level = level[parent[level] >= 0]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    some = np.flatnonzero(children | leaves | saved)
    return pa.Table.from_batches([_batch(k0=stored[0][some], k1=stored[1][some], n_children=children[some], n_leaves=leaves[some], saved_tokens=saved[some])])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's comma-joined ids, streamed block by block."""
    now, state = None, None
    for batch in batches:
        k0, k1, shas = [], [], []
        for a, b, ids in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            if (a, b) == now:
                state.update(b"," + ids.encode())
                continue
            if now:
                k0.append(now[0]), k1.append(now[1]), shas.append(state.hexdigest())
            now, state = (a, b), hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(k0, pa.int64()), pa.array(k1, pa.int64()), pa.array(shas, pa.string())], names=["k0", "k1", "sha"])
    if now:
        yield pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]]), pa.array([state.hexdigest()])], names=["k0", "k1", "sha"])


def ends_digests(ends: DataFrame) -> DataFrame:
    """(k0, k1, sha) of nodes where members end; a block holds at most
    ``2 ** ID_BLOCK`` ids, and a node's blocks pass through one hash in order."""
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string"))
    blocks = ends.groupBy("k0", "k1", F.shiftright("conv_id", ID_BLOCK).alias("block")).agg(F.array_join(ids, ",").alias("ids"))
    ranged = blocks.repartition("k0", "k1").sortWithinPartitions("k0", "k1", "block").select("k0", "k1", "ids")
    return ranged.mapInArrow(_ends, "k0 long, k1 long, sha string")


def prefix_trie(df: DataFrame, range_rows: int = RANGE_ROWS, shard_rows: int = SHARD_ROWS, band_turns: int = BAND) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    spark = df.sparkSession
    paths, lengths = rebuild(ordered_turns(df, range_rows))
    root = {"k0": 0, "k1": 0}  # the digest of no turns
    root_keys = [F.lit(v).cast("long").alias(k) for k, v in root.items()]
    folded = paths.groupBy("k0", "k1").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("up0").alias("up0"), F.min("up1").alias("up1"),
        F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("ends").cast("long")).alias("n_ends"), F.max("size").alias("size"),
    )
    top = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum((F.col("total") == 0).cast("long")).alias("n_ends"))
    none = F.lit(0).cast("long")
    top = top.filter("n_convs > 0").select(*root_keys, "conv_id", none.alias("depth"), none.alias("up0"), none.alias("up1"), "n_convs", "n_ends", none.alias("size"))
    nodes = settle(folded.unionByName(top), "nodes")

    def band(depth: Column) -> Column:
        return F.greatest(F.floor((depth - 1) / band_turns), F.lit(0)).cast("long")

    add = {"saved": (F.col("n_convs") - 1) * F.col("size"), "leaves": (F.col("n_ends") == F.col("n_convs")).cast("long")}
    columns = ["conv_id", "depth", "k0", "k1", "up0", "up1"]
    owned = nodes.withColumns(add).select(*columns, F.lit(1).alias("kind"), "saved", "leaves", band(F.col("depth")).alias("band"))
    walked = paths.select(*columns, F.lit(0).alias("kind"), none.alias("saved"), none.alias("leaves"), band(F.col("depth")).alias("band"))
    dealt = owned.unionByName(walked)
    if not lengths.filter(F.col("total") > band_turns).isEmpty():
        dealt = dealt.unionByName(_below(owned, walked, band_turns))
    shards = max(spark.sparkContext.defaultParallelism, -(-2 * paths.count() // shard_rows))
    shard = F.pmod(F.xxhash64("conv_id", "band"), F.lit(shards))
    inputs = dealt.select(shard.alias("shard"), "k0", "k1", "up0", "up1", "depth", "kind", "saved", "leaves")
    shares = inputs.groupBy("shard").applyInArrow(lambda table: accumulate(table, band_turns), _SHARE)
    ends = paths.filter("ends").select("k0", "k1", "conv_id").unionByName(lengths.filter("total = 0").select(*root_keys, "conv_id"))
    given = {"conv_id": "long", "depth": "long", "up0": "long", "up1": "long", "n_convs": "long", "n_children": "long", "n_leaves": "long", "saved_tokens": "long", "sha": "string"}

    def widened(part: DataFrame) -> DataFrame:
        return part.select("k0", "k1", *[F.col(c) if c in part.columns else F.lit(None).cast(t).alias(c) for c, t in given.items()])

    whole = widened(nodes).unionByName(widened(shares)).unionByName(widened(ends_digests(ends)))
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    joined = whole.groupBy("k0", "k1").agg(*[F.max(c).alias(c) for c in ("conv_id", "depth", "up0", "up1", "n_convs", "sha")], *sums)
    # one row per key on the right; a parent of very many children is split
    parents = nodes.select(F.col("k0").alias("up0"), F.col("k1").alias("up1"), F.col("conv_id").alias("above"))
    return joined.join(parents, ["up0", "up1"], "left").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("above")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )


def _below(owned: DataFrame, walked: DataFrame, band_turns: int) -> DataFrame:
    """For conversations of several bands: what the bands further down add to
    the last turn of each band, as a row of that turn."""
    sums = owned.filter("band > 0").groupBy("conv_id", "band").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    tops = walked.filter((F.col("band") > 0) & (F.col("depth") == F.col("band") * band_turns + 1)).drop("saved", "leaves", "k0", "k1")
    onward = Window.partitionBy("conv_id").orderBy(F.col("band").desc())
    none = F.lit(0).cast("long")
    added = tops.join(sums, ["conv_id", "band"], "left").select(
        "conv_id", (F.col("band") - 1).alias("band"), (F.col("depth") - 1).alias("depth"), F.col("up0").alias("k0"), F.col("up1").alias("k1"),
        none.alias("up0"), none.alias("up1"), F.lit(2).alias("kind"),
        *[F.sum(F.coalesce(c, none)).over(onward).alias(c) for c in ("saved", "leaves")],
    )
    return added
