"""Near-duplicate documents by b-bit MinHash.

Texts are lowered (A-Z), cut into words at ASCII white space, and become sets
of five-word shingles. Equal sets are one class from the start. Candidates come
from bands of full minima; the low bits of the minima, packed into a
signature, give a collision-corrected estimate that drops hopeless candidates;
what is left is confirmed on the full sets.

Links only have to give the right components, so a bucket is not multiplied
out: first its components are each compared with one of them, in buckets of
several bands (nearly equal members) and then of one; at last only members of
different components that still share a bucket are compared, all of them.

Defined results: NULL and wordless texts have an empty set, link with nothing
and are kept; fewer than five words are one shingle; a NULL doc_id takes no
part (component NULL, kept); repeated rows form one class, in which every row
with the smallest doc_id is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import free_name
from tidemark.llm.components import merge_roots
from tidemark.llm.words import Words, long_array, mix, pieces, runs
from tidemark.session import settle

SHINGLE = 5
MINIMA = 1024
BANDS, ROWS = 25, 5
BITS = 2  # of each minimum; 32 of them fill a long
SIGNATURE = MINIMA * BITS // 64
CHANCE = 1 / 2**BITS  # that different minima agree in their low bits

_rng = np.random.default_rng(20250117)
_SEEDS = _rng.integers(1, 2**63, MINIMA, dtype=np.uint64)
_MULTS = _rng.integers(1, 2**63, MINIMA, dtype=np.uint64) | np.uint64(1)


def _shingles(texts: Words) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes (with repeats) and bounds per text; a short text is one."""
    sizes = np.diff(texts.first)
    values, bounds = runs(texts.hash, texts.first, SHINGLE)
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if not len(short):
        return values, bounds
    extra = np.empty(len(short), np.uint64)
    for j, i in enumerate(short):
        own = texts.hash[texts.first[i] : texts.first[i + 1]]
        extra[j] = runs(own, np.array([0, len(own)]), len(own))[0][0] ^ np.uint64(len(own))
    counts = np.diff(bounds)
    counts[short] = 1
    return np.insert(values, bounds[short], extra), np.concatenate([[0], np.cumsum(counts)])


def _sets(texts: Words) -> list[np.ndarray]:
    values, bounds = _shingles(texts)
    return [np.unique(values[bounds[i] : bounds[i + 1]]) for i in range(len(bounds) - 1)]


def _class_id(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _minima(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Minima per text with a shingle (texts without are left out)."""
    full = np.flatnonzero(np.diff(bounds) > 0)
    starts = bounds[:-1][full]
    out = np.empty((len(full), MINIMA), np.uint64)
    work = np.empty_like(values)
    for k in range(MINIMA):
        np.bitwise_xor(values, _SEEDS[k], out=work)
        np.multiply(work, _MULTS[k], out=work)
        out[:, k] = np.minimum.reduceat(work, starts)
    return out


def sketch(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, text_hash, n_shingles, class (16 bytes, NULL without shingles), bands,
    signature."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(1)):
                texts = Words(data, offsets)
                values, bounds = _shingles(texts)
                sets = [np.unique(values[bounds[i] : bounds[i + 1]]) for i in range(hi - lo)]
                sizes = np.fromiter(map(len, sets), np.int64, len(sets))
                full = np.flatnonzero(sizes)
                flat = np.concatenate(sets) if len(full) else np.zeros(0, np.uint64)
                bands = np.zeros((len(full), BANDS), np.uint64)
                packed = np.zeros((len(full), SIGNATURE), np.uint64)
                if len(full):
                    least = mix(_minima(flat, np.concatenate([[0], np.cumsum(sizes)])))
                    for b in range(BANDS):
                        h = np.full(len(full), np.uint64(b + 1))
                        for j in range(ROWS):
                            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + least[:, b * ROWS + j])
                        bands[:, b] = h
                    low = least & np.uint64((1 << BITS) - 1)
                    for k in range(MINIMA):
                        packed[:, k * BITS // 64] |= low[:, k] << np.uint64(k * BITS % 64)
                has = (sizes > 0).astype(np.int64)
                ids = [_class_id(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(2).slice(lo, hi - lo),
                        pa.array(sizes),
                        pa.array(ids, pa.binary()),
                        long_array(bands.reshape(-1), np.concatenate([[0], np.cumsum(has * BANDS)])),
                        long_array(packed.reshape(-1), np.concatenate([[0], np.cumsum(has * SIGNATURE)])),
                    ],
                    names=["key", "text_hash", "n_shingles", "class", "bands", "signature"],
                )

    return df.select(F.col(key), F.col(text), F.xxhash64(text)).mapInArrow(
        run, f"key {kind}, text_hash long, n_shingles long, class binary, bands array<long>, signature array<long>"
    )


def shingle_sets(df: DataFrame, classes: DataFrame, key: str, text: str) -> DataFrame:
    """(id, shingles) of the classes asked for, each from a row with its key
    ``rep`` and text hash, so that a key on very many rows is no hot key."""
    wanted = classes.select(F.col("rep").alias("key"), F.col("rep_hash").alias("text_hash"), "id", "class")
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    rows = rows.join(wanted, ["key", "text_hash"]).select("text", "id", "class")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(0)):
                own = batch.column(2).slice(lo, hi - lo).to_pylist()
                sets = _sets(Words(data, offsets))
                # a repeated row comes again, another text with that hash as well
                good = [i for i in range(hi - lo) if len(sets[i]) and _class_id(sets[i]) == own[i]]
                if good:
                    flat = np.concatenate([sets[i] for i in good])
                    bounds = np.concatenate([[0], np.cumsum([len(sets[i]) for i in good])])
                    ids = batch.column(1).take(pa.array([lo + i for i in good]))
                    yield pa.RecordBatch.from_arrays([ids, long_array(flat, bounds)], names=["id", "shingles"])

    return rows.mapInArrow(run, "id long, shingles array<long>").dropDuplicates(["id"])


def estimate(a: Column, b: Column) -> Column:
    """Similarity from packed low bits: matches are counted by bits, and the
    matches that b random bits give by chance are taken out."""
    ones = 0x5555555555555555
    differ = None
    for i in range(SIGNATURE):
        x = a[i].bitwiseXOR(b[i])
        pair = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(ones))
        differ = F.bit_count(pair) if differ is None else differ + F.bit_count(pair)
    return (1 - differ / F.lit(float(MINIMA)) - CHANCE) / (1 - CHANCE)


def slack(percent: int) -> float:
    """Five standard deviations of an estimate (0.066 for 85 percent): a true
    link falls lower once in three million times."""
    agree = CHANCE + (1 - CHANCE) * percent / 100
    return 5 * (agree * (1 - agree) / MINIMA) ** 0.5 / (1 - CHANCE)


def _alike(percent: int) -> Column:
    """Sizes and signatures of sides a and b leave the similarity possible."""
    sizes = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    return sizes & (estimate(F.col("sa"), F.col("sb")) >= percent / 100 - slack(percent))


def _side(sketches: DataFrame, n: str) -> DataFrame:
    return sketches.select(F.col("id").alias(n), F.col("n_shingles").alias(f"n{n}"), F.col("signature").alias(f"s{n}"))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``pairs`` (a, b, ra, rb) whose full sets are similar enough."""
    full = lambda n: sets.select(F.col("id").alias(n), F.col("shingles").alias(f"f{n}"))
    shared = F.size(F.array_intersect("fa", "fb"))
    return (
        pairs.join(full("a"), "a")
        .join(full("b"), "b")
        .filter(100 * shared >= percent * (F.size("fa") + F.size("fb") - shared))
        .select("ra", "rb")
    )


def _buckets(sketches: DataFrame, depth: int) -> DataFrame:
    """(id, band, bucket): one bucket per band, keyed by the minima of ``depth``
    bands in a row. Deeper buckets hold more similar members."""
    keys = F.transform("bands", lambda x, i: F.xxhash64(*[F.get("bands", (i + d) % BANDS) for d in range(depth)]))
    return sketches.select("id", F.posexplode("bands" if depth == 1 else keys).alias("band", "bucket"))


def _placed(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return members.withColumn("root", F.col("id"))
    return members.join(roots.withColumnRenamed("node", "id"), "id", "left").select("bucket", "band", "id", F.coalesce("root", "id").alias("root"))


def _stars(placed: DataFrame) -> DataFrame:
    """In each bucket one member of every component against the first of them."""
    reps = placed.groupBy("bucket", "root").agg(F.min("id").alias("b"))
    lead = F.min(F.struct("b", "root")).alias("lead")
    leads = reps.groupBy("bucket").agg(lead, F.count(F.lit(1)).alias("n")).filter("n > 1")
    leads = leads.select("bucket", F.col("lead.b").alias("a"), F.col("lead.root").alias("ra"))
    return reps.join(leads, "bucket").filter("a <> b").select("a", "b", "ra", F.col("root").alias("rb")).distinct()


def _open_pairs(placed: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """All pairs of a bucket that lie in different components and may be similar:
    members outside of a bucket's largest component against all others. A pair
    comes from the first bucket that it shares."""
    sized = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    main = sized.groupBy("bucket").agg(F.max(F.struct("n", "root"))["root"].alias("main"), F.count(F.lit(1)).alias("roots"))
    rows = settle(placed.join(main.filter("roots > 1").select("bucket", "main"), "bucket").join(sketches.select("id", "n_shingles", "signature", "bands"), "id"), "open")
    minor = rows.filter("root <> main").select("bucket", F.col("id").alias("a"), F.col("root").alias("ra"), F.col("n_shingles").alias("na"), F.col("signature").alias("sa"), F.col("bands").alias("ba"), "band")
    other = rows.select("bucket", F.col("id").alias("b"), F.col("root").alias("rb"), F.col("main").alias("mb"), F.col("n_shingles").alias("nb"), F.col("signature").alias("sb"), F.col("bands").alias("bb"))
    # two minor members meet once, in the order of their numbers
    once = (F.col("rb") == F.col("mb")) | (F.col("a") < F.col("b"))
    first = ~F.arrays_overlap(F.slice("ba", 1, F.col("band")), F.slice("bb", 1, F.col("band")))
    joined = minor.join(other, (minor["bucket"] == other["bucket"]) & (F.col("ra") != F.col("rb")) & once & _alike(percent) & first)
    return joined.select("a", "b", "ra", "rb").distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """Per row of ``df``: key, n_shingles, component (smallest key reachable), kept,
    and text_hash, a 64-bit hash of the text."""
    rows = settle(sketch(df, key, text), "sketches")
    alive = rows.filter(F.col("class").isNotNull() & F.col("key").isNotNull())
    one = F.first(F.struct("n_shingles", "signature", "bands")).alias("x")
    least = F.min(F.struct("key", "text_hash")).alias("r")
    classes = alive.groupBy("class").agg(least, one)
    classes = classes.select("class", F.col("r.key").alias("rep"), F.col("r.text_hash").alias("rep_hash"), "x.*")
    classes = settle(classes.withColumn("id", F.monotonically_increasing_id()), "classes")  # numbers are fixed by storing them

    members = _buckets(classes, 1)
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    members = settle(members.join(shared, "bucket"), "buckets")
    busy = settle(classes.join(members.select("id").distinct(), "id", "left_semi"), "busy")
    sets = settle(shingle_sets(df, busy, key, text), "sets")

    def linked(stars: DataFrame) -> DataFrame:
        pairs = stars.join(_side(busy, "a"), "a").join(_side(busy, "b"), "b").filter(_alike(percent))
        return _confirm(pairs.select("a", "b", "ra", "rb"), sets, percent)

    deep = [_stars(_placed(_buckets(busy, depth), None)) for depth in (3, 2)]
    roots = merge_roots(None, linked(deep[0].unionByName(deep[1]).distinct()))
    roots = merge_roots(roots, linked(_stars(_placed(members, roots))))
    open_pairs = _open_pairs(_placed(members, roots), busy, percent)
    roots = merge_roots(roots, _confirm(open_pairs, sets, percent))
    grouped = classes.select("class", "rep", "id").join(roots.withColumnRenamed("node", "id"), "id", "left")
    grouped = grouped.select("class", "rep", F.coalesce("root", "id").alias("root"))
    least = grouped.groupBy("root").agg(F.min("rep").alias("component"))
    named = grouped.join(least, "root").select("class", "component")
    out = rows.select("key", "text_hash", "n_shingles", "class").join(named, "class", "left")
    component = F.coalesce("component", "key")
    return out.select(
        F.col("key").alias(key),
        "n_shingles",
        component.alias("component"),
        (F.col("key").isNull() | (F.col("key") == component)).alias("kept"),
        "text_hash",
    )


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """``df`` with one row of each component, all columns as they are; of rows
    that repeat a key and text one stays. Rows without a word or key all stay."""
    found = near_duplicates(df, key, text, percent).filter((F.col("n_shingles") > 0) & F.col(key).isNotNull())
    first = found.groupBy("component").agg(F.min(F.struct(F.col(key).alias("k"), F.col("text_hash").alias("h"))).alias("x"))
    own, k, h = (free_name(df, n) for n in ("own_hash", "chosen_key", "chosen_hash"))
    chosen = first.select(F.col("x.k").alias(k), F.col("x.h").alias(h))
    hashed = df.withColumn(own, F.xxhash64(text))
    same = (F.col(key) == F.col(k)) & (F.col(own) == F.col(h))
    kept = hashed.join(chosen, same, "left_semi").dropDuplicates([key, own]).drop(own)
    worded = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return kept.unionByName(df.filter(F.col(key).isNull() | ~worded))
