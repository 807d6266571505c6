"""Toxicity by weak supervision.

Voters look at a text and vote by presence: groups of lexicon entries (words,
word beginnings, and beginnings of two different words of a text, that labelled
toxic texts use far more than others) and
patterns (several different entries, dense entries, shouting, exclamation).
A generative model of all votes, fitted by EM without labels, estimates how
each voter votes on toxic and clean texts and how voters correlate within a
class; correlated voters are discounted. Its posteriors are the labels on which
a linear classifier is trained; true labels then set the scale of its score and
the weight of a text's length.

An entry is one if its labelled texts are toxic far more often than chance
allows: the probability of so many toxic ones among them (a Chernoff bound on
the binomial tail) times the number of entries tested is at most ``CHANCE``. So
few labels give few entries, and more labels also rarer ones. Voters and features
that count hits go by their number in ``RATE`` words of a longer text, so that a
very long text does not collect votes; more hits never lower a score.

Vote patterns are counted over all documents. With ``N_VOTERS`` voters there
are at most ``2 ** N_VOTERS`` patterns, so the model is fitted on those counts.
The lexicon and the classifier see a sample of at most ``max_labelled``
labelled rows, taken by a hash of the key.

Defined results: NULL and empty texts are scored as texts without any vote;
repeated rows are scored alike; labels with a NULL key or value are ignored and
of several labels of a key the largest counts; without toxic labels every score
is the share of toxic labels, 0; an empty table gives an empty result; NULL keys
are scored like others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Matrices
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import BY_ALNUM, Words, long_array, pieces
from tidemark.session import settle

MAX_LABELLED = 12_000
#: Expected number of chance entries, and the share of an entry's texts that are toxic.
CHANCE, MOSTLY = 0.05, 0.8
PREFIXES = (4, 5, 6)  # bytes of a word's beginning
GROUPS_PER_KIND = 2
#: Kind 0 are words, then come the beginnings, then those of two different words.
KINDS = 1 + 2 * len(PREFIXES)
N_GROUPS = KINDS * GROUPS_PER_KIND
PATTERNS = ("two_entries", "four_entries", "dense", "shouting", "exclaims")
N_VOTERS = N_GROUPS + len(PATTERNS)
N_FEATURES = N_GROUPS + 5  # the last is the length
#: Words of a long text for each hit that a voter asks for.
RATE = 1000
THRESHOLD = 0.3
_U = np.uint64
_KIND_SALT = np.random.default_rng(20250411).integers(1, 2**63, 1 + len(PREFIXES), dtype=np.uint64)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_labels(labels: DataFrame, key: str, label: str, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(key, label) of at most ``max_labelled`` rows that are not held out."""
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
    known = known.groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("_label"))
    return known.orderBy(F.xxhash64("_key"), "_key").limit(max_labelled)


def _entries(words: Words) -> list[np.ndarray]:
    """Per kind the entry hash of every word; words shorter than a prefix keep
    their own length in it."""
    out = [words.hash ^ _KIND_SALT[0]]
    for k, n in enumerate(PREFIXES, 1):
        out.append(words.part(words.start, np.minimum(words.end, words.start + n)) ^ _KIND_SALT[k])
    return out


def _different(text: np.ndarray, entry: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, entry, number of different words with it), sorted by text."""
    order = np.lexsort([word, entry, text])
    t, e, w = text[order], entry[order], word[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (e[1:] != e[:-1])
    other = new.copy()
    other[1:] |= w[1:] != w[:-1]
    at = np.flatnonzero(new)
    return t[at], e[at], np.add.reduceat(other.astype(np.int64), at) if len(at) else at


def find_lexicon(rows: DataFrame, text: str, label: str, chance: float = CHANCE) -> list[tuple[int, int]]:
    """(entry, kind) of the entries tied to label 1, the strongest first.

    ``rows`` is the bounded sample, which bounds the entries too: each stands in
    several of its texts. An entry counts once per text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(1)):
                words = Words(data, offsets, BY_ALNUM)
                text_of = np.repeat(np.arange(hi - lo), np.diff(words.first))
                for kind, entry in enumerate(_entries(words)):
                    text, seen, n = _different(text_of, entry, words.hash)
                    for k, some in ((kind, n >= 1), (kind + len(PREFIXES), n >= 2))[: 1 + (kind > 0)]:
                        bounds = np.searchsorted(text[some], np.arange(hi - lo + 1))
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).slice(lo, hi - lo), pa.array(np.full(hi - lo, k, np.int32)), long_array(seen[some], bounds)],
                            names=["label", "kind", "entries"],
                        )

    seen = rows.select(F.col(label).cast("int"), F.col(text)).mapInArrow(run, "label int, kind int, entries array<long>")
    counts = seen.select("label", "kind", F.explode("entries").alias("entry")).groupBy("kind", "entry").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")
    )
    total, toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(label), F.lit(0))).first()
    if not toxic or toxic == total:
        return []
    counts = settle(counts, "entries")
    base = toxic / total
    own = F.col("toxic") / F.col("n")
    rest = F.when(own < 1, (1 - own) * F.log((1 - own) / (1 - base))).otherwise(0.0)
    mostly = counts.filter(own >= max(MOSTLY, base))
    evidence = mostly.withColumn("evidence", F.col("n") * (own * F.log(own / base) + rest))
    strong = evidence.filter(F.col("evidence") >= float(np.log(max(counts.count(), 1) / chance)))
    best = strong.orderBy(F.desc("evidence"), "kind", "entry").collect()
    return [(r["entry"], r["kind"]) for r in best]


@dataclass
class Lexicon:
    """Entries of all kinds with their groups, for looking up many words."""

    entries: list[tuple[int, int]]
    kinds: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(init=False)

    def __post_init__(self):
        self.kinds = []
        for kind in range(KINDS):
            own = np.array([e for e, k in self.entries if k == kind], np.int64).view(np.uint64)
            group = kind * GROUPS_PER_KIND + np.arange(len(own)) % GROUPS_PER_KIND
            order = np.argsort(own)
            sieve = np.zeros(1 << 16, bool)
            sieve[(own & _U(0xFFFF)).astype(np.int64)] = True
            self.kinds.append((own[order], group[order], sieve))

    def features(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(texts x features) and the votes of each text as bits."""
        n = len(offsets) - 1
        words = Words(data, offsets, BY_ALNUM)
        sizes = np.diff(words.first)
        hits = np.zeros((n, N_GROUPS))
        any_hit = np.zeros(len(words.hash), bool)
        found = []
        for kind, entry in enumerate(_entries(words)):
            for k in (kind, kind + len(PREFIXES))[: 1 + (kind > 0)]:
                known, group, sieve = self.kinds[k]
                if not len(known):
                    continue
                maybe = np.flatnonzero(sieve[(entry & _U(0xFFFF)).astype(np.int64)])
                at = np.minimum(np.searchsorted(known, entry[maybe]), len(known) - 1)
                good = known[at] == entry[maybe]
                word, at = maybe[good], at[good]
                text = np.searchsorted(words.first, word, "right") - 1
                if k != kind:  # keep beginnings of two different words
                    t, a, others = _different(text, at, words.hash[word])
                    keep = np.isin(text * len(known) + at, (t * len(known) + a)[others >= 2])
                    word, at, text = word[keep], at[keep], text[keep]
                np.add.at(hits, (text, group[at]), 1)
                any_hit[word] = True
                found.append(np.stack([text, words.hash[word].view(np.int64)], axis=1))
        different = np.zeros(n, np.int64)
        if found:
            pairs = np.unique(np.concatenate(found), axis=0)
            different = np.bincount(pairs[:, 0], minlength=n)
        hit_words = np.diff(np.concatenate([[0], np.cumsum(any_hit)])[words.first])
        density = hit_words / np.maximum(sizes, 1)

        def share(flag: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(flag)])
            return np.diff(sums[offsets]) / np.maximum(np.diff(offsets), 1)

        shouting = share((data >= 65) & (data <= 90))
        exclaims = share(data == 33)
        long = np.maximum(sizes / RATE, 1)
        features = np.column_stack([np.log1p(hits / long[:, None]), np.log1p(different / long), 100 * density, 10 * shouting, 10 * exclaims, np.log1p(sizes)])
        votes = np.column_stack([hits >= long[:, None], different >= 2 * long, different >= 4 * long, density >= 0.01, shouting > 0.3, exclaims > 0.02])
        return features, votes @ (1 << np.arange(N_VOTERS))


def vote(df: DataFrame, key: str, text: str, lexicon: Lexicon) -> DataFrame:
    """(key, features, votes) of every row."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(1)):
                features, votes = lexicon.features(data, offsets)
                flat = pa.array(features.reshape(-1))
                lists = pa.ListArray.from_arrays(pa.array((np.arange(hi - lo + 1) * N_FEATURES).astype(np.int32)), flat)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lists, pa.array(votes.astype(np.int64))], names=["key", "features", "votes"])

    return df.select(F.col(key), F.col(text)).mapInArrow(run, f"key {kind}, features array<double>, votes long")


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, prior: float, rounds: int = 3, steps: int = 40) -> np.ndarray:
    """Posterior of label 1 for every vote pattern, by EM over pattern counts.

    Each round fits the voters' rates per class, then their correlations within
    a class; a voter that says what others say counts by its share only.
    """
    bits = ((patterns[:, None] >> np.arange(N_VOTERS)) & 1).astype(float)
    posterior = 1 / (1 + np.exp(3 - 2 * bits[:, :N_GROUPS].sum(axis=1)))
    discount = np.ones(N_VOTERS)
    base = np.log(prior / (1 - prior))
    for _ in range(rounds):
        for _ in range(steps):
            rates = []
            for w in (counts * posterior, counts * (1 - posterior)):
                rates.append((w @ bits + 0.5) / (w.sum() + 1))
            yes = np.log(rates[0]) - np.log(rates[1])
            no = np.log1p(-rates[0]) - np.log1p(-rates[1])
            logit = base + (bits * yes + (1 - bits) * no) @ discount
            posterior = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        strength = np.zeros((N_VOTERS, N_VOTERS))
        for w, rate in zip((counts * posterior, counts * (1 - posterior)), rates):
            total = w.sum() + 1e-9
            apart = bits - rate
            cov = (apart * w[:, None]).T @ apart / total
            scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            strength += np.abs(cov / np.outer(scale, scale)) / 2
        np.fill_diagonal(strength, 0)
        discount = 1 / (1 + np.where(strength > 0.1, np.minimum(strength, 1), 0).sum(axis=1))
    return posterior


@dataclass
class Model:
    """Score: 1 / (1 + exp(-(weights . features + bias)))."""

    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights + self.bias, -500, 500)))


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", max_labelled: int = MAX_LABELLED) -> Model:
    """Fit voters, label model and classifier; see the module's description."""
    # at most max_labelled keys: small enough to send to every task
    train = F.broadcast(training_labels(labels, key, label, max_labelled))
    sample = settle(df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(train, "_key"), "labelled")
    total, toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("_label"), F.lit(0))).first()
    lexicon = Lexicon(find_lexicon(sample, "_text", "_label"))
    share = toxic / total if total else 0.0
    if not lexicon.entries:
        edge = np.clip(share, 1e-9, 1 - 1e-9)
        return Model(lexicon, np.zeros(N_FEATURES), float(np.log(edge / (1 - edge))))
    counted = vote(df, key, text, lexicon).groupBy("votes").agg(F.count(F.lit(1)).alias("n")).toPandas()
    patterns, counts = counted["votes"].to_numpy(), counted["n"].to_numpy(float)
    posterior = fit_label_model(patterns, counts, min(max(share, 0.001), 0.5))
    spark = df.sparkSession
    soft = spark.createDataFrame([(int(v), float(p)) for v, p in zip(patterns, posterior)], "votes long, p double")
    voted = vote(sample, "_label", "_text", lexicon).join(F.broadcast(soft), "votes")
    rows = settle(voted.select("features", F.col("key").cast("double").alias("truth"), "p"), "posteriors")
    both = rows.select(
        array_to_vector("features").alias("features"),
        F.explode(F.array(F.struct(F.lit(1.0).alias("y"), F.col("p").alias("w")), F.struct(F.lit(0.0).alias("y"), (1 - F.col("p")).alias("w")))).alias("x"),
    ).select("features", "x.y", "x.w")
    # hits, different entries and density only speak for label 1
    least = [0.0] * (N_GROUPS + 2) + [-1e6] * (N_FEATURES - N_GROUPS - 2)
    linear = LogisticRegression(
        featuresCol="features", labelCol="y", weightCol="w", regParam=1e-4, maxIter=100, lowerBoundsOnCoefficients=Matrices.dense(1, N_FEATURES, least)
    ).fit(both)
    weights, bias = np.array(linear.coefficients.toArray()), linear.intercept
    raw = sum((F.get("features", i) * float(w) for i, w in enumerate(weights)), F.lit(float(bias)))
    length = F.get("features", N_FEATURES - 1)
    scale = rows.select(array_to_vector(F.array(raw, length)).alias("features"), F.col("truth").alias("y"))
    if scale.select("y").distinct().count() == 2:
        platt = LogisticRegression(featuresCol="features", labelCol="y", regParam=1e-4, maxIter=100).fit(scale)
        slope, shift = max(float(platt.coefficients[0]), 0.0), float(platt.intercept)
        weights, bias = weights * slope, bias * slope + shift
        weights[-1] += float(platt.coefficients[1])
    return Model(lexicon, weights, float(bias))


def score_texts(df: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """(key, score) of every row."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(1)):
                score = model.score(model.lexicon.features(data, offsets)[0])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(score)], names=["key", "score"])

    return df.select(F.col(key), F.col(text)).mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)


def drop_toxic(df: DataFrame, text: str, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``df`` that score below the threshold, all columns as they are."""
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(model.lexicon.features(d, o)[0]) for _, _, d, o in pieces(batch.column(at))]
            if scores:
                yield batch.filter(pa.array(np.concatenate(scores) < threshold))

    return df.mapInArrow(run, df.schema)
