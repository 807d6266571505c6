"""Small tables with the awkward cases, and plain versions of what operators do."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def prose(rng: random.Random, n: int) -> str:
    syllables = ["ka", "to", "mi", "re", "sun", "vel", "dor", "ish", "én", "pra", "lu", "xo"]
    out = []
    for _ in range(n):
        out.append("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))))
        if rng.random() < 0.06:
            out[-1] += ".\n"
    return " ".join(out)


def edited(rng: random.Random, text: str, rate: float) -> str:
    w = text.split(" ")
    for i in range(len(w)):
        if rng.random() < rate:
            w[i] = "zz%d" % rng.randrange(10**6)
    return " ".join(w)


def awkward() -> list[tuple]:
    """NULLs in every column, empty, blank and very long texts, repeated rows."""
    long = prose(random.Random(9), 30_000)
    rows = [
        (1, None, "en", "a", None),
        (2, "", "en", None, 0),
        (3, " \t\n ", None, "a", 4),
        (None, "a row without a key has five words and more", "en", "a", 1),
        (None, None, None, None, None),
        (4, long, "en", "a", len(long)),
        (5, "one", "en", "a", 3),
        (5, "one", "en", "a", 3),
        (6, "x" * 20_000, "en", "a", 20_000),
        (7, "emoji 😀 and \x00 nul", "en", "a", 9),
    ]
    return [(*r,) for r in rows]


def frame(spark, rows, clash: bool = False):
    df = spark.createDataFrame(rows, SCHEMA)
    if clash:
        from pyspark.sql import functions as F

        for name in "key class component kept shard slot size bin node offset length range tid drop rule host path score features votes bucket root id n_words n_lines begin end".split():
            df = df.withColumn(name, F.lit("clash"))
    return df
