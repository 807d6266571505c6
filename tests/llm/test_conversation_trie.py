from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversation_trie
from tidemark.llm.perfect_hash import PerfectHash

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_trie(data):
    convs = defaultdict(list)
    for c, turn, role, text in data:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    rows = []
    for node, who in members.items():
        inside = [n for n in members if n[: len(node)] == node]
        kids = [n for n in inside if len(n) == len(node) + 1]
        leaves = [n for n in inside if not any(len(m) == len(n) + 1 and m[:-1] == n for m in inside)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in inside if n)
        ends = ",".join(str(c) for c in sorted(who) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(who), len(node), parent, len(who), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def check(spark, data, **sizes):
    df = spark.createDataFrame(data, SCHEMA)
    for name in ("k0", "part", "shard", "depth", "pos", "base", "total"):
        df = df.withColumn(name, F.lit("clash"))
    got = [tuple(r) for r in conversation_trie.prefix_trie(df, **sizes).collect()]
    key = lambda r: (r[1], r[0])
    assert sorted(got, key=key) == sorted(plain_trie(data), key=key)


def some_conversations(rng, n):
    data = []
    for c in rng.sample(range(-20, 3 * n), n):
        for turn in range(rng.randint(1, 14)):
            data.append((c, turn, "user" if turn % 2 == 0 else "assistant", rng.choice(["hi", "yes é", "no", "a longer answer"])))
    return data


@pytest.mark.parametrize("sizes", [{}, {"range_rows": 20, "shard_rows": 50, "band_turns": 3}])
def test_trie_is_that_of_all_prefixes(spark, sizes):
    rng = random.Random(4)
    data = some_conversations(rng, 60)
    data += [(c, t, r, x) for c in range(300, 330) for t, r, x in [(0, "user", "hi"), (1, "assistant", "no"), (2, "user", "bye")]]
    data += [(1000, None, None, None), (1000, None, "user", "b"), (1000, None, "user", "a"), (1000, 2, "user", ""), (1001, 1, None, "x" * 50_000)]
    data += [(1002, 5, "user", "same")] * 40 + [(None, 1, "user", "nobody's")] * 3
    check(spark, data, **sizes)


def test_one_conversation_over_many_ranges_and_bands(spark):
    rng = random.Random(5)
    data = [(0, t, "user", rng.choice("abc")) for t in range(120)]
    data += [(c, t, r, x) for c in (5, 1, 10) for _, t, r, x in data[: 20 * c]]
    data += some_conversations(rng, 10)
    check(spark, data, range_rows=15, shard_rows=30, band_turns=8)


def test_many_members_end_at_one_node(spark):
    data = [(c, 0, "user", "x") for c in range(0, 6000)]
    df = spark.createDataFrame(data, SCHEMA)
    got = {(r["conv_id"], r["depth"]): r for r in conversation_trie.prefix_trie(df, shard_rows=500).collect()}
    assert set(got) == {(0, 0), (0, 1)} and all(r["n_convs"] == 6000 for r in got.values())
    assert got[0, 1]["ends_sha256"] == hashlib.sha256(",".join(map(str, range(6000))).encode()).hexdigest()


def test_slots_are_minimal_and_perfect():
    codes = np.unique(np.random.default_rng(1).integers(0, 2**63, 20_000, dtype=np.uint64))
    table = PerfectHash(codes)
    assert sorted(table.slots(codes)) == list(range(len(codes)))
    assert PerfectHash(codes[:0]).slots(codes[:3]).tolist() == [-1, -1, -1]


def test_trie_of_an_empty_table(spark):
    assert conversation_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
