from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
from texts import awkward, frame, prose

from tidemark.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int"


def plain_audit(data, labels):
    """Every order applied to every document, step by step."""
    docs = []
    for key, text, lang, *_ in data:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        smaller = any(k is not None and key is not None and k < key and (o or "") == t for k, o, *_ in data)
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": smaller,
        }
        good = any(d == key and q == 1 for d, q, _ in labels if key is not None)
        toxic = any(d == key and x == 1 for d, _, x in labels if key is not None)
        docs.append((lang or "", fails, good, toxic))
    rows, shapley = {}, Counter()
    for part in {p for p, *_ in docs}:
        own = [d for d in docs if d[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                out = [d for d in left if d[1][f]]
                failing = [d for d in own if d[1][f]]
                alone = [d for d in failing if sum(d[1].values()) == 1]
                left = [d for d in left if not d[1][f]]
                shapley[part, f] += len(out)
                rows[part, order, step] = (len(left), len(out), len(failing) - len(out), len(alone), sum(d[2] for d in out), sum(d[3] for d in out))
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in rows.items()}


def got_rows(df):
    return {
        (r["part"], r["filter_order"], r["step"]): tuple(
            r[c] for c in "kept removed redundant unique_fails good_lost toxic_lost shapley".split()
        )
        for r in df.collect()
    }


def some_documents(rng, n):
    data = []
    for i in range(n):
        text = prose(rng, rng.choice([5, 60, 99, 100, 101, 150]))
        if rng.random() < 0.3:
            text = " ".join(rng.choice(["one", "two", "Three"]) for _ in range(150))
        if rng.random() < 0.2:
            text = text.upper()
        if rng.random() < 0.3:
            text += rng.choice(["#", "|", "$ 5", "é&"])
        data.append((rng.randrange(2 * n), text, rng.choice(["en", "fr", "", None]), "a", 1))
    copies = rng.choices(data, k=n)
    return data + [(rng.randrange(2 * n), t, rng.choice(["en", "fr", None]), s, c) for _, t, _, s, c in copies]


def test_audit_is_that_of_every_order_applied(spark):
    rng = random.Random(11)
    data = awkward() + some_documents(rng, 60)
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d, *_ in data if d is not None and rng.random() < 0.6] + [(None, 1, 1), (10**9, 1, 1)]
    got = filter_audit.audit_filters(frame(spark, data, clash=True), spark.createDataFrame(labels, LABELS))
    assert got.count() == len(got_rows(got))
    assert got_rows(got) == plain_audit(data, labels)


def test_the_walk_stores_the_survivors_of_every_subset():
    cells = np.random.default_rng(2).integers(0, 50, (3, 32, 3))
    states = filter_audit.walk_subsets(cells)
    for s in range(32):
        assert (states[:, s] == cells[:, [m for m in range(32) if not m & s]].sum(axis=1)).all()


def test_many_copies_of_one_text_are_few_rows(spark):
    df = spark.range(5000).selectExpr("id as doc_id", "'same words' as text", "'en' as lang")
    cells = {r["mask"]: r["n"] for r in filter_audit.count_cells(df, spark.createDataFrame([], LABELS)).collect() if r["n"]}
    assert cells == {1: 1, 17: 4999}


def test_audit_of_an_empty_table(spark):
    assert filter_audit.audit_filters(frame(spark, []), spark.createDataFrame([], LABELS)).count() == 0
