from __future__ import annotations

import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from texts import awkward, edited, frame, prose, words

from tidemark.llm import components, minhash, suffixes, templates
from tidemark.session import settle
from tidemark.llm.words import BY_ALNUM, BY_SPACE, Words, pieces, runs


@pytest.mark.parametrize("rule", [BY_SPACE, BY_ALNUM])
def test_equal_words_have_equal_hashes(rule):
    texts = ["The cat, the CAT", None, "", "  the\x0bdog\n", "été ÉTÉ 12-3", "x" * 3000]
    lists, hashes = [], []
    for lo, hi, data, offsets in pieces(pa.array(["drop", *texts]).slice(1), piece=7):
        w = Words(data, offsets, rule)
        for i in range(hi - lo):
            span = range(w.first[i], w.first[i + 1])
            lists.append([bytes(data[w.start[k] : w.end[k]]).decode() for k in span])
            hashes.append([int(w.hash[k]) for k in span])
    if rule is BY_SPACE:
        assert lists == [(t or "").split() for t in texts]
    else:
        assert lists[0] == ["The", "cat", "the", "CAT"] and lists[4] == ["été", "ÉTÉ", "12", "3"]
    names = {}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for word, h in zip(sum(lists, []), sum(hashes, [])):
        assert names.setdefault(word.translate(low), h) == h
    assert len(set(names.values())) == len(names)


def test_runs_stay_inside_texts():
    h = np.arange(10, dtype=np.uint64)
    values, bounds = runs(h, np.array([0, 2, 2, 7, 10]), 3)
    assert bounds.tolist() == [0, 0, 0, 3, 4] and len(set(values.tolist())) == 4


def test_components_of_chains_stars_and_pairs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(300, 301), (301, 300), (302, 302)]
    df = spark.createDataFrame(edges, "a long, b long")
    roots = {r["node"]: r["root"] for r in components.connected(df).collect()}
    groups = defaultdict(set)
    for n, r in roots.items():
        groups[r].add(n)
    assert sorted(map(sorted, groups.values())) == [list(range(61)), list(range(100, 140)), [300, 301]]
    assert components.connected(df.limit(0)).count() == 0


def plain_components(data, percent):
    sets = {}
    for n, (key, text, *_) in enumerate(data):
        w = words(text)
        sets[n] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {n: n for n in sets}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    alive = [n for n in sets if sets[n] and data[n][0] is not None]
    for i, a in enumerate(alive):
        for b in alive[:i]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    least = {}
    for n in alive:
        least[find(n)] = min(least.get(find(n), data[n][0]), data[n][0])
    return [(data[n][0], len(sets[n]), least[find(n)] if n in alive else data[n][0]) for n in sets]


def near_copies(seed):
    rng = random.Random(seed)
    data = awkward()
    for g in range(25):
        base = prose(rng, rng.randint(3, 150))
        for k in range(rng.randint(1, 12)):
            data.append((1000 * g + 10 + k, edited(rng, base, rng.choice([0, 0.005, 0.01, 0.03, 0.1])).upper() if k % 3 else base, "en", "a", 1))
    rng.shuffle(data)
    return data


@pytest.mark.parametrize("seed,percent", [(1, 85), (2, 80)])
def test_near_duplicates_match_all_pairs(spark, seed, percent):
    data = near_copies(seed)
    got = minhash.near_duplicates(frame(spark, data, clash=True), "doc_id", "text", percent).collect()
    key = lambda t: tuple((x is not None, x or 0) for x in t)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component"]) for r in got), key=key) == sorted(plain_components(data, percent), key=key)
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component"]) for r in got)


def test_one_of_each_group_stays(spark):
    data = near_copies(3)
    kept = minhash.keep_one(frame(spark, data, clash=True), "doc_id", "text", 85)
    assert kept.columns == frame(spark, data, clash=True).columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    whole = [c for k, n, c in plain_components(data, 85) if k is not None and n]
    assert sorted(k for k, t in rows if k is not None and words(t)) == sorted(set(whole))
    assert sum(k is None or not words(t) for k, t in rows) == sum(k is None or not words(t) for k, t, *_ in data)
    assert minhash.keep_one(frame(spark, [])).count() == 0


def test_many_near_copies_in_one_bucket(spark):
    rng = random.Random(8)
    base = prose(rng, 120)
    data = [(i, edited(rng, base, 0.02), "en", "a", 1) for i in range(150)]
    got = minhash.near_duplicates(frame(spark, data), "doc_id", "text", 85).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component"]) for r in got) == sorted(plain_components(data, 85))


def test_estimate_is_close_to_the_similarity(spark):
    rng = random.Random(4)
    base = prose(rng, 400)
    data = [(i, edited(rng, base, i * 0.002), "en", "a", 1) for i in range(12)]
    sketches = minhash.sketch(frame(spark, data), "doc_id", "text")
    a = sketches.filter("key = 0").select(F.col("signature").alias("sa"))
    got = sketches.crossJoin(a).select("key", minhash.estimate(F.col("signature"), F.col("sa")).alias("e")).collect()
    first = set(tuple(words(data[0][1])[i : i + 5]) for i in range(396))
    for r in got:
        w = words(data[r["key"]][1])
        own = set(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        assert abs(r["e"] - len(own & first) / len(own | first)) < 0.11


def plain_passages(data, least=50):
    all_words = [words(t) for _, t, *_ in data]
    where = defaultdict(set)
    for n, w in enumerate(all_words):
        for i in range(len(w) - least + 1):
            where[tuple(w[i : i + least])].add(n)
    out = set()
    for n, w in enumerate(all_words):
        covered = {i + j for i in range(len(w) - least + 1) if len(where[tuple(w[i : i + least])]) > 1 for j in range(least)}
        out |= {(n, i) for i in covered}
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_passages_match_all_windows(spark, seed, monkeypatch):
    monkeypatch.setattr(suffixes, "RANGE_BYTES", 20_000)  # many ranges, so that runs cross their edges
    rng = random.Random(seed)
    data = awkward()
    passages = [prose(rng, n) for n in (49, 50, 51, 55, 60, 80, 120, 300)]
    for i in range(120):
        parts = [prose(rng, rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(passages), prose(rng, rng.randint(0, 40))]
        data.append((100 + i, " ".join(parts), "en", "a", 1))
    data += [(500 + i, data[-1][1], "en", "a", 1) for i in range(5)]
    own = prose(rng, 70)
    data.append((900, f"{own} between {own}", "en", "a", 1))  # repeats itself only
    got = suffixes.repeated_passages(frame(spark, data, clash=True), "doc_id", "text").collect()
    assert all(r["n_words"] == r["end"] - r["begin"] >= 50 for r in got)
    found = {(r["doc_id"], i) for r in got for i in range(r["begin"], r["end"])}
    assert found == {(data[n][0], i) for n, i in plain_passages(data)}


def test_passages_in_many_copies_with_one_word_changed(spark):
    rng = random.Random(11)
    base = prose(rng, 200)
    data = [(i, edited(rng, base, 0.005), "en", "a", 1) for i in range(80)]
    got = suffixes.repeated_passages(frame(spark, data), "doc_id", "text").collect()
    want = {data[n][0] for n, _ in plain_passages(data)}
    assert {r["doc_id"] for r in got} == want
    assert suffixes.repeated_passages(frame(spark, [])).count() == 0


def test_pairs_that_share_what_follows_or_precedes_a_common_notice(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "RANGE_BYTES", 20_000)  # the halves of the notice fill many ranges
    rng = random.Random(4)
    line = lambda n: prose(rng, n).replace("\n", " ").replace(".", "")
    notice = line(45)
    tails, heads = [line(10) for _ in range(100)], [line(10) for _ in range(100)]
    data = [(i, f"{line(15)} {notice} {tails[i % 100]} {line(15)}", "en", "a", 1) for i in range(200)]
    data += [(200 + i, f"{line(15)} {heads[i % 100]} {notice} {line(15)}", "en", "a", 1) for i in range(200)]
    got = suffixes.repeated_passages(frame(spark, data), "doc_id", "text").collect()
    found = {(r["doc_id"], i) for r in got for i in range(r["begin"], r["end"])}
    assert found == {(data[n][0], i) for n, i in plain_passages(data)}


def position_sets(n):
    """The sets of places behind the two leading words on which lines of n words may agree."""
    rest = list(range(2, n))
    if n < 4:
        return [rest]
    if n < 8:
        return [[p for p in rest if p != out] for out in rest]
    cut = [2 + (n - 2) * b // 4 for b in range(5)]
    blocks = [list(range(x, y)) for x, y in zip(cut, cut[1:])]
    return [*[x + y for x, y in combinations(blocks, 2)], [p for p in rest if p % 2 == 0], [p for p in rest if p % 2]]


def plain_templates(data, least):
    """Documents without the lines that share a template with those of ``least``
    classes of near copies (80 % of the five-word shingles)."""
    texts = sorted({t for _, t, *_ in data if t is not None})
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(split, texts)]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(grams):
        for j in range(i):
            if a and grams[j] and 100 * len(a & grams[j]) >= 80 * len(a | grams[j]):
                root[find(i)] = find(j)

    def keys(line):
        w = ["<*>" if re.search("[0-9]", x) else x for x in split(line)]
        return {(len(w), tuple(w[:2]), tuple(places), tuple(w[p] for p in places)) for places in position_sets(len(w))} if w else set()

    stands = defaultdict(set)
    for i, t in enumerate(texts):
        for k in set().union(*[keys(line) for line in t.split("\n")]):
            stands[k].add(find(i))
    out = []
    for key, text, *_ in data:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not any(len(stands[k]) >= least for k in keys(x))]
        cut = text is not None and len(kept) < len(lines)
        out.append((key, "\n".join(kept) if cut else text, len(lines) - len(kept) if cut else 0))
    return out


def test_recurring_lines_go_and_copies_stay_whole(spark):
    rng = random.Random(6)
    notice = "Posted on day {} by user{} at the usual place in the usual manner today"
    data = awkward()
    for i in range(60):
        body = "\n".join(prose(rng, 25).replace("\n", " ") for _ in range(4))
        data.append((100 + i, f"{notice.format(i, i * 7)}\n{body}\nAll rights reserved.", "en", "a", 1))
    copy = "\n".join(prose(rng, 20).replace("\n", " ") for _ in range(5))
    data += [(300 + i, copy, "en", "a", 1) for i in range(6)]
    df = templates.drop_templates(frame(spark, data, clash=True), "text")
    assert df.columns == [*frame(spark, data, clash=True).drop("n_lines").columns, "n_lines", "n_dropped"] or "n_dropped" in df.columns
    got = [(r["doc_id"], r["text"], r["n_dropped"]) for r in df.collect()]
    key = lambda t: tuple((x is not None, str(x)) for x in t)
    assert sorted(got, key=key) == sorted(plain_templates(data, templates.MIN_DOCS), key=key)
    by_id = {d: (t, n) for d, t, n in got}
    assert by_id[100][1] == 2 and "rights" not in by_id[100][0] and "Posted" not in by_id[100][0]
    assert by_id[300] == (copy, 0)
    assert templates.drop_templates(frame(spark, []), "text").count() == 0


def test_notices_go_from_short_pages_and_near_copies_stay(spark):
    rng = random.Random(8)
    line = lambda n: prose(rng, n).replace("\n", " ")
    notice = [line(20) for _ in range(3)]
    data = [(i, "\n".join([line(20), *notice]), "en", "a", 1) for i in range(30)]
    page = [line(25) for _ in range(8)]
    for i in range(6):  # near copies: a word more in another line
        copy = list(page)
        copy[i] += f" word{i}"
        data.append((100 + i, "\n".join(copy), "en", "a", 1))
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in templates.drop_templates(frame(spark, data), "text").collect()}
    for key, text, *_ in data:
        assert got[key] == ((text.split("\n")[0], 3) if key < 100 else (text, 0))


NAMES = ["Maria Keller", "Tom Oak", "Lin Wu", "Abel Ruiz"]


@pytest.mark.parametrize(
    "notice",
    [
        "This article was written by {} for our readers today",  # a field over even and odd places
        "Page {n} of {n}",
        "Posted by {first} in news",
        "Call us {n} times or write to {first} at the desk",
        "a user {first} logged in from {n} and went on to the {first} page of it",
    ],
)
def test_templates_with_variable_fields(spark, notice):
    rng = random.Random(3)
    line = lambda n: prose(rng, n).replace("\n", " ")
    data = []
    for i, name in enumerate(NAMES):
        text = notice.format(name, n=i + 3, first=name.split()[0])
        data.append((i, f"{line(12)}\n{text}\n{line(9)}", "en", "a", 1))
    got = [(r["doc_id"], r["text"], r["n_dropped"]) for r in templates.drop_templates(frame(spark, data), "text").collect()]
    assert sorted(got) == plain_templates(data, 3) and all(n == 1 for *_, n in got)


def test_lines_of_random_templates_against_brute_force(spark):
    rng = random.Random(21)
    vocabulary = [prose(rng, 1).strip(".\n") for _ in range(12)]
    data = []
    for i in range(150):
        lines = [" ".join(rng.choice(vocabulary[:3] if k < 2 else vocabulary) for k in range(rng.randint(1, 12))) for _ in range(4)]
        data.append((i, "\n".join([prose(rng, 60).replace("\n", " "), *lines]), "en", "a", 1))
    got = [(r["doc_id"], r["text"], r["n_dropped"]) for r in templates.drop_templates(frame(spark, data), "text").collect()]
    want = plain_templates(data, 3)
    assert sorted(got) == want and 100 < sum(n for *_, n in want) < 550


@pytest.mark.parametrize("slots", [1, templates.SLOTS])
def test_lines_of_rare_leaves_stay_where_they_are(spark, monkeypatch, slots):
    members = spark.range(2000).select(F.xxhash64("id").alias("leaf"))
    lines = spark.range(20_000).select("id", F.xxhash64("id").alias("leaf"))
    left = [r["id"] for r in templates.may_hold(lines, "leaf", members).collect()]
    assert len(left) == len(set(left)) < 2200 and set(range(2000)) <= set(left)

    monkeypatch.setattr(templates, "SLOTS", slots)  # of one long all bits are set: nothing is left out
    stored = {}
    monkeypatch.setattr(templates, "settle", lambda df, label: stored.setdefault(label, settle(df, label)))
    rng = random.Random(5)
    line = lambda n: prose(rng, n).replace("\n", " ")
    notices = ["All rights reserved.", "Read more here on our pages", "All rights reserved."]
    data = [(i, "\n".join([line(12), *notices, line(9)]), "en", "a", 1) for i in range(40)]
    df = frame(spark, data + data[:20]).repartition(3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = [(r["doc_id"], r["text"], r["n_dropped"]) for r in templates.drop_templates(df, "text").collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(got) == sorted(plain_templates(data + data[:20], 3)) and all(n == 3 for *_, n in got)
    # one row a text moves on, with its lines in frequent leaves
    assert sorted(len(r["lines"]) for r in stored["leaf_lines"].collect()) == [3] * 40


def test_clashing_columns_stay(spark):
    df = frame(spark, [(1, "one line", "en", "a", 1)]).withColumns({"text_id": F.lit("x"), "drop_lines": F.lit("y"), "__tid": F.lit("z")})
    out = templates.drop_templates(df)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"]
    assert [tuple(r[c] for c in ("text_id", "drop_lines", "__tid", "n_lines")) for r in out.collect()] == [("x", "y", "z", 1)]
