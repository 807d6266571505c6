from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from texts import awkward, frame, prose

from tidemark.llm import quality_rules, sharding, url_filter
from tidemark.llm.queries import URL_RULES


def test_shards_cover_all_rows_and_are_even(spark):
    rng = random.Random(1)
    data = awkward() + [(100 + i, prose(rng, rng.randint(5, 60)), "en", "a", 1) for i in range(600)]
    got = sharding.shard_rows(frame(spark, data, clash=True), "doc_id", "text", 6, n_slots=512).collect()
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in data)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    places, slots = defaultdict(list), {}
    for r in got:
        places[r["shard"]].append(r["slot"])
        assert slots.setdefault(r["virtual_slot"], r["shard"]) == r["shard"]
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert set(places) <= set(range(6))


def test_bytes_are_even_and_copies_are_numbered(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 300).cast("int")).alias("text"))
    df = df.unionByName(spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text")))
    got = sharding.shard_rows(df, "doc_id", "text", 5).groupBy("shard").agg(F.sum("size").alias("s"), F.count("*").alias("n"), F.max("slot").alias("m"), F.countDistinct("slot").alias("d")).collect()
    assert all(r["n"] == r["m"] + 1 == r["d"] for r in got)
    loads = [r["s"] for r in got]
    assert max(loads) - min(loads) <= 308  # one record


def test_many_copies_of_a_record_spread_over_all_shards(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.repeat(F.lit("y"), (F.col("id") % 60).cast("int")).alias("text"))
    df = df.unionByName(spark.range(2000).select(F.lit(9).cast("long").alias("doc_id"), F.repeat(F.lit("x"), 1000).alias("text")))
    for n_slots in (4096, 64):
        rows = sharding.shard_rows(df, "doc_id", "text", 24, n_slots).groupBy("shard").agg(F.sum("size").alias("s"), F.count("*").alias("n"), F.max("slot").alias("m"), F.countDistinct("slot").alias("d")).collect()
        assert len(rows) == 24 and sum(r["n"] for r in rows) == 2500
        assert all(r["n"] == r["m"] + 1 == r["d"] for r in rows)
        if n_slots == 4096:
            assert max(r["s"] for r in rows) - min(r["s"] for r in rows) <= 1008


def test_map_versions_move_slots_only_to_the_new_shard(spark, tmp_path):
    rng = np.random.default_rng(3)
    weights = spark.createDataFrame([(i, int(b), 1) for i, b in enumerate(rng.integers(1, 1000, 256))], "virtual_slot int, bytes long, rows long")
    path = str(tmp_path / "map")
    sharding.write_map(sharding.build_map(weights, 4), path)
    sharding.write_map(sharding.rebalance(sharding.read_map(spark, path), weights, 5), path)
    old = {r["virtual_slot"]: r["shard"] for r in sharding.read_map(spark, path, 1).collect()}
    new = {r["virtual_slot"]: r["shard"] for r in sharding.read_map(spark, path).collect()}
    assert len(old) == len(new) == 256
    assert {new[s] for s in new if new[s] != old[s]} == {4}
    load = Counter()
    for r in weights.collect():
        load[new[r["virtual_slot"]]] += r["bytes"]
    assert max(load.values()) - min(load.values()) < 2000


def test_sharding_of_an_empty_table(spark):
    assert sharding.shard_rows(frame(spark, []), "doc_id", "text", 3).count() == 0


def plain_metrics(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = defaultdict(list)
    for i in range(len(w) - 4):
        places[tuple(w[i : i + 5])].append(i)
    covered = {i + j for p in places.values() if len(p) > 1 for i in p for j in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality_metrics_match_plain_ones(spark):
    rng = random.Random(5)
    data = awkward()
    for i in range(120):
        line = prose(rng, rng.randint(1, 30))
        text = "\n".join(rng.choice([line, line, prose(rng, 9), "", " \x0b", "a # b | c", "so so so so so so so"]) for _ in range(rng.randint(1, 6)))
        data.append((100 + i, text, "en", "a", 1))
    got = quality_rules.quality_rules(frame(spark, data, clash=True), "text", sample_rows=50)
    for r in got.collect():
        mine = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert mine == plain_metrics(r["text"])
        assert r["base_failed"] == (mine[0] < 10 or 100 * mine[4] > 20 * mine[0])
        assert r["kept"] == (r["rejected_by"] is None) and not (r["kept"] and r["base_failed"])


def test_verdict_does_not_depend_on_the_order_of_rules(spark):
    data = [(i, t, "en", "a", 1) for i, t in enumerate(["SHOUTING ALL THE WAY DOWN!! " * 3, "a#b " * 20, "plain words in a row " * 2, "1 2 3 4 5 6 7 8 9 10 11"])]
    df = quality_rules.text_metrics(frame(spark, data), "text")
    ways = [quality_rules.RULES, quality_rules.RULES[::-1]]
    a, b = ([r[0] for r in df.orderBy("doc_id").select(quality_rules.cascade(F.col("text"), w).isNull()).collect()] for w in ways)
    assert a == b == [False, False, True, False]


def test_rules_that_reject_more_for_less_come_first(spark):
    rules = [quality_rules.Rule("never", lambda t: t.isNull()), quality_rules.Rule("always", lambda t: t.isNotNull())]
    df = frame(spark, [(i, f"text {i}", "en", "a", 1) for i in range(50)])
    assert [r.name for r, _, _ in quality_rules.order_rules(df, "text", rules)] == ["always", "never"]
    assert quality_rules.quality_rules(frame(spark, []), "text").count() == 0


def plain_verdict(url):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    best = max((r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)), key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best.verdict if best else "allow"


URLS = [None, "", "no scheme", "http://net/", "http://net", "HTTP://A.NET/x", "https://b.example.net/en/1?q#f", "http://badexample.net/en/", "http://example.net/en", "http://x.example.com/de/../de/", "http://org/fr/", "http://a.org/fr/ü?x", "http://evil.com/.net/", "http://ünï.org/fr/", "a://b://net/", "http://net\n/x", "http://x.net?y", "http://" + "a" * 5000 + ".net/" + "b" * 5000, "http://\x00.net/"]


def test_urls_match_plain_rules(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://a.net/"), (3, "http://net/")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit("clash")).withColumn("host", F.lit(1))
    got = url_filter.judge_urls(df, "url", URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain_verdict(r["url"])
    assert url_filter.judge_urls(df.limit(0), "url", URL_RULES).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_automaton_matches_globs(seed):
    rng = random.Random(seed)
    globs = ["".join(rng.choice("ab/*?") for _ in range(rng.randint(1, 30))) for _ in range(60)]
    urls = ["".join(rng.choice("ab/") for _ in range(rng.randint(0, 14))).encode() for _ in range(200)]
    hit = url_filter.ShiftAnd(globs).run(urls)
    for j, g in enumerate(globs):
        pattern = re.compile("".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(t, re.escape(t)) for t in re.findall(r"\*\*|.", g)), re.S)
        for i, u in enumerate(urls):
            assert hit[i, j] == bool(pattern.fullmatch(u.decode())), (g, u)


def test_url_keys_end_the_host_where_it_ends():
    from tidemark.llm.warc import url_key

    assert url_key("http://a.Example.com/x?y") == "com,example,a)/x?y"
    assert url_key("http://a.example.com?q=/x") == "com,example,a)?q=/x"
    assert url_key("http://a.example.com#z") == "com,example,a)#z"
    assert (url_key("a/b"), url_key(""), url_key("http://")) == (")a/b", ")", ")")
