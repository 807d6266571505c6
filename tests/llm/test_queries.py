from __future__ import annotations

import re
import zlib
from collections import defaultdict

import pytest

from tidemark.llm.queries import ORACLES, QUERIES
from tools.check_queries import compare, duck

SF_DIR = "/root/testdata/sf0.001"


def test_each_operator_has_one_query():
    import __spark_entry__ as entry

    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    problems, n = compare(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLES[name])
    assert not problems and n > 0


def test_shards_of_all_documents(spark):
    rows = QUERIES["op1_virtual_slots"](spark, SF_DIR).collect()
    texts = dict(duck(SF_DIR).sql("select doc_id, text from documents").fetchall())
    assert {r["doc_id"] for r in rows} == set(texts) and len(rows) == len(texts)
    shards = defaultdict(list)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        shards[r["shard"]].append(r["slot"])
    assert set(shards) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in shards.values())


def test_scores_of_all_documents(spark):
    rows = QUERIES["op3_weak_supervision"](spark, SF_DIR).collect()
    assert len(rows) == 200
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
