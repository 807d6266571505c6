"""Speaker attribution and cleaning against a line-by-line Python reading."""

from __future__ import annotations

import re

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.text import word_count
from tidemark.operators import scripts

SCRIPT = [
    "a line before anyone speaks",
    "ZELDA: So then: I was late",
    "  still talking here ",
    "",
    "[stage] note",
    "CLARA:",
    "Interesting",
    "BRUNO : no",
    "ZELDA: yes",
    "ZELDA: again",
]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([("s", i, t) for i, t in enumerate(SCRIPT)], "script_id string, line_no bigint, text string")


def test_speaker_lines(lines):
    spoken = scripts.speaker_lines(lines, exclusions=[r"\[stage"])
    got = [(r.line_no, r.speaker, r.is_turn, r.dialogue, r.words) for r in spoken.orderBy("line_no").collect()]
    assert got == [
        (1, "ZELDA", True, "So then: I was late", 5),
        (2, "ZELDA", False, "still talking here", 3),
        (3, "ZELDA", False, "", 0),
        (5, "CLARA", True, "", 0),
        (6, "CLARA", False, "Interesting", 1),
        (7, "BRUNO", True, "no", 1),
        (8, "ZELDA", True, "yes", 1),
        (9, "ZELDA", True, "again", 1),
    ]


def test_carry_is_the_same_for_every_block_size(lines):
    whole = rows(scripts.speaker_lines(lines))
    for bits in (0, 1, 2):
        assert rows(scripts.speaker_lines(lines, block=scripts.line_block(bits))) == whole


def test_stats_edges_nodes(lines):
    sl = scripts.speaker_lines(lines, exclusions=[r"\[stage"])
    assert [(r.speaker, r.words, r.turns) for r in scripts.speaker_stats(sl).collect()] == [
        ("ZELDA", 10, 3), ("BRUNO", 1, 1), ("CLARA", 1, 1),
    ]
    edge = ("s", "ZELDA", "CLARA", 1)
    order = rows(scripts.speaker_edges(sl, block=scripts.line_block(1)))
    assert edge in order and ("s", "ZELDA", "ZELDA", 1) in order and len(order) == 4
    grouped = rows(scripts.speaker_edges(sl, mode="grouped"))
    assert grouped == [
        ("s", "CLARA", "BRUNO", 1), ("s", "CLARA", "CLARA", 1), ("s", "ZELDA", "CLARA", 1), ("s", "ZELDA", "ZELDA", 4),
    ]
    assert rows(scripts.speaker_edges(sl, 2, "grouped")) == [("s", "ZELDA", "ZELDA", 4)]
    assert ("s", "ZELDA", 10, 100) in rows(scripts.speaker_nodes(sl))
    with pytest.raises(ValueError):
        scripts.speaker_edges(sl, mode="other")


def test_one_speaker_ignores_case(lines):
    assert scripts.speaker_lines(lines, speaker="clara").count() == 2 + 1 - 1


def test_any_name_pattern(spark):
    df = spark.createDataFrame([("s", 0, "Prof Plum: hello"), ("s", 1, "O'Neil_2: hi you")], "script_id string, line_no bigint, text string")
    assert rows(scripts.speaker_words_sameline(df, scripts.ANY_NAME)) == [("s", "O'Neil_2", 2), ("s", "Prof Plum", 1)]


def test_word_frequency_top(lines):
    sl = scripts.speaker_lines(lines)
    top = scripts.word_frequency(sl, stop_words=["now"], top=2).collect()
    assert [(r.word, r["count"]) for r in top][0][1] >= top[1]["count"] and len(top) == 2


def python_clean(text: str) -> tuple[int, str, int]:
    bare = re.sub(r"\[.*?\]", "", text, flags=re.DOTALL)
    kept = [line for line in bare.splitlines() if not re.match(r"^\s*(EXT|INT)", line, re.IGNORECASE)]
    cleaned = "\n".join(kept)
    return len(text.split()), cleaned, len(cleaned.split())


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="[]ab \n\r\t\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0   EXTint", max_size=40), min_size=60, max_size=60))
def test_cleaning_agrees_with_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    out = scripts.clean_script(df).orderBy("i").collect()
    assert [(r.words_before, r.cleaned, r.words_after) for r in out] == [python_clean(t) for t in texts]


def test_word_count_counts_unicode_spaces(spark):
    df = spark.createDataFrame([("a b c  d",), ("",), ("   ",)], "t string")
    assert [r[0] for r in df.select(word_count(F.col("t"))).collect()] == [4, 0, 0]
