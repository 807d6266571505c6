"""Dialogue scripts: cleaning, speaker attribution, counts and interactions.

Input is ``lines(script_id, line_no, text)``. ``line_no`` orders the lines of
a script; lines are worked on in blocks of line numbers, so one very long
script is spread over many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import BRACKETS, drop_brackets, drop_scene_headings, strip, word_count
from tidemark.operators.carry import locf, previous
from tidemark.session import settle

# The two speaker-name patterns. Classes such as \w are Unicode
# wherever a pattern is used here.
CAPS_NAME = r"^([A-Z ]+):"
ANY_NAME = r"^([\w\s']+):"

BLOCK_BITS = 16


def line_block(bits: int = BLOCK_BITS) -> Column:
    return F.shiftright(F.col("line_no"), bits)


def clean_script(df: DataFrame, text: str = "text", bracket: str | Column = "[]") -> DataFrame:
    """Remove bracketed notes and scene headings; add word counts before and
    after: (..., words_before, cleaned, words_after). A column may name the kind
    of bracket of each row."""
    if isinstance(bracket, str):
        plain = drop_brackets(F.col(text), bracket)
    else:
        plain = reduce(lambda a, k: a.when(bracket == k, drop_brackets(F.col(text), k)), BRACKETS, F.when(F.lit(False), F.col(text)))
    cleaned = drop_scene_headings(plain)
    return (
        df.withColumn("words_before", word_count(F.col(text)))
        .withColumn("cleaned", cleaned)
        .withColumn("words_after", word_count(F.col("cleaned")))
    )


def _marked(lines: DataFrame, name_pattern: str, exclusions: list[str]) -> DataFrame:
    """Trimmed lines that match no exclusion at their start, with the name of
    a speaker who starts there (NULL on other lines)."""
    kept = lines.select("script_id", "line_no", strip(F.col("text")).alias("line"))
    for pattern in exclusions:
        kept = kept.filter(~F.col("line").rlike(rf"(?U)\A(?:{pattern})"))
    starts = F.col("line").rlike(rf"(?U)\A(?:{name_pattern})")
    name = strip(F.regexp_extract("line", rf"(?U)\A(?:{name_pattern})", 1))
    return kept.withColumn("name", F.when(starts, name))


def _after_colon() -> Column:
    at = F.instr("line", ":")
    return F.when(at > 0, strip(F.substr(F.col("line"), at + F.lit(1))))


def speaker_lines(
    lines: DataFrame,
    name_pattern: str = CAPS_NAME,
    exclusions: list[str] | None = None,
    speaker: str | None = None,
    block: Column | None = None,
) -> DataFrame:
    """Attribute every line to the speaker who spoke last:
    (script_id, line_no, speaker, is_turn, dialogue, words).

    Lines before the first speaker are dropped. ``speaker`` keeps one
    speaker's lines, matched ignoring case.
    """
    marked = _marked(lines, name_pattern, exclusions or [])
    turns = marked.withColumns({"speaker": F.col("name"), "is_turn": F.col("name").isNotNull()})
    turns = settle(turns, "turns")  # patterns run once, for the block summaries and the fill
    carried = locf(turns, ["script_id"], "line_no", ["speaker"], block if block is not None else line_block())
    spoken = carried.filter(F.col("speaker").isNotNull()).withColumn(
        "dialogue", F.when(F.col("is_turn"), F.coalesce(_after_colon(), F.lit(""))).otherwise(F.col("line"))
    )
    if speaker is not None:
        spoken = spoken.filter(F.lower("speaker") == speaker.lower())
    return spoken.select(
        "script_id", "line_no", "speaker", "is_turn", "dialogue", word_count(F.col("dialogue")).alias("words")
    )


def speaker_stats(sl: DataFrame) -> DataFrame:
    """Words and turns per speaker and script, most words first."""
    return (
        sl.groupBy("script_id", "speaker")
        .agg(F.sum("words").alias("words"), F.count_if("is_turn").alias("turns"))
        .orderBy("script_id", F.desc("words"), "speaker")
    )


def speaker_share(sl: DataFrame) -> DataFrame:
    """Each speaker's share of the words of the script."""
    stats = sl.groupBy("script_id", "speaker").agg(F.sum("words").alias("words"))
    totals = stats.groupBy("script_id").agg(F.sum("words").alias("_total"))
    return stats.join(totals, "script_id").select(
        "script_id", "speaker", "words", F.try_divide(F.col("words"), F.col("_total")).alias("share")
    )


def speaker_words_sameline(lines: DataFrame, name_pattern: str = CAPS_NAME) -> DataFrame:
    """Words on the lines that name the speaker; continuation lines do not count."""
    rest = F.regexp_replace("line", rf"(?U)\A(?:{name_pattern})", "")
    return (
        _marked(lines, name_pattern, [])
        .filter(F.col("name").isNotNull())
        .groupBy("script_id", F.col("name").alias("speaker"))
        .agg(F.sum(word_count(rest)).alias("words"))
    )


def speaker_list(lines: DataFrame, name_pattern: str = CAPS_NAME) -> DataFrame:
    """Distinct speaker names, sorted."""
    named = _marked(lines, name_pattern, []).filter(F.col("name").isNotNull())
    return named.select("script_id", F.col("name").alias("speaker")).distinct().orderBy("script_id", "speaker")


def word_frequency(
    sl: DataFrame,
    by: list[str] | None = None,
    stop_words: list[str] | None = None,
    top: int | None = None,
) -> DataFrame:
    """Word counts, most frequent first, over all lines or per ``by`` columns.
    ``top`` is the number of words wanted in the report."""
    words = F.explode(F.split(F.lower("dialogue"), r"(?U)\W+"))
    counted = sl.select(*(by or []), words.alias("word")).filter("word <> ''")
    if stop_words:
        counted = counted.filter(~F.col("word").isin(stop_words))
    ranked = (
        counted.groupBy(*(by or []), "word")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), *(by or []), "word")
    )
    return ranked if top is None else ranked.limit(top)


def speaker_edges(
    sl: DataFrame, min_interactions: int = 1, mode: str = "order", block: Column | None = None
) -> DataFrame:
    """Directed links between consecutive speakers of a script:
    (script_id, src, dst, weight).

    ``mode="order"`` follows the turns as spoken. ``mode="grouped"`` strings
    together all lines of each speaker, speakers by first appearance: a
    speaker with n lines links n-1 times to themselves and once to the next.
    """
    block = block if block is not None else line_block()
    if mode == "order":
        turns = sl.filter("is_turn").select("script_id", "line_no", "speaker")
        linked = previous(turns, ["script_id"], "line_no", "speaker", "src", block)
        pairs = linked.filter(F.col("src").isNotNull()).select(
            "script_id", "src", F.col("speaker").alias("dst"), F.lit(1).cast("long").alias("w")
        )
    elif mode == "grouped":
        cast = sl.groupBy("script_id", "speaker").agg(
            F.min("line_no").alias("line_no"), F.count(F.lit(1)).alias("_lines")
        )
        own = cast.filter("_lines > 1").select(
            "script_id", F.col("speaker").alias("src"), F.col("speaker").alias("dst"), (F.col("_lines") - 1).alias("w")
        )
        nxt = previous(cast, ["script_id"], "line_no", "speaker", "src", block).filter(F.col("src").isNotNull())
        pairs = own.unionByName(
            nxt.select("script_id", "src", F.col("speaker").alias("dst"), F.lit(1).cast("long").alias("w"))
        )
    else:
        raise ValueError("mode must be 'order' or 'grouped'")
    return (
        pairs.groupBy("script_id", "src", "dst")
        .agg(F.sum("w").alias("weight"))
        .filter(F.col("weight") >= min_interactions)
    )


def speaker_nodes(sl: DataFrame, scale: int = 10) -> DataFrame:
    """Speakers with their drawing weight (words times ``scale``)."""
    return sl.groupBy("script_id", "speaker").agg(
        F.sum("words").alias("words"), (F.sum("words") * scale).alias("node_size")
    )


def split_lines(df: DataFrame, script_id: str, part_no: str, text: str) -> DataFrame:
    """Multi-line parts of a script to single lines. The part number fills
    the high bits of ``line_no``, so parts keep their order whatever their
    length."""
    return df.select(
        F.col(script_id).alias("script_id"),
        F.col(part_no).alias("_part"),
        F.posexplode(F.split(text, r"\r\n|\r|\n")).alias("_pos", "text"),
    ).select(
        "script_id", (F.shiftleft(F.col("_part").cast("long"), 32) + F.col("_pos")).alias("line_no"), "text"
    )


# Block for lines numbered by ``split_lines``: 64 parts of a script.
PART_BLOCK_BITS = 38

