"""Dialogue queries over conversations and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.text import LINE_END, SPACE, SPACE_CHARS
from tidemark.operators import scripts
from tidemark.plans import inputs
from tidemark.suite.base import query

BLOCK = scripts.PART_BLOCK_BITS
WORD = f"'[^{SPACE}]+'"


def _spoken(spark, sf_dir, **kwargs):
    return scripts.speaker_lines(
        inputs.script_lines(spark, sf_dir), block=scripts.line_block(BLOCK), **kwargs
    )


def _trim(expr: str) -> str:
    return f"trim({expr}, '{SPACE_CHARS}')"


def _count(expr: str) -> str:
    return f"len(regexp_extract_all({expr}, {WORD}))"


_LINES = f"""raw as (
  select conv_id as script_id, turn, string_split_regex(upper(role) || ': ' || text, '\\r\\n|\\r|\\n') as parts from conversations),
exploded as (select script_id, turn, unnest(parts) as text, generate_subscripts(parts, 1) - 1 as pos from raw),
lines as (select script_id, turn * 4294967296 + pos as line_no, {_trim('text')} as line from exploded),
named as (select *, case when regexp_matches(line, '^[A-Z ]+:') then trim(regexp_extract(line, '^([A-Z ]+):', 1)) end as name from lines),
carried as (select *, last_value(name ignore nulls) over (partition by script_id order by line_no) as speaker from named),
spoken as (select script_id, line_no, speaker, name is not null as is_turn,
    case when name is not null then {_trim("substr(line, instr(line, ':') + 1)")} else line end as dialogue
  from carried where speaker is not null),
sl as (select *, cast({_count('dialogue')} as int) as words from spoken)"""


@query("speaker_lines", f"with {_LINES} select script_id, cast(line_no as bigint) as line_no, speaker, is_turn, dialogue, words from sl")
def speaker_lines(spark, sf_dir):
    return _spoken(spark, sf_dir)


@query(
    "speaker_one",
    f"with {_LINES} select script_id, cast(line_no as bigint) as line_no, dialogue, words from sl where lower(speaker) = 'user'",
)
def speaker_one(spark, sf_dir):
    return _spoken(spark, sf_dir, speaker="User").select("script_id", "line_no", "dialogue", "words")


@query(
    "speaker_lines_excluding",
    f"""with {_LINES.replace("then trim(regexp_extract(line, '^([A-Z ]+):', 1)) end as name from lines",
                            "then trim(regexp_extract(line, '^([A-Z ]+):', 1)) end as name from lines where not regexp_matches(line, '^(?:SYSTEM|The )')")}
    select script_id, cast(line_no as bigint) as line_no, speaker, words from sl""",
)
def speaker_lines_excluding(spark, sf_dir):
    """Lines that start with an excluded pattern are skipped before speakers
    are carried on."""
    spoken = _spoken(spark, sf_dir, exclusions=["SYSTEM", "The "])
    return spoken.select("script_id", "line_no", "speaker", "words")


@query(
    "speaker_stats",
    f"with {_LINES} select script_id, speaker, cast(sum(words) as bigint) as words, count(*) filter (where is_turn) as turns from sl group by 1, 2",
)
def speaker_stats(spark, sf_dir):
    return scripts.speaker_stats(_spoken(spark, sf_dir))


@query(
    "speaker_share",
    f"""with {_LINES}, s as (select script_id, speaker, cast(sum(words) as bigint) as words from sl group by 1, 2)
    select script_id, speaker, words, round(words / nullif(sum(words) over (partition by script_id), 0), 9) as share from s""",
)
def speaker_share(spark, sf_dir):
    return scripts.speaker_share(_spoken(spark, sf_dir)).withColumn("share", F.round("share", 9))


@query(
    "speaker_words_sameline",
    f"""with {_LINES} select script_id, name as speaker, cast(sum({_count("regexp_replace(line, '^([A-Z ]+):', '')")}) as bigint) as words
    from named where name is not null group by 1, 2""",
)
def speaker_words_sameline(spark, sf_dir):
    return scripts.speaker_words_sameline(inputs.script_lines(spark, sf_dir))


@query("speaker_list", f"with {_LINES} select distinct script_id, name as speaker from named where name is not null")
def speaker_list(spark, sf_dir):
    return scripts.speaker_list(inputs.script_lines(spark, sf_dir))


@query(
    "speaker_edges",
    f"""with {_LINES}, t as (select script_id, speaker as dst, lag(speaker) over (partition by script_id order by line_no) as src from sl where is_turn)
    select script_id, src, dst, count(*) as weight from t where src is not null group by 1, 2, 3""",
)
def speaker_edges(spark, sf_dir):
    return scripts.speaker_edges(_spoken(spark, sf_dir), block=scripts.line_block(BLOCK))


@query(
    "speaker_edges_grouped",
    f"""with {_LINES}, c as (select script_id, speaker, min(line_no) as first_no, count(*) as n from sl group by 1, 2),
    e as (select script_id, speaker as src, speaker as dst, n - 1 as weight from c where n > 1
      union all
      select script_id, lag(speaker) over (partition by script_id order by first_no) as src, speaker as dst, 1 as weight from c)
    select script_id, src, dst, cast(sum(weight) as bigint) as weight from e where src is not null group by 1, 2, 3 having sum(weight) >= 2""",
)
def speaker_edges_grouped(spark, sf_dir):
    return scripts.speaker_edges(_spoken(spark, sf_dir), 2, "grouped", scripts.line_block(BLOCK))


@query(
    "speaker_nodes",
    f"with {_LINES} select script_id, speaker, cast(sum(words) as bigint) as words, cast(sum(words) * 10 as bigint) as node_size from sl group by 1, 2",
)
def speaker_nodes(spark, sf_dir):
    return scripts.speaker_nodes(_spoken(spark, sf_dir))


@query(
    "word_frequency",
    f"""with {_LINES}, w as (select speaker, unnest(string_split_regex(lower(dialogue), '[^\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Nl}}\\p{{Pc}}]+')) as word from sl)
    select speaker, word, count(*) as count from w where word <> '' and word not in ('the', 'of') group by 1, 2""",
)
def word_frequency(spark, sf_dir):
    return scripts.word_frequency(_spoken(spark, sf_dir), ["speaker"], stop_words=["the", "of"])


_SCRIPTED = """scripted as (select doc_id, '[' || source || chr(10) || 'note]' || chr(10) || '  Ext. ' || lang || chr(10) || text
  || ' (aside' || chr(10) || 'two)' || chr(10) || 'INTERIOR' || chr(10) as body from documents)"""


def _cleaned(bracket: str) -> str:
    no_notes = f"regexp_replace(body, '(?s)\\{bracket[0]}.*?\\{bracket[1]}', '', 'g')"
    lines = f"string_split_regex(regexp_replace({no_notes}, '({LINE_END})\\z', ''), '{LINE_END}')"
    keep = f"list_filter({lines}, lambda x: not regexp_matches(x, '(?i)^[{SPACE}]*(EXT|INT)'))"
    return f"array_to_string({keep}, chr(10))"


def _clean_sql(bracket: str) -> str:
    return f"""select doc_id, '{bracket}' as bracket, cast({_count('body')} as int) as words_before, cleaned,
      cast({_count('cleaned')} as int) as words_after from (select doc_id, body, {_cleaned(bracket)} as cleaned from scripted) x"""


@query("script_clean", f"with {_SCRIPTED} {_clean_sql('[]')} union all {_clean_sql('()')}")
def script_clean(spark, sf_dir):
    """Documents with notes and scene headings written in, cleaned."""
    scripted = inputs.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(
            F.lit("["), "source", F.lit("\nnote]\n  Ext. "), "lang", F.lit("\n"), "text", F.lit(" (aside\ntwo)\nINTERIOR\n")
        ).alias("body"),
    )
    kinds = scripted.withColumn("bracket", F.explode(F.array(F.lit("[]"), F.lit("()"))))
    return scripts.clean_script(kinds, "body", F.col("bracket")).drop("body")
