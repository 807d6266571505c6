"""Text expressions: cleaning, word counts, fields of delimited records."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's split() and strip() treat as white
# space, as code points and as a regular-expression class, and the ones
# splitlines() treats as line ends. The notation suits Java and RE2.
SPACE_CHARS = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
SPACE = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LINE_END_CHARS = "\x0b\x0c\x0d\x1c\x1d\x1e\x85\u2028\u2029"
LINE_END = r"\r\n|[\x0a-\x0d\x1c-\x1e\x{85}\x{2028}\x{2029}]"

# Note delimiters and scene-heading words.
BRACKETS = {"[]": r"(?s)\[.*?\]", "()": r"(?s)\(.*?\)"}
SCENE_HEADING = rf"(?i)^[{SPACE}]*(EXT|INT)"

# Delimiter names offered to users of the loader.
DELIMITERS = {"comma": ",", "tilde": "~", "dash": "-", "space": " "}


def word_count(text: Column) -> Column:
    """Number of white-space separated words. Mapping characters and splitting
    on one of them is several times faster than a class of them in a regular
    expression."""
    spaced = F.translate(text, SPACE_CHARS, " " * len(SPACE_CHARS))
    return F.size(F.array_remove(F.split(spaced, " "), ""))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def drop_brackets(text: Column, bracket: str = "[]") -> Column:
    """Remove notes, shortest match first, also across line ends. Text without
    an opening bracket is told by a byte search."""
    return F.when(text.contains(bracket[0]), F.regexp_replace(text, BRACKETS[bracket], "")).otherwise(text)


def split_lines(text: Column) -> Column:
    """Lines as Python's splitlines() gives them: no empty last line."""
    marked = F.translate(
        F.replace(text, F.lit("\r\n"), F.lit("\n")), LINE_END_CHARS, "\n" * len(LINE_END_CHARS)
    )
    # a lambda names the mapped text, which is then computed once
    whole = F.transform(F.array(marked), lambda m: F.when(m.endswith("\n"), F.left(m, F.length(m) - 1)).otherwise(m))[0]
    return F.split(whole, "\n")


def drop_scene_headings(text: Column) -> Column:
    """Remove lines that begin with EXT or INT in any case; there is no word
    boundary, so "Interesting" goes as well."""
    return F.array_join(F.filter(split_lines(text), lambda x: ~x.rlike(SCENE_HEADING)), "\n")


def zero_pad(field: Column, width: int) -> Column:
    """Pad a whole number with zeros to ``width``; the sign counts in the
    width, longer numbers and other text stay as they are.

    Plain digits that fit are padded as they are; signs, leading zeros beyond
    the width and ``_`` between digits take the longer way.
    """
    digits = F.regexp_replace(F.replace(field, F.lit("_"), F.lit("")), r"^[+-]?0*(?=\d)", "")
    sign = F.when(field.startswith("-") & ~field.rlike(r"^-[0_]+$"), F.lit("-")).otherwise(F.lit(""))
    room = F.greatest(F.lit(width) - F.length(sign), F.length(digits))
    return (
        F.when((F.length(field) <= width) & field.rlike(r"^\d+$"), F.lpad(field, width, "0"))
        .when(field.rlike(r"^[+-]?\d+(_\d+)*$"), F.concat(sign, F.lpad(digits, room, F.lit("0"))))
        .otherwise(field)
    )


def whole_number(text: Column, kind: str) -> Column:
    """Text to an integer type, NULL if it is none. The pattern keeps plain
    text away from the cast, which is slow on what it cannot read."""
    return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), text.try_cast(kind))


def split_fields(record: Column, delimiter: str) -> Column:
    return F.split(record, re.escape(delimiter), -1)


def pad_record(record: Column, width: int, delimiter: str) -> Column:
    """Zero-pad every field of a delimited record but the first."""
    fields = split_fields(strip(record), delimiter)
    rest = F.transform(F.slice(fields, F.lit(2), F.size(fields)), lambda x: zero_pad(strip(x), width))
    return F.array_join(F.concat(F.slice(fields, 1, 1), rest), delimiter)


def first_word(text: Column) -> Column:
    return F.substring_index(text, " ", 1)
