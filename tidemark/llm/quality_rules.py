"""Quality rules as a short-circuit cascade of column expressions.

Each rule's cost and share of rejected rows are measured on a bounded sample;
rules then run in order of rejections per cost, and a row that one rejects
never reaches the next (``CASE`` evaluates its branches in order). The verdict
does not depend on the order.

Defined results: a NULL text has no words and no lines and fails the base
rules; an empty text likewise; an empty table gives an empty result; repeated
rows are judged one by one; extra columns are kept, but those with a name of
an added column are replaced, and names beginning with two underscores are
reserved.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
SAMPLE_ROWS = 2000


def _without(text: Column, chars: str) -> Column:
    """Plain replacement is a byte search, much faster than a mapping of characters."""
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def text_metrics(df: DataFrame, text: str) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Repeated five-word windows are looked for by hash first; only texts that
    have one are compared by the words themselves, as sorted windows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(body, r"[ \t\n\x0B\f\r]+"), "")
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    out = df.withColumns({"__words": words, "__lines": lines})
    n = F.size("__words")
    hashes = F.when(n > WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("__words", i, WINDOW))))
    out = out.withColumns({"__hashes": hashes, "__n": n})
    maybe = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    windows = F.transform(
        F.sequence(F.lit(1), F.col("__n") - (WINDOW - 1)),
        lambda i: F.struct(F.concat_ws(" ", F.slice("__words", i, WINDOW)).alias("w"), i.alias("at")),
    )
    out = out.withColumn("__sorted", F.when(maybe, F.sort_array(windows)))
    s = F.col("__sorted")
    twice = F.transform(
        s,
        lambda x, j: F.when(
            ((j > 0) & (x["w"] == F.get(s, F.greatest(j - 1, F.lit(0)))["w"])) | (x["w"] == F.get(s, j + 1)["w"]), x["at"]
        ),
    )
    out = out.withColumn("__starts", F.sort_array(F.array_compact(twice)))
    p = F.col("__starts")
    # each start covers its window, or up to the next start
    covered = F.aggregate(
        F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))),
        F.lit(0),
        lambda a, x: a + x,
    )
    added = {
        "n_words": F.col("__n").cast("long"),
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_symbols": (F.length(body) - F.length(_without(body, SYMBOLS))).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
    }
    return out.withColumns(added).drop("__words", "__lines", "__hashes", "__n", "__sorted", "__starts")


@dataclass(frozen=True)
class Rule:
    """``rejects`` makes, from the text column, a condition that is true for a
    bad text. It may use the columns of ``text_metrics``."""

    name: str
    rejects: Callable[[Column], Column]


def _per_char(count: Column) -> Column:
    return count / F.greatest("word_chars", F.lit(1))


#: Bounds are of the kind published for web text: symbols, shouting, exclamation
#: marks, digits, mean word length, lines ending in an ellipsis, repeated lines.
RULES = [
    Rule("symbols", lambda t: _per_char(F.col("n_symbols")) > 0.05),
    Rule("shouting", lambda t: _per_char(F.regexp_count(t, F.lit("[A-Z]"))) > 0.4),
    Rule("exclaims", lambda t: _per_char(F.length(t) - F.length(_without(t, "!"))) > 0.05),
    Rule("digits", lambda t: _per_char(F.regexp_count(t, F.lit("[0-9]"))) > 0.5),
    Rule("long_words", lambda t: F.col("word_chars") > 25 * F.greatest(F.length(t) - F.col("word_chars") + 1, F.lit(1))),
    Rule("ellipsis_lines", lambda t: F.regexp_count(t, F.lit(r"(\.\.\.|…)[ \t\r]*(\n|$)")) > 0.3 * (F.regexp_count(t, F.lit("\n")) + 1)),
    Rule("dup_lines", lambda t: F.size(F.array_distinct(F.split(t, "\n"))) < 0.5 * F.size(F.split(t, "\n"))),
]


def order_rules(df: DataFrame, text: str, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """Rules with (seconds on the sample, share rejected), best order first.

    The sample holds about ``sample_rows`` rows, taken by a hash of the text;
    it only decides the order. It is stored once and each rule runs alone.
    """
    total = df.count()
    grains = 1 << 20
    part = F.pmod(F.xxhash64(F.col(text)), F.lit(grains)) < int(grains * min(1.0, sample_rows / max(1, total))) + 1
    sample = settle(text_metrics(df.filter(part).select(F.coalesce(F.col(text), F.lit("")).alias("t")), "t"), "rule_sample")

    def timed(flag: Column) -> tuple[float, float]:
        best, share = float("inf"), 0.0
        for _ in range(2):
            start = time.perf_counter()
            share = sample.agg(F.coalesce(F.avg(flag.cast("int")), F.lit(0.0))).first()[0]
            best = min(best, time.perf_counter() - start)
        return best, share

    idle, _ = timed(F.col("t").isNull())
    measured = [(rule, *timed(rule.rejects(F.col("t")))) for rule in rules]
    costed = [(rule, max(cost - idle, 1e-3), share) for rule, cost, share in measured]
    return sorted(costed, key=lambda x: -x[2] / x[1])


def cascade(text: Column, ordered: list[Rule]) -> Column:
    """Name of the first rule that rejects the text, NULL if none does."""
    verdict = None
    for rule in ordered:
        hit = rule.rejects(F.coalesce(text, F.lit("")))
        verdict = F.when(hit, F.lit(rule.name)) if verdict is None else verdict.when(hit, F.lit(rule.name))
    return verdict if verdict is not None else F.lit(None).cast("string")


def quality_rules(df: DataFrame, text: str, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Add the metrics, base_failed, rejected_by and kept."""
    rules = RULES if rules is None else rules
    ordered = [r for r, _, _ in order_rules(df, text, rules, sample_rows)]
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = text_metrics(df, text).withColumn("base_failed", base)
    out = out.withColumn("rejected_by", F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(F.col(text), ordered)))
    return out.withColumn("kept", F.col("rejected_by").isNull())
