"""Series alignment, encodings, metrics and histograms."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import as_date
from tidemark.operators.numbering import number_rows
from tidemark.session import settle

#: Levels that may become columns of a frame.
WIDE_LEVELS = 1000


def align_series(series: list[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Inner join of dated series, rows with a NULL dropped.

    Each series is (frame, date column, value column, output name); the first
    is the dependent one. Output: (obs_date, name...).
    """
    frames = [
        df.select(F.col(d).cast("date").alias("obs_date"), F.col(v).alias(name)).dropna()
        for df, d, v, name in series
    ]
    return reduce(lambda a, b: a.join(b, "obs_date"), frames)


def overlap_range(series: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Date range of each series and the range they share:
    (series, start_date, end_date); the shared one is named ``overlap`` and
    has NULL bounds if there is none."""
    spans = [
        df.agg(F.min(F.col(d).cast("date")).alias("start_date"), F.max(F.col(d).cast("date")).alias("end_date"))
        .select(F.lit(name).alias("series"), "start_date", "end_date")
        for df, d, name in series
    ]
    every = reduce(DataFrame.unionByName, spans)
    lo, hi = F.max("start_date"), F.min("end_date")
    shared = every.agg(
        F.lit("overlap").alias("series"),
        F.when(lo <= hi, lo).alias("start_date"),
        F.when(lo <= hi, hi).alias("end_date"),
    )
    return every.unionByName(shared)


def filter_range(df: DataFrame, date_col: str, start: dt.date | None, end: dt.date | None) -> DataFrame:
    """Keep dates inside the bounds, both inclusive."""
    if start and end and start > end:
        raise ValueError("start date is after end date")
    day = F.col(date_col)
    if start:
        df = df.filter(day >= as_date(start))
    return df.filter(day <= as_date(end)) if end else df


def check_range(overlap: DataFrame, start: dt.date | None, end: dt.date | None, frequency: str | None = None) -> None:
    """Refuse a range that is not inside the shared one of ``overlap_range``.

    A value of a ``monthly`` or ``annual`` series stands for its whole month or
    year, so the shared range then runs from the first day of its first period
    to the last day of its last one."""
    shared = overlap.filter("series = 'overlap'").first()
    if shared is None or shared["start_date"] is None:
        raise ValueError("the series share no dates")
    if start and end and start > end:
        raise ValueError("start date is after end date")
    lo, hi = shared["start_date"], shared["end_date"]
    if frequency == "monthly":
        lo, hi = period_bounds(frequency, (lo.year, lo.month), (hi.year, hi.month))
    elif frequency:
        lo, hi = period_bounds(frequency, lo.year, hi.year)
    for name, day in (("start", start), ("end", end)):
        if day and not lo <= day <= hi:
            raise ValueError(f"{name} date {day} is outside {lo} to {hi}")


def period_bounds(frequency: str, first: tuple[int, int] | int, last: tuple[int, int] | int) -> tuple[dt.date, dt.date]:
    """First and last day of a choice of (year, month) pairs or of years."""
    if frequency == "monthly":
        (y0, m0), (y1, m1) = first, last
        after = dt.date(y1 + m1 // 12, m1 % 12 + 1, 1)
        return dt.date(y0, m0, 1), after - dt.timedelta(days=1)
    if frequency == "annual":
        return dt.date(first, 1, 1), dt.date(last, 12, 31)
    raise ValueError("frequency must be 'monthly' or 'annual'")


def level_index(df: DataFrame, column: str) -> DataFrame:
    """(level, level_index): all levels in text order, numbered from 0. Any
    number of levels: they stay a table."""
    levels = df.select(F.col(column).cast("string").alias("level")).dropna().distinct()
    return number_rows(levels, [F.col("level")], "_n").select("level", (F.col("_n") - 1).alias("level_index"))


def fit_levels(df: DataFrame, columns: list[str]) -> DataFrame:
    """The level table of an encoding, (feature, level, level_index): store it
    with the model and encode later rows by it."""
    tables = [level_index(df, c).select(F.lit(c).alias("feature"), "level", "level_index") for c in columns]
    return settle(reduce(DataFrame.unionByName, tables), "levels")


def _check_rule(unlisted: str) -> None:
    if unlisted not in ("error", "own", "null"):
        raise ValueError("unlisted must be 'error', 'own' or 'null'")


def _refuse(column: str, level: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"unlisted level of {column}: "), level))


def sparse_indicators(
    df: DataFrame, keys: list[str], column: str, levels: DataFrame | None = None, unlisted: str = "error"
) -> DataFrame:
    """One-hot encoding of a column with any number of levels, as the non-zero
    cells (keys..., level_index, value); the first level has none.

    ``levels`` is a fitted level table (by default that of the rows themselves).
    A level it does not list is an ``error``, gets its ``own`` column (index -1)
    or, with ``null``, no cell, as a NULL has none."""
    _check_rule(unlisted)
    known = level_index(df, column) if levels is None else levels.filter(F.col("feature") == column).select("level", "level_index")
    rows = df.select(*keys, F.col(column).cast("string").alias("level")).filter("level is not null").join(known, "level", "left")
    other = {"error": _refuse(column, F.col("level")).cast("long"), "own": F.lit(-1).cast("long"), "null": F.lit(None).cast("long")}
    found = rows.withColumn("level_index", F.coalesce("level_index", other[unlisted]))
    return found.filter("level_index <> 0").select(*keys, "level_index", F.lit(1.0).alias("value"))


def encode_features(
    df: DataFrame, levels: DataFrame | dict[str, list[str]], always_one_hot: bool = False, unlisted: str = "error"
) -> tuple[DataFrame, list[str]]:
    """Categories to numbers by their levels: two give one 0/1 column, more (or
    all, with ``always_one_hot``) one column per level but the first. Returns the
    frame and the new feature names.

    ``levels`` is a fitted level table or lists of levels by column. A level that
    is not among them is an ``error`` when it is met, sets an ``own`` column
    (``<column>_other``) with zeros in the others, or makes them all ``null``, as
    a NULL does. One column per level has its limit at ``WIDE_LEVELS``; use
    ``sparse_indicators`` beyond.
    """
    _check_rule(unlisted)
    if isinstance(levels, DataFrame):
        listed = levels.orderBy("feature", "level_index").limit(WIDE_LEVELS + 1).collect()
        if len(listed) > WIDE_LEVELS:
            raise ValueError(f"over {WIDE_LEVELS} levels; encode them with sparse_indicators")
        levels = {}
        for r in listed:
            levels.setdefault(r["feature"], []).append(r["level"])
    new: dict[str, Column] = {}
    for c, names in levels.items():
        text = F.col(c).cast("string")
        known = text.isin(names)
        if len(names) == 2 and not always_one_hot:
            values = {f"{c}_code": (text == names[1]).cast("double")}
        else:
            values = {f"{c}_{level}": (text == level).cast("double") for level in names[1:]}
        if unlisted == "own":
            values[f"{c}_other"] = (~known).cast("double")
        for name, value in values.items():
            if unlisted == "error":
                new[name] = F.when(known, value).when(text.isNotNull(), _refuse(c, text).cast("double"))
            elif unlisted == "null":
                new[name] = F.when(known, value)
            else:
                new[name] = value
    return df.withColumns(new) if new else df, list(new)


def regression_metrics(pred: DataFrame, actual: str = "y", predicted: str = "y_hat") -> DataFrame:
    """(n, mse, r2) in one pass."""
    y, e = F.col(actual), F.col(actual) - F.col(predicted)
    sse, sst = F.sum(e * e), F.var_pop(y) * F.count(y)
    return pred.agg(
        F.count(F.lit(1)).alias("n"), F.avg(e * e).alias("mse"), (1 - F.try_divide(sse, sst)).alias("r2")
    )


def confusion(pred: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Row counts per pair of classes."""
    return pred.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_report(pred: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support per class, then the rows
    ``accuracy``, ``macro avg`` and ``weighted avg``. A rate with an empty
    base is 0. Everything after the first count works on pairs of classes."""
    pairs = confusion(pred, actual, predicted)
    flows = pairs.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("actual").cast("string").alias("label"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("called"),
                    F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"),
                ),
                F.struct(
                    F.col("predicted").cast("string").alias("label"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("called"),
                    F.lit(0).cast("long").alias("hit"),
                ),
            )
        )
    )
    zero = F.lit(0.0)
    per_class = (
        flows.groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "called", "hit")])
        .withColumns(
            {
                "precision": F.coalesce(F.try_divide(F.col("hit"), F.col("called")), zero),
                "recall": F.coalesce(F.try_divide(F.col("hit"), F.col("support")), zero),
            }
        )
        .withColumn(
            "f1",
            F.coalesce(
                F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero
            ),
        )
    )
    rates = ["precision", "recall", "f1"]
    n = F.sum("support")
    hits = F.try_divide(F.sum("hit"), n)
    overall = per_class.agg(
        n.alias("support"),
        hits.alias("accuracy"),
        *[F.avg(r).alias(f"m_{r}") for r in rates],
        *[F.try_divide(F.sum(F.col(r) * F.col("support")), n).alias(f"w_{r}") for r in rates],
    )

    def line(label: str, values: list[Column]) -> Column:
        return F.struct(F.lit(label).alias("label"), *[v.alias(r) for v, r in zip(values, rates)], F.col("support"))

    summary = overall.select(
        F.inline(
            F.array(
                line("accuracy", [F.col("accuracy")] * 3),
                line("macro avg", [F.col(f"m_{r}") for r in rates]),
                line("weighted avg", [F.col(f"w_{r}") for r in rates]),
            )
        )
    )
    return per_class.select("label", *rates, "support").unionByName(summary)


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Counts over equal-width bins from minimum to maximum, last bin closed:
    (bin, lo, hi, count) with empty bins shown. A constant column is centred
    in a range of width one."""
    x = F.col(col).cast("double")
    ends = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    counts = (
        df.filter(x.isNotNull())
        .select(F.least(F.width_bucket(x, lo, hi, F.lit(bins)), F.lit(bins)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    step = (F.col("hi") - F.col("lo")) / bins
    frame = ends.filter("lo is not null").select(
        F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), "lo", step.alias("step")
    )
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * F.col("step")).alias("lo"),
        (F.col("lo") + F.col("bin") * F.col("step")).alias("hi"),
        F.coalesce("n", F.lit(0)).cast("long").alias("count"),
    )
