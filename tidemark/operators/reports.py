"""Report sheets held as cells: range configuration and extraction.

Cells are rows (report, sheet, row, col, value) with 1-based numbers, so a
million reports are read by the same joins as one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.numbering import number_rows
from tidemark.session import settle

CELL = r"([A-Z]+)(\d+)"
RANGE = rf"{CELL}:{CELL}"
#: Interval rows that may be sent to every task (about 100 bytes each).
CONFIG_ROWS = 100_000
#: Bits of a row number within one block of the interval index.
BLOCK_BITS = 12


def column_number(letters: Column) -> Column:
    """``A`` = 1, ``Z`` = 26, ``AA`` = 27."""
    return F.aggregate(
        F.filter(F.split(letters, ""), lambda x: x != ""),
        F.lit(0),
        lambda acc, x: acc * 26 + (F.ascii(x) - F.lit(64)),
    )


def parse_range(text: Column) -> Column:
    """``A1:C9`` to a struct of column letters and row numbers; NULL if the
    text is not a range."""
    part = [F.regexp_extract(text, RANGE, i) for i in range(1, 5)]
    return F.when(
        text.rlike(RANGE),
        F.struct(
            part[0].alias("start_col"),
            part[1].try_cast("int").alias("start_row"),
            part[2].alias("end_col"),
            part[3].try_cast("int").alias("end_row"),
        ),
    )


def column_span(text: Column) -> Column:
    """The column letters of a range, with or without row numbers."""
    ends = [F.regexp_extract(text, r"^([A-Z]+)\d*:([A-Z]+)\d*", i) for i in (1, 2)]
    return F.when(text.rlike(r"^[A-Z]+\d*:[A-Z]+\d*"), F.concat_ws(":", *ends))


def word_kind(text: Column) -> Column:
    """What a configuration value is: ``flag``, ``none`` (the word null),
    ``range``, ``empty`` or other ``text``."""
    low = F.lower(text)
    return (
        F.when(low.isin("true", "false"), "flag")
        .when(low == "null", "none")
        .when(text.rlike(rf"^{RANGE}$"), "range")
        .when(~filled(text), "empty")
        .otherwise("text")
    )


def coerce_word(text: Column) -> Column:
    """The word ``null`` in any case becomes NULL, booleans lower case; ranges,
    empty and other text stay."""
    kind = word_kind(text)
    return F.when(kind == "flag", F.lower(text)).when(kind != "none", text)


def filled(text: Column) -> Column:
    return F.coalesce(F.trim(text) != "", F.lit(False))


def build_range_config(cfg: DataFrame) -> DataFrame:
    """Config CSV rows to one row per range.

    Input columns: line_no, sheet_key, sheet_id, frame, header1, header2,
    start, stop, control_column, end_column, data, dynamic_headers. Sheets are
    numbered by first appearance. With start and stop values the range is
    found by markers, otherwise by its cell range. ``use_dynamic_headers`` is
    the header value with its words typed (``header_kind`` says as what);
    marker ranges never use it.
    """
    firsts = cfg.groupBy("sheet_key").agg(F.min("line_no").alias("_first"))
    indexed = number_rows(firsts, [F.col("_first")], "sheet_index").select("sheet_key", "sheet_index")
    dynamic = filled(F.col("start")) & filled(F.col("stop"))
    data = F.when(~dynamic & filled(F.col("data")), parse_range(F.col("data")))
    head = F.when(~dynamic & filled(F.col("dynamic_headers")), parse_range(F.col("dynamic_headers")))
    heads = F.filter(F.array("header1", "header2"), filled)
    return (
        cfg.withColumns({"_d": data, "_h": head})
        .join(indexed, "sheet_key")
        .select(
            F.col("sheet_index").cast("int").alias("sheet_index"),
            "sheet_id",
            F.col("sheet_key").alias("sheet"),
            F.col("frame"),
            "line_no",
            F.when(~dynamic, column_span(F.col("data"))).alias("data_range"),
            F.when(~dynamic, column_span(F.col("dynamic_headers"))).alias("header_range"),
            (F.col("_d.start_row") - 1).alias("skiprows_data"),
            (F.col("_d.end_row") - F.col("_d.start_row") + 1).alias("nrows_data"),
            (F.col("_h.start_row") - 1).alias("header_rows_skip"),
            (F.col("_h.end_row") - F.col("_h.start_row") + 1).alias("nrows_header"),
            F.when(dynamic, "false").otherwise(coerce_word(F.col("dynamic_headers"))).alias("use_dynamic_headers"),
            F.when(dynamic, "flag").otherwise(word_kind(F.col("dynamic_headers"))).alias("header_kind"),
            F.array_join(heads, "|").alias("prepend_headers"),
            dynamic.alias("use_markers"),
            F.when(dynamic, coerce_word(F.col("start"))).alias("start_value"),
            F.when(dynamic, coerce_word(F.col("stop"))).alias("stop_value"),
            F.when(dynamic, F.col("control_column")).alias("control_column"),
            F.when(dynamic, F.col("end_column")).alias("end_column"),
        )
    )


def nest_range_config(config: DataFrame) -> DataFrame:
    """One row per sheet with its ranges as a list, in file order. The list
    holds configuration lines, never report data."""
    ranges = F.array_sort(F.collect_list(F.struct("line_no", "frame", "data_range", "header_range")))
    return config.groupBy("sheet_index", "sheet").agg(
        F.transform(ranges, lambda x: x["frame"]).alias("frames")
    )


def _small(rows: DataFrame) -> DataFrame:
    """Send a stored table to every task if a count says that it is small;
    otherwise a join shuffles it."""
    return F.broadcast(rows) if rows.count() <= CONFIG_ROWS else rows


def _width_error(row_from: str, row_to: str) -> Column:
    width, head = (F.col(f"{b}to") - F.col(f"{b}from") + 1 for b in ("col_", "head_"))
    return (
        F.when(F.col(row_to).isNull() | F.col(row_from).isNull(), F.lit("range not found"))
        .when(F.col("head_row").isNull() | head.isNull(), F.lit("header range missing"))
        .when(width < 1, F.lit("empty range"))
        .when(
            width != head,
            F.concat(
                F.lit("range is "), width.cast("string"), F.lit(" columns wide but its header "), head.cast("string")
            ),
        )
    )


def _fixed_ranges(config: DataFrame) -> DataFrame:
    """Bounds of the ranges given by cells, which are those of every report."""

    def ends(name: str, i: int) -> Column:
        return column_number(F.split_part(F.col(name), F.lit(":"), F.lit(i)))

    fixed = config.filter("not use_markers").select(
        "sheet",
        "frame",
        (F.col("skiprows_data") + 1).alias("row_from"),
        (F.col("skiprows_data") + F.col("nrows_data")).alias("row_to"),
        ends("data_range", 1).alias("col_from"),
        ends("data_range", 2).alias("col_to"),
        (F.col("header_rows_skip") + 1).alias("head_row"),
        ends("header_range", 1).alias("head_from"),
        ends("header_range", 2).alias("head_to"),
    )
    return fixed.withColumn("error", _width_error("row_from", "row_to"))


def _marker_ranges(config: DataFrame, cells: DataFrame) -> DataFrame:
    """Bounds of the marker ranges, per report: between the first start value
    in the control column and the first stop value below it."""
    marks = config.filter("use_markers").select(
        "sheet",
        "frame",
        "start_value",
        "stop_value",
        column_number(F.col("control_column")).alias("col"),
        column_number(F.col("end_column")).alias("col_to"),
    )
    # Each cell meets only the ranges that name its sheet, column and value;
    # the few marker cells are stored, as starts and stops both read them.
    kinds = F.array(
        F.struct(F.col("start_value").alias("value"), F.lit("start").alias("kind")),
        F.struct(F.col("stop_value").alias("value"), F.lit("stop").alias("kind")),
    )
    marks = marks.select("sheet", "frame", "col", "col_to", F.inline(kinds))
    hits = settle(cells.join(_small(marks), ["sheet", "col", "value"]), "markers")
    group = ["report", "sheet", "frame", "col", "col_to"]
    starts = hits.filter("kind = 'start'").groupBy(*group).agg(F.min("row").alias("head_row"))
    stops = (
        hits.filter("kind = 'stop'")
        .join(starts.select("report", "sheet", "frame", "head_row"), ["report", "sheet", "frame"])
        .filter("row > head_row")
        .groupBy("report", "sheet", "frame")
        .agg((F.min("row") - 1).alias("row_to"))
    )
    marked = starts.join(stops, ["report", "sheet", "frame"], "left").select(
        "report",
        "sheet",
        "frame",
        (F.col("head_row") + 1).alias("row_from"),
        "row_to",
        F.col("col").alias("col_from"),
        "col_to",
        "head_row",
        F.col("col").alias("head_from"),
        F.col("col_to").alias("head_to"),
    )
    return marked.withColumn("error", _width_error("row_from", "row_to"))


def interval_index(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Ranges as an index to join cells with: one row per column of a range,
    for its data and for its header, and per block of rows it touches. A cell
    then meets only intervals of its own column and block, however many ranges
    lie on that column."""
    column = F.explode(F.sequence(F.lit(0), F.col("col_to") - F.col("col_from"))).alias("_i")
    spans = ranges.select("*", column)
    place = [*keys, "frame", (F.col("_i") + 1).alias("col_no")]
    data = spans.select(*place, F.lit(False).alias("is_header"), (F.col("col_from") + F.col("_i")).alias("col"), "row_from", "row_to")
    head = spans.select(
        *place,
        F.lit(True).alias("is_header"),
        (F.col("head_from") + F.col("_i")).alias("col"),
        F.col("head_row").alias("row_from"),
        F.col("head_row").alias("row_to"),
    )
    block = F.explode(F.sequence(F.shiftright("row_from", BLOCK_BITS), F.shiftright("row_to", BLOCK_BITS)))
    return data.unionByName(head).filter("row_to >= row_from").withColumn("block", block)


def _cells_inside(cells: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    blocked = cells.withColumn("block", F.shiftright("row", BLOCK_BITS))
    met = blocked.join(index, [*keys, "col", "block"]).filter("row between row_from and row_to")
    return met.select("report", "sheet", "frame", "is_header", (F.col("row") - F.col("row_from") + 1).alias("row_no"), "col_no", "value")


def extract_ranges(
    cells: DataFrame, config: DataFrame, sheets: list[str] | str = "All"
) -> tuple[DataFrame, DataFrame]:
    """Read every configured range of every report.

    Returns (long, failures): long rows are (report, sheet, frame, row_no,
    col_no, header, value) with numbers inside the range; failures are
    (report, sheet, frame, error). Cells missing from a range are no rows.

    Ranges become an interval index. The cells are read once for headers and
    data together, and once more for markers if there are any; what lies inside
    a range is stored, and its data rows then meet one header row each.
    """
    if sheets != "All":
        config = config.filter(F.col("sheet").isin(list(sheets)))
    config = settle(config, "config")
    fixed = settle(_fixed_ranges(config), "fixed_ranges")
    index = settle(interval_index(fixed.filter("error is null"), ["sheet"]), "intervals")
    inside = _cells_inside(cells, _small(index), ["sheet"])
    keys = ["report", "sheet", "frame"]
    pages = cells.select("report", "sheet").distinct()
    failures = pages.join(fixed.filter("error is not null").select("sheet", "frame", "error"), "sheet").select(*keys, "error")
    if not config.filter("use_markers").isEmpty():
        marked = settle(_marker_ranges(config, cells), "marker_ranges")
        good = interval_index(marked.filter("error is null"), ["report", "sheet"])
        inside = inside.unionByName(_cells_inside(cells, good, ["report", "sheet"]))
        unmarked = (
            pages.join(config.filter("use_markers").select("sheet", "frame"), "sheet")
            .join(marked.select(*keys), keys, "left_anti")
            .select(*keys, F.lit("start value not found").alias("error"))
        )
        failures = failures.unionByName(marked.filter("error is not null").select(*keys, "error")).unionByName(unmarked)
    absent = (
        config.select("sheet", "frame")
        .join(pages.select("sheet").distinct(), "sheet", "left_anti")
        .select(F.lit(None).cast("string").alias("report"), "sheet", "frame", F.lit("sheet not found").alias("error"))
    )
    inside = settle(inside, "range_cells")
    headers = inside.filter("is_header").select(*keys, "col_no", F.col("value").alias("header"))
    long = (
        inside.filter("not is_header")
        .join(headers, [*keys, "col_no"], "left")
        .select(*keys, "row_no", "col_no", "header", "value")
    )
    return long, failures.unionByName(absent)


def widen(long: DataFrame, headers: list[str]) -> DataFrame:
    """The final table view of a range: one column per listed header."""
    return long.groupBy("report", "sheet", "frame", "row_no").pivot("header", headers).agg(F.min("value"))


def load_summary(long: DataFrame, failures: DataFrame) -> DataFrame:
    """Ranges loaded and failed, by reason: (status, error, ranges)."""
    keys = ["report", "sheet", "frame"]
    ok = long.select(*keys).distinct().select(F.lit("loaded").alias("status"), F.lit(None).cast("string").alias("error"))
    bad = failures.select(F.lit("failed").alias("status"), "error")
    return ok.unionByName(bad).groupBy("status", "error").agg(F.count(F.lit(1)).alias("ranges"))


def report_order(df: DataFrame, brand_col: str, model_col: str, priority: list[str]) -> DataFrame:
    """Add ``sort_rank``: listed brands first in list order, then brand, brand
    totals after models, first word of the model, other totals last, model."""
    brand, model = F.col(brand_col), F.col(model_col)
    place = reduce(
        lambda acc, p: acc.when(brand == p[1], p[0]),
        list(enumerate(priority, start=1))[1:],
        F.when(brand == priority[0], 1),
    ).otherwise(len(priority) + 1)
    brand_total = model.isin([f"{b} Total" for b in priority])
    keys = {
        "_k1": place,
        "_k2": brand,
        "_k3": F.when(brand_total, 2).otherwise(1),
        "_k4": F.substring_index(model, " ", 1),
        "_k5": F.when(model.like("% Total") & ~brand_total, 2).otherwise(1),
        "_k6": model,
    }
    ranked = number_rows(df.withColumns(keys), [F.col(k) for k in keys], "sort_rank")
    return ranked.drop(*keys)
