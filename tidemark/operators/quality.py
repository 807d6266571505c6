"""Data-quality profiles, gates, rejects, duplicates and contracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import TableContract
from tidemark.functions.text import split_fields, strip, whole_number, zero_pad
from tidemark.operators.numbering import number_rows
from tidemark.operators.shape import WHOLE_TYPES
from tidemark.session import settle

LIMB = 9
#: Records that one written file should hold.
FILE_ROWS = 1_000_000


def dq_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: type, rows, nulls and distinct values.

    Cells are first counted per (column, value); map-side counting folds
    repeated values, so one shuffle serves all three figures of all columns.
    """
    columns = columns or df.columns
    types = dict(df.dtypes)
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(types[c]).alias("type"),
                F.col(c).cast("string").alias("value"),
            )
            for c in columns
        ]
    )
    counted = (
        df.select(F.inline(cells)).groupBy("column", "type", "value").agg(F.count(F.lit(1)).alias("_n"))
    )
    return counted.groupBy("column", "type").agg(
        F.sum("_n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("_n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("distinct_values"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column in one pass and one row."""
    return df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])


def _failed(rule: Column) -> Column:
    """A row passes only if the rule is true."""
    return ~F.coalesce(rule, F.lit(False))


def dq_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule with its failed row count, plus the full-row
    duplicate gate: (rule, failed_rows, passed)."""
    gates = df.agg(
        *[F.count(F.when(_failed(c), 1)).alias(name) for name, c in rules.items()]
    )
    rows = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("failed_rows")) for n in rules]
    )
    copies = (
        df.groupBy(*df.columns)
        .agg((F.count(F.lit(1)) - 1).alias("_extra"))
        .agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias("failed_rows"))
        .select(F.lit("no_duplicate_rows").alias("rule"), "failed_rows")
    )
    return (
        gates.select(F.inline(rows)).unionByName(copies).withColumn("passed", F.col("failed_rows") == 0)
    )


def dq_rejects(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that fail any rule, with the names of the failed rules."""
    names = F.array(*[F.when(_failed(c), F.lit(n)) for n, c in rules.items()])
    return df.withColumn("failed_rules", F.array_join(F.array_compact(names), ",")).filter("failed_rules <> ''")


def dq_accepted(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(False)) for c in rules.values()]))


def resolve_column(df: DataFrame, name: str) -> str:
    """Find a column ignoring case and a ``table.`` prefix."""
    for c in df.columns:
        if c.split(".")[-1].lower() == name.lower():
            return c
    raise ValueError(f"Column {name!r} does not exist; columns are {df.columns}")


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL is never reported."""
    c = F.col(f"`{resolve_column(df, column)}`")
    return df.groupBy(c.alias("value")).agg(F.count(c).alias("count")).filter(F.col("count") > 1)


def duplicate_rows(df: DataFrame, column: str, value) -> DataFrame:
    """Rows holding ``value`` with their row numbers in the table sorted by
    ``column`` (NULLs first, ties by the other columns).

    Rows sorting before ``value`` are only counted; just the matching rows are
    numbered, and those over many tasks.
    """
    c = F.col(f"`{resolve_column(df, column)}`")
    before = df.filter(c.isNull() | (c < F.lit(value))).agg(F.count(F.lit(1)).alias("n")).scalar()
    numbered = number_rows(df.filter(c == F.lit(value)), [c], "_pos")
    return numbered.withColumn("row_number", F.col("_pos") + before).drop("_pos")


def contract_violations(df: DataFrame, contract: TableContract) -> DataFrame:
    """One row per breach: (column, kind, rows). Missing and extra columns
    come from the schemas, bad casts and over-long text from the data."""
    have = {c.lower(): c for c in df.columns}
    types = dict(df.dtypes)
    checks: list[tuple[str, str, Column]] = []
    for f in contract.fields:
        name = have.get(f.name.lower())
        if name is None:
            checks.append((f.name, "missing", F.lit(True)))
            continue
        cell = F.col(name)
        whole = types[name] == "string" and f.type in WHOLE_TYPES
        typed = whole_number(cell, f.type) if whole else cell.try_cast(f.type)
        checks.append((f.name, "bad_type", cell.isNotNull() & typed.isNull()))
        if f.max_length:
            checks.append((f.name, "too_long", F.length(cell.cast("string")) > f.max_length))
        if not f.nullable:
            checks.append((f.name, "null", cell.isNull()))
    known = {f.name.lower() for f in contract.fields}
    checks += [(c, "unexpected", F.lit(True)) for c in df.columns if c.lower() not in known]
    sums = df.agg(*[F.count(F.when(cond, 1)).alias(f"c{i}") for i, (_, _, cond) in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("column"), F.lit(k).alias("kind"), F.col(f"c{i}").alias("rows"))
            for i, (n, k, _) in enumerate(checks)
        ]
    )
    return sums.select(F.inline(rows)).filter("rows > 0")


def _limbs(x: Column) -> Column:
    """A whole number as limbs of ``LIMB`` digits, the lowest first; other text
    is zero. Every length has its limbs, so no field is left out of a sum."""
    digits = F.ltrim(F.when(x.rlike(r"^\d+$"), x).otherwise("0"), F.lit("0"))
    n = F.greatest(F.length(digits), F.lit(1))

    def limb(i: Column) -> Column:
        end = n - i * LIMB
        begin = F.greatest(end - LIMB, F.lit(0))
        part = F.substr(digits, begin + 1, end - begin)
        return F.when(part == "", F.lit("0")).otherwise(part).cast("bigint")

    return F.transform(F.sequence(F.lit(0), F.floor((n - 1) / LIMB).cast("int")), limb)


def _written_out(sums: Column, name: str) -> Column:
    """Sums of limbs as one decimal number, carried from limb to limb."""
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.lit("").alias("text"))
    base = F.lit(10**LIMB).cast("bigint")

    def add(state: Column, x: Column) -> Column:
        total = state["carry"] + x[name]
        low = F.lpad((total % base).cast("string"), LIMB, "0")
        return F.struct(F.call_function("div", total, base).alias("carry"), F.concat(low, state["text"]).alias("text"))

    text = F.aggregate(sums, start, add, lambda s: F.concat(s["carry"].cast("string"), s["text"]))
    lean = F.ltrim(text, F.lit("0"))
    return F.when(lean == "", F.lit("0")).otherwise(lean)


def _padded_fields(df: DataFrame, by: str, column: str, width: int, delimiter: str) -> DataFrame:
    """(by, position, before, after): every field but the first of a record."""
    fields = split_fields(strip(F.col(column)), delimiter)
    raw = (
        df.filter(strip(F.col(column)) != "")
        .select(by, F.posexplode(F.slice(fields, F.lit(2), F.size(fields))).alias("position", "_raw"))
        .select(by, "position", strip(F.col("_raw")).alias("before"))
    )
    return raw.withColumn("after", zero_pad(F.col("before"), width))


def pad_checksum(df: DataFrame, by: str, column: str, width: int, delimiter: str) -> DataFrame:
    """Column sums of the numeric fields before and after padding, per file:
    (by, position, sum_before, sum_after, passed). The sums are exact whole
    numbers of any length, written as text.

    There are two lanes. Numbers of up to ``2 * LIMB`` digits are two columns of
    plain sums in one aggregate. Longer ones are cut into limbs; only records
    with so many digits in a row are split again for them.
    """
    base = F.lit(10**LIMB).cast("bigint")
    short = rf"^0*\d{{1,{2 * LIMB}}}$"
    numbers = _padded_fields(df, by, column, width, delimiter).select(
        by, "position", *[F.when(F.col(s).rlike(short), F.col(s).cast("bigint")).alias(s) for s in ("before", "after")]
    )

    def total(side: str, high: bool) -> Column:
        part = F.call_function("div", F.col(side), base) if high else F.col(side) % base
        return F.coalesce(F.sum(part), F.lit(0))

    plain = numbers.groupBy(by, "position").agg(
        F.array(*[F.struct(total("before", high).alias("b"), total("after", high).alias("a")) for high in (False, True)]).alias("_s")
    )
    lanes = plain.select(by, "position", F.posexplode("_s").alias("_limb", "_x"))

    def long(side: str) -> Column:
        return _limbs(F.when(~F.col(side).rlike(short), F.col(side)))

    many = df.filter(F.col(column).rlike(rf"\d(?:_?\d){{{2 * LIMB},}}"))
    cut = (
        _padded_fields(many, by, column, width, delimiter)
        .filter(F.length("before") > 2 * LIMB)
        .select(by, "position", F.posexplode(F.arrays_zip(long("before").alias("b"), long("after").alias("a"))).alias("_limb", "_x"))
        .groupBy(by, "position", "_limb")
        .agg(F.struct(F.coalesce(F.sum("_x.b"), F.lit(0)).alias("b"), F.coalesce(F.sum("_x.a"), F.lit(0)).alias("a")).alias("_x"))
    )
    # as many limbs as the longest field has; a few rows per file and position
    limbs = lanes.unionByName(cut).groupBy(by, "position", "_limb").agg(F.sum("_x.b").alias("b"), F.sum("_x.a").alias("a"))
    whole = limbs.groupBy(by, "position").agg(F.sort_array(F.collect_list(F.struct("_limb", "b", "a"))).alias("_s"))
    out = whole.select(by, "position", _written_out(F.col("_s"), "b").alias("sum_before"), _written_out(F.col("_s"), "a").alias("sum_after"))
    return out.withColumn("passed", F.col("sum_before") == F.col("sum_after"))


def passing_files(checksum: DataFrame, by: str) -> DataFrame:
    """Files all of whose column sums match."""
    return checksum.groupBy(by).agg(F.bool_and("passed").alias("_ok")).filter("_ok").select(by)


def write_passing_files(records: DataFrame, checksum: DataFrame, by: str, path: str, fmt: str = "text", **options: str) -> None:
    """Write the records of files all of whose column sums match, and no others,
    one folder per file. ``checksum`` has a few rows per file.

    Making a file costs far more than a small file's records, so all records of
    a file go to one task, which makes one file of them; only those of more than
    ``FILE_ROWS`` records are dealt over several. The tasks move their folders
    into place themselves, not the driver one by one at the end.
    """
    sizes = records.groupBy(by).agg(F.count(F.lit(1)).alias("_rows"))
    good = settle(passing_files(checksum, by).join(sizes, by), "passing")
    total = good.agg(F.sum("_rows")).first()[0] or 0
    tasks = max(records.sparkSession.sparkContext.defaultParallelism, -(-total // FILE_ROWS))
    split = F.pmod(F.xxhash64(*records.columns), F.ceil(F.col("_rows") / FILE_ROWS))
    dealt = records.join(good, by).repartition(tasks, by, split).select(*records.columns)
    moved = {"mapreduce.fileoutputcommitter.algorithm.version": "2", **options}
    dealt.write.mode("overwrite").options(**moved).partitionBy(by).format(fmt).save(path)
