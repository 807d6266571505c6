"""Sources, sinks, ledger, reports, streams and models."""

from __future__ import annotations

import datetime as dt
import os
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import OBJECTIVE_LAYOUTS, CsvSpec, layout_from_ranges
from tidemark.functions import dates
from tidemark.operators import models, reports, stats
from tidemark.session import release, scratch_dir, settle, stored_copies
from tidemark.sinks import ledger, writers
from tidemark.sources import dimensions, listing, readers
from tidemark.streaming import jobs

D = dt.date


def put(folder, name, text=""):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_scratch_lies_under_the_checkpoint_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_dir(spark)
    assert path != scratch_dir(spark) and (not base or path.startswith(base.rstrip("/")))
    assert settle(spark.range(3)).count() == 3


def test_stored_copies_can_go(spark):
    before = stored_copies()
    kept = [settle(spark.range(n), "kept") for n in (1, 2, 3)]
    release(spark, since=before, keep=1)
    assert stored_copies() == before + 1 and kept[2].count() == 3
    assert not Path(kept[0].inputFiles()[0].removeprefix("file://")).exists()
    release(spark, since=before)
    assert stored_copies() == before


def test_csv_options(spark, tmp_path):
    put(tmp_path, "t.tsv", "id\tday\tname\n# note\n 1 \t2024-01-02\t\"a\tb\"\n2\t\tx\n")
    spec = CsvSpec(sep="\t", header=True, null_value="", date_format="yyyy-MM-dd", comment="#", trim=True)
    df = readers.read_delimited(spark, str(tmp_path), "id int, day date, name string", spec)
    assert rows(df) == [(1, D(2024, 1, 2), "a\tb"), (2, None, "x")]


def test_bad_rows_fail_or_are_kept(spark, tmp_path):
    put(tmp_path, "t.csv", "1,a\nx,b\n")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("s", T.StringType())])
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        readers.read_delimited(spark, str(tmp_path), schema).collect()
    kept = readers.read_delimited(spark, str(tmp_path), schema, CsvSpec(permissive=True)).collect()
    assert [r._corrupt_record for r in kept] == [None, "x,b"]


@pytest.mark.parametrize("kind", sorted(OBJECTIVE_LAYOUTS))
def test_layouts_read_what_was_rendered(spark, tmp_path, kind):
    layout = OBJECTIVE_LAYOUTS[kind]
    want, line = [], [" "] * 60
    for i, s in enumerate(layout.slots):
        text = {"date": "02292024", "int": str(i + 1).zfill(s.length), "bigint": str(i + 1).zfill(s.length)}.get(
            s.type, chr(65 + i) * s.length
        )
        line[s.start - 1 : s.start - 1 + s.length] = text
        want.append(D(2024, 2, 29) if s.type == "date" else i + 1 if "int" in s.type else text)
    put(tmp_path, "f.txt", "HDR  XXX01/02/2024\n" + "".join(line) + "\n")
    assert rows(readers.read_fixed_width(spark, str(tmp_path), layout)) == [tuple(want)]


def test_equal_lines_are_sliced_once(spark, tmp_path):
    layout = OBJECTIVE_LAYOUTS["NAT"]
    put(tmp_path, "a.txt", "HDR  XXX01/02/2024\n" + "..01AAA022920240000007\n" * 3 + "..01AAA02292024xxxxxxx\n")
    put(tmp_path, "b.txt", "..01AAA022920240000007\n" * 2 + ".. 1AAA022920240000007\n\n")
    got = readers.read_fixed_width(spark, str(tmp_path), layout, count="lines")
    seven, other = (1, "AAA", D(2024, 2, 29), 7), (1, "AAA", D(2024, 2, 29), None)
    want = [(*seven, 5), (*seven, 1), (*other, 1), (None, "", None, None, 1)]
    key = lambda t: tuple((x is not None, str(x)) for x in t)
    assert rows(got) == sorted(want, key=key)
    whole = readers.read_fixed_width(spark, str(tmp_path), layout)
    assert rows(whole) == sorted((r[:-1] for r in want for _ in range(r[-1])), key=key)


def test_range_layout(spark, tmp_path):
    put(tmp_path, "f.txt", "abcdef12\n")
    assert rows(readers.load(spark, "fixed-width", str(tmp_path), layout=layout_from_ranges("1-6,7-8"))) == [("abcdef", "12")]
    for bad in ("0-3", "5-2"):
        with pytest.raises(ValueError):
            layout_from_ranges(bad)
    for fmt in ("xlsx", "nope"):
        with pytest.raises(ValueError):
            readers.load(spark, fmt, "x")


def test_listing(spark, tmp_path):
    for name, text in [("Out_01022024_new_20240102a.txt", "x"), ("Out_01022024_new_20240102.txt", ""), ("e_2024-01-31.csv", "1"), ("e_2024-02-01.CSV", "1")]:
        put(tmp_path, name, text)
    files = listing.list_files(spark, str(tmp_path))
    assert files.count() == 3  # Spark leaves empty files out of a listing
    matched = listing.match_pattern(listing.valid_files(files, ".*"), D(2024, 1, 2), "Out_{MMddyyyy}_new_{yyyyMMdd}*.txt")
    assert [r.name for r in matched.collect()] == ["Out_01022024_new_20240102a.txt"]
    assert listing.latest_by_name_date(files).first().name == "e_2024-02-01.CSV"
    with pytest.raises(FileNotFoundError):
        listing.list_valid(spark, str(tmp_path), "nothing")
    assert listing.latest_by_name_date(files.limit(0)).isEmpty()


def test_header_dates_and_lineage(spark, tmp_path):
    put(tmp_path, "a.txt", "HDR  BAC02/29/2024\nrow1\n")
    put(tmp_path, "b.txt", "HDR  BACxx\nrow2\n")
    lines = readers.header_dated_lines(readers.read_lines(spark, str(tmp_path)))
    assert rows(lines.select("header_dt", "value")) == [(None, "row2"), (D(2024, 2, 29), "row1")]


def test_header_dates_beyond_the_broadcast_bound(spark, tmp_path):
    for i in range(5):
        put(tmp_path, f"f{i}.txt", f"HDR  BAC0{i + 1}/02/2024\n" + "".join(f"row{i}-{j}\n" for j in range(30)))
    lines = readers.read_lines(spark, str(tmp_path))
    near, far = readers.header_dated_lines(lines), readers.header_dated_lines(lines, most=2)
    assert rows(near.select("header_dt", "value")) == rows(far.select("header_dt", "value"))
    assert near.filter("header_dt is null").isEmpty() and near.count() == 150
    # the data lines stay where they were read
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_stored_listing_by_month(spark, tmp_path):
    names = [f"IN_2024{m:02d}{d:02d}.txt" for m in (1, 2, 3) for d in (1, 20)] + ["IN_notes.txt"]
    for name in names:
        put(tmp_path, name, "x\n")
    path = scratch_dir(spark)
    listing.store_listing(listing.list_files(spark, str(tmp_path)), path)
    assert listing.stored_listing(spark, path).count() == 7
    span = listing.stored_listing(spark, path, D(2024, 1, 20), D(2024, 2, 1))
    assert rows(span.select("name")) == [("IN_20240120.txt",), ("IN_20240201.txt",)]
    assert "file_month" in span._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1][:200]


def test_guarded_and_incremental_appends(spark):
    path = scratch_dir(spark)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert writers.append_if_absent(df, path, "id") is True
    assert writers.append_if_absent(df.filter("id = 2"), path, "id") is False
    more = spark.createDataFrame([(2, "z"), (3, "c"), (3, "d")], "id int, v string")
    for _ in range(2):
        writers.append_new(more, path, ["id"])
    writers.append_new(more.limit(0), path, ["id"])
    assert rows(writers.existing(spark, path, df.schema)) == [(1, "a"), (2, "b"), (3, "c")]


def test_inserts_open_only_folders_of_staged_keys(spark):
    path, keys = scratch_dir(spark), ["id", "k"]
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 7, f"v{i}") for i in range(200)], "id int, k int, v string")
    writers.append_new(df, path, keys, buckets=8)
    late = spark.createDataFrame([(5, 5, "again"), (6, None, "again"), (5, None, "new"), (5, None, "new too")], df.schema)
    touched = {r[0] for r in late.select(writers.key_bucket(keys, 8)).collect()}
    assert len(touched) < 8
    for folder in Path(path).glob("bucket_of_8=*"):
        if int(folder.name.split("=")[1]) not in touched:
            for f in folder.glob("*.parquet"):
                f.write_bytes(b"no parquet")
                (folder / f".{f.name}.crc").unlink(missing_ok=True)
    for _ in range(2):
        writers.append_new(late, path, keys, buckets=8)
    layout = T.StructType([*df.schema.fields, T.StructField("bucket_of_8", T.IntegerType())])
    stored = writers.existing(spark, path, layout).filter(F.col("bucket_of_8").isin(*touched)).select("id", "k", "v")
    kept = df.filter(writers.key_bucket(keys, 8).isin(*touched)).unionByName(late.filter("v = 'new'"))
    assert rows(stored) == rows(kept)


def test_an_insert_moves_each_side_once(spark):
    a = spark.createDataFrame([], T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("v", T.StringType())]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = writers.unseen(a.filter("id > 0"), a.filter("id < 9"), ["id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


def test_verify_sees_duplicate_drift(spark):
    path = scratch_dir(spark)
    df = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    df.write.parquet(path)
    assert writers.verify_written(df, path).first().passed
    drift = writers.verify_written(df.union(df.filter("id = 1")), path).first()
    assert (drift.missing_rows, drift.extra_rows, drift.passed) == (2, 0, False)
    assert writers.differences(df, df.distinct()).count() == 1


def test_copies_are_verified_against_a_source_that_moves_once(spark, tmp_path):
    df = spark.range(10).selectExpr("id % 4 as id", "cast(null as string) as v")
    paths = {n: str(tmp_path / n) for n in ("same", "fewer", "more", "none")}
    for n, copy in zip(paths, (df, df.filter("id <> 1"), df.union(df.limit(1)), df.limit(0))):
        copy.write.parquet(paths[n])
    found = writers.verify_copies(df, paths)
    assert rows(found) == sorted([("fewer", 10, 7, 3, 0, False), ("more", 10, 11, 0, 1, False), ("none", 10, 0, 10, 0, False), ("same", 10, 10, 0, 0, True)])
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1


def test_tables_and_partitioned_csv(spark):
    name = "t_tidemark_test"
    spark.sql(f"drop table if exists {name}")
    path = scratch_dir(spark)
    df = spark.createDataFrame([("x", 1), ("y", 2)], "state string, n int")
    writers.write_table(df, name, path, partition_by=["state"])
    assert not writers.ensure_table(spark, name, df.schema)
    pruned = spark.table(name).filter("state = 'x'")
    assert "PartitionFilters: [isnotnull(state" in pruned._jdf.queryExecution().executedPlan().toString()
    spark.sql(f"drop table {name}")
    assert writers.ensure_table(spark, name, df.schema) and spark.table(name).isEmpty()
    spark.sql(f"drop table {name}")
    out = scratch_dir(spark)
    writers.write_partitioned_csv(df, "state", out)
    assert rows(spark.read.option("header", "true").csv(f"{out}/state=y")) == [("2",)]
    assert rows(writers.archive_raw(df, scratch_dir(spark))) == rows(df)


def test_ledger_and_arrivals(spark):
    files = spark.createDataFrame([("a",), ("b",)], "path string")
    path = scratch_dir(spark)
    ledger.record_processed(files.filter("path = 'a'"), path, dt.datetime(2024, 1, 1))
    ledger.record_processed(files.filter("path = 'a'"), path, dt.datetime(2024, 1, 2))
    stored = writers.existing(spark, path, ledger.LEDGER)
    assert stored.count() == 1 and rows(ledger.claim_new_files(files, stored)) == [("b",)]
    days = spark.createDataFrame([(D(2024, 1, 5),), (D(2024, 1, 7),)], "d date")
    missing = ledger.missing_arrivals(days, "d", D(2024, 1, 9))
    assert [r.missing_dt for r in missing.orderBy("missing_dt").collect()] == [D(2024, 1, 6), D(2024, 1, 9)]


def test_dimensions(spark):
    nested = dimensions.nested_literal(spark, {"MI": {"Farm": "x", "Mill": "y"}}, "state", "string")
    out = dimensions.dimension_from_nested(nested, "state", "producer_name")
    assert ("MI", "Farm", "x", "Farm|MI") in rows(out)
    lat, lon = dimensions.lat_long(F.col("l"))
    locs = spark.createDataFrame([("42.3, -83.0",), ("bad",), (None,)], "l string")
    assert [tuple(r) for r in locs.select(lat, lon).collect()] == [(42.3, -83.0), (None, None), (None, None)]


def test_range_text(spark):
    df = spark.createDataFrame([("A1:C9",), ("AA10:AB12",), ("A:C",), ("x",), ("",)], "t string")
    parsed = df.select(reports.parse_range(F.col("t")).alias("p"), reports.column_span(F.col("t")).alias("s")).collect()
    assert [tuple(r.p) if r.p else None for r in parsed] == [("A", 1, "C", 9), ("AA", 10, "AB", 12), None, None, None]
    assert [r.s for r in parsed] == ["A:C", "AA:AB", "A:C", None, None]
    letters = spark.createDataFrame([("A",), ("Z",), ("AA",)], "t string")
    assert [r[0] for r in letters.select(reports.column_number(F.col("t"))).collect()] == [1, 26, 27]
    words = spark.createDataFrame([("TRUE",), ("Null",), ("Abc",), ("A1:B2",), ("  ",)], "t string")
    typed = words.select(reports.coerce_word(F.col("t")), reports.word_kind(F.col("t"))).collect()
    assert [tuple(r) for r in typed] == [("true", "flag"), (None, "none"), ("Abc", "text"), ("A1:B2", "range"), ("  ", "empty")]


def test_report_extraction_of_absent_sheets(spark):
    cells = spark.createDataFrame([("r", "S", 1, 1, "H"), ("r", "S", 2, 1, "v"), ("r", "S", 4, 1, "w")], "report string, sheet string, row int, col int, value string")
    cfg = spark.createDataFrame(
        [(1, "S", "1", "f", "", "", "", "", "", "", "A2:A4", "A1:A1"), (2, "T", "2", "g", "", "", "", "", "", "", "A2:A4", "A1:A1"),
         (3, "S", "1", "open", "", "", "H", "none", "A", "A", "", "")],
        "line_no int, sheet_key string, sheet_id string, frame string, header1 string, header2 string, start string, stop string, "
        "control_column string, end_column string, data string, dynamic_headers string",
    )
    config = reports.build_range_config(cfg)
    long, failures = reports.extract_ranges(cells, config)
    assert rows(long) == [("r", "S", "f", 1, 1, "H", "v"), ("r", "S", "f", 3, 1, "H", "w")]
    assert rows(failures) == [(None, "T", "g", "sheet not found"), ("r", "S", "open", "range not found")]
    assert reports.extract_ranges(cells, config, ["T"])[0].isEmpty()
    assert rows(reports.nest_range_config(config)) == [(1, "S", ["f", "open"]), (2, "T", ["g"])]


CONFIG = (
    "line_no int, sheet_key string, sheet_id string, frame string, header1 string, header2 string, start string, stop string, "
    "control_column string, end_column string, data string, dynamic_headers string"
)


def test_many_ranges_on_one_tall_column(spark):
    rows_, n = 20_000, 400
    cells = spark.range(1, rows_ + 1).select(
        F.lit("r").alias("report"), F.lit("S").alias("sheet"), F.col("id").cast("int").alias("row"), F.lit(1).alias("col"), F.col("id").cast("string").alias("value")
    )
    spans = [(50 * i + 2, 50 * i + 2 + (9000 if i % 100 == 0 else 5)) for i in range(n)]
    lines = [(i, "S", "1", f"f{i}", "", "", "", "", "", "", f"A{a}:A{b}", f"A{a - 1}:A{a - 1}") for i, (a, b) in enumerate(spans)]
    config = reports.build_range_config(spark.createDataFrame(lines, CONFIG))
    long, failures = reports.extract_ranges(cells, config)
    got = {r["frame"]: r for r in long.groupBy("frame").agg(F.count("*").alias("n"), F.min("header").alias("h"), F.min(F.col("value").cast("int")).alias("a"), F.max(F.col("value").cast("int")).alias("b"), F.countDistinct("row_no").alias("d")).collect()}
    for i, (a, b) in enumerate(spans):
        r, last = got[f"f{i}"], min(b, rows_)
        assert (r["n"], r["h"], r["a"], r["b"], r["d"]) == (last - a + 1, str(a - 1), a, last, last - a + 1)
    assert failures.isEmpty()
    # a cell meets the intervals of its block only, not all of its column
    index = reports.interval_index(reports._fixed_ranges(config), ["sheet"])
    assert index.groupBy("col", "block").count().agg(F.max("count")).first()[0] < n


def test_histogram_of_a_constant_and_of_nothing(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    bins = stats.histogram(df, "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in bins] == [0, 0, 2, 0] and (bins[0].lo, bins[3].hi) == (2.5, 3.5)
    assert stats.histogram(df.limit(0), "x", 4).isEmpty()


def test_levels_that_were_not_listed(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "z"), (5, None)], "id int, g string")
    levels = stats.fit_levels(df.filter("g <> 'z'"), ["g"])
    own, names = stats.encode_features(df, levels, unlisted="own")
    assert names == ["g_b", "g_c", "g_other"]
    assert rows(own.select("id", *names)) == [(1, 0.0, 0.0, 0.0), (2, 1.0, 0.0, 0.0), (3, 0.0, 1.0, 0.0), (4, 0.0, 0.0, 1.0), (5, None, None, None)]
    null, names = stats.encode_features(df, levels, unlisted="null")
    assert rows(null.select("id", *names))[3:] == [(4, None, None), (5, None, None)]
    with pytest.raises(Exception, match="unlisted level of g: z"):
        stats.encode_features(df, levels)[0].collect()
    with pytest.raises(ValueError):
        stats.encode_features(df, levels, unlisted="zero")
    two, names = stats.encode_features(df.filter("g in ('a', 'b')"), stats.fit_levels(df.filter("g < 'c'"), ["g"]))
    assert names == ["g_code"] and rows(two.select("id", "g_code")) == [(1, 0.0), (2, 1.0)]
    cells = stats.sparse_indicators(df, ["id"], "g", levels, unlisted="own")
    assert rows(cells.select("id", "level_index")) == [(2, 1), (3, 2), (4, -1)]
    with pytest.raises(Exception, match="unlisted level"):
        stats.sparse_indicators(df, ["id"], "g", levels).collect()


def test_a_period_stands_for_all_its_days(spark):
    series = spark.createDataFrame([(D(2020, 3, 1),), (D(2021, 12, 1),)], "d date")
    overlap = stats.overlap_range([(series, "d", "a"), (series, "d", "b")])
    stats.check_range(overlap, *stats.period_bounds("monthly", (2020, 3), (2021, 12)), "monthly")
    for first, last in (((2020, 2), (2021, 12)), ((2020, 3), (2022, 1))):
        with pytest.raises(ValueError):
            stats.check_range(overlap, *stats.period_bounds("monthly", first, last), "monthly")
    stats.check_range(overlap, *stats.period_bounds("annual", 2020, 2021), "annual")
    with pytest.raises(ValueError):
        stats.check_range(overlap, *stats.period_bounds("monthly", (2020, 3), (2021, 12)))


def test_local_times_that_occur_twice_or_never(spark):
    at = dt.datetime
    times = [at(2024, 3, 10, 1, 30), at(2024, 3, 10, 2, 30), at(2024, 3, 10, 3, 0), at(2024, 11, 3, 1, 30), at(2024, 11, 3, 2, 0)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")

    def utc(**rules):
        return [r[0] for r in df.select(dates.from_local(F.col("t"), "America/New_York", **rules)).collect()]

    assert utc() == [at(2024, 3, 10, 6, 30), at(2024, 3, 10, 7, 30), at(2024, 3, 10, 7, 0), at(2024, 11, 3, 5, 30), at(2024, 11, 3, 7, 0)]
    assert utc(twice="second")[3] == at(2024, 11, 3, 6, 30)
    assert utc(missing="null")[1] is None
    half = spark.createDataFrame([(at(2024, 4, 7, 1, 45),), (at(2024, 10, 6, 2, 15),)], "t timestamp_ntz")
    got = half.select(dates.from_local(F.col("t"), "Australia/Lord_Howe", "second", "null")).collect()
    assert [r[0] for r in got] == [at(2024, 4, 6, 15, 15), None]


def test_overlap_may_be_empty(spark):
    a = spark.createDataFrame([(D(2024, 1, 1),)], "d date")
    b = spark.createDataFrame([(D(2024, 2, 1),)], "d date")
    out = {r.series: (r.start_date, r.end_date) for r in stats.overlap_range([(a, "d", "a"), (b, "d", "b")]).collect()}
    assert out["overlap"] == (None, None)


def test_report_of_a_single_class(spark):
    df = spark.createDataFrame([("x", "x"), ("x", "x")], "actual string, predicted string")
    out = {r.label: (r.precision, r.recall, r.f1, r.support) for r in stats.classification_report(df).collect()}
    assert out["x"] == (1.0, 1.0, 1.0, 2) and out["macro avg"] == (1.0, 1.0, 1.0, 2)


@pytest.fixture(scope="module")
def sample(spark):
    return spark.range(400).selectExpr(
        "cast(id % 17 as double) as a", "cast((id * 7) % 11 as double) as b", "concat('g', id % 3) as g",
        "cast(3 * (id % 17) - 2 * ((id * 7) % 11) + (id * 13) % 5 as double) as y",
        "cast((id % 17) + (id * 31) % 9 > 12 as double) as hit",
    )


def test_lasso_meets_its_optimality_conditions(sample):
    alpha = 0.8
    result = models.fit(sample, models.ModelSpec("lasso", "y", (("a", "continuous"), ("b", "continuous"), ("g", "categorical")), alpha=alpha))
    coef = {r.feature: r.value for r in result.coefficients.collect()}
    data, _ = stats.encode_features(sample, {"g": ["g0", "g1", "g2"]})
    names = [n for n in coef if n != "intercept"]
    fitted = sum((F.col(n) * coef[n] for n in names), F.lit(coef["intercept"]))
    grads = data.select(*[F.avg(F.col(n) * (F.col("y") - fitted)).alias(n) for n in names]).first()
    for n in names:
        if abs(coef[n]) > 1e-9:
            assert abs(grads[n] - alpha * (1 if coef[n] > 0 else -1)) < 1e-3
        else:
            assert abs(grads[n]) <= alpha + 1e-3


@pytest.mark.parametrize("model", ["logistic", "probit"])
def test_binary_models_fit_the_observed_rate(sample, model):
    result = models.fit(sample, models.ModelSpec(model, "hit", (("a", "continuous"), ("b", "continuous"))))
    assert {r.feature for r in result.coefficients.collect()} == {"a", "b", "intercept"}
    gap, n = result.predictions.select(F.avg(F.col("y_hat") - F.col("y")), F.count("y")).first()
    assert n == 400 and abs(gap) < (1e-6 if model == "logistic" else 0.02)


def test_iterative_models_report_their_steps(sample):
    spec = models.ModelSpec("logistic", "hit", (("a", "continuous"), ("g", "categorical")), max_iter=1)
    short = {r.stat: r.value for r in models.fit(sample, spec).summary.collect()}
    spec = models.ModelSpec("logistic", "hit", (("a", "continuous"), ("g", "categorical")))
    full = {r.stat: r.value for r in models.fit(sample, spec).summary.collect()}
    assert short["converged"] == 0 and full["converged"] == 1 and full["iterations"] > 1


def test_categories_may_have_many_levels(spark):
    df = spark.range(3000).selectExpr("cast(id % 1500 as string) as g", "cast(id % 1500 as double) as y")
    result = models.fit(df, models.ModelSpec("lasso", "y", (("g", "categorical"),), alpha=1e-4, max_iter=5))
    assert len(result.features) == 1499


@pytest.mark.parametrize("model,y", [("rf_classification", "hit"), ("rf_regression", "y")])
def test_forests_learn_in_sample(sample, model, y):
    result = models.fit(sample, models.ModelSpec(model, y, (("a", "continuous"), ("b", "continuous"), ("g", "categorical")), n_estimators=8))
    assert abs(sum(r.value for r in result.coefficients.collect()) - 1) < 1e-6
    if model == "rf_classification":
        hits = result.predictions.select(F.avg((F.col("y") == F.col("y_hat")).cast("int"))).first()[0]
        assert hits > 0.75 and "probability" in result.predictions.columns
    else:
        assert stats.regression_metrics(result.predictions).first().r2 > 0.7


@pytest.mark.parametrize("model,y", [("rf_classification", "k"), ("rf_regression", "y")])
def test_forests_on_rows_that_share_points_grow_on_points(spark, monkeypatch, model, y):
    cells = spark.range(4000).selectExpr("id % 2 as odd", "cast(sqrt(id) as int) % 15 as c")  # of unequal size, so no splits tie
    df = cells.selectExpr("cast(c % 5 as double) as a", "cast(c % 3 as string) as g", "c * c % 11 * 10.0 + c + odd as y", "cast(c * c % 7 % 3 + odd as double) as k")
    spec = models.ModelSpec(model, y, (("a", "continuous"), ("g", "categorical")), n_estimators=1, resample=False)
    many = models.ModelSpec(model, y, spec.x, n_estimators=6, max_depth=8)
    plain = models.fit(df, spec)
    monkeypatch.setattr(models, "FOLD_ROWS", 4000)
    seen = []
    keep = models._folded_forest
    monkeypatch.setattr(models, "_folded_forest", lambda *a: seen.append(1) or keep(*a))
    folded, forest = models.fit(df, spec), models.fit(df, many)
    assert len(seen) == 2

    def counts(result):
        cells = [F.round(c, 9).alias(c) for c in result.predictions.columns]
        return rows(result.predictions.groupBy(*cells).count())

    assert counts(folded) == counts(plain)
    shares = [[r.value for r in x.coefficients.orderBy("feature").collect()] for x in (folded, plain)]
    assert shares[0] == pytest.approx(shares[1])
    assert forest.predictions.count() == 4000 and forest.predictions.columns == plain.predictions.columns
    error, constant = forest.predictions.agg(F.avg(F.pow(F.col("y") - F.col("y_hat"), 2)), F.var_pop("y")).first()
    assert error < constant or model == "rf_classification"
    n = models._poisson(F.col("u"))
    drawn = spark.range(100_000).withColumn("u", F.rand(1)).agg(F.avg(n), F.var_pop(n)).first()
    assert all(abs(x - 1) < 0.03 for x in drawn)


def test_forest_on_text_classes(sample):
    named = sample.withColumn("word", F.when(F.col("hit") == 1, "yes").otherwise("no"))
    result = models.fit(named, models.ModelSpec("rf_classification", "word", (("a", "continuous"), ("b", "continuous")), n_estimators=5))
    assert result.labels == ["no", "yes"]
    report = stats.classification_report(result.predictions, "y", "y_hat")
    assert {r.label for r in report.collect()} >= {"no", "yes", "accuracy"}


def test_model_specs_are_checked(sample):
    bad = models.ModelSpec("lasso", "y", (("y", "continuous"), ("g", "categorical"), ("g", "continuous")), alpha=0)
    assert len(models.spec_problems(bad)) == 3
    with pytest.raises(ValueError):
        models.fit(sample, bad)
    found = models.validate_variables(sample, models.ModelSpec("logistic", "y", (("g", "categorical"),))).collect()
    assert {(r.variable, r.rule): r.ok for r in found}[("y", "binary")] is False


def test_streams_restart_and_drop_late_rows(spark):
    landing, out, mark = (scratch_dir(spark) for _ in range(3))
    schema = "id bigint, ts timestamp, kind string"

    def land(*items):
        spark.createDataFrame(items, schema).write.mode("append").parquet(landing)

    def run():
        stream = jobs.file_stream(spark, landing, spark.createDataFrame([], schema).schema)
        jobs.daily_counts_stream(stream, out, mark, "ts", "kind", "1 day").awaitTermination()

    at = dt.datetime
    land((1, at(2024, 1, 1, 5), "x"), (2, at(2024, 1, 2, 5), "x"))
    run()
    land((3, at(2024, 1, 9, 5), "x"), (4, at(2024, 1, 2, 6), "x"))
    run()
    land((5, at(2024, 1, 2, 7), "x"))  # a week behind the watermark
    run()
    run()  # nothing new
    assert rows(jobs.latest_counts(spark, out, "kind")) == [(D(2024, 1, 1), "x", 1), (D(2024, 1, 2), "x", 2), (D(2024, 1, 9), "x", 1)]


def test_counts_are_read_from_the_snapshot_and_the_tail(spark):
    out, day = scratch_dir(spark), D(2024, 1, 1)

    def batch(n):
        jobs.write_counts(spark.createDataFrame([(day + dt.timedelta(n // 10), "x", n), (day, "all", n)], "day date, kind string, n long"), out, n)

    for n in range(50):
        batch(n)
        if n in (20, 40):
            jobs.compact_counts(spark, out, "kind", n - 1)
    want = [(day, "all", 49)] + [(day + dt.timedelta(i), "x", 10 * i + 9) for i in range(5)]
    assert rows(jobs.latest_counts(spark, out, "kind")) == sorted(want)
    batch(10)  # a replay of a batch that is in a snapshot
    for n in range(40):  # batches that are in a snapshot are read no more
        for f in Path(f"{out}/batch={n}").glob("*.parquet"):
            f.write_bytes(b"no parquet")
    (Path(out) / "snapshots" / "upto=48").mkdir()  # unfinished
    assert rows(jobs.latest_counts(spark, out, "kind")) == sorted(want)
    batch(49)
    assert rows(jobs.latest_counts(spark, out, "kind")) == sorted(want)


def test_stream_snapshots_keep_results(spark):
    landing, out, mark = (scratch_dir(spark) for _ in range(3))
    schema = "id bigint, ts timestamp, kind string"
    for i in range(5):
        spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i // 2, 5), "x")], schema).coalesce(1).write.mode("append").parquet(landing)
        stream = jobs.file_stream(spark, landing, spark.createDataFrame([], schema).schema)
        jobs.daily_counts_stream(stream, out, mark, "ts", "kind", "3 days", compact_every=2).awaitTermination()
    made = {p.name for p in (Path(out) / "snapshots").iterdir()}
    assert {"upto=1", "upto=3"} <= made and all(int(n.split("=")[1]) % 2 for n in made)
    assert rows(jobs.latest_counts(spark, out, "kind")) == [(D(2024, 1, 1), "x", 2), (D(2024, 1, 2), "x", 2), (D(2024, 1, 3), "x", 1)]


def test_stream_insert_is_idempotent(spark):
    landing, out = scratch_dir(spark), scratch_dir(spark)
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    df.write.parquet(landing)
    for _ in range(2):  # a new checkpoint replays every file
        stream = jobs.file_stream(spark, landing, df.schema)
        jobs.incremental_insert_stream(stream, out, scratch_dir(spark), ["id"], within="id").awaitTermination()
    assert rows(writers.existing(spark, out, df.schema)) == [(1, "a"), (2, "c")]
