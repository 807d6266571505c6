"""Profiles, gates, padding, comparison and row numbers."""

from __future__ import annotations

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.contracts import COURTESY_TARGET, TableContract
from tidemark.functions.text import zero_pad
from tidemark.operators import quality
from tidemark.operators.compare import compare_datasets, compare_summary
from tidemark.operators.numbering import number_rows
from tidemark.operators.shape import cast_columns, concat_key, label_codes, pad_fields, parse_dates


def python_pad(text: str, width: int) -> str:
    try:
        return f"{int(text):0{width}}"
    except ValueError:
        return text


def test_padding_cases(spark):
    cases = ["-5", "+5", "1234567", "", "abc", "1_000", "-0", "0000000012", "12345678901234567890123", "-12345678901234567890123", "1.5", "__1", "-0_0", "+007"]
    df = spark.createDataFrame([(c,) for c in cases], "x string")
    got = [r[0] for r in df.select(zero_pad(F.col("x"), 6)).collect()]
    assert got == [python_pad(c, 6) for c in cases]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.from_regex(r"\A[+-]?[0-9_a]{0,25}\Z"), min_size=40, max_size=40), st.integers(1, 12))
def test_padding_agrees_with_python(spark, cases, width):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x string")
    got = [r[0] for r in df.orderBy("i").select(zero_pad(F.col("x"), width)).collect()]
    assert got == [python_pad(c, width) for c in cases]


def test_pad_records_skip_blank_lines_and_keep_the_first_field(spark):
    df = spark.createDataFrame([("7~42~ 3 ~x",), ("  ",), (" 9~1|2~-4 \t",)], "r string")
    out = pad_fields(df, "r", 6, "~").select("padded")
    assert rows(out) == [("7~000042~000003~x",), ("9~1|2~-00004",)]
    regex_sep = spark.createDataFrame([("a|1|2",)], "r string")
    assert pad_fields(regex_sep, "r", 3, "|").first().padded == "a|001|002"


def test_checksum_fails_for_plus_signs(spark):
    df = spark.createDataFrame([("f", "a~+5"), ("g", "a~5"), ("g", "b~007~x")], "file string, r string")
    sums = quality.pad_checksum(df, "file", "r", 6, "~")
    assert rows(quality.passing_files(sums, "file")) == [("g",)]


def test_checksum_is_exact_for_any_number_of_digits(spark):
    big, more = "9" * 40, "1" + "0" * 9
    df = spark.createDataFrame([("f", f"a~{big}~{more}"), ("f", f"b~{big}~{more}"), ("f", "c~007~"), ("f", "d~x~-3")], "file string, r string")
    got = {r.position: (r.sum_before, r.sum_after, r.passed) for r in quality.pad_checksum(df, "file", "r", 6, "~").collect()}
    total = str(2 * int(big) + 7)
    assert got == {0: (total, total, True), 1: (str(2 * int(more)), str(2 * int(more)), True)}


def test_only_passing_files_are_written(spark, tmp_path):
    df = spark.createDataFrame([("f", "a~+5"), ("g", "a~5"), ("g", "b~007~x")], "file string, r string")
    sums = quality.pad_checksum(df, "file", "r", 6, "~")
    quality.write_passing_files(df, sums, "file", str(tmp_path / "out"))
    assert rows(spark.read.text(str(tmp_path / "out"))) == [("a~5", "g"), ("b~007~x", "g")]


def test_a_small_file_is_written_by_one_task_and_a_large_one_by_several(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quality, "FILE_ROWS", 100)
    df = spark.range(0, 1500, 1, 6).selectExpr("if(id % 3 = 0, 'big', concat('f', id % 10)) as file", "concat('k~', id) as r")
    quality.write_passing_files(df, quality.pad_checksum(df, "file", "r", 6, "~"), "file", str(tmp_path / "out"))
    parts = {d.name: len(list(d.glob("part-*"))) for d in (tmp_path / "out").glob("file=*")}
    assert parts.pop("file=big") > 1 and parts == {f"file=f{i}": 1 for i in range(10)}
    assert rows(spark.read.text(str(tmp_path / "out"))) == rows(df.select("r", "file"))


def test_whole_numbers_of_any_length(spark):
    df = spark.createDataFrame([("0" * 30 + "42",), ("9" * 30,), ("+7",), ("1 2",)], "n string")
    assert [r.n for r in cast_columns(df, {"n": "bigint"}).collect()] == [42, None, 7, None]


def test_comparison_of_repeated_rows_keeps_its_rows_narrow(spark):
    def side(values):
        return spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k int, v string")

    left = side({1: ["a", "b", "b"], 2: ["a", "b", "b"], 3: ["x"] * 50 + [None], 4: ["q"]})
    right = side({1: ["b", "a", "b"], 2: ["a", "a", "b"], 3: [None] + ["x"] * 50, 4: ["r"]})
    diff = compare_datasets(left, right, ["k"])
    assert rows(diff) == [(2, None, "3", "3", "duplicate_key"), (4, "v", "q", "r", "value")]
    assert "decimal" not in diff._jdf.queryExecution().optimizedPlan().toString()


def test_comparison_of_repeated_keys_and_columns(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (2, "x"), (None, "n"), (3, None)], "k int, v string")
    same = compare_datasets(a, a.orderBy(F.desc("v")), ["k"])
    assert same.count() == 0
    b = spark.createDataFrame([(1, "x", 0), (1, "z", 0), (2, "x", 0), (2, "x", 0), (None, "n", 0), (3, "", 0)], "k int, v string, w int")
    got = rows(compare_datasets(a, b, ["k"]))
    assert got == [(None, "w", None, None, "missing_column_left"), (1, None, "2", "2", "duplicate_key"), (3, "v", None, "", "value")]
    plan = compare_datasets(a, b.select("k", "v"), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_casts_give_null_for_bad_text(spark):
    df = spark.createDataFrame([("abc", "13312023"), ("", "12312023"), (" 12 ", None), ("99999999999", "")], "n string, d string")
    out = parse_dates(cast_columns(df, {"N": "int"}), {"d": "MMddyyyy"})
    assert [r.n for r in out.collect()] == [None, None, 12, None]
    assert [str(r.d) for r in out.collect()] == ["None", "2023-12-31", "None", "None"]


def test_labels_and_keys(spark):
    df = spark.createDataFrame([(11, "a", None), (99, "b", "c")], "code int, x string, y string")
    out = label_codes(df, "code", {11: "Buick"}, "label").select("label", concat_key(["x", "y"], "s").alias("k"))
    assert [tuple(r) for r in out.collect()] == [("Buick", None), (None, "b|c|s")]


def test_null_rule_values_fail(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1), (3, -1)], "id int, v int")
    rules = {"positive": F.col("v") > 0}
    assert rows(quality.dq_rules(df, rules)) == [("no_duplicate_rows", 1, False), ("positive", 3, False)]
    assert [r.id for r in quality.dq_rejects(df, rules).orderBy("id").collect()] == [2, 3, 3]
    assert [r.id for r in quality.dq_accepted(df, rules).collect()] == [1]


def test_profile_and_null_counts(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (2, None)], "a int, b string")
    assert rows(quality.dq_profile(df)) == [("a", "int", 3, 0, 2), ("b", "string", 3, 2, 1)]
    assert tuple(quality.null_counts(df).first()) == (0, 2)


def test_duplicates_find_columns_loosely_and_skip_null(spark):
    df = spark.createDataFrame([(None,), (None,), ("x",), ("x",), ("y",)], "`t.Name` string")
    assert rows(quality.duplicate_values(df, "NAME")) == [("x", 2)]
    with pytest.raises(ValueError):
        quality.duplicate_values(df, "other")


def test_duplicate_rows_number_the_sorted_table(spark):
    df = spark.createDataFrame([("b", i) for i in range(30)] + [("a", 1), (None, 2), ("c", 3)], "k string, v int")
    out = [(r.v, r.row_number) for r in quality.duplicate_rows(df, "k", "b").orderBy("row_number").collect()]
    assert out == [(i, i + 3) for i in range(30)]


def test_row_numbers_with_a_large_group_of_copies(spark):
    df = spark.range(500).selectExpr("if(id % 3 = 0, 7, cast(id as int)) as v")
    numbered = number_rows(df, [F.col("v")], "n", parts=5)
    got = [(r.v, r.n) for r in numbered.orderBy("n").collect()]
    assert got == [(v, i) for i, v in enumerate(sorted(r.v for r in df.collect()), start=1)]


def test_copies_expand_over_several_blocks(spark, monkeypatch):
    from tidemark.operators import numbering

    monkeypatch.setattr(numbering, "COPY_BLOCK", 10)
    df = spark.range(47).selectExpr("if(id < 35, 1, 2) as v")
    assert [r.n for r in number_rows(df, [F.col("v")], "n", 3).orderBy("n").collect()] == list(range(1, 48))


def test_compare_kinds(spark):
    left = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3), (3, "c", 3), (None, "n", 1)], "k int, s string, v int")
    right = spark.createDataFrame([(1, "a", 1), (2, "x", None), (3, "c", 3), (4, "d", 4), (None, "n", 2)], "k int, s string, v int")
    diff = compare_datasets(left, right, ["k"])
    assert rows(diff) == [
        (None, "v", "1", "2", "value"),
        (2, "s", "b", "x", "value"),
        (3, None, "2", "1", "duplicate_key"),
        (4, None, None, None, "missing_left"),
    ]
    assert rows(compare_summary(diff))[0] == (None, "duplicate_key", 1)
    assert compare_datasets(left.limit(0), left.limit(0), ["k"]).isEmpty()
    assert compare_datasets(left.filter("k = 1"), left.filter("k = 1"), ["k"]).isEmpty()


def test_contract(spark):
    contract = TableContract.of(("A", "int", None, False), ("B", "string", 2), ("C", "date"))
    df = spark.createDataFrame([("1", "abc", 5), ("x", "a", 6), (None, None, 7)], "b_ string, b string, extra int").withColumnRenamed("b_", "a")
    assert rows(quality.contract_violations(df, contract)) == [
        ("A", "bad_type", 1), ("A", "null", 1), ("B", "too_long", 1), ("C", "missing", 3), ("extra", "unexpected", 3),
    ]
    with pytest.raises(ValueError, match="C"):
        contract.apply(df)
    assert len(COURTESY_TARGET.schema()) == 21
