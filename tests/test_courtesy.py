"""Dedupe, attribution, NOT IN and skewed joins."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.dedupe import dedupe, first_seen_on, merge_first_nonnull
from tidemark.operators import numbering
from tidemark.operators.joins import not_in
from tidemark.plans import courtesy

D = dt.date


def oos(spark, data):
    return spark.createDataFrame(
        data,
        "vin string, outdate date, outmile int, todaydate date, outtype string, daysinservice int, loangreaterthan60 string",
    )


def test_dedupe_winners_and_null_keys(spark):
    df = spark.createDataFrame(
        [("a", None, 1, "x"), ("a", None, 2, "y"), ("a", None, 2, "z"), (None, 1, 5, "q")], "k1 string, k2 int, t int, v string"
    )
    assert rows(dedupe(df, ["k1", "k2"], "t", "last")) == [(None, 1, 5, "q"), ("a", None, 2, "z")]
    assert rows(dedupe(df, ["k1", "k2"], "t", "first")) == [(None, 1, 5, "q"), ("a", None, 1, "x")]
    with pytest.raises(ValueError):
        dedupe(df, ["k1"], "t", "newest")


def test_dedupe_reduces_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 as k", "id as t")
    plan = dedupe(df, ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_first_seen_equals_dedupe_then_filter(spark):
    data = [
        ("v1", D(2024, 1, 1), 10, D(2024, 1, 5), "A", 10, "N"),
        ("v1", D(2024, 1, 1), 10, D(2024, 1, 9), "A", 10, "N"),
        ("v2", D(2024, 1, 1), None, D(2024, 1, 9), "A", 10, "N"),
        ("v3", D(2024, 1, 1), None, D(2024, 1, 8), "A", 10, "N"),
        ("v3", D(2024, 1, 1), None, D(2024, 1, 9), "A", 10, "N"),
    ]
    df, keys = oos(spark, data), courtesy.NATURAL_KEY
    day = F.lit(D(2024, 1, 9))
    long_way = dedupe(df, keys, "todaydate", "first").filter(F.col("todaydate") == day)
    assert rows(first_seen_on(df, keys, "todaydate", day)) == rows(long_way)
    assert [r.vin for r in long_way.collect()] == ["v2"]


def deliveries(spark):
    data = [
        ("v1", D(2021, 1, 1), 7, 11), ("v1", D(2021, 6, 1), 8, 12), ("v1", D(2021, 9, 1), 7, 11),
        ("v2", D(2021, 1, 1), 9, 99), ("v3", D(2020, 1, 1), 9, 13),
    ]
    return spark.createDataFrame(
        [(v, d, b, s, 2021, 25, "US", 1, "M") for v, d, b, s in data],
        "veh_id_nbr string, orig_proc_dt date, biz_assoc_id bigint, sell_src_cd int, model_yr int, kpi_type_cd int, "
        "ntl_cd string, veh_deliv_cnt int, veh_prod_rpt_model_cd string",
    )


def test_dealer_sequence_uses_first_processing_per_dealer(spark):
    (row,) = courtesy.dealer_sequence(deliveries(spark)).collect()
    assert (row.veh_id_nbr, row.first_dealer.biz_assoc_id, row.last_dealer.biz_assoc_id) == ("v1", 7, 8)
    assert row.last_dealer.selling_source == "Cadillac"


def test_history_credits_first_then_last_dealer(spark):
    events = oos(
        spark,
        [
            ("v1", D(2021, 7, 1), 10, D(2021, 7, 5), "A", 10, "N"),
            ("v1", D(2021, 8, 1), 20, D(2021, 8, 5), "A", 20, "N"),
            ("v1", D(2020, 8, 1), 20, D(2021, 9, 5), "A", 20, "N"),
            ("v1", D(2021, 9, 1), 30, D(2021, 12, 31), "A", 20, "N"),
        ],
    )
    out = courtesy.ctp_historical(events, deliveries(spark), D(2021, 12, 31))
    # The July event repeats the kept event's out and file date; the 2020 one
    # precedes the delivery; the last one is not due yet.
    assert [(r.file_dt, r.biz_assoc_id) for r in out.orderBy("file_dt").collect()] == [
        (D(2021, 7, 5), 7), (D(2021, 8, 5), 8),
    ]


def test_history_computes_its_events_once_and_has_no_copies(spark):
    data = [("v1", D(2021, 7, i), None if i % 3 else 10, D(2021, 7, i + j), None if i % 2 else "A", 10, "N") for i in range(1, 9) for j in (1, 3)]
    out = courtesy.ctp_historical(oos(spark, data), deliveries(spark), D(2021, 12, 31))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Aggregate") == 2  # the first event of a vehicle, used twice
    assert out.count() == out.distinct().count() == 8


def test_combined_knows_the_dealers_of_the_day_before(spark):
    events = oos(spark, [("v1", D(2021, 7, 2), 10, D(2021, 7, 5), "A", 10, "N"), ("v1", D(2021, 7, 1), 20, D(2021, 7, 4), "A", 20, "N")])
    day = D(2021, 7, 5)
    both = courtesy.ctp_combined(events, deliveries(spark).filter("biz_assoc_id < 9"), day)
    assert sorted((r.File_Dt, r.Biz_Assoc_Id) for r in both.collect()) == [(D(2021, 7, 4), 7), (D(2021, 7, 5), 8)]
    late = deliveries(spark).withColumn("orig_proc_dt", F.when(F.col("biz_assoc_id") == 8, D(2021, 7, 5)).otherwise(F.col("orig_proc_dt")))
    both = courtesy.ctp_combined(events, late, day)
    assert sorted((r.File_Dt, r.Biz_Assoc_Id) for r in both.collect()) == [(D(2021, 7, 4), 7), (D(2021, 7, 5), 7)]


def test_not_in_modes(spark):
    probe = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    listed = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(not_in(probe, listed, ["k"])) == [(2,)]
    assert rows(not_in(probe, listed, ["k"], strict_null=True)) == []
    assert rows(not_in(probe, listed.filter("k is not null"), ["k"], strict_null=True)) == [(2,)]
    assert rows(not_in(probe, listed.limit(0), ["k"], strict_null=True)) == [(None,), (1,), (2,)]


def test_a_heavy_vehicle_is_split_by_the_join(spark):
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        left = spark.range(0, 20000, 1, 8).selectExpr("if(id % 3 = 0, 0, id % 400) as k", "uuid() as v")
        right = spark.range(400).selectExpr("id as k", "id * 10 as w")
        joined = left.join(right, "k").groupBy("k").agg(F.max("v"), F.max("w"))
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("parts", ["2", "7"])
def test_number_rows_sizes_its_ranges_by_count(spark, parts, monkeypatch):
    monkeypatch.setattr(numbering, "RANGE_ROWS", 100)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    seen = {}
    keep = numbering.settle
    monkeypatch.setattr(numbering, "settle", lambda df, label: seen.setdefault(label, keep(df, label)))
    try:
        df = spark.range(1000).selectExpr("pmod(hash(id), 5000) as k", "id")
        got = numbering.number_rows(df, [F.col("k")], "n").orderBy("n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert [r.n for r in got] == list(range(1, 1001)) and [r.k for r in got] == sorted(r.k for r in got)
    assert seen["ranges"].groupBy("_part").count().agg(F.max("count")).first()[0] < 250


def test_event_sequence_of_a_hot_vehicle(spark):
    data = [("v", D(2000 + i, 1, 1)) for i in range(40)] + [("u", D(2001, 1, 1)), ("w", D(1999, 1, 1))]
    df = spark.createDataFrame(data, "veh_id_nbr string, file_dt date")
    out = courtesy.event_sequence(df).orderBy("veh_id_nbr", "file_dt").collect()
    assert [r.seq_asc for r in out] == [1, *range(1, 41), 1]
    assert [r.seq_desc for r in out] == [1, *range(40, 0, -1), 1]


def test_merge_first_nonnull(spark):
    df = spark.createDataFrame([("k", 1, None, "b"), ("k", 2, 7, "c"), ("k", 3, 8, None)], "k string, o int, a int, b string")
    assert rows(merge_first_nonnull(df, ["k"], ["o"], ["a", "b"])) == [("k", 7, "b")]
