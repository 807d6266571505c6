"""Courtesy-vehicle plans: out-of-service events credited to dealers.

``oos`` holds out-of-service rows (vin, outdate, outmile, todaydate, outtype,
daysinservice, loangreaterthan60); ``deliveries`` the program deliveries
(veh_id_nbr, orig_proc_dt, biz_assoc_id, sell_src_cd, model_yr, kpi_type_cd,
ntl_cd, veh_deliv_cnt, veh_prod_rpt_model_cd).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import COURTESY_TARGET
from tidemark.functions.dates import as_date
from tidemark.operators.dedupe import dedupe, first_seen_on
from tidemark.operators.numbering import number_rows
from tidemark.operators.shape import audit_columns, label_codes
from tidemark.session import settle

# Selling-source codes and labels, KPI types, program start.
BRANDS = {11: "Buick", 12: "Cadillac", 13: "Chevrolet", 48: "GMC"}
KPI_TYPES = [25, 95]
FIRST_YEAR = 2021

NATURAL_KEY = ["vin", "outdate", "daysinservice", "outmile"]
SOURCE = "171749"

DEALER = ["orig_proc_dt", "biz_assoc_id", "selling_source", "sell_src_cd", "veh_prod_rpt_model_cd", "model_yr"]


def program_deliveries(
    deliveries: DataFrame, country: str = "US", first_year: int = FIRST_YEAR, until: dt.date | None = None
) -> DataFrame:
    """First processing of each vehicle at each dealer in the program."""
    rows = deliveries.filter(
        (F.col("ntl_cd") == country)
        & F.col("kpi_type_cd").isin(KPI_TYPES)
        & F.col("sell_src_cd").isin(list(BRANDS))
        & (F.year("orig_proc_dt") >= first_year)
        & (F.col("veh_deliv_cnt") == 1)
    )
    if until:
        rows = rows.filter(F.col("orig_proc_dt") <= as_date(until))
    labelled = label_codes(rows, "sell_src_cd", BRANDS, "selling_source").select("veh_id_nbr", *DEALER)
    return dedupe(labelled, ["veh_id_nbr", "biz_assoc_id"], "orig_proc_dt", keep="first")


def dealer_sequence(deliveries: DataFrame, **kwargs) -> DataFrame:
    """First and last dealer of each vehicle, one row per vehicle:
    (veh_id_nbr, first_dealer struct, last_dealer struct). Ties on the date
    go to the dealer number and the other columns."""
    return _sequence(program_deliveries(deliveries, **kwargs))


def _sequence(seen: DataFrame) -> DataFrame:
    return seen.groupBy("veh_id_nbr").agg(
        F.min(F.struct(*DEALER)).alias("first_dealer"), F.max(F.struct(*DEALER)).alias("last_dealer")
    )


def _credited(events: DataFrame, dealer: str) -> DataFrame:
    """Events after the dealer's processing date, in target names."""
    return events.filter(F.col("outdate") > F.col(f"{dealer}.orig_proc_dt")).select(
        F.col("vin").alias("veh_id_nbr"),
        F.col("todaydate").alias("file_dt"),
        F.col(f"{dealer}.orig_proc_dt").alias("in_svc_dt"),
        F.col("outdate").alias("out_svc_dt"),
        F.col(f"{dealer}.biz_assoc_id").alias("biz_assoc_id"),
        F.col("daysinservice").alias("day_in_svc_cnt"),
        F.col("outmile").alias("out_svc_mil_cnt"),
        F.col("outtype").alias("out_svc_type_cd"),
        F.col(f"{dealer}.selling_source").alias("sell_src_desc"),
        F.col(f"{dealer}.sell_src_cd").alias("sell_src_cd"),
        F.col(f"{dealer}.veh_prod_rpt_model_cd").alias("veh_prod_rpt_model_cd"),
        F.col(f"{dealer}.model_yr").alias("model_yr"),
        F.col("loangreaterthan60").alias("loan_great_than_60_day_cd"),
    )


def ctp_historical(
    oos: DataFrame, deliveries: DataFrame, as_of: dt.date, first_year: int = FIRST_YEAR
) -> DataFrame:
    """All out-of-service events up to the day before ``as_of``.

    The first event of a vehicle goes to its first dealer; all events go to
    its last dealer, except those that repeat the first event's dealer or out
    date on the same file date. Rows without those values are left out.
    """
    return _historical(oos, program_deliveries(deliveries, first_year=first_year), as_of)


def _historical(oos: DataFrame, seen: DataFrame, as_of: dt.date) -> DataFrame:
    dealers = _sequence(seen).withColumnRenamed("veh_id_nbr", "vin")
    newest = dedupe(oos, NATURAL_KEY, "todaydate", keep="last")
    due = newest.filter(F.col("todaydate") <= as_date(as_of - dt.timedelta(days=1)))
    # One row per vehicle on the right: a vehicle with very many events is split
    # by adaptive execution, also where an aggregate on the vehicle follows. The
    # joined events are stored, as they are read for the first dealer and the last.
    events = settle(due.join(dealers, "vin"), "credited")
    incoming = _credited(events, "first_dealer")
    ranked = [c for c in incoming.columns if c not in ("veh_id_nbr", "file_dt")]
    first = (
        incoming.groupBy("veh_id_nbr")
        .agg(F.min(F.struct("file_dt", *ranked)).alias("_e"))
        .select("veh_id_nbr", "_e.*")
        .select(*incoming.columns)
    )
    # One kept event per vehicle, so the exclusion is one join on the vehicle.
    kept = first.select(
        "veh_id_nbr",
        F.col("file_dt").alias("_file"),
        F.col("biz_assoc_id").alias("_dealer"),
        F.col("out_svc_dt").alias("_out"),
    )
    outgoing = _credited(events, "last_dealer").join(kept, "veh_id_nbr", "left")
    same_file = F.coalesce(F.col("file_dt") == F.col("_file"), F.lit(False))
    repeats = same_file & (
        F.coalesce(F.col("biz_assoc_id") == F.col("_dealer"), F.lit(False))
        | F.coalesce(F.col("out_svc_dt") == F.col("_out"), F.lit(False))
    )
    comparable = reduce(
        lambda a, b: a & b, [F.col(c).isNotNull() for c in ("veh_id_nbr", "biz_assoc_id", "file_dt", "out_svc_dt")]
    )
    later = outgoing.filter(comparable & ~repeats).select(*incoming.columns)
    # An event keeps its natural key, of which there is one row, and the first
    # event does not come again among the later: no two rows are equal.
    return first.unionByName(later)


def ctp_incremental(
    oos: DataFrame, deliveries: DataFrame, as_of: dt.date, first_year: int = FIRST_YEAR
) -> DataFrame:
    """Events first reported on ``as_of``, credited to the last dealer known
    the day before."""
    until = as_of - dt.timedelta(days=1)
    return _incremental(oos, program_deliveries(deliveries, first_year=first_year, until=until), as_of)


def _incremental(oos: DataFrame, seen: DataFrame, as_of: dt.date) -> DataFrame:
    dealers = _sequence(seen).withColumnRenamed("veh_id_nbr", "vin")
    fresh = first_seen_on(oos, NATURAL_KEY, "todaydate", as_date(as_of))
    return _credited(fresh.join(dealers, "vin"), "last_dealer")


def ctp_combined(
    oos: DataFrame,
    deliveries: DataFrame,
    as_of: dt.date,
    first_year: int = FIRST_YEAR,
    job_id: str = "courtesy_kpi",
    run_ts: dt.datetime | None = None,
) -> DataFrame:
    """History and the day's increment as the courtesy target table."""
    run_ts = run_ts or dt.datetime.combine(as_of, dt.time())
    # A dealer's first processing is the same row whatever comes later, so what
    # was known the day before is a part of the stored processings.
    seen = settle(program_deliveries(deliveries, first_year=first_year), "processings")
    known = seen.filter(F.col("orig_proc_dt") <= as_date(as_of - dt.timedelta(days=1)))
    rows = _historical(oos, seen, as_of).unionByName(_incremental(oos, known, as_of))
    named = rows.select(*[F.col(c).alias(c.title()) for c in rows.columns])
    return COURTESY_TARGET.apply(
        audit_columns(named, ["Veh_Id_Nbr", "File_Dt", "Out_Svc_Dt"], SOURCE, job_id, run_ts)
    )


def event_sequence(events: DataFrame) -> DataFrame:
    """Number the events of each vehicle by file date: ``seq_asc`` and
    ``seq_desc``, ties by the other columns.

    All events are numbered once in vehicle and date order, over many tasks;
    the vehicle's own numbers follow from its first and last position, so a
    vehicle with a large part of all events is no special case.
    """
    numbered = number_rows(events, [F.col("veh_id_nbr"), F.col("file_dt")], "_n")
    ends = numbered.groupBy("veh_id_nbr").agg(F.min("_n").alias("_lo"), F.max("_n").alias("_hi"))
    return numbered.join(ends, "veh_id_nbr").select(
        *events.columns,
        (F.col("_n") - F.col("_lo") + 1).alias("seq_asc"),
        (F.col("_hi") - F.col("_n") + 1).alias("seq_desc"),
    )
