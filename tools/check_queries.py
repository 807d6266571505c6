"""Compare registered queries with their check SQL in DuckDB.

    python tools/check_queries.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
}


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    if isinstance(v, list):
        return tuple(plain(x) for x in v)
    return v


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def compare(spark_df, con, sql: str) -> tuple[list[str], int]:
    """Problems found (none means equal columns, types and rows) and row count."""
    names = sorted(spark_df.columns)
    rel = con.sql(sql)
    problems = []
    if sorted(rel.columns) != names:
        return [f"columns {names} vs {sorted(rel.columns)}"], -1
    kinds = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for name, kind in spark_df.dtypes:
        want = TYPES.get(kind, kind.upper().replace("DECIMAL", "DECIMAL"))
        if kinds[name].replace(" ", "") != want.replace(" ", ""):
            problems.append(f"type of {name}: {kind} vs {kinds[name]}")
    got = Counter(tuple(plain(r[n]) for n in names) for r in spark_df.collect())
    pos = [rel.columns.index(n) for n in names]
    want = Counter(tuple(plain(r[i]) for i in pos) for r in rel.fetchall())
    if got != want:
        a, b = list((got - want).items())[:2], list((want - got).items())[:2]
        problems.append(f"rows {sum(got.values())} vs {sum(want.values())}; only spark {a}; only sql {b}")
    return problems, sum(got.values())


def main() -> int:
    from tidemark.session import get_session, release
    from tidemark.suite import ORACLES, QUERIES

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    wanted = args[1:] or list(QUERIES)
    spark = get_session("check", "local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in wanted:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problems, n = compare(df, con, ORACLES[name])
            else:
                problems, n = [], df.count()
        except Exception as err:  # report and go on with the next query
            problems, n = [f"{type(err).__name__}: {str(err)[:1500]}"], -1
        release(spark)
        bad += bool(problems)
        state = "BAD" if problems else ("ok" if name in ORACLES else "rows")
        print(f"{state:5}{name:28}{n:>9} rows {time.time() - start:6.1f}s {problems or ''}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
