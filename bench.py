"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Other names may be given as arguments; ``all`` runs every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.session import get_session, release  # noqa: E402
from tidemark.suite import QUERIES  # noqa: E402

HEADLINE = [
    "daily_sales",
    "mtd_all_months",
    "foos_cds",
    "daily_from_mtd",
    "daily_by_model",
    "date_spine_fill",
    "ytd_kpis",
    "dedupe_latest",
    "dealer_sequence",
    "ctp_historical",
    "ctp_incremental",
    "asof_join",
    "incremental_insert",
    "dq_profile",
    "dq_rules",
    "duplicate_rows",
    "compare_datasets",
    "pad_checksum",
    "report_ranges",
    "script_clean",
    "speaker_stats",
    "speaker_edges",
    "word_frequency",
    "ols_fit",
    "classification_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()  # start-up is not a query
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        release(spark)
        print(f"{times[name]:8.2f}  {name}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_query_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
