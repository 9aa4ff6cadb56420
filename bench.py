"""Time the queries on one machine and print one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of threads,
BENCH_QUERIES a choice of queries (comma-separated, or ``all``); by default the
headline queries run, a few for each family of operators. Each query runs twice
and the second run counts. Results go to Spark's ``noop`` writer, which makes
every row and column but stores nothing.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidyloom.queries import QUERIES  # noqa: E402
from tidyloom.settings import build_session  # noqa: E402


HEADLINE = """
    q_sum_by_status_prio_weekday q_count_month_weekday q_price_stats q_mean_pass q_product q_trip_share q_pareto q_first_order q_latest_event
    q_partition_stats q_star q_role_join q_join_inner q_unbooked q_unbooked_cust q_fill_ids q_generation q_next_workday q_tax_bands q_scaffold_month
    q_demographics q_melt q_pivot_first q_likert q_explode_split q_letter_freq q_harmonize_columns q_fill_blanks q_regex_groups q_parse_money
    q_parse_dates q_tenure q_weekday_rank q_lowest5 q_global_rank q_sort_index q_running_balance q_ledger q_daily_balance q_ffill q_pct_change
    q_rolling3 q_qcut6 q_top2pct q_scan_csv q_file_month q_json_by_key
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = HEADLINE if not chosen else list(QUERIES) if chosen == "all" else chosen.split(",")
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
    }
    settings["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="tidyloom-bench-")
    spark = build_session("tidyloom-bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
        if "--verbose" in sys.argv:
            print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds_second_run",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
