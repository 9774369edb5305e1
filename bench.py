"""Headline queries: seconds per query, one JSON line.

Every query runs once to warm up and then three times; its time is the median.
The result is fully computed on the executors and thrown away (no-op sink), so
the time is that of the query and not of moving rows to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import registered  # noqa: E402
from starloom import build_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = """
    star_distinct_by_region macro_distinct_children category_case_distinct top_suppliers sk_lookup_default0
    sk_lookup_with_missing_keys sk_lookup_fallback multi_key_first_wins bridge_fanout keyword_theta_match
    keyword_contains_pairs orphans_left_anti latest_order_per_customer first_last_per_key distinct_pair surrogate_keys
    sorted_factorize role_union_consolidate group_profile distinct_profile distinct_and_sum_per_group text_cleaning
    split_explode_terms safe_numeric parse_dates duration_months time_dimension string_agg_distinct quality_rules
    pk_grain_duplicates reconcile_raw_vs_star theme_fact_distinct promote_semi student_dimension graduate_dimension
    institution_dimension theme_dimension goal_bridge authorship_fact authorship_theme_fact graduation_fact
    themes_by_state themes_by_category top_institutions
""".split()


def main() -> None:
    registered.load_all()
    spark = build_session(
        "bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            started = time.perf_counter()
            registered.QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": FOLDER.rsplit("sf", 1)[-1].strip("/"), "cpus": int(CPUS), "runs": RUNS,
    }))


if __name__ == "__main__":
    main()
