"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR   table folder (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_QUERIES  comma-separated names, or 'all' (default: the headline set)
"""

from __future__ import annotations

import json
import os
import time

from tallyhouse.config import session
from tallyhouse.plans import QUERIES

HEADLINE = [
    "wow", "wow_by_literal", "prev_gathered", "yoy_snapped", "yoy_364", "trailing_35_365",
    "five_week_avg", "past_year_avg_excl", "series_week", "lag_7_364_grid", "regular_grid",
    "holiday_comparison", "feed_union_regroup", "pivot_rollup", "matrix_subtotals",
    "engagement_mart", "giving_extract", "asof_stage", "asof_join", "family_rollup",
    "merge_upsert", "reconcile_deletes", "history_last_two_versions", "json_rows",
    "type_mismatch_report", "infer_types", "period_distinct_people", "audience_card",
    "cumulative_by_series", "quality_unique", "quality_relationship", "staging_requests"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = session("bench", cpus)
    QUERIES["totals_by_campus"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        spark.catalog.clearCache()
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": sf_dir.rpartition("sf")[2]}))
    spark.stop()


if __name__ == "__main__":
    main()
