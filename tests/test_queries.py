"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tallyhouse.plans import QUERIES, SQL
from tests.oracle import compare

NAMES = list(QUERIES)  # the corpus queries have tests of their own
WRITES = {"full_load_roundtrip", "stream_upsert", "stream_dedupe", "load_path_table",
          "load_path_folder", "load_path_moves", "merge_versions", "key_index_probe",
          "reconcile_by_digest", "digest_fetches", "period_people_bitmaps", "load_path_logged"}


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(name, spark, sf_dir, con):
    df = entry.queries()[name](spark, sf_dir)
    if name in entry.oracle_sql():
        assert compare(df, con, entry.oracle_sql()[name]) == ""
    else:
        assert df.collect()


def test_sql_only_for_known_queries():
    assert set(SQL) <= set(NAMES)
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(NAMES) <= set(entry.queries())


def test_entry_has_rows(spark):
    rows = entry.entry(spark).collect()
    assert {r.campus for r in rows} == {"A", "B", "C", "Online"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in NAMES if n not in WRITES])
def test_no_nested_loops_or_python(name, spark, sf_dir):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython"):
        assert bad not in plan, bad


@pytest.mark.parametrize("name,column", [
    ("wow", "l_shipdate"), ("trailing_35_365", None), ("scan_incremental_26h", "ts"),
    ("giving_extract", "o_orderdate"), ("history_last_two_versions", "o_orderdate")])
def test_filters_and_columns_reach_the_scan(name, column, spark, sf_dir):
    df = entry.queries()[name](spark, sf_dir)
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    if column:
        pushed = [line for line in text.splitlines() if "PushedFilters" in line]
        assert any(f"({column}" in line for line in pushed)
    assert "l_tax" not in text and "l_discount" not in text


def test_top_versions_are_limited_before_the_shuffle(spark, sf_dir):
    plan = plan_of(entry.queries()["history_last_two_versions"](spark, sf_dir))
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", [
    "wow", "wow_by_literal", "yoy_snapped", "yoy_364", "trailing_35_365", "five_week_avg",
    "five_week_avg_dates", "series_month", "series_week", "series_multi_year", "prev_gathered",
    "card_previous", "latest_totals", "date_labels", "sunday_summary", "group_metrics",
    "infer_types"])
def test_comparisons_read_their_table_once(name, spark, sf_dir):
    assert plan_of(entry.queries()[name](spark, sf_dir)).count("FileScan parquet") == 1


@pytest.mark.parametrize("name", ["yoy_snapped", "series_week", "past_year_avg_excl",
                                  "adhoc_two_dates", "series_month"])
def test_report_periods_bound_the_scan_on_both_sides(name, spark, sf_dir):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


@pytest.mark.parametrize("name", ["pivot_rollup", "matrix_subtotals"])
def test_subtotals_copy_cells_not_orders(name, spark, sf_dir):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    below = plan[plan.index("Expand"):]
    assert "partial_sum" in below and "Exchange hashpartitioning" in below


@pytest.mark.parametrize("name,scans,single", [("quality_models", 16, 0), ("quality_bronze", 16, 0)])
def test_checks_read_each_model_once(name, scans, single, spark, sf_dir):
    """Fifteen tables, and one of them a second time: the current rows of the history, and
    staging beside bronze."""
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    assert plan.count("FileScan") <= scans
    assert plan.count("Exchange SinglePartition") <= single


def test_rows_are_numbered_without_sorting_the_whole_table(spark, sf_dir):
    """The cuts are one subquery that both readers of the ranges name."""
    plan = plan_of(entry.queries()["type_mismatch_report"](spark, sf_dir))
    assert plan.count("FileScan") <= 4 and plan.count("Exchange SinglePartition") <= 3
    assert "Join" not in plan and "RangePartitioning" not in plan
