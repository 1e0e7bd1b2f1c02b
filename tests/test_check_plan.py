"""Checks in one pass against the single checks."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import quality


def test_one_pass_equals_single_checks(spark):
    a = spark.createDataFrame(
        [(1, 10, "x"), (1, 11, None), (2, None, "y"), (None, 99, "z"), (None, 99, "z"), (3, 10, "x")],
        "id int, parent int, kind string")
    b = spark.createDataFrame([(10, 1), (11, 2), (None, 3)], "id long, self long")
    plan = quality.CheckPlan()
    plan.unique(a, "id", "unique.a.id")
    plan.unique(b, "id", "unique.b.id")
    for c in ("id", "parent", "kind"):
        plan.not_null(a, c, f"not_null.a.{c}", "warn" if c == "kind" else "error")
    plan.reference(a, "parent", b, "id", "reference.a.parent")
    plan.reference(b, "self", b, "id", "reference.b.self")
    plan.accepted(a, "kind", ["x", "y"], "accepted.a.kind")
    plan.same_row_count(a, a.where("id > 1"), "rows.a")
    single = quality.together([
        quality.unique(a, ["id"], "unique.a.id"), quality.unique(b, ["id"], "unique.b.id"),
        quality.not_null(a, ["id", "parent"], "not_null.a"),
        quality.not_null(a, ["kind"], "not_null.a", "warn"),
        quality.relationship(a, "parent", b, "id", "reference.a.parent"),
        quality.relationship(b, "self", b, "id", "reference.b.self"),
        quality.accepted_values(a, "kind", ["x", "y"], "accepted.a.kind"),
        quality.same_row_count(a, a.where("id > 1"), "rows.a")])
    got = sorted(map(tuple, plan.result(spark).collect()))
    assert got == sorted(map(tuple, single.collect())) and len(got) == 9
    assert ("reference.a.parent", 2, "warn") in got and ("rows.a", 4, "error") in got


def test_no_rows_and_all_checks_listed(spark):
    empty = spark.createDataFrame([], "id int, t timestamp")
    plan = quality.CheckPlan()
    plan.unique(empty, "id", "u")
    plan.not_null(empty, "id", "n")
    plan.fresh(empty, "t", "f")
    assert sorted(map(tuple, plan.result(spark, "2024-01-02 00:00:00").collect())) == [
        ("f", 1, "error"), ("n", 0, "error"), ("u", 0, "error")]


@pytest.mark.parametrize("hours,state", [(30, "pass"), (31, "warn"), (49, "error")])
def test_age_in_the_plan(spark, hours, state):
    now = dt.datetime(2024, 3, 10, 12)
    df = spark.createDataFrame([(now - dt.timedelta(hours=h),) for h in (hours, 100)], "t timestamp")
    plan = quality.CheckPlan()
    plan.fresh(df, "t", "f")
    assert tuple(plan.result(spark, "2024-03-10 12:00:00").first()) == (
        "f", int(state != "pass"), state)


def test_a_hot_value_is_one_row_per_task(spark):
    child = spark.range(0, 20_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("v"))
    parent = spark.range(100).toDF("id")
    plan = quality.CheckPlan()
    plan.reference(child, "v", parent, "id", "r")
    rows = plan.result(spark)
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert text.index("partial_sum") > text.index("Exchange hashpartitioning(check")
    assert rows.first().failures == sum(1 for i in range(20_000) if i % 3 == 0 and i >= 100)
