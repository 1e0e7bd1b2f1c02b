"""Distinct people of any period from weekly bitmaps, against sets."""

from __future__ import annotations

import datetime as dt
import random

from tallyhouse.operators import bitmaps

PERIODS = {"x": ("2024-01-10", "2024-03-02"), "whole": ("2024-02-05", "2024-02-11"),
           "days": ("2024-02-06", "2024-02-08"), "before": ("2023-01-01", "2023-02-01"),
           "two": ("2024-01-03", "2024-01-15"), "one": ("2024-01-07", "2024-01-07")}


def test_any_period_equals_sets(spark):
    rng = random.Random(2)
    people = [None, 0, -5, 1, 32_768, 32_769, 40_000]
    rows = [(rng.choice("ab"), rng.choice([*people, rng.randrange(100_000)]),
             dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(120))) for _ in range(2000)]
    rows += [("c", 5, None), (None, 7, dt.date(2024, 2, 6)), ("d", None, dt.date(2024, 2, 6))] * 2
    df = spark.createDataFrame(rows, "g string, p long, d date").repartition(5)
    weekly = bitmaps.weekly_bitmaps(df, ["g"], "p", "d")
    got = {r.g: r for r in bitmaps.distinct_in_periods(df, weekly, ["g"], "p", "d", PERIODS).collect()}
    assert set(got) == {"a", "b", "d", None}
    for g, r in got.items():
        for name, (a, b) in PERIODS.items():
            first, last = dt.date.fromisoformat(a), dt.date.fromisoformat(b)
            assert r[name] == len({p for x, p, d in rows if x == g and d and first <= d <= last}), name


def test_weeks_can_be_merged_in_two_steps(spark):
    """Bitmaps kept for two halves of the rows are those of the whole, merged."""
    rows = [("a", k % 50, dt.date(2024, 1, 1) + dt.timedelta(days=k % 21)) for k in range(200)]
    df = spark.createDataFrame(rows, "g string, p long, d date")
    halves = [bitmaps.weekly_bitmaps(spark.createDataFrame(part, df.schema), ["g"], "p", "d")
              for part in (rows[:90], rows[90:])]
    args = (["g"], "p", "d", {"all": ("2024-01-01", "2024-01-21")})
    both = bitmaps.distinct_in_periods(df, halves[0].unionByName(halves[1]), *args)
    assert both.collect() == bitmaps.distinct_in_periods(
        df, bitmaps.weekly_bitmaps(df, ["g"], "p", "d"), *args).collect()
    assert both.first()["all"] == 50
