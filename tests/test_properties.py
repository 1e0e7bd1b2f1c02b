"""Properties over generated inputs, each checked against plain Python."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.functions import dates as D
from tallyhouse.operators import journey, metrics
from tallyhouse.sources import tables

QUICK = settings(max_examples=6, deadline=None,
                 suppress_health_check=[HealthCheck.function_scoped_fixture])
KEYS = st.dictionaries(st.integers(0, 12), st.text("abc", max_size=2), max_size=10)


def frame(spark, rows):
    return spark.createDataFrame(list(rows.items()), "id int, v string")


def as_dict(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return dict(rows)


@QUICK
@given(KEYS, KEYS)
def test_merge_is_a_dictionary_update(spark, stored, batch):
    target, staged = frame(spark, stored), frame(spark, batch)
    merged = tables.merge_upsert(target, staged, ["id"])
    assert as_dict(merged) == stored | batch
    assert as_dict(tables.merge_upsert(merged, staged, ["id"])) == stored | batch
    assert as_dict(tables.merge_insert_only(target, staged, ["id"])) == batch | stored
    assert as_dict(tables.remove_deleted(merged, staged, "id")) == batch


@QUICK
@given(st.lists(st.dates(dt.date(1996, 1, 1), dt.date(2040, 12, 31)), min_size=1, max_size=60))
def test_dates(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select("d", D.week_ending_sunday("d").alias("w"), D.last_sunday("d").alias("s"),
                    D.us_week_number("d").alias("n"), D.year_before("d").alias("y"),
                    D.snapped_year_before("d").alias("p")).collect()
    for r in got:
        assert r.w.isoweekday() == 7 and 0 <= (r.w - r.d).days < 7
        assert r.s.isoweekday() == 7 and 0 <= (r.d - r.s).days < 7
        first = dt.date(r.d.year, 1, 1)
        start = first - dt.timedelta(days=first.isoweekday() % 7)
        assert r.n == (r.d - start).days // 7 + 1
        leap = (r.d.month, r.d.day) == (2, 29)
        assert r.y == (dt.date(r.d.year - 1, 3, 1) if leap else r.d.replace(year=r.d.year - 1))
        assert r.p.isoweekday() in (1, 7) and abs((r.p - r.y).days) <= 3


COUNTS = st.lists(st.tuples(st.integers(0, 60), st.sampled_from("AB"), st.integers(0, 30)),
                  min_size=1, max_size=60)


@QUICK
@given(COUNTS)
def test_weekly_metrics(spark, counts):
    base = dt.date(2024, 6, 2)
    data = [(base - dt.timedelta(days=7 * w), c, "x", "9", n) for w, c, n in counts]
    hc = spark.createDataFrame(data, "sunday_date date, campus string, literal string, "
                                     "schedule string, cnt bigint")
    totals = {}
    for d, c, _, _, n in data:
        totals[c, d] = totals.get((c, d), 0) + n
    for r in metrics.week_over_week(hc, base, ["campus"]).collect():
        current = totals.get((r.campus, base), 0)
        before = sorted(d for (c, d), n in totals.items() if c == r.campus and d < base and n)
        assert r.current == current and r.previous_date == (before[-1] if before else None)
        previous = totals[r.campus, before[-1]] if before else 0
        assert r.wow == (round((current - previous) / previous, 6) if previous else 0.0)
    for r in metrics.trailing_sums(hc, ["campus"]).collect():
        near = sum(n for (c, d), n in totals.items()
                   if c == r.campus and 0 <= (r.sunday_date - d).days < 35)
        assert r.trailing_35 == near
    for r in metrics.year_over_year_364(hc, ["campus"]).collect():
        assert r.prior_year == totals.get((r.campus, r.sunday_date - dt.timedelta(days=364)))


@QUICK
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40)), min_size=1, max_size=40))
def test_validity_covers_time_once(spark, changes):
    base = dt.date(2024, 1, 1)
    rows = [(k, i, base + dt.timedelta(days=d), f"s{i}") for i, (k, d) in enumerate(changes)]
    df = spark.createDataFrame(rows, "k int, id int, d date, stage string")
    closed = journey.validity(df, "k", "d", "id")
    assert closed.count() == len(rows)
    for day in range(0, 42, 7):
        on = base + dt.timedelta(days=day)
        valid = journey.as_of_versions(closed, on, "d", "expire_date")
        got = {r.k: r.stage for r in valid.collect()}
        assert valid.groupBy("k").count().where(F.col("count") > 1).isEmpty()
        want = {}
        for k, i, d, s in sorted(rows, key=lambda r: (r[2], r[1])):
            if d <= on:
                want[k] = s
        assert got == want
