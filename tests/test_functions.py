from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import columns as C
from tallyhouse.functions import dates as D
from tallyhouse.functions import ordering as O

D_ = dt.date


def one(spark, **cols):
    return tuple(spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first())


def test_surrogate_key_keeps_null(spark):
    df = spark.createDataFrame([(1,), (None,)], "id bigint")
    keys = [r[0] for r in df.select(C.surrogate_key("id")).collect()]
    assert keys[0] is not None and keys[1] is None


def test_safe_division(spark):
    lit = F.lit
    assert one(spark, a=C.safe_divide(lit(4), lit(2)), b=C.safe_divide(lit(4), lit(0)),
               c=C.safe_divide(lit(4), lit(None), 0), d=C.change_ratio(lit(3), lit(2)),
               e=C.change_ratio(lit(3), lit(None).cast("int"), 0)) == (2.0, None, 0.0, 0.5, 0.0)


def test_rounding_away_and_towards_zero(spark):
    vals = [C.round_up(F.lit(v)) for v in (1.2, -1.2)] + [C.round_down(F.lit(v))
                                                          for v in (1.8, -1.8)]
    assert one(spark, **{f"v{i}": v for i, v in enumerate(vals)}) == (2, -2, 1, -1)


def test_formats(spark):
    assert one(spark, a=C.percent_text(F.lit(0.125)), b=C.signed_percent_text(F.lit(-0.0234)),
               c=C.signed_percent_text(F.lit(0.0)), d=C.thousands_text(F.lit(1234567.5)),
               e=C.trend_arrow(F.lit(0)), f=C.trend_arrow(F.lit(None).cast("int"))) == (
        "13%", "-2.3%", "0.0%", "1,234,568", C.UP, None)


def test_text_splits(spark):
    t = F.lit("Grace  - A Name - x")
    assert one(spark, a=C.split_before(t, " - "), b=C.split_after(t, " - "),
               c=C.split_before(F.lit("none"), " - "), d=C.split_after(F.lit("none"), " - "),
               e=C.blank_concat(F.lit(None), F.lit(", "), F.lit("GA")),
               f=C.single_spaced(F.lit("  a   b ")), g=C.strip(F.lit("\t a  b \n"))) == (
        "Grace ", "A Name - x", None, None, ", GA", "a b", "a  b")


def test_iso_timestamps(spark):
    texts = ["2026-01-04T15:30:00Z", "2026-01-04T15:30:00+0000", "2026-01-04T10:30:00-05:00",
             "not a time", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(F.date_format(C.iso_timestamp("t"), "HH:mm")).collect()]
    assert got == ["15:30", "15:30", "15:30", None, None]


def test_null_safe_predicates(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert [r[0] for r in df.where(C.not_in("x", ["a"])).collect()] == ["b", None]
    assert [r[0] for r in df.where(C.differs("x", "a")).collect()] == ["b", None]


@pytest.mark.parametrize("birth,as_of,age", [
    (D_(2000, 6, 4), D_(2024, 6, 4), 24), (D_(2000, 6, 5), D_(2024, 6, 4), 23),
    (D_(2000, 2, 29), D_(2023, 2, 28), 22), (D_(2000, 2, 29), D_(2023, 3, 1), 23)])
def test_age(spark, birth, as_of, age):
    assert one(spark, a=D.age_years(F.lit(birth), as_of)) == (age,)


def test_feb_29_rolls_to_march(spark):
    assert one(spark, a=D.year_before(F.lit(D_(2024, 2, 29)))) == (D_(2023, 3, 1),)


def test_snap_goes_to_its_week_for_every_weekday(spark):
    # Last year's dates: Monday to Thursday snap to Monday, the rest to Sunday.
    for k in range(7):
        day = D_(2024, 6, 3) + dt.timedelta(days=k)
        prior = D_(2023, day.month, day.day)
        shift = {0: 0, 1: -1, 2: -2, 3: -3, 4: 2, 5: 1, 6: 0}[prior.weekday()]
        assert one(spark, a=D.snapped_year_before(F.lit(day))) == (
            prior + dt.timedelta(days=shift),)


def test_last_sunday_for_every_weekday(spark):
    for k in range(7):
        day = D_(2024, 1, 28) + dt.timedelta(days=k)
        assert one(spark, a=D.last_sunday(F.lit(day)),
                   b=D.week_ending_sunday(F.lit(day))) == (
            D_(2024, 1, 28), D_(2024, 1, 28) if k == 0 else D_(2024, 2, 4))


def test_us_weeks(spark):
    for day in (D_(2023, 1, 1), D_(2022, 1, 1), D_(2022, 1, 2), D_(2024, 12, 31)):
        jan1 = D_(day.year, 1, 1)
        want = (day.timetuple().tm_yday + (jan1.isoweekday() % 7) - 1) // 7 + 1
        assert one(spark, a=D.us_week_number(F.lit(day))) == (want,)


def gauss_easter(y):
    """Gauss's rule, as an independent check."""
    a, b, c = y % 19, y % 4, y % 7
    k = y // 100
    p, q = (13 + 8 * k) // 25, k // 4
    m, n = (15 - p + k - q) % 30, (4 + k - q) % 7
    d = (19 * a + m) % 30
    e = (2 * b + 4 * c + 6 * d + n) % 7
    if d == 29 and e == 6:
        return D_(y, 4, 19)
    if d == 28 and e == 6 and (11 * m + 11) % 30 < 19:
        return D_(y, 4, 18)
    return D_(y, 3, 22) + dt.timedelta(days=d + e)


def test_easter(spark):
    got = {r.id: r.e for r in spark.range(1900, 2100).select(
        "id", D.easter("id").alias("e")).collect()}
    assert got == {y: gauss_easter(y) for y in range(1900, 2100)}


def test_holiday_status(spark):
    christmas = F.lit(D_(2025, 12, 24))
    got = [one(spark, s=D.holiday_status(F.lit(data), day, christmas))[0] for data, day in [
        (True, D_(2025, 1, 1)), (False, D_(2025, 12, 23)), (False, D_(2025, 12, 24)),
        (False, D_(2026, 1, 7)), (False, D_(2026, 1, 8))]]
    assert got == ["Show", "Upcoming", "Processing", "Processing", "Show"]


def add_months(day, k):
    total = day.year * 12 + day.month - 1 + k
    y, m = divmod(total, 12)
    last = (D_(y + (m == 11), (m + 1) % 12 + 1, 1) - dt.timedelta(days=1)).day
    return D_(y, m + 1, min(day.day, last))


def brute_meetings(start, rhythm, as_of):
    if start is None:
        return 0
    step = {"weekly": 7, "every other week": 14}.get(rhythm)
    dates = ([start] if rhythm == "once" else
             [start + dt.timedelta(days=step * k) for k in range(200)] if step else
             [add_months(start, k) for k in range(60)] if rhythm == "monthly" else [])
    low = as_of - dt.timedelta(days=35)
    return sum(low <= d <= as_of for d in dates)


def test_meetings_match_expansion(spark):
    rnd = random.Random(3)
    rows = [(D_(2023, 1, 1) + dt.timedelta(days=rnd.randrange(600)), r)
            for r in ("once", "weekly", "every other week", "monthly", "other") for _ in range(60)]
    rows += [(D_(2024, 1, 31), "monthly"), (D_(2024, 8, 1), "weekly"), (None, "weekly")]
    df = spark.createDataFrame(rows, "start date, rhythm string")
    for as_of in (D_(2024, 3, 31), D_(2024, 6, 4)):
        got = df.select("start", "rhythm", D.meetings_in_period(
            "start", "rhythm", as_of).alias("n")).collect()
        for r in got:
            assert r.n == brute_meetings(r.start, r.rhythm, as_of), (r, as_of)


# --- ordered operators under a hot key ----------------------------------------------------

def hot_rows(n=600, seed=5):
    """Versions where one key holds most rows, with ties on the date."""
    rnd = random.Random(seed)
    return [(1 if rnd.random() < 0.6 else rnd.randrange(2, 20), i,
             D_(2020, 1, 1) + dt.timedelta(days=rnd.randrange(400)), f"v{i}") for i in range(n)]


def test_latest_first_and_top(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k int, id int, d date, v string").repartition(7)
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    newest = {k: max(v, key=lambda r: (r[2], r[1])) for k, v in by_key.items()}
    oldest = {k: min(v, key=lambda r: (r[2], r[1])) for k, v in by_key.items()}
    assert {r.k: tuple(r) for r in O.latest_per_key(df, ["k"], ["d", "id"]).collect()} == newest
    assert {r.k: tuple(r) for r in O.first_per_key(df, ["k"], ["d", "id"]).collect()} == oldest
    top = O.top_per_key(df, ["k"], [F.desc("d"), F.desc("id")], 3).collect()
    want = {tuple(r) for v in by_key.values()
            for r in sorted(v, key=lambda r: (r[2], r[1]), reverse=True)[:3]}
    assert {tuple(r)[:4] for r in top} == want


@pytest.mark.parametrize("spread", ["even", "clustered"])
def test_row_index(spark, spread):
    rnd = random.Random(1)
    keys = (rnd.sample(range(10**6), 3000) if spread == "even" else
            [*range(2000), *(10**15 + i for i in range(50)), -10**12])
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(9)
    got = {r.k: r.row_index for r in O.with_row_index(df, "k", splits=8).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys), start=1)}
    assert O.with_row_index(df.where("k is null"), "k").count() == 0
