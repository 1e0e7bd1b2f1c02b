"""Loads by the log of runs, and runs that die."""

from __future__ import annotations

import pytest

from tallyhouse.config import TableConfig
from tallyhouse.sources import runlog, tables

ROWS = [(1, "a", "2024-01-01 00:00:00"), (2, "b", "2024-01-02 00:00:00"), (3, "n", None),
        (4, "later", "2024-01-09 00:00:00")]


@pytest.mark.parametrize("by_month", [False, True])
def test_a_run_that_dies_before_its_entry_is_repeated(spark, monkeypatch, by_month):
    def source(rows):
        return spark.createDataFrame(rows, "id int, v string, at string").selectExpr(
            "id", "v", "cast(at AS timestamp) AS at", "timestamp '2024-01-01' AS made")

    def seen():
        return sorted((r.id, r.v) for r in spark.table(config.target).collect())

    log = f"run_log_{by_month}".lower()
    config = TableConfig("t", f"logged_{by_month}".lower(), "id", "at", ("id", "v", "made"), (),
                         "made" if by_month else None)

    def load(rows, as_of):
        return runlog.load_since_mark(spark, source(rows), config, log, "v", as_of,
                                      by_month=by_month)

    assert runlog.entries(spark, log).count() == 0
    assert not load([], "2023-12-01 00:00:00")  # nothing published, so no entry
    assert runlog.entries(spark, log).count() == 0
    assert load(ROWS, "2024-01-02 00:00:00")
    assert seen() == [(1, "a"), (2, "b"), (3, "n")]

    changed = ROWS[:1] + [(2, "B", "2024-01-05 00:00:00")] + ROWS[2:]
    with monkeypatch.context() as died:
        died.setattr(runlog, "append", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(changed, "2024-01-06 00:00:00")
    assert seen() == [(1, "a"), (2, "B"), (3, "n")]
    assert runlog.entries(spark, log).count() == 1
    with monkeypatch.context() as died:  # dies before it publishes
        died.setattr(runlog, "load_table", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(changed, "2024-01-07 00:00:00")
    # Far beyond any look-back: everything since the first run's mark is read again.
    assert load(changed, "2024-02-01 00:00:00")
    assert seen() == [(1, "a"), (2, "B"), (3, "n"), (4, "later")]
    assert not load(changed, "2024-02-02 00:00:00")  # nothing new; the mark moves on
    assert runlog.entries(spark, log).count() == 3
    assert tables.MONTH in spark.table(config.target).columns if by_month else True
