from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyhouse.streaming import ingest

SCHEMA = "id int, v string, changed timestamp, day date"


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def row(i, v, hour, day=1):
    return (i, v, dt.datetime(2024, 1, day, hour), dt.date(2024, 1, day))


def test_upsert_stream_is_incremental_and_replayable(spark, tmp_path):
    src, table = str(tmp_path / "src"), "streamed_edits"
    land(spark, src, [row(1, "a", 1), row(1, "b", 2), row(2, "x", 1)])
    schema = spark.read.parquet(src).schema

    def run(checkpoint):
        stream = ingest.landed_stream(spark, src, schema)
        ingest.upsert_stream(stream, table, "id", "changed", "day",
                             str(tmp_path / checkpoint)).awaitTermination()
        return sorted((r.id, r.v) for r in spark.table(table).collect())

    assert run("c1") == [(1, "b"), (2, "x")]
    land(spark, src, [row(2, "y", 5), row(3, "z", 4, day=2)])
    assert run("c1") == [(1, "b"), (2, "y"), (3, "z")]
    # A run from a lost checkpoint replays everything and changes nothing.
    assert run("c2") == [(1, "b"), (2, "y"), (3, "z")]


def test_upsert_stream_moves_rows_and_keeps_blank_days(spark, tmp_path):
    src, table = str(tmp_path / "src"), "streamed_moves"
    blank = dt.datetime(2024, 1, 1, 1)
    land(spark, src, [row(1, "a", 1), row(4, "only", 1, day=3), (2, "n", blank, None),
                      (3, "m", blank, None)])
    schema = spark.read.parquet(src).schema

    def run(checkpoint):
        stream = ingest.landed_stream(spark, src, schema)
        ingest.upsert_stream(stream, table, "id", "changed", "day",
                             str(tmp_path / checkpoint)).awaitTermination()
        return sorted((r.id, r.v, r.day.day if r.day else None)
                      for r in spark.table(table).collect())

    assert run("c1") == [(1, "a", 1), (2, "n", None), (3, "m", None), (4, "only", 3)]
    # Row 1 moves to day 2, row 4 leaves its day empty, row 2 is edited without a day; of two
    # versions with one time the greater wins whatever their order.
    land(spark, src, [row(1, "b", 5, day=2),
                      (4, "moved", dt.datetime(2024, 1, 4), dt.date(2024, 1, 2)),
                      (2, "x", dt.datetime(2024, 1, 1, 9), None),
                      (2, "z", dt.datetime(2024, 1, 1, 9), None)])
    after = [(1, "b", 2), (2, "z", None), (3, "m", None), (4, "moved", 2)]
    assert run("c1") == after
    assert run("c2") == after


def test_late_rows_are_repaired(spark, tmp_path):
    src = str(tmp_path / "src")
    land(spark, src, [row(2, "b", 1, day=4)])
    schema = spark.read.parquet(src).schema
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for rows in ([], [row(9, "late", 1), row(2, "b", 1, day=4)]):
        if rows:
            land(spark, src, rows)
        stream = ingest.landed_stream(spark, src, schema, files_per_trigger=1)
        (ingest.within_lookback(stream, "id", "changed").writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", check)
         .trigger(availableNow=True).start()).awaitTermination()
    landed = spark.read.schema(schema).parquet(src)
    stored = spark.read.schema(schema).parquet(out)
    assert [r.id for r in stored.collect()] == [2]
    assert sorted(r.id for r in ingest.with_late(stored, landed, "id", "changed").collect()
                  ) == [2, 9]


def test_dedupe_query_does_not_depend_on_batches(spark, sf_dir):
    from tallyhouse.plans.stream import stream_dedupe

    one, eight = (sorted(map(tuple, stream_dedupe(spark, sf_dir, n).collect())) for n in (1, 8))
    assert one == eight


def test_dedupe_within_lookback_and_late_rows(spark, tmp_path):
    src = str(tmp_path / "src")
    land(spark, src, [row(1, "a", 1), row(1, "a", 1), row(2, "b", 1, day=4)])
    schema = spark.read.parquet(src).schema
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        stream = ingest.landed_stream(spark, src, schema)
        query = (ingest.within_lookback(stream, "id", "changed").writeStream.format("parquet")
                 .option("path", out).option("checkpointLocation", check)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        return sorted(r.id for r in spark.read.schema(schema).parquet(out).collect())

    assert run() == [1, 2]
    # More than 26 hours behind the newest change: outside the look-back, dropped.
    land(spark, src, [row(9, "late", 1), row(2, "b", 1, day=4)])
    assert run() == [1, 2]


def test_weekly_counts_as_a_stream(spark, tmp_path):
    src = str(tmp_path / "src")
    # Monday 1 January to Sunday 7 January is one week; Monday 8 starts the next.
    land(spark, src, [row(1, "a", 1), row(2, "a", 23, day=7), row(3, "a", 0, day=8)])
    schema = spark.read.parquet(src).schema
    counted = ingest.weekly_counts(ingest.landed_stream(spark, src, schema), "changed", ["v"])
    query = (counted.writeStream.format("memory").queryName("weekly").outputMode("complete")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    got = sorted((r.sunday_date, r.cnt) for r in spark.table("weekly").collect())
    assert got == [(dt.date(2024, 1, 7), 2), (dt.date(2024, 1, 14), 1)]
    batch = ingest.weekly_counts(spark.read.parquet(src), "changed", ["v"])
    assert sorted((r.sunday_date, r.cnt) for r in batch.collect()) == got
    assert batch.where(F.col("cnt") > 0).count() == 2


def test_weekly_stream_closes_weeks_and_counts_late_rows(spark, tmp_path):
    src, weeks, check = (str(tmp_path / x) for x in ("src", "weeks", "check"))

    def run(rows):
        land(spark, src, rows)
        stream = ingest.landed_stream(spark, src, spark.read.parquet(src).schema)
        ingest.weekly_stream(stream, "changed", ["v"], weeks, check).awaitTermination()
        closed = spark.read.schema("sunday_date date, v string, cnt long").parquet(weeks)
        table = ingest.weekly_table(closed, spark.read.parquet(src), "changed", ["v"])
        return (sorted((r.sunday_date.day, r.cnt) for r in closed.collect()),
                sorted((r.sunday_date.day, r.v or "", r.cnt, r.late) for r in table.collect()))

    # Nothing is closed: the watermark is 26 hours behind.
    assert run([row(1, "a", 1), row(2, "a", 23, day=7), row(3, None, 2)]) == (
        [], [(7, "", 1, None), (7, "a", 2, None)])
    # The week to the 7th closes; the state of the first run is still there.
    assert run([row(4, "a", 5, day=9)]) == (
        [(7, 1), (7, 2)], [(7, "", 1, 0), (7, "a", 2, 0), (14, "a", 1, None)])
    # One late row of a known group and one of a group that the week did not have.
    assert run([row(5, "a", 5, day=3), row(6, "z", 5, day=3), row(7, "a", 5, day=10)]) == (
        [(7, 1), (7, 2)],
        [(7, "", 1, 0), (7, "a", 3, 1), (7, "z", 1, 1), (14, "a", 2, None)])
