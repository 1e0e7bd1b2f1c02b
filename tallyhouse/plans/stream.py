"""Queries over the streaming re-aims."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..config import shared_folder
from ..streaming import ingest
from . import inputs as I
from .registry import query


def _land(spark, sf_dir, folder):
    """Events landed as several files, as many as the scan has partitions and eight at least,
    with a repeated slice in the last ones."""
    events = I.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"),
        F.to_date("ts").alias("day"))
    _write(events.unionByName(events.where("event_type = 'signup'")), folder, events)
    return events.schema


def _write(rows, folder, source):
    files = max(8, source.select(F.spark_partition_id()).distinct().count())
    rows.repartitionByRange(files, "ts").write.mode("append").parquet(folder)


# Signups are edited a day later, which moves them; errors have no day, and of their two
# versions with one time the greater type wins.
_EDITS = {"event_id": "event_id", "user_id": "user_id",
          "event_type": "CASE event_type WHEN 'error' THEN 'fixed' ELSE event_type END",
          "value": "value",
          "ts": "CASE event_type WHEN 'error' THEN ts ELSE ts + INTERVAL '1' DAY END",
          "day": "CASE event_type WHEN 'error' THEN NULL ELSE CAST(ts + INTERVAL '1' DAY AS DATE) "
                 "END"}


@query("stream_upsert", """
    SELECT CASE event_type WHEN 'error' THEN NULL WHEN 'signup'
                THEN CAST(ts + INTERVAL 1 DAY AS DATE) ELSE CAST(ts AS DATE) END AS day,
           CASE event_type WHEN 'error' THEN 'fixed' ELSE event_type END AS event_type,
           count(*) AS events, CAST(count(DISTINCT event_id) AS BIGINT) AS keys
    FROM events GROUP BY 1, 2""")
def stream_upsert(spark, sf_dir):
    """Landed files, then edits that move a row to another day, rows without a day and
    versions of one time, upserted as a stream; then summarised."""
    folder, name = shared_folder(spark, "stream-upsert"), f"streamed_{os.urandom(4).hex()}"
    schema = _land(spark, sf_dir, f"{folder}/landed")

    def run():
        stream = ingest.landed_stream(spark, f"{folder}/landed", schema, files_per_trigger=4)
        ingest.upsert_stream(stream, name, "event_id", "ts", "day",
                             f"{folder}/checkpoint").awaitTermination()

    run()
    edits = I.mapped(I.table(spark, sf_dir, "events").where(
        "event_type IN ('signup', 'error')"), _EDITS)
    edits.select(*[F.col(f.name).cast(f.dataType) for f in schema]).write.mode("append").parquet(
        f"{folder}/landed")
    run()
    return (spark.table(name).groupBy("day", "event_type")
            .agg(F.count("*").alias("events"), F.count_distinct("event_id").alias("keys")))


@query("stream_dedupe", """
    SELECT CAST(ts AS DATE) AS day, count(*) AS events FROM events GROUP BY 1""")
def stream_dedupe(spark, sf_dir, files_per_trigger=4):
    """Landed files, some rows twice, through the look-back de-duplication; rows that came
    late are added by a merge."""
    folder = shared_folder(spark, "stream-dedupe")
    schema = _land(spark, sf_dir, f"{folder}/landed")
    stream = ingest.landed_stream(spark, f"{folder}/landed", schema, files_per_trigger)
    done = (ingest.within_lookback(stream, "event_id", "ts").writeStream.format("parquet")
            .option("path", f"{folder}/table").option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True).start())
    done.awaitTermination()
    whole = ingest.with_late(spark.read.schema(schema).parquet(f"{folder}/table"),
                             spark.read.schema(schema).parquet(f"{folder}/landed"),
                             "event_id", "ts")
    return whole.groupBy("day").agg(F.count("*").alias("events"))


@query("weekly_audience_windows", """
    SELECT CAST(date_trunc('week', ts) AS DATE) + 6 AS sunday_date, event_type,
           count(*) AS cnt FROM events GROUP BY 1, 2""")
def weekly_audience_windows(spark, sf_dir):
    """Windowed state over landed files in two runs. Signups of the first days land only
    before the second run, when their week is closed: they are late, and counted."""
    folder = shared_folder(spark, "stream-weekly")
    events = I.table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    held_back = "event_type = 'signup' AND ts < TIMESTAMP '2024-01-10 00:00:00'"
    for rows in (events.where(f"NOT coalesce({held_back}, false)"), events.where(held_back)):
        _write(rows, f"{folder}/landed", events)
        stream = ingest.landed_stream(spark, f"{folder}/landed", events.schema)
        ingest.weekly_stream(stream, "ts", ["event_type"], f"{folder}/weeks",
                             f"{folder}/checkpoint").awaitTermination()
    weeks = spark.read.schema("sunday_date date, event_type string, cnt long").parquet(
        f"{folder}/weeks")
    landed = spark.read.schema(events.schema).parquet(f"{folder}/landed")
    return ingest.weekly_table(weeks, landed, "ts", ["event_type"]).drop("late")
