"""Polling re-aimed as streams over landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import LOOKBACK_HOURS
from ..functions.ordering import latest_per_key
from ..sources import versions
from ..sources.tables import missing_only


def landed_stream(spark: SparkSession, folder: str, schema: T.StructType,
                  files_per_trigger: int = 100) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(folder))


def within_lookback(stream: DataFrame, key: str, modified: str,
                    hours: int = LOOKBACK_HOURS) -> DataFrame:
    """Drop repeats of a record inside the look-back; the watermark bounds the state. An
    edit has a new modification time, so it is not a repeat and passes. Rows further
    behind than the look-back are late and dropped: use it where that is wanted."""
    return (stream.withWatermark(modified, f"{hours} hours")
            .dropDuplicatesWithinWatermark([key, modified]))


def upsert_stream(stream: DataFrame, name: str, key: str, modified: str, partition: str,
                  checkpoint: str) -> StreamingQuery:
    """Merge each micro-batch into the versioned table `name`, then stop when the landed
    files are used up. A batch keeps the newest row per key (of equal times the one with the
    greatest other columns); all its partitions appear at once, and merging it again changes
    nothing, so a batch replayed after a failure is harmless. An edit may change the
    partition value: the row moves."""
    def merge(batch: DataFrame, _: int) -> None:
        newest = latest_per_key(batch, [key], [modified]).persist()  # read several times
        if versions.manifest(batch.sparkSession, name) is None:
            versions.replace(newest, name, [key], partition)
        else:
            versions.upsert(newest, name)
        newest.unpersist()

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def with_late(stored: DataFrame, landed: DataFrame, key: str, modified: str) -> DataFrame:
    """The stream's output with the landed rows that the look-back dropped as late: each
    (key, time) that the output lacks, once. The answer then no longer depends on how
    files were batched."""
    return stored.unionByName(missing_only(
        landed.dropDuplicates([key, modified]), stored, [key, modified]))


# Windows are aligned to the epoch, a Thursday: four days later is a Monday.
MONDAY_OFFSET = "4 days"


def weekly_counts(stream: DataFrame, ts: str, by: list[str],
                  late: str = f"{LOOKBACK_HOURS} hours") -> DataFrame:
    """Counts per Monday-to-Sunday week, labelled with the week's Sunday."""
    week = F.window(ts, "7 days", startTime=MONDAY_OFFSET)
    rows = stream.withWatermark(ts, late) if stream.isStreaming else stream
    return (rows.groupBy(week.alias("week"), *by).agg(F.count("*").alias("cnt"))
            .select(F.date_sub(F.to_date("week.end"), 1).alias("sunday_date"), *by, "cnt"))


def weekly_stream(stream: DataFrame, ts: str, by: list[str], folder: str, checkpoint: str,
                  late: str = f"{LOOKBACK_HOURS} hours") -> StreamingQuery:
    """Append the counts of a week to `folder` once, when the watermark has passed its end,
    then stop when the landed files are used up. Open weeks stay in the state, which the
    checkpoint keeps for the next run; rows of a week that is closed are late and dropped
    (`weekly_table` counts them)."""
    return (weekly_counts(stream, ts, by, late).writeStream.format("parquet").outputMode("append")
            .option("path", folder).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def weekly_table(closed: DataFrame, landed: DataFrame, ts: str, by: list[str]) -> DataFrame:
    """All weeks: (sunday_date, by, cnt, late). `late` is how many rows came after the week was
    closed, null while it is open. A week is closed if it is not after the last one of the
    stream's output, so a week whose rows all came late is closed too.

    To correct only some weeks, restrict both inputs to them: a range on `ts` reaches the
    scan of the landed files."""
    emitted = closed.select("sunday_date", *by, F.col("cnt").alias("_emitted"))
    last = closed.agg(F.max("sunday_date").alias("last")).scalar()
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"e.{c}")) for c in ("sunday_date", *by)]
    found = weekly_counts(landed, ts, by).alias("w").join(emitted.alias("e"), same, "left")
    return found.select(
        "w.sunday_date", *[f"w.{c}" for c in by], "w.cnt",
        F.when(F.col("w.sunday_date") <= last,
               F.col("w.cnt") - F.coalesce("e._emitted", F.lit(0))).alias("late"))
