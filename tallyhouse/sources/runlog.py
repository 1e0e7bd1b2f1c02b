"""The log of runs, and loads that go on from its newest entry.

An entry (view, the time a run loaded up to) is appended only after the rows it speaks of
have been published. A run that dies between the two leaves no entry, so the next run starts
from the older mark and reads those rows again; they are merged on the primary key, so
nothing is lost and nothing is doubled.
"""

from __future__ import annotations

import dataclasses
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TableConfig
from ..functions.dates import as_timestamp
from . import bronze
from .tables import load_table

SCHEMA = "view_name string, last_generated_time timestamp, run_id string"


def entries(spark: SparkSession, log: str) -> DataFrame:
    """The log, empty before its first entry."""
    if spark.catalog.tableExists(log):
        return spark.table(log)
    return spark.createDataFrame([], SCHEMA)


def append(spark: SparkSession, log: str, view: str, as_of) -> None:
    """One entry, in a file of its own: writers do not disturb each other."""
    (spark.range(1).coalesce(1).select(
        F.lit(view).alias("view_name"), as_timestamp(as_of).alias("last_generated_time"),
        F.lit(os.urandom(8).hex()).alias("run_id"))
     .write.format("parquet").mode("append").saveAsTable(log))


def publish_since_mark(spark: SparkSession, source: DataFrame, config: TableConfig, log: str,
                       view: str, as_of, database: str | None = None,
                       by_month: bool = False) -> bool:
    """Load what changed between the view's newest entry and as_of, both included; without
    an entry everything up to as_of, rows without a modification time among it, as a full
    load. False if there was nothing. It writes no entry: `load_since_mark` does."""
    changed_at = F.col(config.modified_column)
    known = entries(spark, log).where(F.col("view_name") == view)
    first = known.isEmpty()
    rows = (source.where(changed_at.isNull() | (changed_at <= as_timestamp(as_of))) if first
            else source.where(changed_at.between(
                bronze.high_water_mark(known, view), as_timestamp(as_of))))
    # The rows are chosen here, so the load applies no look-back of its own.
    return load_table(spark, rows, dataclasses.replace(config, modified_column=None), as_of,
                      "full" if first else "incremental", database, by_month=by_month)


def load_since_mark(spark: SparkSession, source: DataFrame, config: TableConfig, log: str,
                    view: str, as_of, database: str | None = None,
                    by_month: bool = False) -> bool:
    """Publish what changed since the view's newest entry, then append the entry. A full load
    of no rows publishes nothing, so it leaves no entry; an incremental one does."""
    first = entries(spark, log).where(F.col("view_name") == view).isEmpty()
    loaded = publish_since_mark(spark, source, config, log, view, as_of, database, by_month)
    if loaded or not first:
        append(spark, log, view, as_of)
    return loaded
