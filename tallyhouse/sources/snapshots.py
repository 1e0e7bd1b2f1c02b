"""Weekly audience snapshots: JSON payloads unpacked and merged into their tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.dates import as_timestamp
from .bronze import json_rows
from .tables import merge_insert_only, merge_upsert

# The payload fields of both platforms.
PLATFORM_A = {"video_id": "string", "title": "string", "published_at": "string",
              "views": "bigint", "total_views": "bigint", "views_source": "string",
              "was_live": "boolean"}
PLATFORM_B = {"video_id": "string", "live_video_id": "string", "title": "string",
              "gathering": "string", "sunday_date": "date", "one_minute_views": "bigint",
              "broadcast_start_time": "timestamp", "planned_start_time": "timestamp",
              "creation_time": "timestamp", "status": "string"}


def unpack_a(payloads: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Platform A rows; a value of the wrong type fails the job."""
    return json_rows(payloads, column, PLATFORM_A, keep=keep)


def unpack_b(payloads: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Platform B rows; a value of the wrong type becomes null."""
    return json_rows(payloads, column, PLATFORM_B, safe=True, keep=keep)


def merge_titles(titles: DataFrame, rows: DataFrame) -> DataFrame:
    return merge_upsert(titles, rows.select("video_id", "title", "published_at"), ["video_id"])


def merge_snapshot(snapshot: DataFrame, rows: DataFrame, as_of) -> DataFrame:
    """Upsert by video; every written row carries the time of this run."""
    return merge_upsert(snapshot, rows.withColumn("snapshot_taken_at", as_timestamp(as_of)),
                        ["video_id"])


def insert_missing(stored: DataFrame, rows: DataFrame, as_of) -> DataFrame:
    """Add gatherings not stored yet for their Sunday; stored ones never change."""
    return merge_insert_only(stored, rows.withColumn("snapshot_taken_at", as_timestamp(as_of)),
                             ["sunday_date", "gathering"])

