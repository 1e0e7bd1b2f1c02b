"""Lookups, context joins, chained lookups and correlated expansion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import is_sunday


def lookup_value(df: DataFrame, table: DataFrame, on: Mapping[str, str], value: str,
                 out: str) -> DataFrame:
    """Left lookup of one value by key columns ({column of df: column of table}).

    Repeats of one value are fine; a key with several different values (a blank beside
    another is two) fails the job when one of its rows is looked up. The table is reduced to one row per key
    first, so the join never fans out.
    """
    keys = list(on.values())
    one = table.groupBy(*keys).agg(
        F.min(value).alias("_low"),
        (F.min(value).eqNullSafe(F.max(value))
         & F.count(F.col(value)).isin(F.lit(0), F.count(F.lit(1)))).alias("_single"))
    side = one.select(*[F.col(k).alias(c) for c, k in on.items()], "_low", "_single")
    checked = F.when(F.coalesce("_single", F.lit(True)), F.col("_low")).otherwise(
        F.raise_error(F.lit(f"several values of {value} for one key")))
    return df.join(side, list(on), "left").withColumn(out, checked).drop("_low", "_single")


def with_context(df: DataFrame, context: DataFrame, keys: Sequence[str],
                 columns: Sequence[str]) -> DataFrame:
    """Service context (weather, holidays, school breaks) by date and campus."""
    return df.join(context.select(*keys, *columns), list(keys), "left")


# Rows of one side that a cell of the grid gets, about: a cell makes at most the square.
CELL_ROWS = 1000


def many_to_many(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str,
                 cell_rows: int = CELL_ROWS) -> DataFrame:
    """Every pair of rows with the same `key`, however many rows one key has.

    The rows of a key are dealt by a hash of their id over a grid: the left side over its
    rows, the right side over its columns, as many as the key's count asks for. A left row is
    copied to every column and a right row to every row, so each pair meets in one cell, and
    a key with most of the rows is as many tasks as it has cells. A key of few rows has one
    cell and no copies. Rows without a key match nothing.
    """
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(key).agg(F.ceil(F.count("*") / cell_rows).cast("int").alias(name))

    grid = counted(left, "_rows").join(counted(right, "_columns"), key)

    def dealt(df: DataFrame, row_id: str, own: str, other: str, salt: str, copy: str) -> DataFrame:
        return (df.join(grid, key).withColumn(salt, F.pmod(F.xxhash64(row_id), F.col(own)))
                .withColumn(copy, F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                       F.col(other).cast("bigint") - 1)))
                .drop("_rows", "_columns"))

    a = dealt(left, left_id, "_rows", "_columns", "_r", "_c")
    b = dealt(right, right_id, "_columns", "_rows", "_c", "_r")
    return a.join(b, [key, "_r", "_c"]).drop("_r", "_c")


def event_group_hotels(events: DataFrame, event_groups: DataFrame, event_hotels: DataFrame,
                       groups: DataFrame, hotels: DataFrame) -> DataFrame:
    """Every group of an event with every hotel of that event: the result is that
    product, so its size is the report's, not an intermediate."""
    pairs = many_to_many(event_groups, event_hotels, "event_id", "group_id", "hotel_id").join(
        events.select(F.col("id").alias("event_id"), F.col("name").alias("event_name")),
        "event_id")
    return (pairs.join(groups.select(F.col("id").alias("group_id"),
                                     F.col("name").alias("group_name")), "group_id", "left")
            .join(hotels.select(F.col("id").alias("hotel_id"),
                                F.col("name").alias("hotel_name")), "hotel_id", "left"))


def order_hotels(orders: DataFrame, event_hotels: DataFrame, hotels: DataFrame,
                 events: DataFrame, event_groups: DataFrame, groups: DataFrame) -> DataFrame:
    """Hotel orders that are not deleted, each followed through its ids to the
    hotel, event and group names."""
    placed = orders.where((F.col("item_type") == "Hotel") & F.col("deleted_at").isNull())

    def named(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.select(F.col("id").alias(key), F.col("name").alias(name))

    return (placed.select(F.col("id").alias("order_id"), "orderable_id", "event_group_id")
            .join(event_hotels.select(F.col("id").alias("orderable_id"), "hotel_id", "event_id"),
                  "orderable_id", "left")
            .join(named(hotels, "hotel_id", "hotel_name"), "hotel_id", "left")
            .join(named(events, "event_id", "event_name"), "event_id", "left")
            .join(event_groups.select(F.col("id").alias("event_group_id"), "group_id"),
                  "event_group_id", "left")
            .join(named(groups, "group_id", "group_name"), "group_id", "left"))


def people_per_group(groups: DataFrame, members: DataFrame, group: str = "group_id",
                     person: str = "person_id") -> DataFrame:
    """Distinct members of each group. Distinct pairs come first, so the count per
    group is combined on the map side however large the group is."""
    counts = members.select(group, person).distinct().groupBy(group).agg(
        F.count(person).alias("member_count"))
    return groups.join(counts, group, "left")


def max_chain(df: DataFrame, *steps: tuple[DataFrame, str, str]) -> DataFrame:
    """Follow (table, key, value) steps, taking the largest value for each key."""
    out = df
    for table, key, value in steps:
        out = out.join(table.groupBy(key).agg(F.max(value).alias(value)), key, "left")
    return out


def sunday_only_groups(groups: DataFrame, check_ins: DataFrame, group: str = "group_id",
                       date: str = "occurrence_date") -> DataFrame:
    """1 for groups with a requested attendance and no check-in outside Sundays."""
    seen = check_ins.groupBy(group).agg(
        F.max(F.coalesce("requested", F.lit(False))).alias("_requested"),
        F.count_if(~is_sunday(date)).alias("_other_days"))
    ok = F.col("_requested") & (F.col("_other_days") == 0)
    return (groups.join(seen, group, "left")
            .withColumn("has_sunday_checkins", F.when(ok, 1).otherwise(0))
            .drop("_requested", "_other_days"))
