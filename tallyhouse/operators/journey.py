"""Families: check-in map, gift dates, and giving stages as of a date."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_col, decode, in_box
from ..functions.dates import as_date

# Best stage first, and the map code of each stage.
STAGE_RANK = {"Consistent Giver": 1, "New Giver": 2, "Occasional Giver": 3, "Lapsed Giver": 4,
              "Former Giver": 5, "Non-Giver": 6}
STAGE_CODE = {"New Giver": 1, "Consistent Giver": 2, "Occasional Giver": 3, "Lapsed Giver": 4,
              "Former Giver": 5, "Non-Giver": 0}
# Campuses, their codes, and the map's box (south, north, west, east).
MAP_CAMPUS_CODES = {2: "5", 3: "C", 13: "T"}
MAP_BOX = (33.3, 34.5, -85.2, -83.8)
OPEN_END = "9999-01-01"


def validity(history: DataFrame, key: str, effective: str, tie: str) -> DataFrame:
    """Close each version on the day of the key's next one (open versions end in 9999).
    Of versions that start on one day the last by `tie` holds; the others are empty. A
    version without a key or a start keeps its row, with no end.

    The next day is looked up in one row per (key, day), which is at most a calendar
    of rows per key, and joined back. The versions themselves are never gathered or
    sorted by key, so a key with very many versions is no larger a task than others.
    """
    days = history.groupBy(key, effective).agg(F.max(tie).alias("_last")).withColumn(
        "_next", F.lead(effective).over(Window.partitionBy(key).orderBy(effective)))
    until = F.coalesce("_next", F.lit(OPEN_END).cast("date"))
    return (history.join(days, [key, effective], "left")
            .withColumn("expire_date", F.when(F.col(tie) == F.col("_last"), until)
                        .when(F.col("_last").isNotNull(), F.col(effective)))
            .drop("_last", "_next"))


def as_of_versions(history: DataFrame, as_of, effective: str = "effective_date",
                   expire: str = "expire_date") -> DataFrame:
    """Versions valid on a date: effective <= date < expire."""
    on = as_date(as_of)
    return history.where((F.col(effective) <= on) & (F.col(expire) > on))


def as_of_join(facts: DataFrame, history: DataFrame, key: str, date: str, tie: str,
               effective: str = "effective_date", expire: str = "expire_date") -> DataFrame:
    """Each fact with the version valid on its own date (null columns if none).

    Versions of a key must not overlap. Days are what is matched: the last version
    started on each (key, day) and the days asked about are laid on one timeline per
    key, at most a calendar of rows, and every asked day takes the version before it.
    Facts then join that table on (key, day), an equi-join with one row per day, so
    neither facts x versions of a key nor a key's facts ever meet in one task.
    """
    extra = [c for c in history.columns if c not in (key, tie)]
    started = history.groupBy(key, F.col(effective).alias("_day")).agg(
        F.max_by(F.struct(*extra), tie).alias("_version")).withColumn("_asked", F.lit(False))
    asked = facts.select(key, F.col(date).alias("_day")).distinct().withColumns({
        "_version": F.lit(None).cast(started.schema["_version"].dataType),
        "_asked": F.lit(True)})
    before = Window.partitionBy(key).orderBy("_day", "_asked").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    days = (started.unionByName(asked)
            .withColumn("_version", F.last("_version", ignorenulls=True).over(before))
            .where("_asked").select(key, F.col("_day").alias(date), "_version"))
    valid = F.col(f"_version.{expire}") > F.col(date)
    return facts.join(days, [key, date], "left").select(
        *facts.columns, *[F.when(valid, F.col(f"_version.{c}")).alias(c) for c in extra])


def best_stage(members: DataFrame, by: Sequence[str], stage: str,
               ranks: Mapping[str, int] = STAGE_RANK,
               codes: Mapping[str, int] = STAGE_CODE) -> DataFrame:
    """The code of the best-ranked stage per group (the lowest code among equals)."""
    rank, code = decode(stage, ranks, 7), decode(stage, codes, 0)
    best = F.min(F.struct(rank.alias("rank"), code.alias("code")))
    return (members.groupBy(*by).agg(best.alias("b"))
            .select(*by, F.col("b.rank").alias("stage_rank"),
                    F.col("b.code").alias("giving_code")))


def family_stage(people: DataFrame, history: DataFrame, as_of, **maps) -> DataFrame:
    """Giving code per family on a date; 0 for a family without a valid version."""
    valid = as_of_versions(history, as_of).select("person_id", "stage")
    held = best_stage(people.join(valid, "person_id").select("family_id", "stage"),
                      ["family_id"], "stage", **maps)
    families = people.select("family_id").where("family_id IS NOT NULL").distinct()
    return (families.join(held, "family_id", "left")
            .withColumn("giving_code", F.coalesce("giving_code", F.lit(0))))


def gift_dates(signals: DataFrame) -> DataFrame:
    """Last and previous gift date per family."""
    return signals.groupBy("family_id").agg(F.max("last_gift_date").alias("last_gift_date"),
                                            F.max("prev_gift_date").alias("prev_gift_date"))


def ministry_code(type_name, names: Mapping[str, Sequence[str]]) -> Column:
    """A code by lists of type names; null when no list holds the name."""
    c = as_col(type_name)
    out = F.lit(None).cast("string")
    for code, listed in reversed(list(names.items())):
        out = F.when(c.isin(list(listed)), code).otherwise(out)
    return out


def map_check_ins(check_ins: DataFrame, people: DataFrame,
                  ministries: Mapping[str, Sequence[str]],
                  campus_codes: Mapping[int, str] = MAP_CAMPUS_CODES,
                  box: Sequence[float] = MAP_BOX) -> DataFrame:
    """Attended check-ins of mapped campuses and ministries with usable coordinates, as
    counts `n` per person, Sunday and codes. Counted before the join, so a person with
    very many check-ins is a few rows by then."""
    code = ministry_code("type_name", ministries)
    wanted = (check_ins.where(F.col("did_attend") & F.col("sunday_date").isNotNull()
                              & F.col("campus_id").isin(list(campus_codes)))
              .withColumn("min_code", code).where("min_code IS NOT NULL")
              .groupBy("person_id", "sunday_date",
                       decode("campus_id", campus_codes, "U").alias("campus_code"), "min_code")
              .agg(F.count("*").alias("n")))
    located = (people.where(in_box("lat", "lng", *box) & F.col("family_id").isNotNull())
               .select("person_id", "family_id", "lat", "lng"))
    return wanted.join(located, "person_id")


def distinct_codes(column: str) -> Column:
    """Aggregate: the group's distinct codes joined in sorted order. Codes are a
    fixed short list, so the set stays small."""
    return F.array_join(F.sort_array(F.collect_set(column)), "")


def family_week(mapped: DataFrame, gifts: DataFrame) -> DataFrame:
    """One row per family and Sunday: campuses, ministries, headcount, gift dates."""
    rolled = (mapped.groupBy("sunday_date", "family_id", "lat", "lng")
              .agg(distinct_codes("campus_code").alias("campus_list"),
                   distinct_codes("min_code").alias("min_list"),
                   F.sum("n").alias("headcount")))
    return rolled.join(gifts, "family_id", "left")


def map_rows(families: DataFrame, stages: DataFrame, as_of) -> DataFrame:
    """Map rows of one Sunday with each family's giving code."""
    on = as_date(as_of)
    return (families.where(F.col("sunday_date") == on).join(stages, "family_id", "left")
            .withColumn("giving_code", F.coalesce("giving_code", F.lit(0))))
