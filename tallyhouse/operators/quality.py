"""Data-quality checks. Each returns (check_name, failures, severity) rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_timestamp

# Freshness thresholds in hours.
WARN_HOURS, ERROR_HOURS = 30, 48


def _result(failures: DataFrame, name: str, severity: str) -> DataFrame:
    """`failures` is one row with the count column `n`."""
    return failures.select(F.lit(name).alias("check_name"),
                           F.coalesce("n", F.lit(0)).cast("bigint").alias("failures"),
                           F.lit(severity).alias("severity"))


def unique(df: DataFrame, keys: Sequence[str], name: str, severity: str = "error") -> DataFrame:
    """Key values that occur more than once; keys with a null are left out."""
    present = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("c"))
    return _result(present.where("c > 1").agg(F.count("*").alias("n")), name, severity)


def not_null(df: DataFrame, columns: Sequence[str], name: str,
             severity: str = "error") -> DataFrame:
    """Rows with a null, per column, in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(f"{name}.{c}").alias("check_name"),
                              F.col(c).alias("n")) for c in columns])
    return counts.select(F.explode(rows).alias("r")).select(
        "r.check_name", F.col("r.n").alias("failures"), F.lit(severity).alias("severity"))


def relationship(child: DataFrame, column: str, parent: DataFrame, parent_column: str,
                 name: str, severity: str = "warn") -> DataFrame:
    """Child rows whose value has no parent; null children are fine. Children are
    counted per value before the join, so a hot value is one row."""
    values = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v")).agg(
        F.count("*").alias("c"))
    known = parent.select(F.col(parent_column).alias("_v"))
    orphans = values.join(known, "_v", "left_anti")
    return _result(orphans.agg(F.sum("c").alias("n")), name, severity)


def accepted_values(df: DataFrame, column: str, values: Sequence, name: str,
                    severity: str = "error") -> DataFrame:
    """Rows whose value is outside the list; nulls are fine."""
    bad = ~F.col(column).isin(list(values))
    return _result(df.agg(F.count_if(bad).alias("n")), name, severity)


def freshness(df: DataFrame, loaded_at: str, as_of, name: str, warn: int = WARN_HOURS,
              error: int = ERROR_HOURS) -> DataFrame:
    """Hours since the newest load, and pass / warn / error."""
    newest = df.agg(F.lit(name).alias("check_name"), F.max(loaded_at).alias("newest"))
    return _aged(newest, as_of, warn, error)


def freshness_by(df: DataFrame, source: str, loaded_at: str, as_of, warn: int = WARN_HOURS,
                 error: int = ERROR_HOURS) -> DataFrame:
    """Freshness of every source named in a column, in one scan."""
    newest = df.groupBy(F.col(source).alias("check_name")).agg(F.max(loaded_at).alias("newest"))
    return _aged(newest, as_of, warn, error)


def _aged(newest: DataFrame, as_of, warn: int, error: int) -> DataFrame:
    hours = F.timestamp_diff("SECOND", "newest", as_timestamp(as_of)) / 3600
    return newest.select(
        "check_name", F.floor(hours).cast("bigint").alias("hours_old"),
        F.when(F.col("newest").isNull() | (hours > error), "error")
        .when(hours > warn, "warn").otherwise("pass").alias("state"))


def same_row_count(bronze: DataFrame, silver: DataFrame, name: str) -> DataFrame:
    """Silver has exactly the rows of bronze."""
    before = bronze.agg(F.count("*").alias("c")).scalar()
    return silver.agg(F.count("*").alias("after")).select(
        F.lit(name).alias("check_name"),
        F.abs(F.col("after") - before).alias("failures"), F.lit("error").alias("severity"))


# --- many checks in one pass -------------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    """One check of a plan. `kind` says how its rows are judged once they are summed up per
    key: 'unique' counts keys that occur more than once, 'reference' the child rows whose key
    no parent row has, 'count' rows, 'balance' the difference of two counts, and 'fresh' the
    age of the newest key."""

    name: str
    kind: str
    severity: str = "error"


class CheckPlan:
    """Checks of many models, each model read once.

    A row of a model becomes one entry (check, key) per check that looks at it; rows that a
    condition check accepts give none. Entries of all models are summed up per (check, key)
    before they are shuffled, so uniqueness and references of all models share one shuffle,
    a key that most rows have is one row per task, and parents meet their children there.
    """

    def __init__(self):
        self.checks: list[Check] = []
        self.entries: dict[int, tuple[DataFrame, list[Column]]] = {}  # by model

    def _number(self, check: Check) -> int:
        self.checks.append(check)
        return len(self.checks) - 1

    def _enter(self, df: DataFrame, number: int, key: Column | None = None,
               when: Column | None = None, parent: bool = False) -> None:
        entry = F.struct(
            F.lit(number).alias("check"),
            (F.lit(None) if key is None else key).cast("string").alias("key"),
            F.lit(int(parent)).alias("parent"))
        self.entries.setdefault(id(df), (df, []))[1].append(
            entry if when is None else F.when(when, entry))

    def unique(self, df: DataFrame, column: str, name: str, severity: str = "error") -> None:
        key = F.col(column)
        self._enter(df, self._number(Check(name, "unique", severity)), key, key.isNotNull())

    def count(self, df: DataFrame, when: Column, name: str, severity: str = "error") -> None:
        """Rows for which `when` is true."""
        self._enter(df, self._number(Check(name, "count", severity)), when=when)

    def not_null(self, df: DataFrame, column: str, name: str, severity: str = "error") -> None:
        self.count(df, F.col(column).isNull(), name, severity)

    def accepted(self, df: DataFrame, column: str, values: Sequence, name: str,
                 severity: str = "error") -> None:
        self.count(df, ~F.col(column).isin(list(values)), name, severity)

    def reference(self, child: DataFrame, column: str, parent: DataFrame, parent_column: str,
                  name: str, severity: str = "warn") -> None:
        number = self._number(Check(name, "reference", severity))
        kind = parent.schema[parent_column].dataType
        self._enter(child, number, F.col(column).cast(kind), F.col(column).isNotNull())
        self._enter(parent, number, F.col(parent_column), F.col(parent_column).isNotNull(), True)

    def same_row_count(self, before: DataFrame, after: DataFrame, name: str) -> None:
        number = self._number(Check(name, "balance"))
        self._enter(before, number, parent=True)
        self._enter(after, number)

    def fresh(self, df: DataFrame, loaded_at: str, name: str) -> None:
        """Age of the newest `loaded_at`; pass, warn or error is its severity."""
        self._enter(df, self._number(Check(name, "fresh")), F.unix_timestamp(loaded_at))

    def result(self, spark: SparkSession, as_of=None, warn: int = WARN_HOURS,
               error: int = ERROR_HOURS) -> DataFrame:
        """(check_name, failures, severity) of every check."""
        rows = together([
            df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
            for df, entries in self.entries.values()])
        keys = rows.groupBy("check", "key").agg(
            F.sum(1 - F.col("parent")).alias("n"), F.sum("parent").alias("parents"))
        found = keys.groupBy("check").agg(
            F.count_if(F.col("n") > 1).alias("unique"),
            F.sum(F.when(F.col("parents") == 0, F.col("n"))).alias("reference"),
            F.sum("n").alias("count"), F.abs(F.sum(F.col("n") - F.col("parents"))).alias("balance"),
            F.max(F.col("key").try_cast("bigint")).alias("newest"))
        listed = spark.createDataFrame(
            [(i, c.name, c.kind, c.severity) for i, c in enumerate(self.checks)],
            "check int, check_name string, kind string, severity string")
        hours = (F.unix_timestamp(as_timestamp(as_of)) - F.col("newest")) / 3600 if as_of else F.lit(0)
        late = (F.when(F.col("newest").isNull() | (hours > error), "error")
                .when(hours > warn, "warn").otherwise("pass"))
        failures = F.when(F.col("kind") == "fresh", (late != "pass").cast("bigint"))
        for kind in ("unique", "reference", "count", "balance"):
            failures = failures.when(F.col("kind") == kind, F.col(kind))
        return listed.join(found, "check", "left").select(
            "check_name", F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
            F.when(F.col("kind") == "fresh", late).otherwise(F.col("severity")).alias("severity"))


def together(checks: Sequence[DataFrame]) -> DataFrame:
    out = checks[0]
    for other in checks[1:]:
        out = out.unionByName(other)
    return out
