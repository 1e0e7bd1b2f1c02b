"""Source scans: projection, incremental windows, stamping, typing, landed JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import FETCH_SIZE, LOOKBACK_HOURS, SOURCE_SYSTEM, TableConfig
from ..functions.columns import as_col, exact, flag_text, iso_text, safe_cast
from ..functions.dates import as_timestamp
from ..functions.ordering import first_per_key, top_per_key, with_row_index


def landed(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    """One landed entity extract."""
    return spark.read.parquet(f"{folder}/{entity}.parquet")


def jdbc_options(config: TableConfig, url: str, lower: int, upper: int, partitions: int,
                 fetch_size: int = FETCH_SIZE) -> dict[str, str]:
    """Options for a partitioned JDBC read: executors fetch key ranges in parallel
    and stream `fetch_size` rows at a time."""
    return {"url": url, "dbtable": config.source_table, "fetchsize": str(fetch_size),
            "partitionColumn": config.primary_key, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions)}


def read_jdbc(spark: SparkSession, config: TableConfig, url: str, lower: int, upper: int,
              partitions: int, **properties: str) -> DataFrame:
    options = jdbc_options(config, url, lower, upper, partitions) | properties
    return scan(spark.read.format("jdbc").options(**options).load(), config)


def scan(source: DataFrame, config: TableConfig) -> DataFrame:
    """Only the configured columns, so the source reads nothing else."""
    return source.select(*config.column_list(source.columns))


def scan_incremental(source: DataFrame, config: TableConfig, as_of,
                     hours: int = LOOKBACK_HOURS) -> DataFrame:
    """Rows modified in the look-back window; the bound is a literal and is pushed down."""
    if config.modified_column is None:
        return scan(source, config)
    since = as_timestamp(as_of) - F.expr(f"INTERVAL {hours} HOURS")
    return scan(source.where(F.col(config.modified_column) >= since), config)


def high_water_mark(log: DataFrame, view: str) -> Column:
    """The newest logged run of a view, as a scalar subquery (null if never run)."""
    return (log.where(F.col("view_name") == view)
            .agg(F.max("last_generated_time").alias("mark")).scalar())


def scan_since_mark(source: DataFrame, config: TableConfig, log: DataFrame, view: str,
                    as_of) -> DataFrame:
    """Rows modified between the view's last logged run and as_of, both included."""
    changed = F.col(config.modified_column).between(high_water_mark(log, view),
                                                    as_timestamp(as_of))
    return scan(source.where(changed), config)


def history_incremental(history: DataFrame, as_of, person: str = "PersonId",
                        effective: str = "EffectiveDate", row_id: str = "Id",
                        hours: int = LOOKBACK_HOURS, versions: int = 2) -> DataFrame:
    """The newest versions of every person whose newest version is inside the window.

    A person's newest version is inside the window exactly when some version is, so
    the changed people come from a pushed-down filter. Every person is cut to their
    newest versions before the join: the rank limit runs before its shuffle, so a person
    with very many versions never fills one task, and the optimizer broadcasts the
    changed people where their size allows it.
    """
    since = as_timestamp(as_of) - F.expr(f"INTERVAL {hours} HOURS")
    changed = history.where(F.col(effective) >= since).select(person).distinct()
    newest_first = [F.desc(effective), F.desc(row_id)]
    newest = top_per_key(history, [person], newest_first, versions)
    return newest.join(changed, person, "left_semi")


def stamp(df: DataFrame, as_of, source_system: str = SOURCE_SYSTEM) -> DataFrame:
    return df.withColumns({"_loaded_at": as_timestamp(as_of),
                           "_source_system": F.lit(source_system)})


def force_decimals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact decimals for the listed columns that are present."""
    return df.withColumns({c: F.col(c).cast("decimal(38,9)") for c in columns if c in df.columns})


# --- type inference ----------------------------------------------------------

# Kinds in the order they are tried; each probe is null where a text does not fit. The
# date pattern keeps bare times of day as text.
_DATED = r"^\s*\d{4}-\d"
_PROBES = {
    "boolean": lambda c: F.when(F.lower(c).isin("true", "false"), F.lit(1)),
    "bigint": lambda c: safe_cast(c, "bigint"),
    "double": lambda c: safe_cast(c, "double"),
    "timestamp": lambda c: F.when(c.rlike(_DATED), c.try_cast("timestamp")),
}


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per text column: how many values are present, how many fit each
    type, and the type decided. A single aggregate over the table."""
    names = list(columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)])
    counts = []
    for name in names:
        c = F.col(name)
        fits = [F.count(probe(c)).alias(kind) for kind, probe in _PROBES.items()]
        counts.append(F.struct(F.lit(name).alias("column_name"),
                               F.count(c).alias("present"), *fits).alias(name))
    stats = df.agg(*counts).select(F.explode(F.array(*names)).alias("s")).select("s.*")
    decided = F.when(F.col("present") == 0, "string")
    for kind in _PROBES:
        decided = decided.when(F.col(kind) == F.col("present"), kind)
    return stats.withColumn("decided", decided.otherwise("string"))


def decided_schema(df: DataFrame, decimal_columns: Sequence[str] = ()) -> T.StructType:
    """The explicit schema of a batch: forced decimals, then inferred text types.
    One small row per column reaches the driver."""
    text = [f.name for f in df.schema
            if isinstance(f.dataType, T.StringType) and f.name not in decimal_columns]
    found = {r.column_name: r.decided for r in infer_types(df, text).collect()} if text else {}

    def kind(f: T.StructField):
        if f.name in decimal_columns:
            return T.DecimalType(38, 9)
        return T._parse_datatype_string(found[f.name]) if f.name in found else f.dataType

    return T.StructType([T.StructField(f.name, kind(f), True) for f in df.schema])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast a batch to a committed schema; columns the batch lacks become null."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema])


def type_mismatches(df: DataFrame, types: Mapping[str, str], key: str) -> DataFrame:
    """Cells whose text does not fit the declared type, with the row's number in
    key order: (row_number, column_name, value)."""
    bad = F.array(*[
        F.when(F.col(c).isNotNull() & safe_cast(c, t).isNull(),
               F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")))
        for c, t in types.items()])
    numbered = with_row_index(df.withColumn("_bad", F.array_compact(bad)).select(key, "_bad"),
                              key, "row_number")
    return (numbered.where(F.size("_bad") > 0)
            .select("row_number", F.explode("_bad").alias("b")).select("row_number", "b.*"))


# --- landed JSON -------------------------------------------------------------

def json_rows(df: DataFrame, column: str, fields: Mapping[str, str], safe: bool = False,
              keep: Sequence[str] = ()) -> DataFrame:
    """A JSON-array text column to typed rows.

    Fields are read as text and then cast: strictly (a bad value fails the job) or
    safely (a bad value becomes null). Missing fields are null; an empty or
    missing array gives no rows.
    """
    text_rows = T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in fields]))
    rows = df.select(*keep, F.explode(F.from_json(F.col(column), text_rows)).alias("r"))

    def typed(name: str, kind: str) -> Column:
        c = F.col(f"r.{name}")
        return (safe_cast(c, kind) if safe else c.cast(kind)).alias(name)

    return rows.select(*keep, *[typed(n, k) for n, k in fields.items()])


def first_seen(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """De-duplicate paged records: the first record of each key in page order."""
    return first_per_key(df, [key], order)


def encode_for_extract(df: DataFrame, flags: Sequence[str] = (), timestamps: Sequence[str] = (),
                       money: Sequence[str] = (), floats: Sequence[str] = (),
                       dates: Sequence[str] = ()) -> DataFrame:
    """Source-side encodings: bits as 'true'/'false', times and dates as ISO text,
    money as decimal(18,2), statistics as doubles."""
    changed = {c: flag_text(c) for c in flags} | {c: iso_text(c) for c in timestamps}
    changed |= {c: exact(c) for c in money} | {c: as_col(c).cast("double") for c in floats}
    changed |= {c: F.date_format(c, "yyyy-MM-dd") for c in dates}
    return df.withColumns(changed)
