"""Table maintenance on plain Parquet: loads, merges, delete passes, publishing.

The `merge_*`, `remove_deleted` and `missing_only` functions are lazy plans. The
others write: a full load and a whole-table merge publish a new version behind a
view. Tables kept by month are in `versions`: a merge there rewrites only the partitions
a batch touches, and they appear together.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TableConfig, shared_folder
from ..functions.ordering import latest_per_key
from . import bronze

MERGE_META = "_loaded_at"
BROADCAST_ROWS = 100_000  # of a batch that the optimizer may still broadcast


def sized(batch: DataFrame, rows: int) -> DataFrame:
    """A batch to be joined to a table. The optimizer goes by the size of its compressed
    files, also when it is aggregated first, and would send millions of rows through the
    driver; so beyond a number of rows the join is a sort-merge one."""
    return batch.hint("merge") if is_large(rows) else batch


def is_large(rows: int) -> bool:
    return rows > BROADCAST_ROWS


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, _new) with the row's other columns as a struct, failing at run time if a
    key repeats. Only the batch is shuffled, and repeats are combined map-side."""
    rest = F.struct(*[c for c in df.columns if c not in keys])
    message = F.lit(f"merge source repeats a value of {', '.join(keys)}")
    return (df.groupBy(*keys).agg(F.count("*").alias("_n"), F.first(rest).alias("_new"))
            .select(*keys, F.when(F.col("_n") == 1, F.col("_new"))
                    .otherwise(F.raise_error(message)).alias("_new")))


def newest_staged(staged: DataFrame, pk: str, order: Sequence[str]) -> DataFrame:
    """Staging that is appended to may hold a key several times: keep the newest."""
    return latest_per_key(staged, [pk], order)


def merge_upsert(target: DataFrame, staged: DataFrame, keys: Sequence[str],
                 update: Sequence[str] | None = None, batch_rows: int = 0) -> DataFrame:
    """Target after an upsert: matched rows take `update` columns from the batch
    (default: all non-key columns), other columns keep the target's value, and
    unmatched batch rows are inserted. A repeated batch key is an error.

    The batch is joined to the target and its matched keys are found by a second,
    key-only scan, so a small batch is broadcast by the optimizer and the target
    is never shuffled; a large batch falls back to a sort-merge join. `batch_rows`, if
    known, settles what is large.
    """
    keys = list(keys)
    update = [c for c in (update or target.columns) if c in staged.columns and c not in keys]
    batch = one_per_key(bronze.conform(staged, target.schema), keys)
    kept = (target.join(sized(batch, batch_rows), keys, "left")
            .select(*[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}"))
                      .otherwise(F.col(c)).alias(c) if c in update else F.col(c)
                      for c in target.columns]))
    matched = target.select(*keys).join(sized(batch.select(*keys), batch_rows), keys, "left_semi")
    inserted = batch.join(sized(matched, batch_rows), keys, "left_anti").select(*keys, "_new.*")
    return kept.unionByName(inserted)


def merge_insert_only(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus the batch rows whose key is new: the first write wins."""
    return target.unionByName(missing_only(batch, target, keys), allowMissingColumns=True)


def missing_only(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key the target does not hold. The target is first cut down
    to the batch's keys, so a large target is scanned but not shuffled."""
    keys = list(keys)
    present = target.select(*keys).join(batch.select(*keys), keys, "left_semi")
    return batch.join(present, keys, "left_anti")


def existing_keys(target: DataFrame, date_column: str, dates: Sequence,
                  keys: Sequence[str]) -> DataFrame:
    """Keys already stored for a set of dates (a pushed-down IN filter)."""
    return target.where(F.col(date_column).isin(list(dates))).select(*keys).distinct()


def remove_deleted(target: DataFrame, current_keys: DataFrame, pk: str) -> DataFrame:
    """Target rows whose key still exists at the source. A null key in the current
    set matches nothing and a null target key is never removed, as with NOT IN
    over non-null keys."""
    still_there = target.join(current_keys.select(pk), pk, "left_semi")
    return still_there.unionByName(target.where(F.col(pk).isNull()))


def deleted_rows(target: DataFrame, current_keys: DataFrame, pk: str) -> DataFrame:
    return target.where(F.col(pk).isNotNull()).join(
        current_keys.select(pk), pk, "left_anti")


# --- writers -----------------------------------------------------------------

def laid_out(df: DataFrame, partition: str) -> DataFrame:
    """Rows brought to the tasks that write their partition: few files per partition,
    while adaptive execution splits a partition that is too large for one task."""
    return df.hint("rebalance", F.col(partition))


def publish(df: DataFrame, name: str, partition: str | None = None) -> None:
    """Write a new table version, then point the view `name` at it. Readers and the
    job itself keep the old version until the write has finished, and a lost or
    repeated run leaves the view as it was."""
    spark = df.sparkSession
    database, _, bare = name.rpartition(".")
    prefix = f"{bare}__v"
    old = [t.name for t in spark.catalog.listTables(database or None)
           if t.name.startswith(prefix)]
    number = 1 + max((int(n[len(prefix):]) for n in old), default=0)
    qualify = (lambda n: f"{database}.{n}") if database else (lambda n: n)
    fresh = qualify(f"{prefix}{number}")
    rows = df if partition is None else laid_out(df, partition)
    rows.write.format("parquet").mode("overwrite").saveAsTable(fresh, partitionBy=partition)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {fresh}")
    # Two versions stay: the one readers may still use, and one a lost run may have left.
    for stale in sorted(old, key=lambda n: int(n[len(prefix):]))[:-2]:
        spark.sql(f"DROP TABLE IF EXISTS {qualify(stale)}")


def materialise(df: DataFrame, name: str, as_table: bool, partition: str | None = None) -> None:
    """Silver models are views, gold models are tables."""
    if as_table:
        publish(df, name, partition)
    else:
        df.createOrReplaceTempView(name)


# Month of a partitioned table's rows as yyyyMM, 0 without a creation time. A number,
# so that folder names are read back with one type.
MONTH = "_month"


def with_month(df: DataFrame, created: str) -> DataFrame:
    return df.withColumn(MONTH, F.coalesce(
        F.date_format(created, "yyyyMM").cast("int"), F.lit(0)))


def write_folder(df: DataFrame, path: str, partition: str) -> None:
    laid_out(df, partition).write.partitionBy(partition).parquet(path)


def _of_partitions(rows: DataFrame, partition: str, values: DataFrame) -> DataFrame:
    """Rows whose partition is among `values` (a blank one matches a blank one). A join,
    so no list is collected and the scan prunes partitions while it runs."""
    wanted = values.select(F.col(partition).alias("_wanted")).distinct()
    return rows.join(wanted, F.col(partition).eqNullSafe(F.col("_wanted")), "left_semi")


def _drop_folders(spark: SparkSession, folders: Sequence[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def upsert_partitions(staged: DataFrame, path: str, keys: Sequence[str], partition: str,
                      update: Sequence[str] | None = None) -> None:
    """Upsert into a plain partitioned Parquet folder, rewriting only touched partitions.

    Touched are the partitions the batch names and those that hold its keys now, which a
    scan of the key columns finds: a row whose partition value has changed moves. A blank
    partition value is a partition of its own. Each partition is overwritten on its own, so
    a lost job may leave some old and some new; merging the same batch again sets that
    right, as stored rows of its keys are replaced wherever they are. `versions.upsert`
    does the same at once for all partitions, and needs no scan of the keys.
    """
    spark, keys = staged.sparkSession, list(keys)
    # Folder names do not tell the partition's type when they are all blank; the batch does.
    stored_as = T.StructType([
        T.StructField(f.name, staged.schema[f.name].dataType) if f.name == partition else f
        for f in spark.read.parquet(path).schema])
    target = spark.read.schema(stored_as).parquet(path)
    batch_keys = staged.select(*keys).distinct()
    touched = staged.select(partition).unionByName(target.select(*keys, partition).join(
        batch_keys, keys, "left_semi").select(partition))
    old = _of_partitions(target, partition, touched)
    stored = old.join(batch_keys, keys, "left_semi")
    matched = latest_per_key(stored, keys, [c for c in target.columns if c not in keys])
    merged = old.join(batch_keys, keys, "left_anti").unionByName(
        merge_upsert(matched, staged, keys, update))
    # Partitions that only held rows which move away: few, and usually none.
    located = target.select(*keys, F.col(partition).alias("_from"), F.regexp_replace(
        F.col("_metadata.file_path"), "/[^/]*$", "").alias("_folder"))
    left = (located.join(staged.select(*keys, partition), keys)
            .where(~F.col(partition).eqNullSafe(F.col("_from")))
            .select("_from", "_folder").distinct())
    stay = merged.select(F.col(partition).alias("_stay")).distinct()
    emptied = [r["_folder"] for r in left.join(
        stay, F.col("_from").eqNullSafe(F.col("_stay")), "left_anti").collect()]
    (laid_out(merged, partition).write.partitionBy(partition)
     .option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path))
    _drop_folders(spark, emptied)


def reconcile(spark: SparkSession, name: str, current_keys: DataFrame, pk: str,
              by_month: bool = False, allow_empty: bool = False) -> int:
    """The delete pass: a published table without the rows gone at the source. Returns how
    many were removed; a table that lost nothing is left as it is, and of a table kept by
    month only the months that lost rows are rewritten. The keys of both sides are compared
    by digests, so only ranges that differ are looked at key by key. A source without any
    key would empty the table, so that has to be asked for."""
    from . import digests, versions

    stored = spark.table(name)
    if not allow_empty and current_keys.where(F.col(pk).isNotNull()).isEmpty():
        raise ValueError(f"the source of {name} has no keys: nothing is deleted")
    gone = digests.gone_keys(stored.select(pk), current_keys.select(pk), pk)
    if by_month:
        return versions.remove(spark, name, gone)
    folder = shared_folder(spark, "gone")
    gone.write.parquet(folder)  # read twice
    gone = spark.read.schema(gone.schema).parquet(folder)
    lost = sized(gone, gone.count())
    removed = stored.join(lost, pk, "left_semi").count()
    if removed:
        publish(stored.join(lost, pk, "left_anti"), name)
    return removed


def load_table(spark: SparkSession, source: DataFrame, config: TableConfig, as_of, mode: str,
               database: str | None = None, reconcile_deletes: bool = False,
               by_month: bool = False) -> bool:
    """Load one configured table, 'full' or 'incremental'. False if nothing was loaded.

    The source is read once, into a staging table that is dropped at the end; typing
    and merging, which read a batch several times, use that. Full loads decide the
    schema; incremental loads are cast to the schema the target already has and merged
    on its primary key alone. With `by_month`, a table whose configuration names a creation
    time is kept in monthly partitions, and an incremental load rewrites only the months
    that its batch names or that hold its keys: a creation time may become known or change.
    """
    from . import versions

    def qualify(name: str) -> str:
        return f"{database}.{name}" if database else name

    name, staging = qualify(config.target), qualify(f"_stg_{config.target}")
    monthly = by_month and config.partition_column is not None
    batch = (bronze.scan(source, config) if mode == "full"
             else bronze.scan_incremental(source, config, as_of))
    bronze.stamp(bronze.force_decimals(batch, config.decimal_columns), as_of).write.format(
        "parquet").mode("overwrite").saveAsTable(staging)
    try:
        staged = spark.table(staging)
        loaded = not staged.isEmpty()
        if loaded and mode == "full":
            typed = bronze.conform(staged, bronze.decided_schema(staged, config.decimal_columns))
            if monthly:
                versions.replace(with_month(typed, config.partition_column), name,
                                 [config.primary_key], MONTH)
            else:
                publish(typed, name)
        elif loaded:
            update = [c for c in batch.columns if c != config.primary_key] + [MERGE_META]
            if monthly:
                versions.upsert(with_month(staged, config.partition_column), name, update)
            else:
                publish(merge_upsert(spark.table(name), staged, [config.primary_key], update,
                                     staged.count()), name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
    if reconcile_deletes:
        reconcile(spark, name, source, config.primary_key, monthly)
    return loaded


def load_all(spark: SparkSession, read: Callable[[TableConfig], DataFrame], as_of, mode: str,
             configs: Mapping[str, TableConfig] | None = None, **options) -> dict[str, bool]:
    """Load every configured table; by default all source tables, limited to the columns
    that the silver models read, so no sensitive column is stored."""
    if configs is None:
        from ..operators.warehouse import extract_configs

        configs = extract_configs()
    return {key: load_table(spark, read(config), config, as_of, mode, **options)
            for key, config in configs.items()}
