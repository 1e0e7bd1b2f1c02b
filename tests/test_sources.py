from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import config
from tallyhouse.sources import bronze, tables

TARGET = "id int, name string, extra string, _loaded_at string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sides(spark):
    target = spark.createDataFrame([(1, "a", "x", "old"), (2, "b", "y", "old")], TARGET)
    staged = spark.createDataFrame([("2", "B", "new"), ("3", "C", "new")],
                                   "id string, name string, _loaded_at string")
    return target, staged


def test_merge_updates_inserts_and_keeps_other_columns(spark):
    target, staged = sides(spark)
    out = tables.merge_upsert(target, staged, ["id"], ["name", "_loaded_at"])
    assert rows(out) == [(1, "a", "x", "old"), (2, "B", "y", "new"), (3, "C", None, "new")]
    assert out.schema == target.schema


def test_merge_is_idempotent(spark):
    target, staged = sides(spark)
    once = tables.merge_upsert(target, staged, ["id"], ["name", "_loaded_at"])
    assert rows(tables.merge_upsert(once, staged, ["id"], ["name", "_loaded_at"])) == rows(once)


def test_merge_writes_nulls_of_the_batch(spark):
    target, _ = sides(spark)
    staged = spark.createDataFrame([(1, None, "new")], "id int, name string, _loaded_at string")
    out = tables.merge_upsert(target, staged, ["id"], ["name", "_loaded_at"])
    assert (1, None, "x", "new") in rows(out)


def test_merge_rejects_repeated_keys(spark):
    target, staged = sides(spark)
    with pytest.raises(PySparkException, match="repeats"):
        tables.merge_upsert(target, staged.unionByName(staged), ["id"]).collect()


def test_merge_of_an_empty_batch(spark):
    target, staged = sides(spark)
    assert rows(tables.merge_upsert(target, staged.where("false"), ["id"])) == rows(target)


def test_insert_only_keeps_the_first_write(spark):
    target, staged = sides(spark)
    out = tables.merge_insert_only(target, staged.withColumn("id", F.col("id").cast("int")), ["id"])
    assert rows(out) == [(1, "a", "x", "old"), (2, "b", "y", "old"), (3, "C", None, "new")]


def test_reconcile_ignores_null_keys_and_drops_absent_ones(spark):
    target, _ = sides(spark)
    current = spark.createDataFrame([(2,), (None,), (7,)], "id int")
    assert rows(tables.remove_deleted(target, current, "id")) == [(2, "b", "y", "old")]
    assert rows(tables.deleted_rows(target, current, "id").select("id")) == [(1,)]


def test_upsert_then_reconcile_equals_the_source(spark):
    target, _ = sides(spark)
    source = spark.createDataFrame([(2, "B", "z", "now"), (5, "E", "e", "now")], TARGET)
    merged = tables.merge_upsert(target, source, ["id"])
    assert rows(tables.remove_deleted(merged, source, "id")) == rows(source)


def test_type_inference(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "true", "2024-01-01", "x", None, "12:30"),
         ("2", "2e3", "FALSE", "2024-02-01 10:00:00", "7", None, "13:00"),
         (None, None, None, None, None, None, None)],
        "a string, b string, c string, d string, e string, f string, g string")
    got = {r.column_name: r.decided for r in bronze.infer_types(df).collect()}
    assert got == {"a": "bigint", "b": "double", "c": "boolean", "d": "timestamp",
                   "e": "string", "f": "string", "g": "string"}
    schema = bronze.decided_schema(df.withColumn("money", F.lit("1.25")), ["money"])
    assert schema["money"].dataType == T.DecimalType(38, 9)
    assert schema["d"].dataType == T.TimestampType()


def test_conform_to_the_committed_schema(spark):
    staged = spark.createDataFrame([("1", None)], "id string, note string")
    schema = T.StructType([T.StructField("id", T.LongType()),
                           T.StructField("amount", T.DoubleType()),
                           T.StructField("note", T.StringType())])
    out = bronze.conform(staged, schema)
    assert out.schema == schema and rows(out) == [(1, None, None)]


def test_json_rows_strict_and_safe(spark):
    text = '[{"d":"2024-01-07","n":"5"},{"d":"bad","n":"x"},{}]'
    df = spark.createDataFrame([(1, text), (2, "[]"), (3, None)], "id int, j string")
    fields = {"d": "date", "n": "bigint"}
    safe = bronze.json_rows(df, "j", fields, safe=True, keep=["id"])
    assert rows(safe) == sorted([(1, dt.date(2024, 1, 7), 5), (1, None, None), (1, None, None)],
                                key=repr)
    with pytest.raises(PySparkException):
        bronze.json_rows(df, "j", fields).collect()


def test_mismatch_report_counts_rows_from_one(spark):
    df = spark.createDataFrame([(10, "1"), (20, "x"), (30, None), (40, "y")], "k int, v string")
    assert rows(bronze.type_mismatches(df, {"v": "int"}, "k")) == [(2, "v", "x"), (4, "v", "y")]


def test_column_lists_and_jdbc_options():
    c = config.TableConfig("dbo.Person", "people", columns=("Id", "Name", "Id"))
    assert c.column_list([]) == ["Id", "Name"]
    options = bronze.jdbc_options(c, "jdbc:x", 1, 1000, 16)
    assert options["fetchsize"] == "50000" and options["numPartitions"] == "16"
    assert options["partitionColumn"] == "Id"
    assert len(config.list_tables()) == 15


def test_incremental_window_is_26_hours(spark):
    c = config.TableConfig("t", "t", "id", "m")
    times = [dt.datetime(2024, 1, 1, h) for h in (0, 9, 10, 23)]
    df = spark.createDataFrame(list(enumerate(times)), "id int, m timestamp")
    kept = bronze.scan_incremental(df, c, "2024-01-02 12:00:00")
    assert [r.id for r in kept.orderBy("id").collect()] == [2, 3]


def test_history_increment_keeps_two_versions_of_changed_people(spark):
    at = dt.datetime
    df = spark.createDataFrame(
        [(1, 1, at(2024, 1, 1)), (2, 1, at(2024, 1, 5)), (3, 1, at(2024, 1, 9, 12)),
         (4, 1, at(2024, 1, 9, 12)), (5, 2, at(2024, 1, 1)), (6, 3, at(2024, 1, 9, 20))],
        "Id int, PersonId int, EffectiveDate timestamp")
    out = bronze.history_incremental(df, "2024-01-10 00:00:00")
    assert sorted((r.PersonId, r.Id, r.rn) for r in out.collect()) == [
        (1, 3, 2), (1, 4, 1), (3, 6, 1)]


def test_load_table_full_incremental_and_delete_pass(spark):
    c = config.TableConfig("dbo.T", "loaded", "id", "changed", decimal_columns=("amount",))
    at = dt.datetime
    first = spark.createDataFrame([(1, "1.10", at(2024, 1, 1), None), (2, "2", at(2024, 1, 1), None)],
                                  "id int, amount string, changed timestamp, note string")
    assert tables.load_table(spark, first, c, "2024-01-02 00:00:00", "full")
    assert spark.table("loaded").schema["amount"].dataType == T.DecimalType(38, 9)
    # A later batch whose note looks numeric keeps the committed text type.
    later = spark.createDataFrame([(2, "9", at(2024, 1, 5), "7"), (3, "3", at(2024, 1, 5), "8")],
                                  "id int, amount string, changed timestamp, note string")
    assert tables.load_table(spark, later, c, "2024-01-05 06:00:00", "incremental",
                             reconcile_deletes=True)
    got = {r.id: (float(r.amount), r.note) for r in spark.table("loaded").collect()}
    assert got == {2: (9.0, "7"), 3: (3.0, "8")}
    assert not spark.catalog.tableExists("_stg_loaded")
    # Nothing changed since: the batch is skipped.
    assert not tables.load_table(spark, later, c, "2024-02-05 00:00:00", "incremental")


def test_publish_keeps_the_view_readable_while_replacing(spark):
    tables.publish(spark.range(3).toDF("id"), "numbers")
    tables.publish(spark.table("numbers").where("id > 0"), "numbers")
    tables.publish(spark.table("numbers").where("id > 1"), "numbers")
    assert rows(spark.table("numbers")) == [(2,)]
    for _ in range(3):
        tables.publish(spark.table("numbers"), "numbers")
    kept = [t.name for t in spark.catalog.listTables() if t.name.startswith("numbers__v")]
    assert len(kept) == 3 and rows(spark.table("numbers")) == [(2,)]
    tables.materialise(spark.range(2), "two", as_table=False)
    assert spark.table("two").count() == 2


def test_partitioned_upsert_touches_only_named_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.createDataFrame([(1, "a", 2020), (2, "b", 2021)], "id int, v string, y int")
    base.write.partitionBy("y").parquet(path)
    untouched = sorted(p.name for p in (tmp_path / "t" / "y=2020").iterdir())
    batch = spark.createDataFrame([(2, "B", 2021), (3, "C", 2022)], "id int, v string, y int")
    tables.upsert_partitions(batch, path, ["id"], "y")
    assert rows(spark.read.parquet(path).select("id", "v", "y")) == [
        (1, "a", 2020), (2, "B", 2021), (3, "C", 2022)]
    assert untouched == sorted(p.name for p in (tmp_path / "t" / "y=2020").iterdir())


def test_source_encodings(spark):
    at = dt.datetime
    df = spark.createDataFrame(
        [(True, at(2024, 1, 2, 3, 4, 5), "1.005", 2, dt.date(2024, 2, 29)),
         (None, at(2024, 1, 2, 3, 4, 5, 120000), None, None, None)],
        "b boolean, t timestamp, m string, f int, d date")
    out = bronze.encode_for_extract(df, ["b"], ["t"], ["m"], ["f"], ["d"])
    got = [tuple(r) for r in out.withColumn("m", F.col("m").cast("string")).collect()]
    assert got == [("true", "2024-01-02T03:04:05", "1.01", 2.0, "2024-02-29"),
                   (None, "2024-01-02T03:04:05.120", None, None, None)]


def test_first_seen(spark):
    df = spark.createDataFrame([("v1", 2, "later"), ("v1", 1, "first"), ("v2", 3, "only")],
                               "id string, page int, t string")
    assert rows(bronze.first_seen(df, "id", ["page"]).select("id", "t")) == [
        ("v1", "first"), ("v2", "only")]


def test_load_all_reads_configured_columns_by_default(spark):
    seen = {}

    def read(c):
        seen[c.target] = c.columns
        return spark.createDataFrame([], ", ".join(f"`{n}` string" for n in c.columns)).withColumn(
            "SSNEncrypted", F.lit("x"))

    done = tables.load_all(spark, read, "2024-01-01 00:00:00", "full")
    assert len(done) == 15 and not any(done.values())
    assert all(seen.values()) and "SSNEncrypted" not in seen["people"]


def test_load_all_skips_empty_tables(spark):
    configs = {"one": config.TableConfig("s.one", "all_one", "id", None),
               "two": config.TableConfig("s.two", "all_two", "id", None)}
    data = {"s.one": spark.createDataFrame([(1, "x")], "id int, v string"),
            "s.two": spark.createDataFrame([], "id int, v string")}
    done = tables.load_all(spark, lambda c: data[c.source_table], "2024-01-01 00:00:00", "full",
                           configs)
    assert done == {"one": True, "two": False}
    assert spark.table("all_one").first()["_source_system"] == "rms"


def files_by_month(spark, name):
    """{month: its files} of a table kept by month."""
    found = spark.table(name).select("_month", F.input_file_name().alias("f")).distinct().collect()
    return {m: sorted(r.f for r in found if r["_month"] == m) for m in {r["_month"] for r in found}}


def test_monthly_table_rewrites_only_touched_months(spark):
    c = config.TableConfig("dbo.F", "monthly_facts", "id", "changed", partition_column="created")
    at = dt.datetime
    cols = "id int, v string, created timestamp, changed timestamp"
    first = spark.createDataFrame(
        [(1, "a", at(2024, 1, 3), at(2024, 1, 3)), (2, "b", at(2024, 2, 3), at(2024, 2, 3)),
         (3, "c", None, at(2024, 2, 3))], cols)
    assert tables.load_table(spark, first, c, "2024-02-04 00:00:00", "full", by_month=True)
    before = files_by_month(spark, "monthly_facts")
    later = spark.createDataFrame(
        [(2, "B", at(2024, 2, 3), at(2024, 3, 1)), (4, "d", at(2024, 3, 1), at(2024, 3, 1))], cols)
    assert tables.load_table(spark, later, c, "2024-03-01 06:00:00", "incremental", by_month=True)
    assert rows(spark.table("monthly_facts").select("id", "v", "_month")) == [
        (1, "a", 202401), (2, "B", 202402), (3, "c", 0), (4, "d", 202403)]
    after = files_by_month(spark, "monthly_facts")
    assert all(after[m] == before[m] for m in (0, 202401)) and after[202402] != before[202402]
    # The delete pass drops months that it empties and leaves the others alone.
    assert tables.reconcile(spark, "monthly_facts", first.where("id <> 1"), "id", True) == 2
    assert rows(spark.table("monthly_facts").select("id")) == [(2,), (3,)]
    left = files_by_month(spark, "monthly_facts")
    assert left == {m: after[m] for m in (0, 202402)}
    assert tables.reconcile(spark, "monthly_facts", first, "id", True) == 0
    assert files_by_month(spark, "monthly_facts") == left
    with pytest.raises(ValueError, match="no keys"):
        tables.reconcile(spark, "monthly_facts", first.where("id < 0"), "id", True)


def test_a_creation_month_may_become_known_or_change(spark):
    """A key is found in whatever month it is stored, and moves."""
    c = config.TableConfig("dbo.F", "moving_facts", "id", "changed", partition_column="created")
    at = dt.datetime
    cols = "id int, v string, created timestamp, changed timestamp"
    first = [(1, "a", None, at(2024, 2, 3)), (2, "b", at(2024, 1, 5), at(2024, 2, 3)),
             (3, "c", at(2024, 1, 6), at(2024, 2, 3))]
    tables.load_table(spark, spark.createDataFrame(first, cols), c, "2024-02-04 00:00:00", "full",
                      by_month=True)
    later = [(1, "A", at(2024, 1, 1), at(2024, 3, 1)), (2, "B", at(2023, 12, 31), at(2024, 3, 1)),
             (4, "d", None, at(2024, 3, 1))]
    for _ in range(2):  # a replay changes nothing
        tables.load_table(spark, spark.createDataFrame(later, cols), c, "2024-03-01 06:00:00",
                          "incremental", by_month=True)
        assert rows(spark.table("moving_facts").select("id", "v", "_month")) == [
            (1, "A", 202401), (2, "B", 202312), (3, "c", 202401), (4, "d", 0)]


def test_partitioned_upsert_keeps_blank_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    cols = "id int, v string, day int"
    tables.write_folder(spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", 5)],
                                              cols), path, "day")
    batch = spark.createDataFrame([(9, "n", None), (3, "moved", None)], cols)
    for _ in range(2):  # a replay changes nothing
        tables.upsert_partitions(batch, path, ["id"], "day")
        got = spark.read.schema(cols).parquet(path).select("id", "v", "day")
        assert rows(got) == [(1, "a", None), (2, "b", None), (3, "moved", None), (9, "n", None)]
