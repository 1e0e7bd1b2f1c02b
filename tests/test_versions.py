"""Versioned partitioned tables, their key index, and digests of keys."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tallyhouse.sources import digests, versions

COLS = "id long, v string, day int"


def frame(spark, rows):
    return spark.createDataFrame(rows, COLS)


def seen(spark, name):
    return sorted(tuple(r) for r in spark.table(name).select("id", "v", F.coalesce("day", F.lit(-1))).collect())


@pytest.fixture
def table(spark, request):
    name = f"t_{request.node.name}".lower()[:60]
    versions.replace(frame(spark, [(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", None)]),
                     name, ["id"], "day")
    return name


def test_upsert_moves_inserts_and_empties(spark, table):
    batch = frame(spark, [(3, "C", 1), (4, "D", 7), (9, "n", None), (2, "B", 1)])
    for _ in range(2):  # a replay changes nothing
        versions.upsert(batch, table)
        assert seen(spark, table) == [(1, "a", 1), (2, "B", 1), (3, "C", 1), (4, "D", 7),
                                      (9, "n", -1)]
    held = versions.manifest(spark, table)
    assert held.number == 3 and {p.value for p in held.parts} == {"1", "7", ""}


def test_partial_update_keeps_other_columns(spark, table):
    versions.upsert(spark.createDataFrame([(1, 5)], "id long, day int"), table, [])
    assert (1, "a", 5) in seen(spark, table)
    with pytest.raises(PySparkException, match="repeats"):
        versions.upsert(frame(spark, [(1, "x", 1), (1, "y", 1)]), table)
    assert (1, "a", 5) in seen(spark, table)


def test_a_merge_that_dies_leaves_the_old_table(spark, table, monkeypatch):
    before = seen(spark, table)
    batch = frame(spark, [(1, "new", 2), (8, "new", 3)])

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", die)  # after all data is written
        with pytest.raises(RuntimeError, match="lost"):
            versions.upsert(batch, table)
    assert seen(spark, table) == before
    with monkeypatch.context() as m:
        m.setattr(versions, "_point", die)  # after the commit, before readers are told
        with pytest.raises(RuntimeError, match="lost"):
            versions.upsert(batch, table)
    assert seen(spark, table) == before
    # The next writer starts from what was committed.
    versions.upsert(frame(spark, [(9, "later", 9)]), table)
    assert seen(spark, table) == [(1, "new", 2), (2, "b", 1), (3, "c", 2), (4, "d", -1),
                                  (8, "new", 3), (9, "later", 9)]


def test_writers_do_not_mix(spark, table, monkeypatch):
    base = versions.manifest(spark, table)
    versions.upsert(frame(spark, [(1, "first", 1)]), table)
    with pytest.raises(versions.Conflict):
        versions.rewrite(frame(spark, [(1, "second", 1)]), table, base, ["1"])
    assert (1, "first", 1) in seen(spark, table) and (2, "b", 1) in seen(spark, table)
    # A merge that loses starts again from the winner's rows.
    real, raced = versions.rewrite, []

    def race(df, name, held, touched):
        if not raced:
            raced.append(1)
            versions.replace(frame(spark, [(1, "x", 1), (5, "other", 4)]), name, ["id"], "day")
        real(df, name, held, touched)

    monkeypatch.setattr(versions, "rewrite", race)
    versions.upsert(frame(spark, [(1, "mine", 1), (6, "mine", 6)]), table)
    assert seen(spark, table) == [(1, "mine", 1), (5, "other", 4), (6, "mine", 6)]


def test_expire_drops_what_nobody_reads(spark, table):
    first = versions.manifest(spark, table).data
    for day in (1, 2):
        versions.upsert(frame(spark, [(day, "e", day), (4, "e", None), (3, "e", 2)]), table)
    orphan, _ = versions.stage(frame(spark, [(1, "lost", 1)]), table, ["id"], "day")
    before = seen(spark, table)
    assert versions.expire(spark, table, grace_hours=1.0) == []
    assert versions.manifest(spark, table, 1).data == first
    dropped = versions.expire(spark, table, grace_hours=0.0)
    assert orphan in dropped and first in dropped
    assert seen(spark, table) == before
    used = {p.data for p in versions.manifest(spark, table).parts}
    assert set(versions.data_tables(spark, table)) == used
    versions.upsert(frame(spark, [(7, "on", 1)]), table)
    assert (7, "on", 1) in seen(spark, table)


def test_remove_and_an_emptied_table(spark, table):
    assert versions.remove(spark, table, frame(spark, [(1, None, None), (77, None, None)])) == 1
    assert versions.remove(spark, table, frame(spark, [(77, None, None)])) == 0
    assert versions.remove(spark, table, spark.table(table)) == 3
    assert seen(spark, table) == [] and versions.manifest(spark, table).parts == ()
    versions.upsert(frame(spark, [(5, "again", 1)]), table)
    assert seen(spark, table) == [(5, "again", 1)]


@pytest.mark.parametrize("text", [False, True])
def test_the_index_misses_no_key_and_rules_out_most(spark, text):
    name = f"t_index_{text}".lower()
    rows = spark.range(40_000).select(
        (F.col("id").cast("string") if text else F.col("id")).alias("id"),
        F.lit("x").alias("v"), (F.col("id") % 5).cast("int").alias("day"))
    versions.replace(rows, name, ["id"], "day")
    held = versions.manifest(spark, name)
    assert sum(p.n for p in held.parts) == 40_000 and max(p.blocks for p in held.parts) > 1
    asked = spark.range(10_000, 60_000, 7).select(
        (F.col("id").cast("string") if text else F.col("id")).alias("id"))
    pairs = versions.candidates(spark, held, asked)
    true = rows.join(asked, "id").select("id", versions.text_of("day").alias("value"))
    assert true.join(pairs, ["id", "value"], "left_anti").count() == 0
    false, could = pairs.count() - true.count(), asked.count() * 5 - true.count()
    assert false <= 0.03 * could
    found = versions.located(spark, held, asked)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, true.collect()))


def test_null_keys_match_nothing(spark):
    name = "t_null_keys"
    versions.replace(frame(spark, [(None, "old", 1), (1, "a", 1)]), name, ["id"], "day")
    versions.upsert(frame(spark, [(None, "new", 1), (1, "A", 1)]), name)
    assert [r.v for r in spark.table(name).orderBy("v").collect()] == ["A", "new", "old"]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_gone_keys_against_brute_force(spark, kind):
    stored = [*range(0, 5000, 3), 7, 7, None]
    current = [k for k in range(0, 6000, 3) if k % 997 > 12] + [None, 9, 9]

    def keys(values):
        return spark.createDataFrame([(v,) for v in values], "id long").select(
            F.col("id").cast(kind).alias("id"))

    got = digests.gone_keys(keys(stored), keys(current), "id", (1024, 64))
    want = {k for k in stored if k is not None and k not in set(current)}
    assert sorted(int(r.id) for r in got.collect()) == sorted(want)
    same = digests.near_changes(keys(stored), keys(stored[::-1]), "id", (1024, 64))
    assert same[0].count() == same[1].count() == 0
    assert digests.gone_keys(keys([]), keys([1]), "id").count() == 0
    assert digests.gone_keys(keys([1, 2]), keys([]), "id").count() == 2


def test_repeats_do_not_cancel(spark):
    def keys(values):
        return spark.createDataFrame([(v,) for v in values], "id long")

    got = digests.gone_keys(keys([1, 1, 5]), keys([2, 2, 5]), "id")
    assert [r.id for r in got.collect()] == [1]


def test_a_large_batch_is_not_sent_through_the_driver(spark, monkeypatch):
    """Keys compress well, so the size of their files says little about a batch."""
    name = "t_large_batch"
    rows = spark.range(3_000).select("id", F.lit("x").alias("v"),
                                     (F.col("id") % 30).cast("int").alias("day"))
    versions.replace(rows, name, ["id"], "day")
    held = versions.manifest(spark, name)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    asked = versions.candidates(spark, held, rows.select("id"))
    assert "SortMergeJoin" in plan(asked) and "BuildLeft" not in plan(asked)
    # A key is probed once in all days, not once per day.
    assert {r.word for r in spark.table(f"{held.data}_keys").collect()} == {0}
    monkeypatch.setattr("tallyhouse.sources.tables.BROADCAST_ROWS", 1_000)
    merged, _ = versions._upserted(rows, held, None)
    assert "BroadcastHashJoin" not in plan(merged)


def test_the_delete_pass_computes_its_keys_once(spark, table, monkeypatch):
    plans, real = [], versions.located

    def located(spark, held, gone, *rows):
        plans.append(gone._jdf.queryExecution().executedPlan().toString())
        return real(spark, held, gone, *rows)

    monkeypatch.setattr(versions, "located", located)
    assert versions.remove(spark, table, spark.range(1, 3)) == 2
    assert "Range" not in plans[0] and "parquet" in plans[0]


def test_bit_matrices_are_crossed(spark):
    words = [(0x9E3779B97F4A7C15 * (i + 1) & (1 << 64) - 1) for i in range(64)]

    def signed(x):
        return x - (x >> 63 << 64)

    df = spark.createDataFrame([([*map(signed, words)],)], "m array<long>")
    [found] = versions._crossed(df, ["m"]).first()
    assert found == [signed(sum((w >> p & 1) << s for s, w in enumerate(words)))
                     for p in range(64)]


def test_an_index_leaves_a_task_as_one_row_per_slot_and_block(spark, monkeypatch):
    """Not as one row per position of each key."""
    plans, real = [], DataFrameWriter.saveAsTable

    def save(writer, name, **options):
        if name.endswith("_keys"):
            plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return real(writer, name, **options)

    monkeypatch.setattr(DataFrameWriter, "saveAsTable", save)
    versions.replace(spark.range(300).select("id", F.lit("x").alias("v"),
                                             (F.col("id") % 3).cast("int").alias("day")),
                     "t_index_rows", ["id"], "day")
    assert len(plans) == 1 and "explode" not in plans[0] and "Generate" not in plans[0]


def test_all_of_a_large_batch_is_probed_only_for_partitions_not_yet_named(spark, monkeypatch):
    name = "t_first_keys"
    rows = spark.range(3_000).select("id", F.lit("x").alias("v"),
                                     (F.col("id") / 100).cast("int").alias("day"))
    versions.replace(rows, name, ["id"], "day")
    held, probes, real = versions.manifest(spark, name), [], versions.candidates

    def candidates(spark, held, some):
        probes.append((some.count(), len(held.parts)))
        return real(spark, held, some)

    monkeypatch.setattr(versions, "candidates", candidates)
    monkeypatch.setattr(versions, "FIRST_KEYS", 300)
    assert versions.located(spark, held, rows.select("id")).count() == 3_000
    assert len(probes) == 1 and probes[0][0] < 600  # they name every day
    # One key of a day beside many of another: found although not among the first.
    asked = rows.where("day = 7").unionByName(rows.where("day >= 20 AND id % 100 = 50"))
    monkeypatch.setattr(versions, "FIRST_KEYS", 10)
    found = versions.located(spark, held, asked.select("id"))
    assert sorted(r.value for r in found.select("value").distinct().collect()) == sorted(
        ["7", *map(str, range(20, 30))])
    assert len(probes) == 3 and probes[1][0] + probes[2][0] == asked.count()


def test_a_large_merge_is_one_join(spark, monkeypatch):
    name = "t_one_join"
    versions.replace(frame(spark, [(1, "a", 1), (2, "b", 1), (3, "c", 2), (None, "n", 2)]), name,
                     ["id"], "day")
    monkeypatch.setattr("tallyhouse.sources.tables.BROADCAST_ROWS", 1)
    batch = frame(spark, [(1, "A", 3), (2, None, 1), (9, "i", 2), (None, "m", 1)])
    merged, _ = versions._upserted(batch, versions.manifest(spark, name), None)
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "FullOuter" in plan
    versions.upsert(batch, name)
    rows = spark.table(name).select("id", "v", "day").collect()
    assert {tuple(r) for r in rows} == {(1, "A", 3), (2, None, 1), (3, "c", 2), (9, "i", 2),
                                        (None, "n", 2), (None, "m", 1)} and len(rows) == 6
    versions.upsert(frame(spark, [(1, "p", 3), (8, "q", 4)]).drop("v"), name, [])
    assert {(1, "A", 3), (8, None, 4)} <= {tuple(r) for r in spark.table(name).select(
        "id", "v", "day").collect()}
