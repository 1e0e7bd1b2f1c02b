"""Queries over sources, scans, typing and table maintenance."""

from __future__ import annotations

import dataclasses
import os

from pyspark.sql import functions as F

from ..config import TableConfig, shared_folder
from ..functions.columns import as_col
from ..sources import bronze, digests, runlog, snapshots, tables, versions
from . import inputs as I
from .registry import query

EVENTS = TableConfig("events", "events", "event_id", "ts",
                     ("event_id", "user_id", "event_type", "value"))


@query("scan_project", """
    SELECT c_custkey, c_name, c_acctbal, '2024-01-28 06:00' AS loaded, 'rms' AS _source_system
    FROM customer""")
def scan_project(spark, sf_dir):
    # The repeated column is listed once.
    config = TableConfig("customer", "people", "c_custkey", None,
                         ("c_custkey", "c_name", "c_custkey", "c_acctbal"))
    out = bronze.stamp(bronze.scan(bronze.landed(spark, sf_dir, "customer"), config),
                       "2024-01-28 06:00:00")
    return out.withColumn("loaded", F.date_format("_loaded_at", "yyyy-MM-dd HH:mm")).drop(
        "_loaded_at")


@query("scan_incremental_26h", """
    SELECT event_id, user_id, event_type, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-29 00:00:00' - INTERVAL 26 HOUR""")
def scan_incremental_26h(spark, sf_dir):
    return bronze.scan_incremental(I.table(spark, sf_dir, "events"), EVENTS,
                                   "2024-01-29 00:00:00")


@query("scan_high_water_mark", """
    SELECT event_id, user_id, event_type, value FROM events
    WHERE ts >= (SELECT max(ts) FROM events
                 WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-20 00:00:00')
      AND ts <= TIMESTAMP '2024-01-26 00:00:00'""")
def scan_high_water_mark(spark, sf_dir):
    """The mark is the entry that a load wrote after it had published."""
    events = _events(spark, sf_dir)
    log, config = _logged(os.urandom(4).hex())
    until = events.where("event_type = 'signup' AND ts < TIMESTAMP '2024-01-20 00:00:00'").agg(
        F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    runlog.load_since_mark(spark, events, config, log, "signup", until)
    return bronze.scan_since_mark(events, EVENTS, spark.table(log), "signup",
                                  "2024-01-26 00:00:00")


def _events(spark, sf_dir):
    return I.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _logged(run):
    return f"runs_{run}", dataclasses.replace(EVENTS, target=f"logged_events_{run}")


@query("load_path_logged", """
    SELECT event_type, count(*) AS events, CAST(count(DISTINCT event_id) AS BIGINT) AS keys
    FROM (SELECT event_id, CASE WHEN event_type = 'signup' AND ts < TIMESTAMP '2024-01-10 00:00:00'
                                THEN 'edited' ELSE event_type END AS event_type
          FROM events WHERE ts <= TIMESTAMP '2024-01-26 00:00:00') e GROUP BY 1""")
def load_path_logged(spark, sf_dir):
    """Three loads by the log of runs. The second dies after it has published and before its
    entry; the third starts from the first one's mark, with early signups edited since."""
    log, config = _logged(os.urandom(4).hex())
    events = _events(spark, sf_dir)
    runlog.load_since_mark(spark, events, config, log, "events", "2024-01-12 00:00:00")
    runlog.publish_since_mark(spark, events, config, log, "events", "2024-01-19 00:00:00")
    early = "event_type = 'signup' AND ts < TIMESTAMP '2024-01-10 00:00:00'"
    edited = events.withColumns({
        "event_type": F.expr(f"CASE WHEN {early} THEN 'edited' ELSE event_type END"),
        "ts": F.expr(f"CASE WHEN {early} THEN TIMESTAMP '2024-01-15 00:00:00' ELSE ts END")})
    runlog.load_since_mark(spark, edited, config, log, "events", "2024-01-26 00:00:00")
    return spark.table(config.target).groupBy("event_type").agg(
        F.count("*").alias("events"), F.count_distinct("event_id").alias("keys"))


@query("history_last_two_versions", """
    WITH ranked AS (
      SELECT o_orderkey AS Id, o_custkey AS PersonId, o_orderstatus AS stage,
             CAST(o_orderdate AS TIMESTAMP) AS eff,
             row_number() OVER (PARTITION BY o_custkey
                                ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders),
    recent AS (SELECT PersonId FROM ranked
               WHERE rn = 1 AND eff >= TIMESTAMP '2001-07-20 00:00:00' - INTERVAL 26 HOUR)
    SELECT Id, PersonId, stage, CAST(eff AS DATE) AS effective, rn
    FROM ranked WHERE rn <= 2 AND PersonId IN (SELECT PersonId FROM recent)""",
       wide=("rn",))
def history_last_two_versions(spark, sf_dir):
    history = I.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Id"), F.col("o_custkey").alias("PersonId"),
        F.col("o_orderstatus").alias("stage"), F.col("o_orderdate").alias("EffectiveDate"))
    out = bronze.history_incremental(history, "2001-07-20 00:00:00")
    return out.select("Id", "PersonId", "stage",
                      F.to_date("EffectiveDate").alias("effective"), "rn")


_TEXT = {"event_id": "CAST(event_id AS STRING)", "event_type": "event_type",
         "value": "CAST(value AS STRING)", "is_high": "CAST(value > 100 AS STRING)",
         "mixed": "CASE WHEN value > 50 THEN event_type ELSE CAST(user_id AS STRING) END",
         "empty": "CAST(NULL AS STRING)",
         "day": "CAST(CAST(ts AS DATE) AS STRING)"}
_TEXT_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, {e} AS v FROM events" for name, e in _TEXT.items())


@query("infer_types", f"""
    WITH cells AS ({_TEXT_SQL}),
    counts AS (
      SELECT column_name, count(v) AS present,
             count(*) FILTER (lower(v) IN ('true', 'false')) AS boolean,
             count(*) FILTER (regexp_full_match(v, '[+-]?[0-9]+')) AS bigint,
             count(*) FILTER (regexp_full_match(v, '[+-]?[0-9]+([.][0-9]*)?(E[+-]?[0-9]+)?'))
               AS double,
             count(*) FILTER (regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')) AS days
      FROM cells GROUP BY column_name)
    SELECT column_name, present, boolean, bigint, double,
           CASE WHEN present = 0 THEN 'string' WHEN boolean = present THEN 'boolean'
                WHEN bigint = present THEN 'bigint' WHEN double = present THEN 'double'
                WHEN days = present THEN 'timestamp' ELSE 'string' END AS decided
    FROM counts""")
def infer_types(spark, sf_dir):
    text = I.mapped(I.table(spark, sf_dir, "events"), _TEXT)
    return bronze.infer_types(text).drop("timestamp")


# A batch that changes overdrawn customers and adds a copy of the richest ones
# under new ids; the balance arrives as text and is cast to the target's type.
_BATCH_SQL = """
    SELECT c_custkey AS Id, 'renamed' AS Name, CAST(round(c_acctbal + 100, 2) AS DOUBLE)
           AS Balance FROM customer WHERE c_acctbal < 0
    UNION ALL
    SELECT -1 - c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 9900"""


def _merge_sides(spark, sf_dir):
    customer = I.table(spark, sf_dir, "customer")
    target = customer.select(
        F.col("c_custkey").alias("Id"), F.col("c_name").alias("Name"),
        F.col("c_acctbal").alias("Balance"), F.col("c_mktsegment").alias("Segment"),
        F.lit("old").alias("_loaded_at"), F.lit("first").alias("_source_system"))
    changed = customer.where("c_acctbal < 0").select(
        F.col("c_custkey").alias("Id"), F.lit("renamed").alias("Name"),
        F.round(F.col("c_acctbal") + 100, 2).cast("string").alias("Balance"))
    added = customer.where("c_acctbal > 9900").select(
        (-1 - F.col("c_custkey")).alias("Id"), F.col("c_name").alias("Name"),
        F.col("c_acctbal").cast("string").alias("Balance"))
    batch = changed.unionByName(added).withColumns(
        {"_loaded_at": F.lit("new"), "_source_system": F.lit("second")})
    return target, batch


@query("merge_upsert", f"""
    WITH batch AS ({_BATCH_SQL})
    SELECT c.c_custkey AS Id, coalesce(b.Name, c.c_name) AS Name,
           coalesce(b.Balance, c.c_acctbal) AS Balance, c.c_mktsegment AS Segment,
           CASE WHEN b.Id IS NULL THEN 'old' ELSE 'new' END AS _loaded_at,
           'first' AS _source_system
    FROM customer c LEFT JOIN batch b ON b.Id = c.c_custkey
    UNION ALL
    SELECT Id, Name, Balance, NULL, 'new', 'second' FROM batch
    WHERE Id NOT IN (SELECT c_custkey FROM customer)""")
def merge_upsert(spark, sf_dir):
    target, batch = _merge_sides(spark, sf_dir)
    return tables.merge_upsert(target, batch, ["Id"], ["Name", "Balance", "_loaded_at"])


@query("merge_newest_staged", """
    WITH newest AS (SELECT user_id, event_type, value FROM events
                    QUALIFY row_number() OVER (PARTITION BY user_id
                                               ORDER BY ts DESC, event_id DESC) = 1)
    SELECT c_custkey AS user_id, coalesce(event_type, c_mktsegment) AS event_type,
           coalesce(value, c_acctbal) AS value
    FROM customer LEFT JOIN newest ON user_id = c_custkey
    UNION ALL
    SELECT user_id, event_type, value FROM newest
    WHERE user_id NOT IN (SELECT c_custkey FROM customer)""")
def merge_newest_staged(spark, sf_dir):
    """Appended staging holds a person many times: the newest row is merged."""
    target = I.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("event_type"),
        F.col("c_acctbal").alias("value"))
    staged = I.table(spark, sf_dir, "events").select(
        "user_id", "event_type", "value", "ts", "event_id")
    newest = tables.newest_staged(staged, "user_id", ["ts", "event_id"])
    return tables.merge_upsert(target, newest, ["user_id"])


_DAILY_SQL = ("SELECT CAST(ts AS DATE) AS day, event_type AS gathering, count(*) AS views "
              "FROM events GROUP BY 1, 2")


def _daily(spark, sf_dir):
    return (I.table(spark, sf_dir, "events")
            .groupBy(F.to_date("ts").alias("day"), F.col("event_type").alias("gathering"))
            .agg(F.count("*").alias("views")))


@query("merge_insert_only", f"""
    WITH batch AS ({_DAILY_SQL})
    SELECT day, gathering, CASE WHEN day < DATE '2024-01-20' THEN 0 ELSE views END AS views,
           CASE WHEN day < DATE '2024-01-20' THEN 'first' ELSE 'second' END AS run
    FROM batch""")
def merge_insert_only(spark, sf_dir):
    """Days already stored keep their first values."""
    batch = _daily(spark, sf_dir)
    stored = batch.where("day < DATE '2024-01-20'").select(
        "day", "gathering", F.lit(0).cast("bigint").alias("views"), F.lit("first").alias("run"))
    return tables.merge_insert_only(stored, batch.withColumn("run", F.lit("second")),
                                    ["day", "gathering"])


@query("existing_key_probe", f"""
    WITH batch AS ({_DAILY_SQL})
    SELECT day, gathering, views FROM batch
    WHERE NOT (day IN (DATE '2024-01-07', DATE '2024-01-14') AND gathering <> 'error')""")
def existing_key_probe(spark, sf_dir):
    """Rows already stored for the probed dates are dropped before the insert."""
    batch = _daily(spark, sf_dir)
    stored = batch.where("gathering <> 'error'")
    probed = tables.existing_keys(stored, "day", [F.lit(d).cast("date") for d in
                                                  ("2024-01-07", "2024-01-14")],
                                  ["day", "gathering"])
    return tables.missing_only(batch, probed, ["day", "gathering"])


@query("reconcile_deletes", """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'""")
def reconcile_deletes(spark, sf_dir):
    orders = I.table(spark, sf_dir, "orders")
    target = orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return tables.remove_deleted(target, orders.where("o_orderstatus <> 'P'"), "o_orderkey")


@query("reconcile_deletes_report", """
    SELECT o_orderstatus, count(*) AS removed FROM orders WHERE o_orderstatus = 'P'
    GROUP BY o_orderstatus""")
def reconcile_deletes_report(spark, sf_dir):
    orders = I.table(spark, sf_dir, "orders")
    gone = tables.deleted_rows(orders.select("o_orderkey", "o_orderstatus"),
                               orders.where("o_orderstatus <> 'P'"), "o_orderkey")
    return gone.groupBy("o_orderstatus").agg(F.count("*").alias("removed"))


def _json_events(spark, sf_dir):
    """A JSON array per event: its props, a bad number, and an empty object."""
    text = F.concat(F.lit("["), "props", F.lit(',{"k":"'), "event_type", F.lit('"},{}]'))
    return I.table(spark, sf_dir, "events").select("event_id", text.alias("rows_json"))


@query("json_rows", """
    SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
    UNION ALL SELECT event_id, NULL FROM events
    UNION ALL SELECT event_id, NULL FROM events""")
def json_rows(spark, sf_dir):
    return bronze.json_rows(_json_events(spark, sf_dir), "rows_json", {"k": "bigint"},
                            safe=True, keep=["event_id"])


@query("json_rows_strict", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           CAST(NULL AS BOOLEAN) AS was_live
    FROM events""")
def json_rows_strict(spark, sf_dir):
    wrapped = I.table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("["), "props", F.lit("]")).alias("rows_json"))
    return bronze.json_rows(wrapped, "rows_json", {"k": "bigint", "was_live": "boolean"},
                            keep=["event_id"])


@query("dedupe_first_seen", """
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""")
def dedupe_first_seen(spark, sf_dir):
    pages = I.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type",
                                                    "value")
    return bronze.first_seen(pages, "user_id", ["ts", "event_id"]).drop("ts")


_CELLS = {"event_id": "event_id",
          "amount": "CASE WHEN value > 150 THEN event_type "
                    "ELSE CAST(CAST(floor(value) AS BIGINT) AS STRING) END",
          "person": "CASE WHEN value > 200 THEN 'p-7' ELSE CAST(user_id AS STRING) END"}


@query("type_mismatch_report", f"""
    WITH cells AS ({I.select_sql('events', _CELLS)}),
    numbered AS (SELECT *, row_number() OVER (ORDER BY event_id) AS row_number FROM cells)
    SELECT row_number, 'amount' AS column_name, amount AS value FROM numbered
    WHERE NOT regexp_full_match(amount, '[0-9]+')
    UNION ALL SELECT row_number, 'person', person FROM numbered
    WHERE NOT regexp_full_match(person, '[0-9]+')""")
def type_mismatch_report(spark, sf_dir):
    cells = I.mapped(I.table(spark, sf_dir, "events"), _CELLS)
    return bronze.type_mismatches(cells, {"amount": "double", "person": "bigint"}, "event_id")


# --- audience snapshots ------------------------------------------------------------------

# Two runs whose periods overlap and together cover the table.
_FIRST_RUN = "ts < TIMESTAMP '2024-01-15 00:00:00'"
_SECOND_RUN = "ts >= TIMESTAMP '2024-01-10 00:00:00'"
_VIEWS = "CAST(floor(value * 10) AS BIGINT)"


def _payloads(spark, sf_dir, period):
    """One JSON array per event of a run's period, as a media job would land it."""
    events = I.table(spark, sf_dir, "events").where(period)
    record = F.struct(
        F.col("event_id").cast("string").alias("video_id"), F.col("event_type").alias("title"),
        F.date_format("ts", "yyyy-MM-dd").alias("published_at"),
        F.expr(_VIEWS).alias("views"), F.expr(f"{_VIEWS} + 1").alias("total_views"),
        F.lit("analytics_live").alias("views_source"), (F.col("value") > 50).alias("was_live"))
    return events.select(F.to_json(F.array(record)).alias("rows_json"))


@query("snapshot_upsert", f"""
    SELECT CAST(event_id AS VARCHAR) AS video_id,
           CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 'old' ELSE event_type END AS title,
           {_VIEWS} AS views, value > 50 AS was_live,
           CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 14 ELSE 21 END AS taken_on
    FROM events""")
def snapshot_upsert(spark, sf_dir):
    """A first snapshot, then a run that refreshes some of its videos and adds others."""
    stored = snapshots.unpack_a(_payloads(spark, sf_dir, _FIRST_RUN),
                                "rows_json").withColumns({
        "title": F.lit("old"), "snapshot_taken_at": F.lit("2024-01-14").cast("timestamp")})
    rows = snapshots.unpack_a(_payloads(spark, sf_dir, _SECOND_RUN), "rows_json")
    merged = snapshots.merge_snapshot(stored, rows, "2024-01-21 21:00:00")
    return merged.select("video_id", "title", "views", "was_live",
                         F.dayofmonth("snapshot_taken_at").alias("taken_on"))


@query("titles_upsert", """
    SELECT CAST(event_id AS VARCHAR) AS video_id, strftime(ts, '%Y-%m-%d') AS published_at,
           CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 'old' ELSE event_type END AS title
    FROM events""")
def titles_upsert(spark, sf_dir):
    stored = snapshots.unpack_a(
        _payloads(spark, sf_dir, _FIRST_RUN), "rows_json").select(
        "video_id", F.lit("old").alias("title"), "published_at")
    rows = snapshots.unpack_a(_payloads(spark, sf_dir, _SECOND_RUN), "rows_json")
    return snapshots.merge_titles(stored, rows)


@query("platform_b_insert", """
    WITH b AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n,
                      max(event_id) AS id FROM events GROUP BY 1, 2)
    SELECT day AS sunday_date, event_type AS gathering, CAST(id AS VARCHAR) AS video_id,
           CASE WHEN event_type = 'error' THEN NULL ELSE n END AS one_minute_views,
           CASE WHEN day < DATE '2024-01-08' THEN 7 ELSE 14 END AS taken_on
    FROM b""")
def platform_b_insert(spark, sf_dir):
    """Safely unpacked rows are added only for gatherings not stored yet."""
    daily = (I.table(spark, sf_dir, "events")
             .groupBy(F.to_date("ts").alias("sunday_date"), F.col("event_type").alias("gathering"))
             .agg(F.count("*").alias("n"), F.max("event_id").alias("id")))
    record = F.struct(
        F.col("id").cast("string").alias("video_id"), "gathering",
        F.col("sunday_date").cast("string").alias("sunday_date"),
        F.when(F.col("gathering") == "error", F.lit("n/a"))
        .otherwise(F.col("n").cast("string")).alias("one_minute_views"))
    rows = snapshots.unpack_b(daily.select(F.to_json(F.array(record)).alias("j")), "j")
    stored = rows.where("sunday_date < DATE '2024-01-08'").withColumn(
        "snapshot_taken_at", F.lit("2024-01-07 21:00:00").cast("timestamp"))
    out = snapshots.insert_missing(stored, rows, "2024-01-14 21:00:00")
    return out.select("sunday_date", "gathering", "video_id", "one_minute_views",
                      F.dayofmonth("snapshot_taken_at").alias("taken_on"))


_ENCODED = {"o_orderkey": "o_orderkey",
            "is_open": "CASE o_orderstatus WHEN 'O' THEN true WHEN 'F' THEN false END",
            "created": "CAST(o_orderdate AS TIMESTAMP)", "amount": "o_totalprice",
            "percentile": "o_custkey"}


@query("source_encodings", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'true' WHEN 'F' THEN 'false' END AS is_open,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS created,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount,
           CAST(o_custkey AS DOUBLE) AS percentile
    FROM orders""")
def source_encodings(spark, sf_dir):
    rows = I.mapped(I.table(spark, sf_dir, "orders"), _ENCODED)
    out = bronze.encode_for_extract(rows, ["is_open"], ["created"], ["amount"], ["percentile"])
    return out.withColumn("amount", as_col("amount").cast("string"))


@query("full_load_roundtrip", """
    SELECT year(o_orderdate) AS created_year,
           CASE WHEN o_orderdate >= TIMESTAMP '2001-06-01' THEN 'F' ELSE o_orderstatus END
             AS o_orderstatus, count(*) AS orders
    FROM orders GROUP BY 1, 2""", wide=("created_year",))
def full_load_roundtrip(spark, sf_dir):
    """Orders written in full, a changed batch merged into the partitions it touches,
    and the folder read back and summarised."""
    folder = shared_folder(spark, "full-load")
    orders = I.table(spark, sf_dir, "orders").withColumn(
        "created_year", F.year("o_orderdate"))
    path = f"{folder}/orders"
    tables.write_folder(orders, path, "created_year")
    late = orders.where("o_orderdate >= TIMESTAMP '2001-06-01 00:00:00'").withColumn(
        "o_orderstatus", F.lit("F"))
    tables.upsert_partitions(late, path, ["o_orderkey"], "created_year")
    return (spark.read.parquet(path).groupBy("created_year", "o_orderstatus")
            .agg(F.count("*").alias("orders")))


# --- the real load path ---------------------------------------------------------------------

_FIRST, _SECOND = "2000-06-01 00:00:00", "2002-02-01 00:00:00"
_LOADED_SQL = f"""
    SELECT CASE WHEN o_orderkey % 5 = 0 AND o_orderdate < TIMESTAMP '{_FIRST}' THEN 'E'
                ELSE o_orderstatus END AS o_orderstatus, count(*) AS orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)) * 100) AS BIGINT) AS cents,
           'private_note' AS left_out
    FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY 1"""


def _load_path(spark, sf_dir, by_month=False):
    """Orders loaded in full, then a batch of edits and new orders merged, then the orders
    gone at the source removed, all through load_table; what the table then holds."""
    name = f"loaded_orders_{os.urandom(4).hex()}"
    config = TableConfig(
        "dbo.Orders", name, "o_orderkey", "modified",
        ("o_orderkey", "o_orderstatus", "o_totalprice", "created", "modified"),
        ("o_totalprice",), "created")
    source = I.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("string"),
        F.col("o_orderdate").cast("timestamp").alias("created"),
        F.col("o_custkey").alias("private_note"))
    old = F.col("created") < F.lit(_FIRST).cast("timestamp")
    first = source.where(old).withColumn("modified", F.col("created"))
    tables.load_table(spark, first, config, _FIRST, "full", by_month=by_month)
    edited = source.where(old & (F.col("o_orderkey") % 5 == 0)).withColumn(
        "o_orderstatus", F.lit("E"))
    batch = first.unionByName(edited.unionByName(source.where(~old)).withColumn(
        "modified", F.lit("2002-01-31 12:00:00").cast("timestamp")))
    tables.load_table(spark, batch, config, _SECOND, "incremental", by_month=by_month)
    left = source.where("o_orderkey % 7 <> 0")
    tables.reconcile(spark, name, left, "o_orderkey", by_month)
    stored = spark.table(name)
    missing = sorted(set(source.columns) - set(stored.columns))
    return stored.groupBy("o_orderstatus").agg(
        F.count("*").alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("bigint").alias("cents")
    ).withColumn("left_out", F.lit(",".join(missing)))


@query("load_path_table", _LOADED_SQL)
def load_path_table(spark, sf_dir):
    return _load_path(spark, sf_dir)


@query("load_path_folder", _LOADED_SQL)
def load_path_folder(spark, sf_dir):
    """The same, kept by month of creation."""
    return _load_path(spark, sf_dir, by_month=True)


# --- versioned tables -------------------------------------------------------------------------

# Orders whose time is not known at first, and orders that are dated 45 days later afterwards.
_UNKNOWN, _MOVED = "o_orderkey % 11 = 0", "o_orderkey % 13 = 0"
_AFTER_SQL = f"""CASE WHEN {_UNKNOWN} THEN o_orderdate
    WHEN {_MOVED} THEN o_orderdate + INTERVAL 45 DAY ELSE o_orderdate END"""


@query("load_path_moves", f"""
    SELECT CAST(strftime({_AFTER_SQL}, '%Y%m') AS INT) AS _month,
           CASE WHEN {_UNKNOWN} OR {_MOVED} THEN 'M' ELSE o_orderstatus END AS o_orderstatus,
           count(*) AS orders, count(DISTINCT o_orderkey) AS keys
    FROM orders GROUP BY 1, 2""")
def load_path_moves(spark, sf_dir):
    """Creation times that become known or are corrected, through the load path of a table
    kept by month: no key is in two months."""
    name = f"moved_orders_{os.urandom(4).hex()}"
    config = TableConfig("dbo.Orders", name, "o_orderkey", "modified",
                         ("o_orderkey", "o_orderstatus", "created", "modified"), (), "created")
    source = I.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("timestamp").alias("created"))
    first = source.withColumn("created", F.expr(f"CASE WHEN NOT {_UNKNOWN} THEN created END"))
    tables.load_table(spark, first.withColumn("modified", F.lit(_FIRST).cast("timestamp")),
                      config, _FIRST, "full", by_month=True)
    later = source.where(f"{_UNKNOWN} OR {_MOVED}").withColumns({
        "o_orderstatus": F.lit("M"), "modified": F.lit(_SECOND).cast("timestamp"),
        "created": F.expr(f"CASE WHEN {_UNKNOWN} THEN created "
                          "ELSE created + INTERVAL '45' DAY END")})
    tables.load_table(spark, later, config, _SECOND, "incremental", by_month=True)
    return spark.table(name).groupBy("_month", "o_orderstatus").agg(
        F.count("*").alias("orders"), F.count_distinct("o_orderkey").alias("keys"))


def _events_by_day(spark, sf_dir, name):
    events = I.table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.to_date("ts").alias("day"))
    versions.replace(events, name, ["event_id"], "day")
    return events


@query("merge_versions", """
    WITH d AS (SELECT CAST(ts AS DATE) AS day, event_type FROM events),
    b AS (SELECT 'before' AS step, day, event_type AS kind FROM d
          UNION ALL SELECT 'died', day, event_type FROM d
          UNION ALL SELECT 'merged', CASE WHEN event_type = 'signup' THEN day + 1 ELSE day END,
                           CASE WHEN event_type = 'signup' THEN 'second' ELSE event_type END
                    FROM d)
    SELECT step, CAST(day AS DATE) AS day, kind, count(*) AS events FROM b GROUP BY 1, 2, 3
    UNION ALL SELECT 'refused', NULL, NULL, 1
    UNION ALL SELECT 'left over', NULL, NULL, 0""")
def merge_versions(spark, sf_dir):
    """A merge over many days that dies before its commit leaves the table as it was; of two
    writers that started together the second is refused; what they left is dropped."""
    name = f"versioned_{os.urandom(4).hex()}"
    events = _events_by_day(spark, sf_dir, name)

    def seen(step):
        return spark.table(name).groupBy("day", F.col("event_type").alias("kind")).agg(
            F.count("*").alias("events")).select(F.lit(step).alias("step"), "day", "kind", "events")

    def written(step):
        path = f"{shared_folder(spark, 'versions')}/{step}"
        seen(step).write.parquet(path)
        return spark.read.parquet(path)

    out = written("before")
    base = versions.manifest(spark, name)
    signups = events.where("event_type = 'signup'").withColumn("day", F.date_add("day", 1))
    versions.stage(signups.withColumn("event_type", F.lit("first")), name, ["event_id"], "day")
    out = out.unionByName(written("died"))
    versions.upsert(signups.withColumn("event_type", F.lit("second")), name)
    refused = 0
    try:  # a writer that still starts from the first manifest
        versions.rewrite(signups.withColumn("event_type", F.lit("third")), name, base, ())
    except versions.Conflict:
        refused = 1
    out = out.unionByName(written("merged"))
    versions.expire(spark, name, grace_hours=0.0)
    used = {p.data for p in versions.manifest(spark, name).parts}
    left = [t for t in versions.data_tables(spark, name) if t not in used]
    return out.unionByName(spark.createDataFrame(
        [("refused", None, None, refused), ("left over", None, None, len(left))], out.schema))


@query("key_index_probe", """
    SELECT CAST(count(*) AS BIGINT) AS probed, CAST(count(*) FILTER (event_id % 2 = 0) AS BIGINT)
             AS found, CAST(0 AS BIGINT) AS missed, true AS few_false
    FROM events""")
def key_index_probe(spark, sf_dir):
    """Every event looked up through the index of a table that holds every second one: how
    many pairs of key and day are possible, and whether false ones stay below 3 in 100 of
    the days a key could be ruled out of."""
    name = f"indexed_{os.urandom(4).hex()}"
    events = I.table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))
    held_events = events.where("event_id % 2 = 0")
    versions.replace(held_events, name, ["event_id"], "day")
    held = versions.manifest(spark, name)
    pairs = versions.candidates(spark, held, events.select("event_id"))
    true = held_events.select("event_id", versions.text_of("day").alias("value"),
                              F.lit(1).alias("is_true"))
    counted = pairs.join(true, ["event_id", "value"], "left").agg(
        F.count("*").alias("pairs"), F.count("is_true").alias("hits"))
    sent = events.agg(F.count("*").alias("probed"), F.count_if(F.col("event_id") % 2 == 0)
                      .alias("held"))
    both = counted.unionByName(sent, allowMissingColumns=True).agg(
        *[F.sum(c).alias(c) for c in ("pairs", "hits", "probed", "held")])
    false = F.col("pairs") - F.col("hits")
    return both.select(
        "probed", F.col("hits").alias("found"), (F.col("held") - F.col("hits")).alias("missed"),
        (false <= 0.03 * (F.col("probed") * len(held.parts) - F.col("hits"))).alias("few_false"))


# --- comparing keys by digests ---------------------------------------------------------------

_GONE = "o_orderstatus = 'P' AND o_orderkey % 4096 < 1024"


@query("reconcile_by_digest", f"""
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE NOT ({_GONE})""")
def reconcile_by_digest(spark, sf_dir):
    """The delete pass with keys compared by digests of ranges."""
    orders = I.table(spark, sf_dir, "orders")
    target = orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    gone = digests.gone_keys(target, orders.where(f"NOT ({_GONE})"), "o_orderkey")
    return target.join(gone, "o_orderkey", "left_anti")


@query("digest_fetches", f"""
    WITH r AS (SELECT DISTINCT o_orderkey // 256 AS r FROM orders WHERE {_GONE})
    SELECT (SELECT count(*) FROM orders WHERE {_GONE}) AS gone,
           (SELECT count(*) FROM orders WHERE o_orderkey // 256 IN (SELECT r FROM r)) AS fetched""")
def digest_fetches(spark, sf_dir):
    """How many keys the delete pass looks at one by one: those near a change."""
    orders = I.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    a, b = digests.near_changes(orders, orders.where(f"NOT ({_GONE})"), "o_orderkey")
    return a.join(b.withColumn("here", F.lit(1)), "o_orderkey", "left").agg(
        F.count_if(F.col("here").isNull()).alias("gone"), F.count("*").alias("fetched"))
