"""Queries over the data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality, warehouse
from ..operators import staging as S
from . import inputs as I
from .registry import query


@query("quality_unique", """
    SELECT 'orders.o_orderkey' AS check_name, count(*) AS failures, 'error' AS severity
    FROM (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'lineitem.order_line', count(*), 'warn'
    FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'customer.c_custkey', count(*), 'error'
    FROM (SELECT 1 FROM customer GROUP BY c_custkey HAVING count(*) > 1)
    UNION ALL SELECT 'events.event_id', count(*), 'error'
    FROM (SELECT 1 FROM events GROUP BY event_id HAVING count(*) > 1)""")
def quality_unique(spark, sf_dir):
    def t(name):
        return I.table(spark, sf_dir, name)

    return quality.together([
        quality.unique(t("orders"), ["o_orderkey"], "orders.o_orderkey"),
        quality.unique(t("lineitem"), ["l_orderkey", "l_linenumber"], "lineitem.order_line",
                       "warn"),
        quality.unique(t("customer"), ["c_custkey"], "customer.c_custkey"),
        quality.unique(t("events"), ["event_id"], "events.event_id")])


@query("quality_not_null", f"""
    WITH p AS ({I.select_sql('customer', I.PEOPLE_MAP)}),
    r AS ({I.select_sql(I.REQUEST_SOURCE, I.REQUEST_MAP)})
    SELECT 'people.person_id' AS check_name, count(*) FILTER (Id IS NULL) AS failures,
           'error' AS severity FROM p
    UNION ALL SELECT 'people.full_name', count(*) FILTER (LastName IS NULL), 'error' FROM p
    UNION ALL SELECT 'people.birth_date', count(*) FILTER (BirthDay IS NULL), 'error' FROM p
    UNION ALL SELECT 'requests.connector_person_alias_id',
                     count(*) FILTER (ConnectorPersonAliasId IS NULL), 'warn' FROM r""")
def quality_not_null(spark, sf_dir):
    people = S.people(I.people_bronze(spark, sf_dir))
    requests = S.connection_requests(I.requests_bronze(spark, sf_dir))
    return quality.together([
        quality.not_null(people, ["person_id", "full_name", "birth_date"], "people"),
        quality.not_null(requests, ["connector_person_alias_id"], "requests", "warn")])


@query("quality_relationship", f"""
    WITH a AS ({I.ALIAS_SQL}), r AS ({I.select_sql(I.REQUEST_SOURCE, I.REQUEST_MAP)})
    SELECT 'requests.connector' AS check_name, count(*) AS failures, 'warn' AS severity
    FROM r WHERE ConnectorPersonAliasId IS NOT NULL
      AND ConnectorPersonAliasId NOT IN (SELECT Id FROM a)
    UNION ALL SELECT 'lineitem.order', count(*), 'warn' FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'supplier.parent', count(*), 'warn' FROM supplier
    WHERE s_nationkey NOT IN (SELECT s_suppkey FROM supplier)""")
def quality_relationship(spark, sf_dir):
    """Connectors without an alias, lines without an order, and a self reference."""
    aliases = S.person_aliases(I.aliases_bronze(spark, sf_dir))
    requests = S.connection_requests(I.requests_bronze(spark, sf_dir))
    orders = I.table(spark, sf_dir, "orders")
    supplier = I.table(spark, sf_dir, "supplier")
    return quality.together([
        quality.relationship(requests, "connector_person_alias_id", aliases, "person_alias_id",
                             "requests.connector"),
        quality.relationship(I.table(spark, sf_dir, "lineitem"), "l_orderkey", orders,
                             "o_orderkey", "lineitem.order"),
        quality.relationship(supplier, "s_nationkey", supplier, "s_suppkey",
                             "supplier.parent")])


@query("quality_accepted", """
    SELECT 'orders.status' AS check_name, count(*) FILTER (o_orderstatus NOT IN ('F', 'O'))
             AS failures, 'error' AS severity FROM orders
    UNION ALL SELECT 'lineitem.flag', count(*) FILTER (l_returnflag NOT IN ('A', 'N', 'R')),
                     'error' FROM lineitem""")
def quality_accepted(spark, sf_dir):
    return quality.together([
        quality.accepted_values(I.table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O"],
                                "orders.status"),
        quality.accepted_values(I.table(spark, sf_dir, "lineitem"), "l_returnflag",
                                ["A", "N", "R"], "lineitem.flag")])


@query("quality_freshness", """
    WITH h AS (SELECT epoch(TIMESTAMP '2024-02-01 12:00:00') - epoch(max(ts)) AS s,
                      event_type FROM events GROUP BY event_type)
    SELECT event_type AS check_name, CAST(floor(floor(s) / 3600) AS BIGINT) AS hours_old,
           CASE WHEN floor(s) / 3600 > 48 THEN 'error' WHEN floor(s) / 3600 > 30 THEN 'warn'
                ELSE 'pass' END AS state
    FROM h""")
def quality_freshness(spark, sf_dir):
    return quality.freshness_by(I.table(spark, sf_dir, "events"), "event_type", "ts",
                                "2024-02-01 12:00:00")


@query("quality_row_counts", """
    SELECT 'people' AS check_name, 0::BIGINT AS failures, 'error' AS severity
    UNION ALL SELECT 'current_history', (SELECT count(*) FROM orders WHERE o_orderstatus <> 'O'),
                     'error'""")
def quality_row_counts(spark, sf_dir):
    """Staging keeps every row; a filtered model is reported with what it lost."""
    bronze = I.people_bronze(spark, sf_dir)
    orders = I.table(spark, sf_dir, "orders")
    return quality.together([
        quality.same_row_count(bronze, S.people(bronze), "people"),
        quality.same_row_count(orders, orders.where("o_orderstatus = 'O'"), "current_history")])


@query("quality_models", f"""
    WITH a AS ({I.ALIAS_SQL}),
    g AS (SELECT DISTINCT * FROM ({I.select_sql('events', I.TEAM_MAP)})),
    failed AS (
      SELECT 'not_null.people.email' AS check_name, (SELECT count(*) FROM customer) AS failures,
             'warn' AS severity
      UNION ALL SELECT 'unique.person_current.person_id', (SELECT count(*) FROM (
        SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' GROUP BY 1 HAVING count(*) > 1)),
        'error'
      UNION ALL SELECT 'reference.financial_accounts.parent_account_id', (
        SELECT count(*) FROM part WHERE p_partkey - p_size NOT IN (SELECT p_partkey FROM part)),
        'warn'
      UNION ALL SELECT 'not_null.financial_transaction_details.financial_transaction_detail_id',
        (SELECT count(*) FROM lineitem), 'error'
      UNION ALL SELECT 'reference.group_members.person_id', (SELECT count(*) FROM (
        SELECT DISTINCT user_id, event_type FROM events)
        WHERE user_id NOT IN (SELECT c_custkey FROM customer)), 'warn')
    SELECT * FROM failed WHERE failures > 0""")
def quality_models(spark, sf_dir):
    """Every check of the silver models; the ones that find something."""
    models = warehouse.silver(I.bronze(spark, sf_dir), I.AS_OF)
    return warehouse.checks(models).where("failures > 0")


@query("quality_bronze", """
    SELECT 'not_null.financial_transaction_details.Id' AS check_name, count(*) AS failures,
           'error' AS severity FROM lineitem
    UNION ALL SELECT 'freshness.people', 1, 'warn'""")
def quality_bronze(spark, sf_dir):
    """Keys, freshness and row counts of the fifteen source tables; those that find something."""
    bronze = I.bronze(spark, sf_dir)

    def stamped(name):
        df = bronze(name)
        return df.drop("_loaded_at").withColumn("_loaded_at", F.lit("2024-01-31 06:00:00").cast(
            "timestamp")) if name == "people" else df

    return warehouse.bronze_checks(stamped, "2024-02-01 18:00:00").where("failures > 0")
