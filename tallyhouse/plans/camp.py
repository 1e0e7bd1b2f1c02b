"""Queries over camp orders: pivots, matrices and totals on line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import camp
from . import inputs as I
from .registry import query

# The price per unit is fixed by part and supplier bands, so rows share unit costs.
ORDERS = {"item_key": "l_partkey", "hotel_key": "l_suppkey",
          "quantity": "CAST(l_quantity AS BIGINT)",
          "unit_cost": "CAST(100 + l_partkey % 7 * 25 AS DECIMAL(18,2))",
          "status": "CASE l_returnflag WHEN 'A' THEN 160 WHEN 'N' THEN 70 ELSE 10 END",
          "is_test": "l_linestatus = 'F' AND l_linenumber = 7",
          "deleted_at": "CASE WHEN l_discount > 0.08 THEN l_shipdate END",
          "flag": "l_returnflag", "line": "l_linenumber"}
PARTS = {"item_key": "p_partkey", "item": "p_type", "brand": "p_brand"}
TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
JOINED_SQL = f"""o AS (SELECT *, quantity * unit_cost AS total_cost
                       FROM ({I.select_sql('lineitem', ORDERS)})
                            JOIN ({I.select_sql('part', PARTS)}) USING (item_key)),
    k AS (SELECT * FROM o WHERE NOT is_test AND deleted_at IS NULL AND status IN (160, 70))"""


def _kept(spark, sf_dir):
    return camp.with_total_cost(camp.counted_orders(
        I.mapped(I.table(spark, sf_dir, "lineitem"), ORDERS)))


def _names(spark, sf_dir):
    return {"names": I.mapped(I.table(spark, sf_dir, "part"), PARTS), "item": "item_key"}


def _label(column: str) -> str:
    return (f"CASE WHEN grouping({column}) = 1 THEN 'Total' "
            f"ELSE CAST({column} AS VARCHAR) END AS {column}")


def _money(df):
    return df.withColumns({c: F.col(c).cast("double") for c in df.columns
                           if c.startswith("total_cost")})


_PIVOT_COLUMNS = ", ".join(
    f"(sum(quantity) FILTER (item = '{t}'))::BIGINT AS quantity_{i}, "
    f"(sum(total_cost) FILTER (item = '{t}'))::DOUBLE AS total_cost_{i}"
    for i, t in enumerate(TYPES, start=1))


@query("pivot_rollup", f"""
    WITH {JOINED_SQL}
    SELECT {_label('unit_cost')}, {_label('brand')}, {_PIVOT_COLUMNS},
           sum(quantity)::BIGINT AS quantity, sum(total_cost)::DOUBLE AS total_cost
    FROM k GROUP BY ROLLUP (unit_cost, brand)""")
def pivot_rollup(spark, sf_dir):
    return _money(camp.pivot_matrix(_kept(spark, sf_dir), ["unit_cost", "brand"], "item", TYPES,
                                    **_names(spark, sf_dir)))


@query("matrix_subtotals", f"""
    WITH {JOINED_SQL}
    SELECT {_label('item')}, {_label('unit_cost')}, {_label('brand')},
           sum(quantity)::BIGINT AS quantity, sum(total_cost)::DOUBLE AS total_cost
    FROM k GROUP BY ROLLUP (item, unit_cost, brand)""")
def matrix_subtotals(spark, sf_dir):
    return _money(camp.matrix(_kept(spark, sf_dir), ["item", "unit_cost", "brand"],
                              **_names(spark, sf_dir)))


@query("matrix_average_cost", f"""
    WITH {JOINED_SQL}
    SELECT {_label('item')}, sum(quantity)::BIGINT AS quantity,
           sum(total_cost)::DOUBLE AS total_cost,
           round((sum(unit_cost) / count(*))::DOUBLE, 4) AS average_unit_cost
    FROM k GROUP BY ROLLUP (item)""")
def matrix_average_cost(spark, sf_dir):
    out = camp.matrix(_kept(spark, sf_dir), ["item"], True, **_names(spark, sf_dir))
    return _money(out).withColumn("average_unit_cost",
                                  F.round(F.col("average_unit_cost").cast("double"), 4))


@query("camp_totals", f"""
    WITH {JOINED_SQL}
    SELECT sum(total_cost)::DOUBLE AS total_cost,
           (SELECT max(r_regionkey) FROM region WHERE r_name = 'ASIA')
             * (sum(quantity) FILTER (item IN ('PROMO', 'SMALL')))::BIGINT AS meals_total
    FROM k""")
def camp_totals(spark, sf_dir):
    """Total cost, and a looked-up price times the quantity of two packages."""
    settings = I.mapped(I.table(spark, sf_dir, "region"),
                        {"key": "r_name", "value": "r_regionkey"})
    return _money(camp.totals(_kept(spark, sf_dir), camp.setting(settings, "ASIA"),
                              ("PROMO", "SMALL"), **_names(spark, sf_dir))).withColumn(
        "meals_total", F.col("meals_total").cast("bigint"))


@query("outstanding_by_type", f"""
    WITH {JOINED_SQL}
    SELECT {_label('flag')}, {_label('item')}, sum(quantity)::BIGINT AS quantity,
           sum(total_cost)::DOUBLE AS total_cost
    FROM k GROUP BY ROLLUP (flag, item)""")
def outstanding_by_type(spark, sf_dir):
    return _money(camp.matrix(_kept(spark, sf_dir), ["flag", "item"], **_names(spark, sf_dir)))


@query("team_chart", """
    SELECT p_brand AS group_name, count(DISTINCT l_partkey) AS groups,
           sum(CAST(l_quantity AS BIGINT))::BIGINT AS members
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_brand""")
def team_chart(spark, sf_dir):
    """Distinct groups and summed members by group name. Rows are first summed per
    group, so the distinct count is a plain count and no group is held whole."""
    per_part = I.table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_partkey").alias("p_partkey")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("members"))
    names = I.table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("group_name"))
    return per_part.join(names, "p_partkey").groupBy("group_name").agg(
        F.count("*").alias("groups"), F.sum("members").alias("members"))
