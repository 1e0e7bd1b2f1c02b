"""Camp orders: pivots with subtotals, matrices and totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_col, not_in

# Order statuses kept by the report, the prefix of item types, and
# words that mark test groups (case-sensitive).
KEPT_STATUSES = (160, 70)
TYPE_PREFIX = "App\\Models\\Event"
TEST_WORDS = ("Test", "TEST", "test")
ALL = "Total"


def item_type(orderable_type):
    return F.replace(as_col(orderable_type), F.lit(TYPE_PREFIX), F.lit(""))


def real_groups(groups: DataFrame, name: str = "name") -> DataFrame:
    """Groups not named as a test; a missing name is kept."""
    c = F.coalesce(as_col(name), F.lit(""))
    out = groups
    for word in TEST_WORDS:
        out = out.where(~c.contains(word))
    return out


def counted_orders(orders: DataFrame, statuses: Sequence[int] = KEPT_STATUSES) -> DataFrame:
    """Orders the report's model-wide filters keep."""
    return orders.where(~F.col("is_test") & F.col("deleted_at").isNull()
                        & F.col("status").isin(list(statuses)))


def with_total_cost(orders: DataFrame) -> DataFrame:
    return orders.withColumn("total_cost", F.col("quantity") * F.col("unit_cost"))


def _levels(rows: Sequence[str]):
    """Row labels of a rollup: the value, or 'Total' where the level is summed away."""
    return [F.when(F.grouping(r) == 1, ALL).otherwise(F.col(r).cast("string")).alias(r)
            for r in rows]


def _cells(orders: DataFrame, keys: Sequence[str], names: DataFrame | None,
           item: str | None) -> DataFrame:
    """Orders summed to their finest cells. Subtotals copy rows once per level, so they
    copy these instead of the orders. Keys that are attributes of the item come from
    `names` (one row per `item`), joined to sums per item: a hot item is a few rows by
    then, and the orders themselves are shuffled only after the map-side sum."""
    measures = [F.sum("quantity").alias("quantity"), F.sum("total_cost").alias("total_cost"),
                F.sum("unit_cost").alias("_unit"), F.count("unit_cost").alias("_n")]
    if names is None:
        return orders.groupBy(*keys).agg(*measures)
    own = [k for k in keys if k not in names.columns]
    return (orders.groupBy(*own, item).agg(*measures).join(names, item)
            .groupBy(*keys).agg(*[F.sum(c).alias(c) for c in
                                  ("quantity", "total_cost", "_unit", "_n")]))


def _rolled(cells: DataFrame, rows: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    labels = [c.alias(f"_{r}") for r, c in zip(rows, _levels(rows))]
    return cells.rollup(*rows).agg(*labels, *measures).drop(*rows).withColumnsRenamed(
        {f"_{r}": r for r in rows})


def matrix(orders: DataFrame, rows: Sequence[str], average_cost: bool = False,
           names: DataFrame | None = None, item: str | None = None) -> DataFrame:
    """Quantity and cost by nested rows with a subtotal at every level, and the mean
    unit cost of the orders if asked for."""
    measures = [F.sum("quantity").alias("quantity"), F.sum("total_cost").alias("total_cost")]
    if average_cost:
        measures.append(F.try_divide(F.sum("_unit"), F.sum("_n")).alias("average_unit_cost"))
    return _rolled(_cells(orders, rows, names, item), rows, measures)


def pivot_matrix(orders: DataFrame, rows: Sequence[str], column: str, values: Sequence[str],
                 names: DataFrame | None = None, item: str | None = None) -> DataFrame:
    """Quantity and cost with a column pair per listed value, a total pair, and row
    subtotals at every level."""
    measures = []
    for m in ("quantity", "total_cost"):
        measures += [F.sum(F.when(F.col(column) == v, F.col(m))).alias(f"{m}_{i}")
                     for i, v in enumerate(values, start=1)]
        measures.append(F.sum(m).alias(m))
    return _rolled(_cells(orders, [*rows, column], names, item), rows, measures)


def totals(orders: DataFrame, meal_price, meal_items: Sequence[str], package: str = "item",
           names: DataFrame | None = None, item: str | None = None) -> DataFrame:
    """Total cost, and meals as a price times the quantity of the meal packages.
    `meal_price` is a scalar (a looked-up setting)."""
    meals = F.sum(F.when(F.col(package).isin(list(meal_items)), F.col("quantity")))
    return _cells(orders, [package], names, item).agg(
        F.sum("total_cost").alias("total_cost"),
        F.coalesce(meals, F.lit(0)).alias("meals")).select(
        "total_cost", (meal_price * F.col("meals")).alias("meals_total"))


def setting(settings: DataFrame, key: str):
    """One setting's value as a scalar subquery."""
    return settings.where(F.col("key") == key).agg(F.max("value").alias("v")).scalar()


def listed_groups(groups: DataFrame, excluded_types: Sequence[str],
                  excluded_campus: int = 5) -> DataFrame:
    """Groups with an id, of no excluded type and not of the excluded campus; a
    missing type or campus is kept."""
    has_id = F.col("group_id").isNotNull() & (F.col("group_id").cast("string") != "")
    return groups.where(has_id & not_in("group_type_name", list(excluded_types))
                        & not_in("campus_id", [excluded_campus]))
