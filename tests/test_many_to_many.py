"""Pairs of rows with one key, dealt over a grid."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import lookup


def sides(spark):
    left = [(i, 0 if i < 160 else i % 7) for i in range(200)] + [(900, None)]
    right = [(i, 0 if i < 110 else i % 9) for i in range(150)] + [(900, None), (901, 77)]
    return (spark.createDataFrame(left, "g long, e long"),
            spark.createDataFrame(right, "h long, e long"), left, right)


@pytest.mark.parametrize("cell_rows", [1, 10, 1000])
def test_every_pair_once(spark, cell_rows):
    a, b, left, right = sides(spark)
    got = lookup.many_to_many(a, b, "e", "g", "h", cell_rows)
    want = sorted((g, h) for g, x in left for h, y in right if x is not None and x == y)
    assert got.columns == ["e", "g", "h"]
    assert sorted((r.g, r.h) for r in got.collect()) == want


def test_a_hot_key_is_spread_over_cells(spark, monkeypatch):
    """No cell of the hot event has more than twice the pairs of the median one."""
    left = spark.range(4000).select(F.col("id").alias("g"), F.lit(0).alias("e"))
    right = spark.range(3000).select(F.col("id").alias("h"), F.lit(0).alias("e"))
    seen = {}
    real = type(left).drop

    def drop(df, *cols):
        if cols == ("_r", "_c"):
            seen["cells"] = df.groupBy("e", "_r", "_c").count().collect()
        return real(df, *cols)

    monkeypatch.setattr(type(left), "drop", drop)
    lookup.many_to_many(left, right, "e", "g", "h", 500)
    counts = sorted(r["count"] for r in seen["cells"])
    assert len(counts) == 8 * 6 and sum(counts) == 4000 * 3000
    assert counts[-1] <= 2 * counts[len(counts) // 2]
