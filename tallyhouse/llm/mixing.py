"""Mixing sources to target weights by a low-discrepancy schedule.

Every source is a stream of words: its documents in an order shuffled by a hash, again and
again. The stream is cut into blocks of equally many words. Slots of the mixture are points
of the golden-ratio sequence; a point is mapped through the cumulative weights to its
source, and the k-th slot of a source takes the k-th block of its stream. So every stretch
of the mixture holds the sources in nearly their weights, and the whole holds them exactly:
slots beyond a source's target are dropped, and the few that it lacks follow at the end.

Only DataFrame functions. Orders are kept in parts of bounded size, so a source that holds
most of the rows is never sorted or numbered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 256  # words
GOLDEN = 2654435769  # the golden ratio's fraction in 32 bits, odd
SPAN = 1 << 32  # of the points
CELLS = 1 << 12  # of the points, by which they find their source
PART = 1 << 16  # slots that are numbered together


def sizes(docs: DataFrame, seed: int) -> DataFrame:
    """(doc_id, source, size, place) of each row; `place`, 60 bits, is the shuffled order."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digits = F.substring(F.sha2(key.cast("binary"), 256), 1, 15)
    return docs.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.conv(digits, 16, 10).cast("long").alias("place"))


def targets(sized: DataFrame, weights: Sequence[int], percent: int, most: int) -> DataFrame:
    """(source, number, source_size, target, goal): one row per source.

    The mixture has `percent` of all words, shared by weight; a source stops at `most` times
    its size and the others share the rest. In order of size over weight, the first source
    that can take its share of what the sources before it leave ends the capped ones. `goal`
    is the target in whole words.
    """
    every = Window.orderBy(F.asc_nulls_last("source"))  # one row per source
    weight = F.element_at(F.lit(list(weights)), ((F.col("number") % len(weights)) + 1).cast("int"))
    table = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
             .withColumn("number", (F.row_number().over(every) - 1).cast("long"))
             .withColumn("w", weight.cast("double"))
             .withColumn("cap", (most * F.col("source_size")).cast("double")))
    filled = Window.orderBy(F.col("cap") / F.col("w"), "number")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    zero = F.lit(0.0)
    table = (table
             .withColumn("words", F.sum("source_size").over(whole) * percent / 100
                         - F.coalesce(F.sum("cap").over(before), zero))
             .withColumn("share", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), zero))
             .withColumn("fits", F.col("words") * F.col("w") / F.col("share") <= F.col("cap"))
             .withColumn("rate", F.min_by(F.when(F.col("fits"), F.struct("words", "share")), F.when(
                 F.col("fits"), F.struct(F.col("cap") / F.col("w"), "number"))).over(whole)))
    share = F.col("rate.words") * F.col("w") / F.col("rate.share")
    table = table.withColumn("target", F.coalesce(F.least(share, "cap"), "cap"))
    return table.select("source", "number", "source_size", "target", F.least(
        F.floor(F.col("target") + 0.5), most * F.col("source_size")).alias("goal"))


def placed(sized: DataFrame, table: DataFrame, rows: int, part_rows: int) -> DataFrame:
    """`sized` with the source's columns and `start`, the word at which the row begins in its
    source's stream: counted in parts of the order, then shifted by the parts before."""
    parts = max(1, rows // part_rows)
    part = F.shiftright(F.shiftright("place", 30) * parts, 30)
    known = (sized.join(table.withColumnRenamed("source", "_source"),
                        F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
             .withColumn("part", part))
    before = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = known.groupBy("number", "part").agg(F.sum("size").alias("n")).select(
        "number", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    within = (Window.partitionBy("number", "part").orderBy("place", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (known.withColumn("start", F.coalesce(F.sum("size").over(within), F.lit(0)))
            .join(shift, ["number", "part"])
            .withColumn("start", F.col("start") + F.col("shift")).drop("part", "shift"))


def schedule(table: DataFrame, block: int) -> DataFrame:
    """(slot, number, k): the slots of the mixture in order, each with its source and the
    block of that source's stream that it takes."""
    spark = table.sparkSession
    needed = table.select("number", F.ceil(F.col("goal") / block).alias("needed")).where("needed > 0")
    slots = needed.agg(F.sum("needed")).first()[0] or 0
    upto = Window.orderBy("number")  # one row per source

    def edge(total: Column) -> Column:
        return F.floor(total.cast("double") / slots * SPAN).cast("long")

    ends = F.sum("needed").over(upto)
    width = SPAN // CELLS
    owners = (needed.withColumns({"low": edge(ends - F.col("needed")), "high": edge(ends)})
              .where("low < high")
              .withColumn("cell", F.explode(F.sequence(
                  F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width)))))
    slot = spark.range(slots).withColumnRenamed("id", "slot")
    point = F.pmod(F.pmod(F.col("slot"), F.lit(SPAN // 2)) * GOLDEN, F.lit(SPAN))
    drawn = (slot.withColumn("point", point).withColumn("cell", F.floor(F.col("point") / width))
             .join(owners, "cell").where("low <= point and point < high")
             .withColumn("part", F.floor(F.col("slot") / PART)).select("slot", "part", "number"))
    counts = drawn.groupBy("number", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("number", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    within = Window.partitionBy("number", "part").orderBy("slot")
    ranked = (drawn.withColumn("k", F.row_number().over(within) - 1)
              .join(shift, ["number", "part"]).withColumn("k", F.col("k") + F.col("shift"))
              .join(needed, "number").where("k < needed").select("slot", "number", "k"))
    got = counts.groupBy("number").agg(F.sum("n").alias("got"))
    short = needed.join(got, "number", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    lacking = short.where("got < needed").select(
        "number", F.explode(F.sequence("got", F.col("needed") - 1)).alias("k"))
    order = Window.orderBy("k", "number")  # a few rows per source
    return ranked.unionByName(lacking.select(
        (slots + F.row_number().over(order) - 1).cast("long").alias("slot"), "number", "k"))


def mixture(placed_docs: DataFrame, slots: DataFrame, block: int, most: int) -> DataFrame:
    """(slot, number, start, doc_id, from, length): the passages of the mixture. A passage is
    `length` words of a document from its word `from` on; `start` tells rows of one source
    apart. The words of a slot are its passages in order of `at`, their place in the stream."""
    laps = F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
    spans = (placed_docs.where("size > 0").withColumn("lap", laps)
             .withColumn("begin", F.col("start") + F.col("lap") * F.col("source_size"))
             .withColumn("stop", F.least(F.col("begin") + F.col("size"), F.col("goal")))
             .where("begin < stop")
             .withColumn("k", F.explode(F.sequence(
                 F.floor(F.col("begin") / block), F.floor((F.col("stop") - 1) / block)))))
    at = F.greatest("begin", F.col("k") * block)
    return slots.join(spans, ["number", "k"]).select(
        "slot", "number", "start", "doc_id", at.alias("at"), (at - F.col("begin")).alias("from"),
        (F.least(F.col("stop"), (F.col("k") + 1) * block) - at).alias("length"))


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), percent: int = 150, most: int = 2,
        block: int = BLOCK, seed: int = 1, part_rows: int = 20_000) -> tuple[DataFrame, DataFrame]:
    """(documents with their place in their source's stream, passages of the mixture).

    Sources take `weights` in turn, in code-point order, a null source last. A null or empty
    text has no words and no passage. Rows that repeat a doc_id are documents of their own;
    rows alike in doc_id and size are interchangeable. Rows without a doc_id share one place
    in the order. Empty tables, or no words at all, give an empty mixture. Other columns are
    ignored.
    """
    sized = checkpointed(sizes(docs, seed))
    table = checkpointed(targets(sized, weights, percent, most))
    streams = checkpointed(placed(sized, table, sized.count(), part_rows))
    return streams, mixture(streams, schedule(table, block), block, most)


def report(streams: DataFrame, passages: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of each document."""
    taken = passages.groupBy("number", "start").agg(F.sum("length").alias("taken"))
    return (streams.join(taken, ["number", "start"], "left")
            .select("doc_id", "size", "source_size", "target", F.when(
                F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0)
                .cast("long").alias("taken")))
