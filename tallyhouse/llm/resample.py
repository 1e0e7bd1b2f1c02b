"""Importance resampling towards the distribution of target texts.

Features are runs of words, hashed by CRC-32 into buckets. A document is scanned once: its
words, one space between them, give a running CRC at the end of every word. The CRC of any
run then follows from two of these by cancelling the part before it: with |B| the bytes of
B, crc(B) = crc(AB) xor shift(crc(A), |B|), where shift, appending zero bytes, is linear
over GF(2) and is applied by tables for powers of two. So longer runs need no second pass.

A bucket's gain is the logarithm of how much more frequent it is in the target; a document
weighs the sum of its gains, and Gumbel noise from a hash of its id turns the highest
scores into a sample drawn without replacement by weight.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, id_text, ship, slices

# Words of UTF-8 bytes once A-Z are lowered: digits, a-z and all beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def byte_table() -> np.ndarray:
    """What each byte leaves in the register of the reflected polynomial 0xEDB88320."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


BYTE = byte_table()


def applied(operator: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by one table for each of the four bytes."""
    return (operator[0][values & 255] ^ operator[1][(values >> 8) & 255]
            ^ operator[2][(values >> 16) & 255] ^ operator[3][values >> 24])


def shift_operators() -> list[np.ndarray]:
    """The maps that append 1, 2, 4, ... 2**31 zero bytes."""
    units = np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)
    found = [BYTE[units & 255] ^ (units >> 8)]
    while len(found) < 32:
        found.append(applied(found[-1], found[-1]))
    return found


SHIFT = shift_operators()


def shifted(crcs: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Each CRC after as many zero bytes."""
    out = crcs.copy()
    for k in range(int(zeros.max(initial=0)).bit_length()):
        on = np.flatnonzero((zeros >> k) & 1)
        out[on] = applied(SHIFT[k], out[on])
    return out


def next_word(crc: int, word: bytes) -> int:
    return crc32(word, crc32(b" ", crc))


def run_crcs(texts: Sequence[bytes], shortest: int, longest: int):
    """(words of each text, text number of each run, CRC-32 of each run) for all runs of
    `shortest` to `longest` consecutive words of one text, joined by a space."""
    words: list[bytes] = []
    ends: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        found = WORD.findall(text.lower())
        counts[k] = len(found)
        if found:
            words += found
            ends += accumulate(found[1:], next_word, initial=crc32(found[0]))
    end = np.array(ends, np.uint32)  # of the text up to the end of each word
    length = np.fromiter(map(len, words), np.int64, len(words))
    stop = np.cumsum(length + 1)
    owner = np.repeat(np.arange(len(texts)), counts)
    start = np.zeros(len(words), np.uint32)  # up to the start of each word: one space more
    state = ~end[:-1]
    start[1:] = ~(BYTE[(state ^ np.uint32(0x20)) & 255] ^ (state >> 8))
    start[np.cumsum(counts)[counts > 0] - counts[counts > 0]] = 0
    owners, crcs = [], []
    for n in range(shortest, longest + 1):
        first = np.flatnonzero(owner[:max(0, len(owner) - n + 1)] == owner[n - 1:])
        last = first + n - 1
        size = stop[last] - stop[first] + length[first]
        owners.append(owner[first])
        crcs.append(end[last] ^ shifted(start[first], size))
    return counts, np.concatenate(owners), np.concatenate(crcs)


def texts_of(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def bucket_counts(texts: DataFrame, shortest: int, longest: int, buckets: int) -> DataFrame:
    """(bucket, n): how many features of all `texts` (text) fall into a bucket, as one short
    list per task; the same bucket comes from many tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, 4 << 20):
            _, _, crcs = run_crcs(texts_of(batch), shortest, longest)
            total += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    ship(texts.sparkSession)
    return texts.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "bucket long, n long")


def gains(docs: DataFrame, target: DataFrame, shortest: int, longest: int,
          buckets: int) -> DataFrame:
    """(bucket, gain) of every bucket. The window holds `buckets` rows."""
    def counts(texts: DataFrame, name: str) -> DataFrame:
        return (bucket_counts(texts, shortest, longest, buckets)
                .groupBy("bucket").agg(F.sum("n").alias(name)))

    every = Window.partitionBy()
    rows = (docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
            .join(counts(docs, "s"), "bucket", "left").join(counts(target, "t"), "bucket", "left")
            .select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in "st"])
            .withColumns({"all_s": F.sum("s").over(every), "all_t": F.sum("t").over(every)}))
    ratio = (((F.col("t") + 1) * (F.col("all_s") + buckets))
             / ((F.col("s") + 1) * (F.col("all_t") + buckets)))
    return rows.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def weights(docs: DataFrame, gain: np.ndarray, shortest: int, longest: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each row; `gain` has a number per bucket."""
    spark = ship(docs.sparkSession)
    shared = spark.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, 4 << 20):
            words, owner, crcs = run_crcs(texts_of(batch), shortest, longest)
            of_run = own[crcs % np.uint32(len(own))]
            order = np.argsort(owner, kind="stable") if longest > shortest else slice(None)
            sums = np.append(0, np.cumsum(of_run[order]))
            features = np.bincount(owner, minlength=len(words))
            ends = np.cumsum(features)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words), pa.array(features),
                 pa.array(sums[ends] - sums[ends - features])],
                ["doc_id", "n_words", "n_features", "weight"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return id_text(docs).mapInArrow(
        run, f"doc_id {id_type}, n_words long, n_features long, weight long")


def numbered(rows: DataFrame, order: list, name: str, partitions: int) -> DataFrame:
    """`rows` with their place (1, 2, ..) in `order` as `name`: sorted by ranges, numbered
    within each, and shifted by the sizes of the ranges before (one row per range)."""
    ranged = checkpointed(rows.repartitionByRange(partitions, *order)
                          .sortWithinPartitions(*order)
                          .withColumn("_at", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_range", F.shiftright("_at", 33))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = ranged.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    place = F.col("_shift") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return ranged.join(shift, "_range").withColumn(name, place).drop("_at", "_range", "_shift")


def resample(docs: DataFrame, target: DataFrame, shortest: int = 1, longest: int = 1,
             buckets: int = 10_000, least_words: int = 20, percent: int = 10,
             seed: int = 2024, range_rows: int = 500_000) -> DataFrame:
    """doc_id, n_features, weight, score, rank of each row of `docs`; rank is null unless drawn.

    `percent` of the rows with at least `least_words` words are drawn: those of the highest
    score, ties to the smaller doc_id (a null one last; repeated rows as often as they occur).
    Null and empty texts have no features and weigh 0. The noise of a null doc_id is that of
    an empty one. An empty `docs` gives no rows; an empty `target` counts nothing. Only
    `buckets` gains reach the driver. Other columns are ignored.
    """
    found = gains(docs, target, shortest, longest, buckets).collect()
    gain = np.zeros(buckets, np.int64)
    gain[[r["bucket"] for r in found]] = [r["gain"] for r in found]
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    uniform = (F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10)
               .cast("double") + 0.5) / 4294967296
    rows = checkpointed(weights(docs, gain, shortest, longest).withColumn(
        "score", F.col("weight") + F.floor(-1000 * F.log(-F.log(uniform)))))
    may = F.col("n_words") >= least_words
    eligible = rows.where(may).count()
    drawn = percent * eligible // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]
    placed = numbered(rows.where(may), order, "rank", 1 + eligible // range_rows)
    return placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(
        rows.where(~may).withColumn("rank", F.lit(None).cast("long"))).drop("n_words")
