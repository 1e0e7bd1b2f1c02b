"""Near duplicates by b-bit MinHash, links confirmed on the full shingle sets.

1. Every text gets 128 minima of its shingle hashes. Groups of four make 32 band keys; the
   low two bits of all minima are packed into four longs. Texts with equal sets are one
   node from here on, so exact copies cost nothing further.
2. Nodes that share a band key are candidates. A link of similarity 0.8 shares none of the
   32 keys with a chance of 5e-8.
3. Candidates are never expanded into all pairs of a bucket. First each node is compared
   with the bucket's member that shares most keys with others, usually the text that the
   copies were made from; then, unless links already connect them, with three further
   members per bucket; and last the pairs of nodes that are not known to be connected, each in
   the first band that it shares. Two filters come before the full sets: the packed bits (six
   standard deviations below the threshold), and marks, a bitmap of the whole set: a bit of
   one text that the other lacks stands for a shingle that it lacks, which bounds the
   intersection from above and never rules out a link.
4. A pair is a link if its full sets say so. Components are found by contracting the links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, forget, id_text, join_kept, ship, slices

PERMUTATIONS, ROWS = 128, 4
OTHERS = 3  # further members of a bucket that all are compared with
BITS = 2  # kept of each minimum
MARKS_PER_SHINGLE = 4  # bits at least, up to the next power of two
MOST_MARKS = 1 << 14  # bits; longer sets fill it, and the packed bits decide alone
SMALL_IDS = 500_000  # ids that may be broadcast (8 bytes each)

_rng = np.random.Generator(np.random.PCG64(20240229))
MULTIPLY = _rng.integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 1 << 63, PERMUTATIONS, np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; a shorter text is one shingle.

    ASCII letters are lowered and ASCII white space separates words, as bytes.split does.
    """
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    size = min(words, len(found))
    n = len(found) - size + 1
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = mixed(h * MIX + hashes[k:k + n])
    return np.unique(h)


def minima(hashes: np.ndarray) -> np.ndarray:
    best = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        block = MULTIPLY[:, None] * hashes[None, at:at + 2048] + ADD[:, None]
        np.minimum(best, block.min(axis=1), out=best)
    return best


def packed(low: np.ndarray) -> np.ndarray:
    """Low bits of the minima of many texts as longs, 64 / BITS minima in each."""
    per = 64 // BITS
    shifts = np.arange(per, dtype=np.uint64) * np.uint64(BITS)
    grouped = (low & np.uint64((1 << BITS) - 1)).reshape(len(low), -1, per)
    return (grouped << shifts).sum(axis=2, dtype=np.uint64).view(np.int64)


def marked(hashes: np.ndarray) -> np.ndarray:
    """A bitmap of the set as longs; shorter bitmaps are folds of longer ones."""
    size = 64
    while size < min(MARKS_PER_SHINGLE * len(hashes), MOST_MARKS):
        size *= 2
    bits = np.zeros(size, bool)
    bits[(hashes & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.int64)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands, bits, marks) of each row; no key without a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches):
            sets = [shingle_set(t, words)
                    for t in batch.column("text").cast(pa.binary()).to_pylist()]
            low = np.array([minima(s) for s in sets], np.uint64).reshape(len(sets), PERMUTATIONS)
            keys = np.zeros((len(sets), PERMUTATIONS // ROWS), np.uint64)
            keys += np.arange(PERMUTATIONS // ROWS, dtype=np.uint64)
            for k in range(ROWS):
                keys = mixed(keys * MIX + low[:, k::ROWS])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
                           for s in sets], pa.binary()),
                 pa.array(list(keys.view(np.int64)), pa.list_(pa.int64())),
                 pa.array(list(packed(low)), pa.list_(pa.int64())),
                 pa.array([marked(s) for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "bands", "bits", "marks"])

    ship(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return id_text(docs).mapInArrow(
        run, f"doc_id {id_type}, n_shingles long, set_key binary, bands array<long>, "
             "bits array<long>, marks array<long>")


def may_link(a: Column, b: Column, na: Column, nb: Column, percent: int) -> Column:
    """False only if the sizes exclude a link or the packed bits are six standard deviations
    below what the threshold similarity gives. Of unequal minima, 1 in 2**BITS agree by
    chance: the expected share of agreement is c + (1 - c) * similarity."""
    chance, similarity = 1 / 2 ** BITS, percent / 100
    agree = chance + (1 - chance) * similarity
    least = PERMUTATIONS * agree - 6 * math.sqrt(PERMUTATIONS * agree * (1 - agree))
    every = F.lit(0x5555555555555555)  # one bit for each minimum
    unequal = sum((F.bit_count(
        (a[i].bitwiseXOR(b[i])).bitwiseOR(F.shiftrightunsigned(a[i].bitwiseXOR(b[i]), 1))
        .bitwiseAND(every)) for i in range(PERMUTATIONS * BITS // 64)), F.lit(0))
    sizes = F.least(na, nb) * 100 >= F.greatest(na, nb) * percent
    return sizes & (PERMUTATIONS - unequal >= least)


def enough_in_common(a: Column, b: Column, na: Column, nb: Column, percent: int) -> Column:
    """False only if the bitmaps prove the intersection too small for a link."""
    short = F.least(F.size(a), F.size(b))

    def folded(x: Column) -> Column:
        return F.when(F.size(x) == short, x).otherwise(F.zip_with(
            F.slice(x, 1, short), F.slice(x, short + 1, short), lambda p, q: p.bitwiseOR(q)))

    def lacking(x: Column, y: Column) -> Column:
        each = F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q))))
        return F.aggregate(each, F.lit(0), lambda total, n: total + n)

    fa, fb = folded(a), folded(b)
    most = F.least(na - lacking(fa, fb), nb - lacking(fb, fa))
    return ((F.greatest(F.size(a), F.size(b)) > 2 * short)
            | (most * (100 + percent) >= (na + nb) * percent))


def first_shared(a: Column, b: Column) -> Column:
    """The place of the first band key that two nodes share."""
    return F.coalesce(*[F.when(a[i] == b[i], F.lit(i)) for i in range(PERMUTATIONS // ROWS)])


def confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The distinct (a, b) of `pairs` whose full sets are similar enough, checkpointed."""
    pairs = checkpointed(pairs.select("a", "b").distinct())
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    if 2 * pairs.count() <= SMALL_IDS:  # else the texts are shuffled to the ids
        ids = F.broadcast(ids)
    texts = id_text(docs).join(ids, F.col("doc_id") == F.col("id"), "left_semi")
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, np.zeros(0, np.uint64)
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column("text_a").cast(pa.binary()).to_pylist(),
                              batch.column("text_b").cast(pa.binary()).to_pylist()):
                if ta != last:
                    last, last_set = ta, shingle_set(ta, words)
                other = shingle_set(tb, words)
                shared = len(np.intersect1d(last_set, other, assume_unique=True))
                union = len(last_set) + len(other) - shared
                keep.append(shared > 0 and 100 * shared >= percent * union)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return checkpointed(both.mapInArrow(run, pairs.schema))


def ranked(size: Column, node: Column | str, seed: int = 0) -> Column:
    """A number that orders nodes by `size`, then by a hash that `seed` varies."""
    return size * (1 << 20) + F.pmod(F.xxhash64(node, F.lit(seed)), F.lit(1 << 20))


def pointed(links: DataFrame, seed: int = 0) -> DataFrame:
    """(from, to): each node in `links` and its neighbour of most links, or itself if none
    has more. The hub of a star takes all its leaves at once; equal nodes of a chain are
    told apart by a hash."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.groupBy(F.col("a").alias("b")).agg(F.count("*").alias("degree"))
    rank = ranked(F.col("degree"), "b", seed)
    best = both.join(degree, "b").groupBy("a").agg(
        F.max_by("b", rank).alias("b"), F.max(rank).alias("rank"), F.count("*").alias("degree"))
    return best.select(F.col("a").alias("from"), F.when(
        F.col("rank") > ranked(F.col("degree"), "a", seed), F.col("b")).otherwise(
            F.col("a")).alias("to"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in `links` (a, b): its smallest connected node.

    Each round contracts the links to the nodes pointed at, until none is left.
    """
    ends = links.select("a", "b").where("a <> b").distinct()
    root = ends.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn(
        "root", F.col("node"))
    seed = 0
    while not ends.isEmpty():
        point = checkpointed(pointed(ends, seed))
        to_a = point.select(F.col("from").alias("a"), F.col("to").alias("na"))
        to_b = point.select(F.col("from").alias("b"), F.col("to").alias("nb"))
        ends = checkpointed(
            ends.join(to_a, "a").join(to_b, "b")
            .select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b"))
            .where("a <> b").distinct())
        root = (root.join(point, F.col("root") == F.col("from"), "left")
                .select("node", F.coalesce("to", "root").alias("root")))
        seed += 1
    least = root.groupBy("root").agg(F.min("node").alias("component"))
    return checkpointed(root.join(least, "root").select("node", "component"))


def hooked(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes in `links`: the neighbour of most links, and from
    there its own. Nodes of one such component are connected; connected nodes may have two.
    """
    point = checkpointed(pointed(links))
    further = point.select(F.col("from").alias("to"), F.col("to").alias("top"))
    return point.join(further, "to").select(F.col("from").alias("node"),
                                            F.col("top").alias("component"))


def labelled(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """`rows` (.., node) with the component of the node, itself if it has no link."""
    parts = parts.select("node", F.col("component").alias("part"))
    return rows.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))


def links(nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Confirmed (a, b) that connect all nodes (node, n, bands, bits, marks) which links
    connect."""
    rows = nodes.select("node", F.posexplode("bands").alias("place", "band"))
    shared = (rows.groupBy("band")
              .agg(F.count("*").alias("size"), F.min("node").alias("low"),
                   F.max("node").alias("high"))
              .where("low <> high").select("band", "size"))
    members = checkpointed(rows.join(shared, "band"))
    # The text that others were made from keeps the keys that most of them share.
    popular = members.groupBy("node").agg(F.sum("size").alias("shared_with"))
    pivots = (members.join(popular, "node").groupBy("band")
              .agg(F.max_by("node", ranked(F.col("shared_with"), "node")).alias("first"),
                   F.array(*[F.min_by("node", F.xxhash64("node", "band", F.lit(k)))
                             for k in range(OTHERS)]).alias("others")))
    members = checkpointed(members.drop("size").join(pivots, "band"))

    def side(rows: DataFrame, of: str) -> DataFrame:
        return rows.withColumnsRenamed({"node": of} | {
            c: f"{c}_{of}" for c in ("n", "bits", "marks", "bands", "part", "place")})

    def linkable() -> Column:
        na, nb = F.col("n_a"), F.col("n_b")
        return (may_link(F.col("bits_a"), F.col("bits_b"), na, nb, percent)
                & enough_in_common(F.col("marks_a"), F.col("marks_b"), na, nb, percent))

    def possible(pairs: DataFrame) -> DataFrame:
        light = nodes.drop("bands")
        return pairs.join(side(light, "b"), "b").join(side(light, "a"), "a").where(linkable())

    star = members.where("node <> first").select(
        F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    found = confirmed(possible(star), docs, words, percent)

    parts = hooked(found)
    member = labelled(members, parts)
    pivot = parts.select(F.col("node").alias("other"), F.col("component").alias("other_part"))
    star = (member.select("node", "part", "first", F.explode("others").alias("other"))
            .where("node <> other and other <> first and part <> other")
            .distinct().join(pivot, "other", "left")
            .where(F.col("part") != F.coalesce("other_part", "other"))
            .select(F.col("other").alias("a"), F.col("node").alias("b")).distinct())
    more = confirmed(possible(star), docs, words, percent)
    found = found.unionByName(more)

    parts = hooked(found)
    rest = labelled(members.where(
        "node <> first and not array_contains(others, node)"), parts)
    mixed_bands = (rest.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high"))
                   .where("low <> high").select("band"))
    rest = checkpointed(rest.select("band", "place", "node", "part").join(mixed_bands, "band")
                        .join(nodes, "node"))
    once = first_shared(F.col("bands_a"), F.col("bands_b")) == F.col("place_a")
    pairs = side(rest, "a").join(side(rest, "b"), "band").where(
        F.expr("a < b and part_a <> part_b") & once & linkable())
    return found.unionByName(confirmed(pairs, docs, words, percent))


def groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row.

    Rows are linked if 100 * intersection >= percent * union of their shingle sets;
    component_id is the smallest doc_id that links reach, and its row is kept. A text
    without words (null, empty, white space) is linked with nothing. Rows that repeat a
    doc_id are one document. A row without a doc_id follows the equal texts that have one,
    and stays (component_id null) if there are none. Other columns are ignored.
    """
    signed = checkpointed(signatures(docs, words))
    classes = (signed.where(F.col("set_key").isNotNull()).groupBy("set_key")
               .agg(F.min("doc_id").alias("node")))
    nodes = checkpointed(
        signed.where("n_shingles > 0")
        .join(classes.where(F.col("node").isNotNull()).withColumnRenamed("set_key", "_key"),
              F.col("doc_id") == F.col("node"), "left_semi")
        .select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "bands", "bits",
                "marks"))
    parts = components(links(nodes, docs, words, percent))
    named = labelled(classes, parts).select("set_key", "part")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return (signed.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("part"))
                    .alias("component_id"))
            .withColumn("kept", kept))


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one document of each group, all columns unchanged."""
    decided = groups(docs, words, percent).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    return join_kept(docs, decided.where(~F.col("kept")))
