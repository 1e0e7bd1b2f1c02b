"""I-Match fingerprints of documents over several randomised lexicon subsets.

The lexicon is the set of terms whose inverse document frequency lies in a band. Documents
are counted per 64-bit hash of a term. A band up to an idf of h bounds the lexicon: each of
its terms is in e**-h of the documents or more, so there are at most e**h times the mean
number of distinct terms of a document, however many documents there are. That is what is
broadcast. A document keeps its terms of the lexicon, sorted and distinct. Every subset of the lexicon, chosen by a hash of the
term, gives a hash of the kept terms in it. Sixteen families of nested subsets range from
the whole lexicon to a 2**-14 part of it, so that some suit documents of any length. The
fingerprint is the list of these hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import id_text, ship, slices
from .near_dedup import MIX, mixed

BUCKETS = 1 << 18
LEVELS, FAMILIES = 15, 16
SUBSETS = LEVELS * FAMILIES
NONE = "-" * 4  # hash of a subset that holds no term of the document
BAND = (1.5, 8.0)  # inverse document frequency, natural logarithm

_rng = np.random.Generator(np.random.PCG64(7))
SALTS = _rng.integers(0, 1 << 63, FAMILIES, np.uint64)
# How many zeros a number below 2**(LEVELS - 1) ends with, LEVELS - 1 at most.
ZEROS = np.array([LEVELS - 1] + [(i & -i).bit_length() - 1 for i in range(1, 1 << LEVELS - 1)])

def terms(text: str) -> np.ndarray:
    """Sorted hashes of the distinct lower-case terms."""
    found = set(text.lower().split())
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)))

def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Documents that hold a term of each bucket, over all documents; BUCKETS numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS, np.int64)
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                seen[np.unique(terms(text) % np.uint64(BUCKETS)).astype(np.int64)] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(seen[at])], ["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    counted = id_text(docs).select("text").mapInArrow(run, "bucket int, n long")
    rows = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most BUCKETS
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out

def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> np.ndarray:
    """Whether the inverse document frequency of each bucket lies in the band."""
    seen = document_frequencies(docs)
    n = max(docs.count(), 1)
    low, high = band
    return (seen >= n * np.exp(-high)) & (seen <= n * np.exp(-low)) & (seen > 0)

def term_frequencies(docs: DataFrame, pending: int = 1 << 21) -> DataFrame:
    """(term, n): documents that hold the term of a hash, over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                held.append(terms(text))
                size += len(held[-1])
                if size >= pending:
                    yield counted(held)
                    held, size = [], 0
        if held:
            yield counted(held)

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(n, pa.int64())], ["term", "n"])

    return (id_text(docs).select("text").mapInArrow(run, "term long, n long")
            .groupBy("term").agg(F.sum("n").alias("n")))

def lexicon_terms(docs: DataFrame, band: tuple[float, float] = BAND) -> np.ndarray:
    """Sorted hashes of the terms whose inverse document frequency lies in the band."""
    n = max(docs.count(), 1)
    low, high = (float(n * np.exp(-x)) for x in band)
    rows = (term_frequencies(docs).where((F.col("n") >= high) & (F.col("n") <= low))
            .select("term").toArrow())
    return np.sort(rows["term"].to_numpy().view(np.uint64))

def held_by(inside: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which hashes a lexicon holds: sorted terms, or a flag per bucket."""
    if inside.dtype == bool:
        return inside[(found % np.uint64(BUCKETS)).astype(np.int64)]
    if not len(inside):
        return np.zeros(len(found), bool)
    return inside[np.minimum(np.searchsorted(inside, found), len(inside) - 1)] == found

def subset_hashes(text: str, inside: np.ndarray) -> np.ndarray:
    """[level, family]: a 16-bit hash per subset; -1 where no term of the text is in it.

    A term is in the subsets of a family up to the number of zeros that its hash ends with.
    A text without a term of the lexicon is taken by all its terms.
    """
    found = terms(text)
    kept = found[held_by(inside, found)]
    if len(kept):
        found = kept
    h = mixed((found[:, None] ^ SALTS) * MIX)
    level = ZEROS[(h & np.uint64(len(ZEROS) - 1)).astype(np.intp)]
    cell = (level * FAMILIES + np.arange(FAMILIES)).ravel()
    sums = np.bincount(cell, (h >> np.uint64(32)).astype(np.float64).ravel(), SUBSETS)
    members = np.bincount(cell, minlength=SUBSETS)
    # Of each level and the rarer ones after it; exact below 2**53.
    total, members = (x.reshape(LEVELS, FAMILIES)[::-1].cumsum(axis=0)[::-1]
                      for x in (sums, members))
    hashes = mixed(total.astype(np.uint64) + MIX) & np.uint64(0xFFFF)
    return np.where(members > 0, hashes.astype(np.int64), -1)


def as_text(hashes: np.ndarray) -> str:
    return "".join([f"{h:04x}" if h >= 0 else NONE for h in hashes.ravel().tolist()])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal hashes among the subsets that hold a term of either text.

    Large subsets differ after any edit. Counted are the levels from the first on at which
    an eighth of the families hold no term of either text, where a subset tells little more
    than one term and the share is near the texts' overlap. 1 if there is no term at all.
    """
    either = (a >= 0) | (b >= 0)
    sparse = np.flatnonzero(either.mean(axis=1) <= 7 / 8)
    at = min(int(sparse[0]), LEVELS - 1) if len(sparse) else LEVELS - 1
    while at and not either[at:].any():
        at -= 1
    n = int(either[at:].sum())
    return float(((a == b) & either)[at:].sum() / n) if n else 1.0


def edited(text: str, after: str) -> str:
    """The last half of the characters replaced by the first as many of `after`."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]

def in_order(docs: DataFrame, ranges: int) -> DataFrame:
    """(part, extra, doc_id, text): documents in descending doc_id, in `ranges` parts, each
    closed by a copy (extra = 1) of the document that comes after its last.

    Cut points are approximate quantiles. The driver sees one doc_id per part.
    """
    rows = id_text(docs)
    fractions = [i / ranges for i in range(1, ranges)]
    cuts = (rows.agg(F.percentile_approx("doc_id", fractions, 10_000)).first()[0]
            if fractions else None) or []
    cuts = sorted(set(cuts))
    part = F.lit(len(cuts))
    if cuts:
        at = F.array([F.lit(c) for c in cuts])
        below = F.size(F.filter(at, lambda c: c < F.col("doc_id")))
        part = F.when(F.col("doc_id").isNull(), len(cuts)).otherwise(len(cuts) - below)
    rows = rows.withColumn("part", part.cast("int"))
    first = sorted((r["part"], r["id"]) for r in rows.groupBy("part").agg(
        F.max("doc_id").alias("id")).collect())
    # (part that a boundary document closes, its doc_id); the first one closes the last part
    closes = [(first[k - 1][0], first[k][1]) for k in range(len(first))]
    own = rows.withColumn("extra", F.lit(0))
    if not closes:
        return own
    by_id = F.array(*[F.struct(F.lit(p).alias("part"), F.lit(i).alias("id")) for p, i in closes])
    wanted = F.transform(F.filter(by_id, lambda c: c["id"].eqNullSafe(F.col("doc_id"))),
                         lambda c: c["part"])
    targets = F.concat(F.array(F.struct(F.col("part"), F.lit(0).alias("extra"))),
                       F.transform(wanted, lambda p: F.struct(p.alias("part"),
                                                              F.lit(1).alias("extra"))))
    return (rows.withColumn("target", F.explode(targets))
            .select("target.part", "target.extra", "doc_id", "text"))

def fingerprints(docs: DataFrame, band: tuple[float, float] = BAND, ranges: int | None = None
                 ) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they are.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    The next document is the one after it in descending doc_id, after the last the first;
    rows that repeat a doc_id stand in the order of their text, null doc_ids come last. A
    null text is empty; two texts without any term are alike (1.0). An empty table gives no
    rows, and the only document of a table is its own next one.
    """
    spark = ship(docs.sparkSession)
    inside = spark.sparkContext.broadcast(lexicon_terms(docs, band))
    if ranges is None:
        ranges = min(2000, max(docs.rdd.getNumPartitions(),
                               int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ordered = in_order(docs, ranges)
    ordered = ordered.repartitionByRange(ranges, "part").sortWithinPartitions(
        F.asc("part"), F.asc("extra"), F.col("doc_id").desc_nulls_last(), F.asc("text"))

    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches):
            yield from zip(*[batch.column(c).to_pylist()
                             for c in ("part", "extra", "doc_id", "text")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        waiting = None  # (part, doc_id, text, hashes) of the document before
        for part, extra, doc_id, text in rows(batches):
            hashes = subset_hashes(text, inside.value)
            if waiting and waiting[0] == part:
                _, own_id, own, mine = waiting
                new = edited(own, text)
                theirs = subset_hashes(new, inside.value)
                out.append((own_id, len(own), hashlib.sha256(new.encode()).hexdigest(),
                            as_text(mine), as_text(theirs), likeness(mine, theirs),
                            likeness(mine, hashes)))
            waiting = None if extra else (part, doc_id, text, hashes)
            if len(out) >= 1000:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    id_type = docs.schema["doc_id"]
    schema = (f"doc_id {id_type.dataType.simpleString()}, n_chars long, edited_sha256 string, "
              "fingerprint string, edited_fingerprint string, near_edited double, "
              "near_next double")
    arrow = pa.schema([("doc_id", to_arrow_type(id_type.dataType)), ("n_chars", pa.int64()),
                       ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                       ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                       ("near_next", pa.float64())])

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [[]] * len(arrow)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return ordered.mapInArrow(run, schema)
