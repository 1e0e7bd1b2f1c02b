"""Language identification by unigrams over a public vocabulary, all segmentations summed.

For every language the pieces of a fixed public vocabulary get probabilities, learned by
expectation maximisation from the words of labelled documents. The probability of a word is
the sum over all its segmentations, by the forward algorithm; that of a text is the product
over its words. The best posterior names the language.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import file_bytes, held, ship, slices
from .token_count import MARK, piece_scores

LETTERS = re.compile(r"[^\W\d_]+")
BLOCK = 32  # letters of a word scored together; longer words are cut
UNKNOWN = 1e-7  # probability of a character that is no piece, in any language
UNDECIDED = "und"


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def blocks(word: str) -> list[str]:
    """The word with its mark, cut into blocks that the forward sums can hold."""
    marked = MARK + word
    return [marked[i:i + BLOCK] for i in range(0, len(marked), BLOCK)]


class Lattice:
    """All segmentations of many blocks at once, those of one length side by side.

    The pieces are a trie whose edges (node, character) lie in an open hash table, so all
    blocks take a step at once and one leaves as soon as no piece goes on as it does.
    """

    def __init__(self, pieces: dict[str, int]):
        self.longest = max(map(len, pieces))
        self.unknown = len(pieces)  # row of a character that is no piece
        edges, rows = {}, [-1]
        for piece, row in pieces.items():
            node = 0
            for c in piece:
                child = edges.setdefault((node, ord(c)), len(rows))
                if child == len(rows):
                    rows.append(-1)
                node = child
            rows[node] = row
        self.row_of = np.array(rows)  # of the piece that ends at a node, or -1
        self.bits = (4 * len(edges)).bit_length()
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.child = np.zeros(1 << self.bits, np.int64)
        keys = np.array([node << 21 | c for node, c in edges], np.int64)
        slots, waiting = self.slots(keys), np.arange(len(keys))
        child = np.fromiter(edges.values(), np.int64, len(edges))
        while len(waiting):
            at = slots[waiting]
            free = waiting[self.keys[at] < 0]
            self.keys[slots[free]] = keys[free]  # of several to one slot the last stays
            placed = self.keys[slots[waiting]] == keys[waiting]
            self.child[slots[waiting[placed]]] = child[waiting[placed]]
            waiting = waiting[~placed]
            slots[waiting] = (slots[waiting] + 1) & ((1 << self.bits) - 1)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        hashed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (hashed >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The node after a character, or -1."""
        keys = nodes << 21 | chars
        slots = self.slots(keys)
        seen = self.keys[slots]
        out = np.where(seen == keys, self.child[slots], -1)
        on = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(on):
            slots[on] = (slots[on] + 1) & ((1 << self.bits) - 1)
            seen = self.keys[slots[on]]
            hit = seen == keys[on]
            out[on[hit]] = self.child[slots[on[hit]]]
            on = on[~hit & (seen >= 0)]
        return out

    def spans(self, same: list[str]):
        """(start, end, blocks, rows) of the pieces in blocks of one length, by start. Every
        single character is one, if only an unknown one."""
        n = len(same[0])
        chars = np.array(same, f"U{n}").view(np.uint32).reshape(len(same), n).astype(np.int64)
        for start in range(n):
            blocks, nodes = np.arange(len(same)), np.zeros(len(same), np.int64)
            for end in range(start + 1, min(n, start + self.longest) + 1):
                nodes = self.step(nodes, chars[blocks, end - 1])
                rows = np.where(nodes >= 0, self.row_of[nodes], -1)
                if end == start + 1:
                    yield start, end, blocks, np.where(rows >= 0, rows, self.unknown)
                else:
                    hit = rows >= 0
                    if hit.any():
                        yield start, end, blocks[hit], rows[hit]
                alive = nodes >= 0
                blocks, nodes = blocks[alive], nodes[alive]
                if not len(blocks):
                    break

    def forward(self, same: list[str], table: np.ndarray):
        """(alpha[end, block, language], the spans) of blocks of one length."""
        alpha = np.zeros((len(same[0]) + 1, len(same), table.shape[1]))
        alpha[0] = 1.0
        spans = list(self.spans(same))
        for start, end, blocks, rows in spans:  # all spans up to a start are done before it
            alpha[end, blocks] += alpha[start, blocks] * table[rows]
        return alpha, spans

    def log_probability(self, texts: list[str], table: np.ndarray) -> dict[str, np.ndarray]:
        by_length: dict[int, list[str]] = {}
        for w in texts:
            by_length.setdefault(len(w), []).append(w)
        out = {}
        for same in by_length.values():
            for at in range(0, len(same), 10_000):
                part = same[at:at + 10_000]
                out.update(zip(part, np.log(self.forward(part, table)[0][-1])))
        return out

    def expected(self, counts: dict[str, float], table: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations (one language)."""
        by_length: dict[int, list[str]] = {}
        for w in counts:
            by_length.setdefault(len(w), []).append(w)
        uses = np.zeros(len(table))
        for n, same in by_length.items():
            alpha, spans = self.forward(same, table)
            beta = np.zeros_like(alpha)
            beta[n] = 1.0
            for start, end, blocks, rows in reversed(spans):
                beta[start, blocks] += beta[end, blocks] * table[rows]
            weight = np.array([counts[w] for w in same])[:, None] / alpha[n]
            for start, end, blocks, rows in spans:
                share = alpha[start, blocks] * table[rows] * beta[end, blocks] * weight[blocks]
                np.add.at(uses, rows, share[:, 0])
        return uses


def vocabulary(model: bytes) -> dict[str, int]:
    """Row of each piece that words of letters can use."""
    pieces = [p for p in piece_scores(model)
              if p == MARK or p == p.lower() and p.removeprefix(MARK).isalpha()]
    return {p: i for i, p in enumerate(pieces)}


def learn(labelled: DataFrame, path: str, documents: int = 4000, words: int = 8000,
          rounds: int = 2) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log priors, probability table [pieces + 2, languages]) from (doc_id,
    text, lang).

    Fitted on a bounded sample: of each language about `documents` documents at most, by a
    hash of the doc_id, and of these the `words` most frequent words (blocks of them, if
    long; ties by a hash). What reaches the
    driver is one row per language and one per language and piece. Rows without text or
    lang are not used; no usable row at all gives no language.
    """
    spark = ship(labelled.sparkSession)
    data = file_bytes(spark, path)
    labelled = labelled.select("doc_id", "text", "lang").where(F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(
        F.count("*").alias("n")).collect()}
    if not sizes:
        return [], np.zeros(0), np.zeros((0, 0))
    languages = sorted(sizes)
    share = F.create_map(*[F.lit(x) for lang in languages
                           for x in (lang, min(1.0, documents / sizes[lang]))])
    sample = labelled.where(
        F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            seen: dict[str, Counter] = {}
            for text, lang in zip(batch.column("text").to_pylist(),
                                  batch.column("lang").to_pylist()):
                seen.setdefault(lang, Counter()).update(words_of(text or ""))
            rows = [(lang, b, n) for lang, c in seen.items() for w, n in c.items()
                    for b in blocks(w)]
            columns = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
                 pa.array(columns[2], pa.int64())], ["lang", "word", "n"])

    counted = (sample.select("text", "lang").mapInArrow(count, "lang string, word string, n long")
               .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(
        F.desc("n"), F.xxhash64("word"), "word"))
    chosen = counted.withColumn("rank", rank).where(F.col("rank") <= words)

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pieces = vocabulary(data.value)
        lattice = Lattice(pieces)
        table = np.full((len(pieces) + 2, 1), 1.0 / len(pieces))
        table[-2:, 0] = UNKNOWN, 0.0
        pdf = pdf.sort_values("word")
        counts = dict(zip(pdf["word"], pdf["n"].astype(float)))
        for _ in range(rounds):
            uses = lattice.expected(counts, table)[:-2] + 0.01
            table[:-2, 0] = uses / uses.sum()
        return pd.DataFrame({"lang": key[0], "piece": np.arange(len(pieces)),
                             "p": table[:-2, 0]})

    rows = chosen.groupBy("lang").applyInPandas(fit, "lang string, piece int, p double").collect()
    pieces = vocabulary(data.value)
    table = np.full((len(pieces) + 2, len(languages)), 0.01 / len(pieces))
    for r in rows:
        table[r["piece"], languages.index(r["lang"])] = r["p"]
    table[-2], table[-1] = UNKNOWN, 0.0
    prior = np.log(np.array([sizes[x] for x in languages], float) / sum(sizes.values()))
    return languages, prior, table


class Scorer:
    """Best language of a text and its posterior; of equal ones the first by code point.

    Known words are rows of one matrix. When `limit` of them are reached it starts anew with
    the words of the texts at hand.
    """

    def __init__(self, model: bytes, languages: list[str], prior: np.ndarray, table: np.ndarray,
                 limit: int = 200_000):
        self.languages, self.prior, self.table, self.limit = languages, prior, table, limit
        self.lattice = Lattice(vocabulary(model))
        self.row: dict[str, int] = {}  # 0 for a word without a letter
        self.logs = np.zeros((1, len(languages)))

    def add(self, words: set[str]) -> None:
        """Give all of `words` a row."""
        if len(self.row) + len(words - self.row.keys()) > self.limit:
            self.row, self.logs = {}, np.zeros((1, len(self.languages)))
        new = words - self.row.keys()
        cut = {w: blocks(w) for w in new if any(map(str.isalpha, w))}
        parts = self.lattice.log_probability(
            list({b for p in cut.values() for b in p}), self.table)
        rows = [sum(parts[b] for b in p) for p in cut.values()]
        if rows:
            self.row.update(zip(cut, range(len(self.logs), len(self.logs) + len(rows))))
            self.logs = np.concatenate([self.logs, rows])
        self.row.update((w, 0) for w in new if w not in cut)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if not self.languages:
            return [(UNDECIDED, 0.0)] * len(texts)
        counted = [Counter(words_of(t)) if t else {} for t in texts]
        self.add(set().union(*counted))
        out = []
        for c in counted:
            rows = np.fromiter(map(self.row.__getitem__, c), np.int64, len(c))
            if not rows.any():
                out.append((UNDECIDED, 0.0))
                continue
            often = np.fromiter(c.values(), float, len(c)) * (rows > 0)
            total = self.prior + often @ self.logs[rows]
            top = int(total.argmax())
            out.append((self.languages[top], float(1 / np.exp(total - total[top]).sum())))
        return out


def scorer(data, fitted) -> Scorer:
    """The worker's scorer for a broadcast model, built once."""
    return held(("language", hash(fitted.value[2].tobytes())),
                lambda: Scorer(data.value, *fitted.value))


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray],
             path: str) -> DataFrame:
    """`docs` with (lang_pred, score) for every row; any other column stays as it is.

    A text that is null or has no letter, and any text if no language was learned, is
    `und` with score 0. Only the text is looked at.
    """
    spark = ship(docs.sparkSession)
    data, fitted = file_bytes(spark, path), spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scorer(data, fitted)
        for batch in slices(batches):
            names, scores = zip(*own.predict(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names, "lang_pred", "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id", folds: int = 5):
    """True for the fold that is never learned from; a null doc_id belongs to it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0,
                      F.lit(True))


def predictions(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, learned from the other folds."""
    model = learn(docs.where(~held_out()), path)
    only = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify(only, model, path).drop("text")


def drop_unidentified(docs: DataFrame, path: str, least: float = 0.5) -> DataFrame:
    """`docs` without the rows that are `und` or whose best posterior is below `least`."""
    model = learn(docs.where(~held_out()), path)
    spark = ship(docs.sparkSession)
    data, fitted = file_bytes(spark, path), spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scorer(data, fitted)
        for batch in slices(batches):
            told = own.predict(batch.column("text").to_pylist())
            yield batch.filter(pa.array([lang != UNDECIDED and score >= least
                                         for lang, score in told], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
