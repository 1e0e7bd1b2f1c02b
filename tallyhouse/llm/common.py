"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text) alone, a null text as the empty one: other columns cannot clash."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package once per application, as --py-files would."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="pyfiles-"), "tallyhouse_llm.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, os.path.dirname(root)))
        spark.sparkContext.addPyFile(path)
        _SHIPPED.add(app)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir. Only a local session without that setting (tests)
    gets a folder of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        base = (spark.conf.get("spark.checkpoint.dir", None)
                or context.getConf().get("spark.checkpoint.dir"))
        if not base and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(base or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder beside the checkpoints, for tables written between stages."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{purpose}-{os.urandom(6).hex()}"


def file_bytes(spark: SparkSession, path: str):
    """A vocabulary file (a few MB, fixed) as a broadcast variable."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


_HELD: dict = {}


def held(key, build: Callable):
    """What a Python worker keeps between tasks: the tables of one operator at a time, so
    that those of a stage do not fill the memory of the next."""
    if key not in _HELD:
        forget()
        _HELD[key] = build()
    return _HELD[key]


def forget() -> None:
    """For tasks that need no tables: those of the stages before go, and the memory that
    Arrow keeps for reuse goes back."""
    _HELD.clear()
    pa.default_memory_pool().release_unused()


class Memo(dict):
    """A dictionary that computes what it lacks, for two generations of `limit` entries.

    When the younger one is full it becomes the older, and the older is forgotten; what is
    used again moves back. It lives as long as the Python worker, so tasks that follow find
    the common words. Long keys are not kept, which bounds the memory.
    """

    def __init__(self, compute: Callable, limit: int = 150_000, longest: int = 40):
        self.compute, self.limit, self.longest = compute, limit, longest
        self.older: dict = {}
        self.long: list = []

    def put(self, key, value) -> None:
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[key] = value

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self.put(key, value)
        return value

    def with_all(self, keys: set, compute: Callable) -> dict:
        """Itself, holding all of `keys`; those it lacks are computed in one call. Beyond
        `limit` it holds no more than the keys of one call, long ones only until the next."""
        for key in self.long:
            self.pop(key, None)
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()
        new = keys - self.keys()
        old = [key for key in new if key in self.older]
        self.update(zip(old, map(self.older.__getitem__, old)))
        self.update(compute(list(new.difference(old))))
        self.long = [key for key in new if len(key) > self.longest]
        return self


def slices(batches: Iterable[pa.RecordBatch], chars: int = 8 << 20,
           column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about `chars` bytes of text (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > chars:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)


def join_kept(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """`docs` without the rows whose doc_id is in `gone`, one row per doc_id: of rows that
    repeat one the smallest text stays (a null one first).

    Rows without a doc_id stay, as no decision can name them, and are not shuffled. The
    window needs no exchange beyond that of the join.
    """
    from pyspark.sql import Window

    left = docs.where(F.col("doc_id").isNotNull()).join(
        gone.select(F.col("doc_id").alias("__gone")), F.col("doc_id") == F.col("__gone"),
        "left_anti")
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    return (left.withColumn("__first", first).where("__first = 1").drop("__first")
            .unionByName(docs.where(F.col("doc_id").isNull())))


def spans_text(spans: Column) -> Column:
    """'kind:start:end,...' of an array of (.., kind, start, end) structs."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
