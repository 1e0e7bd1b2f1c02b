"""Partitioned tables whose changes appear all at once, and the index of their keys.

A table is a set of partitions, and each partition is held by one data table. A write puts
the partitions it changes into a new data table (`NAME__d<time>_<id>`), and then commits a
manifest, partition -> data table, as the view `NAME__m<number>`. The catalog lets one
writer create the view of a number; a second one that started from the same manifest fails
(`Conflict`) and starts again from the new one. Last, the view NAME is pointed at the
manifest. So readers see the old table or the new one, a run that dies leaves nothing but
tables no manifest names, and `expire` drops what nobody can still be reading.

Beside each data table lies an index of its keys (`..._keys`): per partition the key range
and a Bloom filter. The filters lie side by side: a position of a block is a word with one
bit for each of 64 slots, and a partition has one slot or, if it is large, several. So a
batch key is looked for in all partitions with one row per 64 slots, not one per partition,
whatever partition the batch says, and key columns are read only where the filter says
"perhaps".

There is at most one data table per partition, and everything that reaches the driver is one
row per partition.
"""

from __future__ import annotations

import os
import re
import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace as changed

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import shared_folder
from . import bronze
from .tables import is_large, laid_out, one_per_key, sized

BLOCK_BITS = 512  # positions of a block
WORD_SLOTS = 64
BITS_PER_KEY, HASHES = 10, 5  # about one false "perhaps" in a hundred
FIRST_KEYS = 20_000  # of a large batch that are probed before the others


class Conflict(RuntimeError):
    """Another writer committed first."""


@dataclass(frozen=True)
class Part:
    """A partition's row of the manifest; `value` is its text, '' for a blank one."""

    value: str
    data: str
    n: int
    low: object
    high: object
    blocks: int  # of each slot
    slot: int  # its first one
    slots: int

    def words(self) -> range:
        return range(self.slot // WORD_SLOTS, (self.slot + self.slots - 1) // WORD_SLOTS + 1)


@dataclass(frozen=True)
class Manifest:
    number: int
    keys: tuple[str, ...]
    partition: str
    parts: tuple[Part, ...]
    data: str  # the data table of the last commit; it has the schema

    def among(self, values: Iterable[str]) -> list[Part]:
        wanted = set(values)
        return [p for p in self.parts if p.value in wanted]


def text_of(partition: str) -> Column:
    """A partition value as the manifest writes it."""
    return F.coalesce(F.col(partition).cast("string"), F.lit(""))


def _bare(name: str) -> str:
    return name.rpartition(".")[2]


def _tables(spark: SparkSession, name: str, kind: str) -> list[str]:
    """The tables of NAME of one kind, in order of their number or time."""
    database, _, bare = name.rpartition(".")
    own = re.compile(re.escape(bare.lower()) + f"__{kind}" + r"(\d{10}|\d{14}_[0-9a-f]{8}(_keys)?)")
    found = [t.name for t in spark.catalog.listTables(database or None, f"{bare}__{kind}*")]
    return sorted(f"{database}.{t}" if database else t for t in found if own.fullmatch(t.lower()))


def data_tables(spark: SparkSession, name: str) -> list[str]:
    """All data tables of NAME that exist, the oldest first."""
    return [t for t in _tables(spark, name, "d") if not t.endswith("_keys")]


# --- reading ------------------------------------------------------------------------------

def manifest(spark: SparkSession, name: str, number: int | None = None) -> Manifest | None:
    """The committed manifest of a number, by default the newest; None if there is none."""
    views = _tables(spark, name, "m")
    if number is not None:
        views = [v for v in views if int(v.rpartition("__m")[2]) == number]
    if not views:
        return None
    rows = spark.table(views[-1]).collect()  # one per partition
    about = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {views[-1]}").collect()}
    return Manifest(int(views[-1].rpartition("__m")[2]), tuple(about["keys"].split(",")),
                    about["partition"], tuple(Part(**r.asDict()) for r in rows), about["data"])


def _by_data(parts: Iterable[Part]) -> dict[str, list[str]]:
    found: dict[str, list[str]] = {}
    for part in parts:
        found.setdefault(part.data, []).append(part.value)
    return found


def rows_of(spark: SparkSession, held: Manifest, parts: Iterable[Part] | None = None) -> DataFrame:
    """The rows of some partitions, by default of all. The filters are on the partition
    column alone, so other partitions of a data table are not read."""
    out = None
    for data, values in _by_data(held.parts if parts is None else parts).items():
        rows = spark.table(data).where(text_of(held.partition).isin(values))
        out = rows if out is None else out.unionByName(rows)
    return spark.table(held.data).where(F.lit(False)) if out is None else out


def _point(spark: SparkSession, name: str) -> None:
    """Let the view NAME show the newest manifest, also if another writer commits meanwhile."""
    shown = None
    while shown is None or shown.number < manifest(spark, name).number:
        shown = manifest(spark, name)
        columns = ", ".join(f"`{c}`" for c in spark.table(shown.data).columns)

        def select(data: str, values: list[str]) -> str:
            listed = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
            where = (f"coalesce(CAST(`{shown.partition}` AS STRING), '') IN ({listed})"
                     if values else "false")
            return f"SELECT {columns} FROM {data} WHERE {where}"

        body = " UNION ALL ".join(select(d, v) for d, v in (
            _by_data(shown.parts) or {shown.data: []}).items())
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {body}")


# --- the key index ------------------------------------------------------------------------

def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def _block(keys: Sequence[str], blocks: Column) -> Column:
    return F.pmod(F.xxhash64(*keys, F.lit(1)), blocks).cast("int")


def _positions(keys: Sequence[str]) -> list[Column]:
    """The key's bits within its block: an arithmetic series from two halves of a hash."""
    first = F.pmod(_hash(keys), F.lit(BLOCK_BITS))
    step = F.pmod(F.shiftright(_hash(keys), 32), F.lit(BLOCK_BITS // 2)) * 2 + 1
    return [F.pmod(first + i * step, F.lit(BLOCK_BITS)) for i in range(HASHES)]


def _slot(keys: Sequence[str], first: Column, slots: Column) -> Column:
    """The slot of a key among those of its partition."""
    return (first + F.pmod(F.xxhash64(*keys, F.lit(2)), slots)).cast("int")


def _bits_of(positions: Sequence[Column], word: int) -> Column:
    """Those of the positions that lie in one long of a block, as its bits."""
    out = None
    for position in positions:
        bit = F.when(F.shiftright(position, 6) == word, F.call_function(
            "shiftleft", F.lit(1).cast("long"), (position % 64).cast("int"))).otherwise(0)
        out = bit if out is None else out.bitwiseOR(bit)
    return out


def _crossed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Arrays of 64 longs as bit matrices with rows and columns changed: bit s of long p
    becomes bit p of long s. Blocks of 32, 16, .. 1 bits change places across the diagonal."""
    for j in (32, 16, 8, 4, 2, 1):
        low = sum(1 << b for b in range(64) if not b & j)
        low -= (low >> 63) << 64  # the lower half of each block of 2 * j bits, as a long
        df = df.withColumns({c: F.expr(
            f"transform({c}, (x, k) -> if((k & {j}) = 0,"
            f" (x & {low}L) | shiftleft({c}[k ^ {j}] & {low}L, {j}),"
            f" (shiftrightunsigned({c}[k ^ {j}], {j}) & {low}L) | (x & ~{low}L)))")
            for c in columns})
    return df


def _slotted(parts: Sequence[Part]) -> list[Part]:
    """The parts with slots of about equal numbers of keys. There are at most two slots to a
    partition, rounded up to whole words, so large partitions do not make the others' blocks
    large."""
    room = WORD_SLOTS * -(-2 * len(parts) // WORD_SLOTS)
    keys = max(1, -(-sum(p.n for p in parts) // max(1, room - len(parts))))  # of a slot
    blocks, first, out = -(-keys * BITS_PER_KEY // BLOCK_BITS), 0, []
    for part in parts:
        slots = -(-part.n // keys)
        out.append(changed(part, blocks=blocks, slot=first, slots=slots))
        first += slots
    return out


def _write_index(spark: SparkSession, data: str, keys: Sequence[str], partition: str) -> list[Part]:
    """Write the key index of a data table and return its manifest rows."""
    rows = spark.table(data).select(*keys, text_of(partition).alias("_value"))
    stats = rows.groupBy("_value").agg(
        F.count("*").alias("n"), F.min(keys[0]).alias("low"), F.max(keys[0]).alias("high"))
    parts = _slotted([Part(r["_value"], data, r["n"], r["low"], r["high"], 1, 0, 1)
                      for r in stats.collect()])
    sizes = spark.createDataFrame([(p.value, p.blocks, p.slot, p.slots) for p in parts],
                                  "_value string, blocks int, _first int, _slots int")
    keyed = rows.join(F.broadcast(sizes), "_value").select(
        _slot(keys, F.col("_first"), F.col("_slots")).alias("slot"),
        _block(keys, F.col("blocks")).alias("block"),
        *[p.alias(f"_p{i}") for i, p in enumerate(_positions(keys))])
    # A slot's bits of a block are a few longs, and leave a task as one row; then the slots of
    # a word are laid side by side. Every slot of every word is there, so that all are in place.
    parted = [f"_w{j}" for j in range(BLOCK_BITS // 64)]
    blocks, slots = max((p.blocks for p in parts), default=0), WORD_SLOTS * max(
        (p.words().stop for p in parts), default=0)
    n = F.col("id")
    empty = spark.range(slots * blocks).select(
        F.floor(n / (blocks or 1)).cast("int").alias("slot"),
        (n % (blocks or 1)).cast("int").alias("block"),
        *[F.lit(0).cast("long").alias(w) for w in parted])
    filters = keyed.groupBy("slot", "block").agg(*[
        F.bit_or(_bits_of([F.col(f"_p{i}") for i in range(HASHES)], j)).alias(w)
        for j, w in enumerate(parted)])
    filters = filters.unionByName(empty).groupBy("slot", "block").agg(*[
        F.bit_or(w).alias(w) for w in parted])
    beside = (filters.groupBy(F.floor(F.col("slot") / WORD_SLOTS).cast("int").alias("word"), "block")
              .agg(F.sort_array(F.collect_list(F.struct("slot", *parted))).alias("_slots"))
              .select("word", "block", *[F.col(f"_slots.{w}").alias(w) for w in parted]))
    (_crossed(beside, parted).select("word", "block", F.concat(*parted).alias("bits"))
     .write.format("parquet").saveAsTable(f"{data}_keys"))
    return parts


def candidates(spark: SparkSession, held: Manifest, batch_keys: DataFrame) -> DataFrame:
    """(keys, value): the partitions that may hold each key. None that does is left out.

    A key is probed once per word of slots whose key ranges include it. The join is a
    sort-merge one: stored keys look small to the optimizer, the probes made of them are not.
    """
    keys = list(held.keys)
    none = batch_keys.select(*keys, F.lit("").alias("value")).where(F.lit(False))
    ranged = [p for p in held.parts if p.low is not None]
    if not ranged:
        return none
    kind = spark.table(held.data).schema[keys[0]].dataType
    groups: dict[tuple[str, int], list[Part]] = {}  # per data table and word
    for part in ranged:
        for word in part.words():
            groups.setdefault((part.data, word), []).append(part)
    number = {group: i for i, group in enumerate(groups)}

    def order(value) -> tuple:
        return value != value, value  # NaN last, as Spark has it

    listed = F.array(*[F.struct(
        F.lit(number[group]).alias("group"),
        F.lit(min((p.low for p in parts), key=order)).cast(kind).alias("low"),
        F.lit(max((p.high for p in parts), key=order)).cast(kind).alias("high"),
        F.lit(parts[0].blocks).alias("blocks")) for group, parts in groups.items()])
    within = F.filter(listed, lambda g: F.col(keys[0]).between(g["low"], g["high"]))
    probes = (batch_keys.select(*keys, F.explode(within).alias("_g"))
              .select(*keys, F.col("_g.group").alias("group"),
                      _block(keys, F.col("_g.blocks")).alias("block")))
    index = None
    for data in _by_data(ranged):
        of = {word: i for (d, word), i in number.items() if d == data}
        group = F.coalesce(*[F.when(F.col("word") == word, i) for word, i in of.items()])
        rows = spark.table(f"{data}_keys").where(F.col("word").isin(list(of))).select(
            group.alias("group"), "block", "bits")
        index = rows if index is None else index.unionByName(rows)
    hit = None  # the slots that have all bits of the key
    for position in _positions(keys):
        word = F.get("bits", position.cast("int"))
        hit = word if hit is None else hit.bitwiseAND(word)
    perhaps = probes.hint("merge").join(index, ["group", "block"]).select(
        *keys, "group", hit.alias("_hit")).where("_hit <> 0")
    low_high = f"low:{kind.simpleString()},high:{kind.simpleString()}"
    owners = spark.createDataFrame(
        [(number[group], group[1], [(p.value, p.low, p.high, p.slot, p.slots) for p in parts])
         for group, parts in groups.items()],
        f"group int, word int, parts array<struct<value:string,{low_high},slot:int,slots:int>>")

    def may_hold(part: Column) -> Column:
        slot = _slot(keys, part["slot"], part["slots"])
        bit = F.call_function("shiftright", F.col("_hit"), F.pmod(slot, F.lit(WORD_SLOTS)))
        return (bit.bitwiseAND(F.lit(1)) == 1) & (
            F.floor(slot / WORD_SLOTS) == F.col("word")) & F.col(keys[0]).between(
                part["low"], part["high"])

    return perhaps.join(F.broadcast(owners), "group").select(
        *keys, F.explode(F.filter("parts", may_hold)).alias("_p")).select(
            *keys, F.col("_p.value").alias("value"))


def named(spark: SparkSession, held: Manifest, batch_keys: DataFrame, n: int) -> list[Part]:
    """The partitions that may hold a key of a batch of `n`: those of `candidates`.

    Of a large batch some keys are probed first. The partitions they name are read anyway,
    so the other keys are probed for the rest of the partitions alone, if any are left."""
    def probed(parts: Sequence[Part], some: DataFrame) -> set[str]:
        found = candidates(spark, changed(held, parts=tuple(parts)), some).select("value")
        return {r["value"] for r in found.distinct().collect()}

    if n <= 2 * FIRST_KEYS:
        return held.among(probed(held.parts, batch_keys))
    turn = F.pmod(F.xxhash64(*held.keys, F.lit(3)), F.lit(-(-n // FIRST_KEYS)))
    values = probed(held.parts, batch_keys.where(turn == 0))
    left = [p for p in held.parts if p.value not in values and p.low is not None]
    if left:
        values |= probed(left, batch_keys.where(turn != 0))
    return held.among(values)


def located(spark: SparkSession, held: Manifest, batch_keys: DataFrame,
            batch_rows: int | None = None) -> DataFrame:
    """(keys, value): where the batch's keys are. Key columns are read only of the
    partitions that the index cannot rule out. `batch_rows` saves counting the batch."""
    keys = list(held.keys)
    n = batch_keys.count() if batch_rows is None else batch_rows
    rows = rows_of(spark, held, named(spark, held, batch_keys, n)).select(
        *keys, text_of(held.partition).alias("value"))
    return rows.join(sized(batch_keys.select(*keys), n), keys, "left_semi")


# --- writing ------------------------------------------------------------------------------

def stage(df: DataFrame, name: str, keys: Sequence[str], partition: str) -> tuple[str, list[Part]]:
    """Write a data table and its index; nobody sees them until they are committed."""
    data = f"{name}__d{time.time_ns() // 1_000_000:014d}_{os.urandom(4).hex()}"
    laid_out(df, partition).write.format("parquet").saveAsTable(data, partitionBy=partition)
    return data, _write_index(df.sparkSession, data, keys, partition)


def discard(spark: SparkSession, data: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {data}_keys")
    spark.sql(f"DROP TABLE IF EXISTS {data}")


def commit(spark: SparkSession, name: str, base: Manifest | None, keys: Sequence[str],
           partition: str, data: str, parts: Sequence[Part]) -> None:
    """Make `parts` the table's partitions, if nobody has committed since `base`."""
    number = base.number + 1 if base else 1
    listing = f"{name}__c{time.time_ns() // 1_000_000:014d}_{os.urandom(4).hex()}"
    kind = spark.table(data).schema[keys[0]].dataType.simpleString()
    spark.createDataFrame([(p.value, p.data, p.n, p.low, p.high, p.blocks, p.slot, p.slots)
                           for p in parts],
                          f"value string, data string, n long, low {kind}, high {kind}, blocks int, "
                          "slot int, slots int").coalesce(1).write.format("parquet").saveAsTable(listing)
    try:
        spark.sql(f"CREATE VIEW {name}__m{number:010d} TBLPROPERTIES ('keys' = '{','.join(keys)}', "
                  f"'partition' = '{partition}', 'data' = '{data}', "
                  f"'listing' = '{listing}', 'committed' = '{time.time_ns() // 1_000_000}') "
                  f"AS SELECT * FROM {listing}")
    except AnalysisException as e:
        if e.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
            raise
        spark.sql(f"DROP TABLE {listing}")
        discard(spark, data)
        raise Conflict(f"{name}: another writer committed version {number} first") from e
    _point(spark, name)


def replace(df: DataFrame, name: str, keys: Sequence[str], partition: str) -> None:
    """A full load: all partitions are those of `df`."""
    spark = df.sparkSession
    base = manifest(spark, name)
    data, parts = stage(df, name, list(keys), partition)
    commit(spark, name, base, list(keys), partition, data, parts)


def rewrite(df: DataFrame, name: str, base: Manifest, touched: Iterable[str]) -> None:
    """Put `df` in the place of the `touched` partitions; those it has no rows of go."""
    spark, gone = df.sparkSession, set(touched)
    data, parts = stage(df, name, base.keys, base.partition)
    kept = [p for p in base.parts if p.value not in gone]
    commit(spark, name, base, base.keys, base.partition, data, kept + parts)


def _upserted(staged: DataFrame, base: Manifest, update: Sequence[str] | None
              ) -> tuple[DataFrame, set[str]]:
    """(the rows of the touched partitions after the merge, those partitions)."""
    spark, keys, n = staged.sparkSession, list(base.keys), staged.count()
    folder = shared_folder(spark, "located")
    located(spark, base, staged.select(*keys).distinct(), n).write.parquet(folder)
    here = spark.read.parquet(folder)  # no more rows than the batch
    given = staged.select(text_of(base.partition).alias("value"))
    touched = {r["value"] for r in given.unionByName(here.select("value")).distinct().collect()}
    old = rows_of(spark, base, base.among(touched))
    given = old.columns if update is None else [*update, base.partition]  # a row may move
    update = [c for c in given if c in staged.columns and c not in keys]
    batch = one_per_key(bronze.conform(staged, old.schema), keys)

    def column(c: str) -> Column:
        return F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(
            F.col(c)) if c in update else F.col(c)

    if is_large(n):  # the join shuffles both sides anyway: one, instead of two
        both = old.withColumn("_old", F.lit(True)).join(sized(batch, n), keys, "full")
        merged = both.select(*[c if c in keys else F.when(F.col("_old"), column(c)).otherwise(
            F.col(f"_new.{c}")).alias(c) for c in old.columns])
        return merged, touched
    merged = old.join(batch, keys, "left").select(*[column(c).alias(c) for c in old.columns])
    inserted = batch.join(here, keys, "left_anti").select(*keys, "_new.*")
    return merged.unionByName(inserted), touched


def upsert(staged: DataFrame, name: str, update: Sequence[str] | None = None,
           attempts: int = 5) -> None:
    """Merge a batch on the table's keys alone: a key is updated wherever it is stored, and
    moves if its partition changed. Rewritten are the partitions that the batch names and
    those that hold its keys. The batch is read several times, so give it stored.

    Columns the batch lacks keep their value. A repeated batch key fails. Rows without a
    key match nothing and are inserted. If another writer commits first, the merge starts
    again from what that one wrote, up to `attempts` times.
    """
    spark = staged.sparkSession
    for attempt in range(attempts):
        base = manifest(spark, name)
        merged, touched = _upserted(staged, base, update)
        try:
            rewrite(merged, name, base, touched)
            return
        except Conflict:
            if attempt == attempts - 1:
                raise


def remove(spark: SparkSession, name: str, gone: DataFrame) -> int:
    """Delete the rows whose key is in `gone` (keys); how many there were. The keys are
    written down first, as they are read several times."""
    base = manifest(spark, name)
    keys = list(base.keys)
    folder = shared_folder(spark, "gone")
    gone.select(*keys).distinct().write.parquet(folder)
    gone = spark.read.schema(gone.select(*keys).schema).parquet(folder)
    n = gone.count()
    lost = located(spark, base, gone, n)
    counts = {r["value"]: r["count"] for r in lost.groupBy("value").count().collect()}
    if counts:
        old = rows_of(spark, base, base.among(counts))
        rewrite(old.join(sized(gone, n), keys, "left_anti"), name, base, counts)
    return sum(counts.values())


def expire(spark: SparkSession, name: str, grace_hours: float = 24.0) -> list[str]:
    """Drop what was replaced more than `grace_hours` ago, and what runs that died that long
    ago left behind. The names of the dropped data tables."""
    before = time.time_ns() // 1_000_000 - int(grace_hours * 3_600_000)

    def about(view: str, key: str) -> str:
        return spark.sql(f"SHOW TBLPROPERTIES {view} ('{key}')").first()["value"]

    views = _tables(spark, name, "m")
    stale = [v for v, later in zip(views, views[1:]) if int(about(later, "committed")) <= before]
    used = set()
    for view in views[len(stale):]:
        held = manifest(spark, name, int(view.rpartition("__m")[2]))
        used |= {about(view, "listing"), held.data, *[p.data for p in held.parts]}
    for view in stale:
        spark.sql(f"DROP VIEW {view}")
    dropped = []
    for table in _tables(spark, name, "c") + _tables(spark, name, "d"):
        written = int(re.search(r"__[cd](\d{14})_", table).group(1))
        if written <= before and table.removesuffix("_keys") not in used:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            dropped.append(table)
    return [t for t in dropped if "__d" in t and not t.endswith("_keys")]
