"""Best-fit packing of documents into fixed-length sequences, with swap-based local search.

Tokenising is per document. What has to be packed is one short row per piece; pieces are
dealt by a hash of their document into groups of bounded size, and each group is packed by
best fit decreasing. Local search then raises the squared fill of the underfull bins by
moving one piece, swapping one for one or two for one, and a bin that becomes empty is
saved. Only the last bin of a group can stay badly filled.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .byte_bpe import SPACE
from .common import checkpointed, file_bytes, held, id_text, ship, slices

# Fixed value: the pattern of the byte-level pre-tokeniser, as tiktoken writes it for speed:
# the runs give nothing back, and the last of them need not look ahead.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
# White space up to the last one before something else: a match of the pattern ends there.
# tiktoken cannot take a million of it that something follows, so long texts are cut there.
RUN = re.compile(f"[{SPACE}]{{64,}}(?=[{SPACE}][^{SPACE}])")
LONG = 500_000
END = (0).to_bytes(4, "little")
# Bytes of text that are encoded at once.
TOGETHER = 4 << 20


def byte_of_char() -> dict[str, int]:
    """How a byte-level file writes bytes: printable Latin-1 as itself, the others by the
    characters from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def added_tokens(data: bytes) -> dict[str, int]:
    """The tokens that the file cuts out of a text before anything else."""
    added = json.loads(data)["added_tokens"]
    if any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") for t in added):
        raise ValueError("added tokens that look at what is beside them are not supported")
    return {t["content"]: t["id"] for t in added}


def ranks_of(data: bytes) -> dict[bytes, int]:
    """The vocabulary of a byte-level tokenizers file as merge ranks, without the added
    tokens. Merging by rank is the file's own rule if each merge makes the token of the next
    id, which is checked."""
    file, byte = json.loads(data), byte_of_char()
    vocabulary, special = file["model"]["vocab"], {t["content"] for t in file["added_tokens"]}
    for i, pair in enumerate(file["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        if vocabulary[left + right] != 256 + i:
            raise ValueError("the file's merges are not in the order of its ids")
    return {bytes(byte[c] for c in token): i for token, i in vocabulary.items()
            if token not in special}


class FileEncoder:
    """Ids by a tokenizers file whose pre-tokeniser is the byte-level one.

    The file's merges are run by tiktoken, whose results for it are those of the tokenizers
    library (tested on every token and on whole texts) at a fifth of the time. It takes whole
    texts: to cut them into words here and to look those up took longer.
    """

    def __init__(self, data: bytes):
        self.tokenizer = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks_of(data),
                                           special_tokens={})
        self.added = added_tokens(data)
        self.cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))
                              or "(?!)")

    def ids(self, text: str) -> bytes:
        """The little-endian 32-bit ids of a text without added tokens."""
        if len(text) <= LONG:
            return array("I", self.tokenizer.encode_ordinary(text)).tobytes()
        ends = [0, *[m.end() for m in RUN.finditer(text)], len(text)]
        return b"".join(array("I", self.tokenizer.encode_ordinary(text[a:b])).tobytes()
                        for a, b in zip(ends, ends[1:]))

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self.ids(t) if not self.cut.search(t) else self.marked(t) for t in texts]

    def marked(self, text: str) -> bytes:
        """The ids of a text with added tokens."""
        marks = [self.added[m].to_bytes(4, "little") for m in self.cut.findall(text)]
        own = map(self.ids, self.cut.split(text))
        return next(own) + b"".join(mark + ids for mark, ids in zip(marks, own))


def file_encoder(data) -> FileEncoder:
    return held(("packing", hash(data.value)), lambda: FileEncoder(data.value))


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else the odd rest first
    and full pieces after it."""
    if n <= size:
        return [(0, n)]
    first = n % size
    return [(0, first)] * bool(first) + [(s, size) for s in range(first, n, size)]


def cut_up(batches: Iterator[pa.RecordBatch], own: FileEncoder, size: int, ids: bool,
           schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The pieces of batches of (doc_id, text)."""
    for batch in slices(batches, TOGETHER):
        names = batch.column("doc_id").to_pylist()
        rows = []
        for name, found in zip(names, own.encode(batch.column("text").to_pylist())):
            found += END
            for k, (start, length) in enumerate(cuts(len(found) // 4, size)):
                part = found[4 * start:4 * (start + length)]
                rows.append((name, k, start, length, zlib.crc32(part),
                             np.frombuffer(part, "<i4") if ids else None))
        columns = list(zip(*rows))[:6 if ids else 5] or [[]] * (6 if ids else 5)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def pieces(docs: DataFrame, path: str, size: int = 2048, ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids array<int>]) of all documents.

    A null or empty text is the end id alone. `ids` adds the token ids themselves.
    """
    spark = ship(docs.sparkSession)
    data = file_bytes(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return cut_up(batches, file_encoder(data), size, ids, schema)

    schema = pa.schema([("doc_id", to_arrow_type(docs.schema["doc_id"].dataType)),
                        ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * ids)
    return id_text(docs).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, "
             "ids_crc32 long" + ", ids array<int>" * ids)


class Bins:
    """Open bins of one group and their search structure: (room, bin) in order."""

    def __init__(self, size: int):
        self.size = size
        self.items: list[list[int]] = []  # piece numbers
        self.fill: list[int] = []

    def best_fit(self, lengths: list[int]) -> None:
        """Longest first, each into the fullest bin that has room for it."""
        rooms: list[tuple[int, int]] = []
        for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
            at = bisect_left(rooms, (lengths[i], -1))
            if at < len(rooms):
                _, b = rooms.pop(at)
            else:
                b = len(self.items)
                self.items.append([])
                self.fill.append(0)
            self.items[b].append(i)
            self.fill[b] += lengths[i]
            if self.fill[b] < self.size:
                insort(rooms, (self.size - self.fill[b], b))

    def improve(self, lengths: list[int], rounds: int = 12) -> None:
        """Empty the least filled bins into the others.

        In turn, each piece of an underfull bin is moved into the tightest room it fits,
        or swapped for one or two shorter pieces of a fuller bin. Every step raises the sum
        of squared fills, so the search ends; `rounds` bounds how often it goes through the
        bins, and it stops when no packing could have fewer.
        """
        size, items, fill = self.size, self.items, self.fill
        least = -(-sum(lengths) // size)
        for _ in range(rounds):
            used = [b for b in range(len(items)) if items[b]]
            if len(used) <= least:
                break
            open_bins = sorted((b for b in used if fill[b] < size), key=lambda b: (fill[b], b))
            rooms = sorted((size - fill[b], b) for b in open_bins)
            changed = False
            for donor in open_bins[:max(1, len(open_bins) // 4)]:
                for i in sorted(items[donor], key=lambda k: (-lengths[k], k)):
                    if self.move(i, donor, lengths, rooms) or self.swap(i, donor, lengths, rooms):
                        changed = True
            if not changed:
                break

    def shift(self, b: int, rooms: list, add: int) -> None:
        at = bisect_left(rooms, (self.size - self.fill[b], b))
        if at < len(rooms) and rooms[at][1] == b:
            rooms.pop(at)
        self.fill[b] += add
        if 0 < self.fill[b] < self.size:
            insort(rooms, (self.size - self.fill[b], b))

    def move(self, i: int, donor: int, lengths: list[int], rooms: list) -> bool:
        n = lengths[i]
        for at in range(bisect_left(rooms, (n, -1)), len(rooms)):
            b = rooms[at][1]
            if b != donor and self.fill[b] + n > self.fill[donor]:
                self.items[donor].remove(i)
                self.items[b].append(i)
                self.shift(donor, rooms, -n)
                self.shift(b, rooms, n)
                return True
        return False

    def swap(self, i: int, donor: int, lengths: list[int], rooms: list, tries: int = 48) -> bool:
        """The swap of piece `i` for one or two pieces of a fuller bin that fills that bin
        most, looked for in `tries` bins spread evenly over the rooms."""
        n, best = lengths[i], (0, -1, ())
        for at in range(0, len(rooms), max(1, len(rooms) // tries)):
            room, b = rooms[at]
            if b == donor or room <= best[0] or self.fill[b] < self.fill[donor]:
                continue
            inside = sorted(self.items[b], key=lengths.__getitem__)
            values = [lengths[k] for k in inside]
            k = bisect_left(values, n - room)
            if k < len(values) and n - values[k] > best[0]:
                best = (n - values[k], b, (inside[k],))
            for x in range(len(values) - 1):
                y = bisect_left(values, n - room - values[x], x + 1)
                if y < len(values) and n - values[x] - values[y] > best[0]:
                    best = (n - values[x] - values[y], b, (inside[x], inside[y]))
        gain, b, out = best
        if not gain:
            return False
        for k in out:
            self.items[b].remove(k)
            self.items[donor].append(k)
        self.items[donor].remove(i)
        self.items[b].append(i)
        self.shift(donor, rooms, -gain)
        self.shift(b, rooms, gain)
        return True


def pack_group(size: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable")
        lengths = pdf["length"].tolist()
        bins = Bins(size)
        bins.best_fit(lengths)
        bins.improve(lengths)
        number, offset = np.zeros(len(pdf), "int64"), np.zeros(len(pdf), "int64")
        for b, inside in enumerate(bins.items):
            at = 0
            for i in inside:
                number[i], offset[i] = b, at
                at += lengths[i]
        return pdf.assign(sequence_id=(int(key[0]) << 32) + number, offset=offset)

    return run


def pack(cut: DataFrame, size: int = 2048, group_pieces: int = 20_000) -> DataFrame:
    """`cut` with (sequence_id, offset) for every piece, into as few sequences as it finds.

    Full pieces are sequences of their own and never move. The others are dealt by a hash
    into groups of about `group_pieces`, so a group fits one task however many documents
    there are. Repeated rows are packed as often as they occur.
    """
    cut = checkpointed(cut)
    rest = cut.where(F.col("length") < size)
    n = max(1, -(-rest.count() // group_pieces))
    dealt = rest.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n)))
    schema = T.StructType([*cut.schema.fields, T.StructField("_group", T.LongType()),
                           T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    packed = dealt.groupBy("_group").applyInPandas(pack_group(size), schema).drop("_group")
    full = cut.where(F.col("length") == size).select(
        "*", (F.lit(-1) - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)
