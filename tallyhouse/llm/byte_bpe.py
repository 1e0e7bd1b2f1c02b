"""Byte-level BPE with a hierarchical-bitmap rank queue.

Pre-tokens are linked lists of parts, many of them laid end to end with a barrier between
them that merges with nothing. Every adjacent pair that the vocabulary can merge is queued
under its merge rank: a bucket of list positions per rank, and a bitmap of two levels over
the ranks, in which find-first-set gives the lowest rank that has entries. An entry whose
pair has changed meanwhile is skipped when it comes up, so merging n bytes costs in
proportion to n pushes and pops, however long a pre-token is.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, file_bytes, held, id_text, ship, slices

# Unicode White_Space, which `\s` of the pattern stands for.
SPACE = "\t-\r \x85\xa0  -     　"
# A single space before other characters always begins a match of the pattern, so texts can
# be cut there first and the pieces looked up.
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


# Ranks to a word of the lower level of the bitmap, as a power of two; both levels are then
# about equally wide for vocabularies of some ten thousand tokens.
WORD_BITS = 8
LOW = (1 << WORD_BITS) - 1
TOGETHER = 200_000  # bytes of pre-tokens that share a queue; a longer one has its own
GONE = -2  # in place of the id of a part that was merged into the one before it


class Encoder:
    """Ids of texts by a rank table; single bytes must be in it."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        # `\s` as written means White_Space; here it would also take U+001C to U+001F.
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}")
                                     .replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]"))
        self.barrier = max(ranks.values()) + 1  # an id that nothing follows
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)] + [self.barrier])
        self.byte_pairs = np.full((257, 257), -1)
        self.byte_pairs[:256, :256] = [[ranks.get(bytes([a, b]), -1) for b in range(256)]
                                       for a in range(256)]
        # For each id those that may follow it, with the rank of the two as one.
        self.follow: list[dict[int, int]] = [{} for _ in range(self.barrier + 1)]
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    self.follow[left][right] = rank
        self.pieces = Memo(None, 300_000)
        self.chunks = Memo(None)

    def merged(self, pieces: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of pre-tokens that share one queue."""
        follow = self.follow
        data = np.frombuffer(b"\0" + b"\0".join(pieces) + b"\0", np.uint8).astype(np.int64)
        data[0] = data[-1] = 256
        data[np.cumsum([len(p) + 1 for p in pieces])] = 256  # the barriers
        ids = self.byte_ids[data].tolist()  # of the part that starts at a position
        end = list(range(1, len(data) + 1))  # of that part
        before = list(range(-1, len(data) - 1))
        pairs = np.append(self.byte_pairs[data[:-1], data[1:]], -1)  # of it and the next
        pair = pairs.tolist()
        order = np.flatnonzero(pairs >= 0)
        order = order[np.argsort(pairs[order], kind="stable")]
        ranks, starts = np.unique(pairs[order], return_index=True)
        places, edges = order.tolist(), [*starts.tolist(), len(order)]
        buckets = {rank: places[a:b] for rank, a, b in zip(ranks.tolist(), edges, edges[1:])}
        words = [0] * ((self.barrier >> WORD_BITS) + 1)
        top = 0  # a bit for every word that is not zero
        for rank in buckets:
            words[rank >> WORD_BITS] |= 1 << (rank & LOW)
            top |= 1 << (rank >> WORD_BITS)
        while top:
            at = (top & -top).bit_length() - 1
            low = words[at] & -words[at]
            rank = (at << WORD_BITS) + low.bit_length() - 1
            words[at] ^= low
            if not words[at]:
                top &= top - 1
            after = follow[rank]
            positions = buckets.pop(rank)
            positions.sort()  # the leftmost of two that overlap is merged
            rest = iter(positions)
            for i in rest:
                if pair[i] != rank:
                    continue  # stale: the pair has changed
                j = end[i]
                end[i] = stop = end[j]
                before[stop] = i
                pair[j], ids[j], ids[i] = -1, GONE, rank
                left = before[i]
                new, new_left = after.get(ids[stop], -1), follow[ids[left]].get(rank, -1)
                pair[i], pair[left] = new, new_left
                if new >= 0:
                    if new in buckets:
                        buckets[new].append(i)
                    else:
                        buckets[new] = [i]
                        words[new >> WORD_BITS] |= 1 << (new & LOW)
                        top |= 1 << (new >> WORD_BITS)
                if new_left >= 0:
                    if new_left in buckets:
                        buckets[new_left].append(left)
                    else:
                        buckets[new_left] = [left]
                        words[new_left >> WORD_BITS] |= 1 << (new_left & LOW)
                        top |= 1 << (new_left >> WORD_BITS)
                if 0 <= new < rank or 0 <= new_left < rank:
                    # What has just become possible comes before the others of this rank.
                    if waiting := list(rest):
                        buckets[rank] = waiting
                        words[at] |= low
                        top |= 1 << at
        found = np.array(ids)
        found = found[found != GONE]
        edges = np.flatnonzero(found == self.barrier).tolist()
        raw = found.astype("<u4").tobytes()
        return [raw[4 * a + 4:4 * b] for a, b in zip(edges, edges[1:])]

    def merge_all(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Little-endian 32-bit ids of each distinct pre-token."""
        found, rest, size = {}, [], 0
        for piece in pieces:
            whole = self.ranks.get(piece)
            if whole is not None:
                found[piece] = whole.to_bytes(4, "little")
                continue
            if rest and size + len(piece) > TOGETHER:
                found.update(zip(rest, self.merged(rest)))
                rest, size = [], 0
            rest.append(piece)
            size += len(piece)
        if rest:
            found.update(zip(rest, self.merged(rest)))
        return found

    def merge(self, piece: bytes) -> bytes:
        return self.merge_all([piece])[piece]

    def new_chunks(self, chunks: list[str]) -> dict[str, bytes]:
        cut = [[m.encode() for m in self.pattern.findall(c)] for c in chunks]
        found = self.pieces.with_all(set().union(*cut), self.merge_all)
        return {c: b"".join(map(found.__getitem__, pieces)) for c, pieces in zip(chunks, cut)}

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of whole texts."""
        cut = [CHUNK.findall(t) for t in texts]
        found = self.chunks.with_all(set().union(*cut), self.new_chunks)
        return [b"".join(map(found.__getitem__, chunks)) for chunks in cut]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def load_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file: base64 of the token and its rank on each line."""
    return {base64.b64decode(token): int(rank)
            for token, rank in map(bytes.split, data.splitlines())}


def encoder(data, pattern: str) -> Encoder:
    """The worker's encoder for a broadcast rank file, built once."""
    return held(("byte_bpe", hash((data.value, pattern))),
                lambda: Encoder(load_ranks(data.value), pattern))


def encoded(batches: Iterator[pa.RecordBatch], data, pattern: str) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids) of batches of (doc_id, text)."""
    own = encoder(data, pattern)
    for batch in slices(batches):
        found = own.encode_all(batch.column("text").to_pylist())
        ends = np.cumsum([0, *map(len, found)]) // 4
        ids = pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4")))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])


def decoded(batches: Iterator[pa.RecordBatch], data) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids, decoded) of batches of (doc_id, ids), one document at a time."""
    token = {rank: word for word, rank in load_ranks(data.value).items()}
    for batch in batches:
        texts = [b"".join(map(token.__getitem__, x.values.to_numpy().tolist()))
                 if x.values is not None else None for x in batch.column("ids")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.binary())],
            ["doc_id", "ids", "decoded"])


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) of each whole text, every match of `pattern` on its own.

    A null or empty text has no ids. Repeated rows and null doc_ids pass through; other
    columns are ignored; an empty table gives no rows.
    """
    data = file_bytes(ship(docs.sparkSession), path)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return id_text(docs).mapInArrow(lambda batches: encoded(batches, data, pattern),
                                    f"doc_id {id_type}, ids array<int>")


def decode(ids: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) with the bytes that the ids stand for, as `decoded` (null ids: null)."""
    data = file_bytes(ship(ids.sparkSession), path)
    id_type = ids.schema["doc_id"].dataType.simpleString()
    return ids.select("doc_id", "ids").mapInArrow(
        lambda batches: decoded(batches, data),
        f"doc_id {id_type}, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """decode(encode(docs)) in one pass through one Python worker per task."""
    data = file_bytes(ship(docs.sparkSession), path)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return id_text(docs).mapInArrow(
        lambda batches: decoded(encoded(batches, data, pattern), data),
        f"doc_id {id_type}, ids array<int>, decoded binary")


def digest(pairs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of encoded and decoded documents."""
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return pairs.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
