"""Fill-in-the-middle transformation with a sparse index of multibyte characters.

A text is cut at word boundaries into prefix, middle and suffix, and written suffix before
middle with a mark before each part. Cuts are found on the UTF-8 bytes. To tell them in code
points only the multibyte characters are recorded, as positions and excess bytes: a binary
search gives the excess before a cut, and everything else is a subtraction, so an ASCII text
needs no index at all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, ship, slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

# Of a byte: an ASCII letter; how many bytes its character has beyond one.
LETTER = np.zeros(256, bool)
LETTER[ord("A"):ord("Z") + 1] = LETTER[ord("a"):ord("z") + 1] = True
EXCESS = np.zeros(256, np.int64)
EXCESS[0xC0:0xE0], EXCESS[0xE0:0xF0], EXCESS[0xF0:] = 1, 2, 3


class Exceptions:
    """Where the multibyte characters of a text are, and nothing about the others."""

    def __init__(self, data: np.ndarray):
        self.at_byte = np.flatnonzero(data >= 0xC0)
        self.excess = np.append(0, np.cumsum(EXCESS[data[self.at_byte]]))  # before the k-th
        self.at_char = self.at_byte - self.excess[:-1]

    def chars(self, cuts):
        """Code points before byte cuts; the cuts lie between characters."""
        return cuts - self.excess[np.searchsorted(self.at_byte, cuts)]

    def bytes(self, cuts):
        """Bytes before code-point cuts."""
        return cuts + self.excess[np.searchsorted(self.at_char, cuts)]


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Byte positions of the units: each run of ASCII letters, each other character."""
    letter = LETTER[data]
    start = (data & 0xC0) != 0x80  # not within a character
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(start)


def draws(seed: int, doc_id) -> list[int]:
    """Four 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k:k + 4], "big") for k in (0, 4, 8, 12)]


def rearranged(text: bytes, doc_id, seed: int, rate: int, spm_rate: int):
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    data = np.frombuffer(text, np.uint8)
    starts = unit_starts(data)
    n = len(starts)
    a, b, which, order = draws(seed, doc_id)
    if n == 0 or which % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, PLAIN, None, None, text
    first, second = sorted((a % (n + 1), b % (n + 1)))
    cuts = np.append(starts, len(text))[[first, second]]
    to_chars = Exceptions(data).chars(cuts)
    i, j = cuts.tolist()
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    form = SPM if order % 100 < spm_rate else PSM
    output = (SUFFIX + suffix + PREFIX + prefix if form == SPM else
              PREFIX + prefix + SUFFIX + suffix) + MIDDLE + middle
    return n, form, int(to_chars[0]), int(to_chars[1] - to_chars[0]), output


def original(output: bytes, form: str) -> bytes:
    """The text that an output was made from. A part never holds a mark, nor can a part and
    the mark after it make one up earlier, so the first mark of a kind is the one written."""
    if form == PLAIN:
        return output
    head, second = (SUFFIX, PREFIX) if form == SPM else (PREFIX, SUFFIX)
    at = output.index(second)
    end = output.index(MIDDLE, at)
    one, two, middle = output[len(head):at], output[at + len(second):end], output[end + len(MIDDLE):]
    return two + middle + one if form == SPM else one + middle + two


SCHEMA = "n long, form string, prefix_chars long, middle_chars long, output string"


def transformed(batches: Iterator[pa.RecordBatch], seed: int, rate: int,
                spm_rate: int) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    for batch in slices(batches):
        rows = [rearranged(text, doc_id, seed, rate, spm_rate) for doc_id, text in zip(
            batch.column("doc_id").to_pylist(),
            batch.column("text").cast(pa.binary()).to_pylist())]
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
        columns[4] = columns[4].cast(pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], [
            "doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, column="output"):
        texts = [None if o is None or f is None else original(o, f) for o, f in zip(
            batch.column("output").cast(pa.binary()).to_pylist(),
            batch.column("form").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())],
            [*batch.schema.names, "restored"])


def transform(docs: DataFrame, seed: int = 1, rate: int = 90, spm_rate: int = 20) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of each row.

    `rate` percent of the texts are rearranged, `spm_rate` percent of those with the suffix
    first. A null or empty text, and one that holds a mark, stays plain (null counts). Rows
    that repeat a doc_id draw the same numbers; a null doc_id draws as an empty one. Other
    columns are ignored; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return id_text(docs).mapInArrow(
        lambda batches: transformed(batches, seed, rate, spm_rate), f"doc_id {id_type}, {SCHEMA}")


def restore(outputs: DataFrame) -> DataFrame:
    """(doc_id, form, output) with the text it was made from as `restored`."""
    ship(outputs.sparkSession)
    id_type = outputs.schema["doc_id"].dataType.simpleString()
    return outputs.select("doc_id", "form", "output").mapInArrow(
        restored, f"doc_id {id_type}, form string, output string, restored string")


def round_trip(docs: DataFrame, seed: int = 1, rate: int = 90, spm_rate: int = 20) -> DataFrame:
    """transform() and restore() in one pass through one Python worker per task."""
    ship(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return id_text(docs).mapInArrow(
        lambda batches: restored(transformed(batches, seed, rate, spm_rate)),
        f"doc_id {id_type}, {SCHEMA}, restored string")
