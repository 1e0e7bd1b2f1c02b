"""How much text the packing tokeniser takes at once."""

from __future__ import annotations

import pyarrow as pa

from tallyhouse.llm import packing


class Counted:
    def __init__(self):
        self.most = 0

    def encode(self, texts):
        self.most = max(self.most, sum(map(len, texts)))
        return [len(t).to_bytes(4, "little") for t in texts]


def test_the_tokeniser_takes_a_bounded_part_of_a_batch():
    own, n = Counted(), 60
    batch = pa.record_batch([pa.array(range(n)), pa.array(["a" * 100_000] * n)], ["doc_id", "text"])
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64())])
    out = list(packing.cut_up(iter([batch]), own, 2048, False, schema))
    assert [x for b in out for x in b.column("doc_id").to_pylist()] == list(range(n))
    assert own.most <= 4 << 20
