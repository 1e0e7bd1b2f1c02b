"""The corpus pipeline, stage by stage, against brute force."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm.test_copies import brute
from tests.llm.test_tokens import check_packed


@pytest.fixture
def corpus(spark, tmp_path, documents):
    words = "the cat sat on the mat and the dog ran over the hill to the sea in the rain".split()
    rows = [(i, " ".join(words[k % 18] + ("s" if k % (i + 2) == 0 else "") for k in range(40)), "en")
            for i in range(8)]
    rows += [(20 + i, "der hund und die katze sind im haus " * 4 + f"tag {i}", "de")
             for i in range(4)]
    rows += [(40, rows[0][1].replace(" ", "  "), "en"), (41, "12345 --- 67890", "en"),
             (42, None, "de"), (43, "mail me at jo@example.org or +1 (201) 555-1234 now", "en"),
             (44, " ".join(words), "en")]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_every_stage(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    before = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, corpus)
        after.write.parquet(f"{corpus}/{k}")
        after = spark.read.parquet(f"{corpus}/{k}")
        old = {r.doc_id: r.text for r in before.collect()}
        if name != "packing":
            assert after.columns == docs.columns
            new = {r.doc_id: r.text for r in after.collect()}
            assert len(new) == after.count()
        if name == "language_id":
            assert set(old) - set(new) == {41, 42}
        if name == "exact_dedup":
            assert set(old) - set(new) == {40}
        if name == "near_dedup":
            want = brute(list(old.items()), 5, 80)
            assert set(new) == {i for i, (_, part) in want.items() if part == i}
        if name == "pii":
            assert set(new) == set(old)
            assert new[43] == "mail me at [EMAIL] or [PHONE] now"
            assert all(new[i] == old[i] for i in new if i != 43)
        if name == "packing":
            rows = after.collect()
            assert {r.doc_id for r in rows} == set(old) and check_packed(rows, 2048) == 1
        before = after


def test_run_on_hard_rows(spark, tmp_path, hard):
    hard.write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                           "offset"]
    assert out.count() == 0  # no language can be learned, so every document goes
