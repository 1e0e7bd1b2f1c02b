"""Landed files and edits grow with the table."""

from __future__ import annotations

import os

from tallyhouse.plans import QUERIES, stream


def test_landed_files_and_edits_keep_the_partitions_of_the_scan(
        spark, sf_dir, tmp_path, monkeypatch):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").limit(2000)
    rows.repartition(12).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(stream, "shared_folder", lambda spark, purpose: f"{tmp_path}/out")
    wide = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(wide)
    spark.conf.set(wide, str(128 << 20))
    try:
        got = QUERIES["stream_upsert"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.set(wide, before)
    landed = [f for f in os.listdir(f"{tmp_path}/out/landed") if f.endswith(".parquet")]
    assert len(landed) == 24
    assert sum(r["events"] for r in got) == sum(r["keys"] for r in got) == rows.count()
