"""Exact and near copies against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import exact_dedup, near_dedup
from tests.oracle import compare

from .conftest import HARD


def test_equal_texts_and_heavy_hitters(documents):
    rows = [(i, "hot  text") for i in range(0, 60, 2)] + [(i, f"own {i}") for i in range(1, 60, 2)]
    rows += [(100, "hot\ttext"), (101, "own 1"), (102, None), (103, "")]
    for share in (0.01, 0.2, 0.9):  # all, some and no groups by broadcast
        got = {r.doc_id: (r.keep_id, r.group_size, r.kept)
               for r in exact_dedup.groups(documents(rows), share).collect()}
        assert got[100] == (0, 31, False) and got[0] == (0, 31, True)
        assert got[101] == (1, 2, False) and got[3] == (3, 1, True)
        assert got[102] == (102, 2, True) and got[103] == (102, 2, False)
        assert len(got) == 64


def test_misra_gries_keeps_the_frequent():
    import pyarrow as pa

    values = ["a"] * 50 + [f"x{i}" for i in range(100)]
    random.Random(1).shuffle(values)
    batches = [pa.RecordBatch.from_pydict({"text_sha256": values[i:i + 7]})
               for i in range(0, 150, 7)]
    out = next(exact_dedup.misra_gries(5)(iter(batches))).to_pydict()
    found = dict(zip(out["text_sha256"], out["weight"]))
    assert len(found) <= 5 and 50 - 150 / 5 <= found["a"] <= 50


def test_exact_hard_rows(hard, empty):
    got = exact_dedup.groups(hard).collect()
    assert len(got) == len(HARD)
    assert {(r.doc_id, r.keep_id, r.kept) for r in got} == {
        (1, 1, True), (2, 1, False), (None, 1, False), (3, 3, True), (4, 4, True),
        (None, None, True), (5, 5, True), (6, 6, True)}
    kept = exact_dedup.drop_copies(hard)
    assert kept.columns == hard.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 3, 4, 5, 6]
    assert exact_dedup.groups(empty).count() == 0
    assert exact_dedup.drop_copies(empty).count() == 0


def sets_of(text, words):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute(rows, words, percent):
    """{doc_id: (set size, component)} by comparing all pairs."""
    sets = {i: sets_of(t, words) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_copies_equal_brute_force(documents):
    words, rng = 5, random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for size in (30, 60, 12, 5, 2, 1, 80):
        base = [rng.choice(vocabulary) for _ in range(size)]
        for _ in range(14):  # a chain of edits: neighbours are near, ends are not
            if rng.random() < 0.7:
                base = base.copy()
                base[rng.randrange(size)] = rng.choice(vocabulary)
            rows.append((n, " ".join(base)))
            n += rng.randint(1, 3)
    rows += [(n, None), (n + 1, "  ")]
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in near_dedup.groups(documents(rows), words).collect()}
    assert got == brute(rows, words, 80)


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (7, 7)]
    random.Random(2).shuffle(edges)
    got = {r.node: r.component for r in near_dedup.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 150: 100, 200: 100}


def test_near_hard_rows(hard, empty):
    got = near_dedup.groups(hard).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in got
                  if r.doc_id) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True),
                                   (4, 1, 4, True), (4, 1, 4, True), (5, 1, 5, True),
                                   (6, 1, 6, True)]
    assert all(r.kept for r in got if r.doc_id is None) and len(got) == len(HARD)
    kept = near_dedup.drop_near_copies(hard)
    assert kept.columns == hard.columns and kept.where("doc_id is not null").count() == 6
    assert near_dedup.groups(empty).count() == 0


def test_packed_bits_estimate_similarity():
    import numpy as np

    rng = np.random.Generator(np.random.PCG64(1))
    shared = rng.integers(0, 1 << 63, 800, np.uint64)
    sets = [np.concatenate([shared, rng.integers(0, 1 << 63, 100, np.uint64)]) for _ in range(2)]
    low = np.array([near_dedup.minima(s) for s in sets])
    bits = near_dedup.packed(low).view(np.uint64)
    assert bits.shape == (2, 4)
    unequal = sum(bin(int((x | x >> np.uint64(1)) & np.uint64(0x5555555555555555))).count("1")
                  for x in bits[0] ^ bits[1])
    agree = 1 - unequal / 128
    assert abs((agree - 0.25) / 0.75 - 0.8) < 0.2


@pytest.mark.parametrize("name", ["op3_minhash", "op7_licenses", "op9_exact_dedup"])
def test_queries_equal_sql(spark, con, sf_dir, name):
    from tallyhouse.llm.queries import QUERIES, SQL

    assert compare(QUERIES[name](spark, sf_dir), con, SQL[name]) == ""


def test_of_rows_that_repeat_an_id_the_smallest_text_stays(spark):
    from tallyhouse.llm.common import join_kept

    rows = [(1, "second text"), (1, "first text"), (2, "gone"), (None, "a"), (None, "a"), (3, "x"),
            (3, None)]
    gone = spark.createDataFrame([(2,)], "doc_id long")
    for order in (rows, rows[::-1]):
        got = join_kept(spark.createDataFrame(order, "doc_id long, text string"), gone).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(
            [(1, "first text"), (None, "a"), (None, "a"), (3, None)], key=repr)


def test_bitmaps_never_rule_out_a_link(spark):
    """Sets of many sizes on both sides of a power of two, against the true similarity."""
    rng = np.random.default_rng(5)
    rows, links = [], 0
    for _ in range(300):
        n = int(rng.choice([1, 2, 15, 17, 60, 64, 70, 255, 260, 1100, 5000]))
        x = rng.integers(0, 1 << 63, n).astype(np.uint64)
        cut = int(n * rng.choice([0, 0.05, 0.1, 0.2, 0.4, 1]))
        y = np.r_[x[cut:], rng.integers(0, 1 << 63, int(cut * rng.random())).astype(np.uint64)]
        x, y = np.unique(x), np.unique(y)
        shared = len(np.intersect1d(x, y))
        linked = shared > 0 and 100 * shared >= 80 * (len(x) + len(y) - shared)
        links += linked
        rows.append((near_dedup.marked(x).tolist(), near_dedup.marked(y).tolist(), len(x), len(y),
                     bool(linked), 100 * min(len(x), len(y)) >= 80 * max(len(x), len(y))
                     and 100 * shared < 60 * (len(x) + len(y) - shared)))
    df = spark.createDataFrame(
        rows, "a array<long>, b array<long>, na long, nb long, linked boolean, far boolean")
    may = near_dedup.enough_in_common(F.col("a"), F.col("b"), F.col("na"), F.col("nb"), 80)
    got = df.select("linked", "far", "na", may.alias("may")).collect()
    assert links > 50 and all(r.may for r in got if r.linked)
    # Of the sets that do not fill their bitmaps and whose sizes allow a link, those far from
    # one are ruled out.
    far = [r.may for r in got if r.far and 15 <= r.na <= 1100]
    assert len(far) > 10 and sum(far) < 0.1 * len(far)


def test_a_pair_is_met_in_the_first_band_it_shares(spark):
    df = spark.createDataFrame([([1] * 32, [1] * 32), ([0] * 31 + [5], [9] * 31 + [5]),
                                ([0] * 32, [9] * 32)], "a array<long>, b array<long>")
    got = df.select(near_dedup.first_shared(F.col("a"), F.col("b")).alias("at")).collect()
    assert [r.at for r in got] == [0, 31, None]
