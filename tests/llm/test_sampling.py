"""Resampling, mixing and infilling against brute force and their SQL."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import infill, mixing, resample
from tallyhouse.llm.queries import QUERIES, SQL
from tests.oracle import compare

from .conftest import HARD

TEXTS = ["The cat, the CAT & the hat", "", "one", "naïve café — 東京 𝒳y z9", "a\x00b\x7fc  d" * 40,
         "word " * 300, "x" * 70_000 + " tail"]


@pytest.mark.parametrize("name", ["op11_resample", "op12_mixing", "op13_infill"])
def test_queries_match_their_sql(name, spark, sf_dir, con):
    assert compare(QUERIES[name](spark, sf_dir), con, SQL[name]) == ""


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


@pytest.mark.parametrize("shortest,longest", [(1, 1), (1, 3), (2, 4)])
def test_crcs_of_runs_follow_from_prefixes(shortest, longest):
    counts, owner, crcs = resample.run_crcs([t.encode() for t in TEXTS], shortest, longest)
    assert counts.tolist() == [len(words_of(t)) for t in TEXTS]
    for k, text in enumerate(TEXTS):
        w = words_of(text)
        want = Counter(zlib.crc32(" ".join(w[i:i + n]).encode())
                       for n in range(shortest, longest + 1) for i in range(len(w) - n + 1))
        assert Counter(crcs[owner == k].tolist()) == want


def test_shift_appends_zero_bytes():
    for n in (0, 1, 7, 64, 1000, 99_999):
        a, b = zlib.crc32(b"left part"), zlib.crc32(b"z" * n)
        got = resample.shifted(np.array([a], np.uint32), np.array([n]))[0] ^ np.uint32(b)
        assert got == zlib.crc32(b"left part" + b"z" * n)


def drawn(rows, target, longest, buckets, least, percent, seed):
    def runs(text):
        w = words_of(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets
                for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    s, t = (Counter(b for text in texts for b in runs(text))
            for texts in ([r[1] for r in rows], target))
    S, T = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in rows:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + buckets)
                                                / ((s[b] + 1) * (T + buckets)))) for b in runs(text))
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(runs(text)), weight,
                    weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None])
    may = [i for i, r in enumerate(rows) if len(words_of(r[1])) >= least]
    may.sort(key=lambda i: (-out[i][3], out[i][0] is None, out[i][0] or 0, out[i][1]))
    for place, i in enumerate(may[:percent * len(may) // 100]):
        out[i][4] = place + 1
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("longest,range_rows", [(1, 500_000), (2, 7)])
def test_resampling_brute_force(spark, documents, longest, range_rows):
    rows = [(i, f"alpha {'beta ' * (i % 7)}gamma {i % 5} {'DELTA' if i % 3 else 'zeta'}")
            for i in range(60)] + HARD + [(70, "alpha " * 30), (71, "alpha " * 30), (71, "alpha " * 30)]
    target = ["gamma delta 3", None, "", "beta beta"]
    goal = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resample.resample(documents(rows), goal, longest=longest, buckets=97, least_words=4,
                            percent=30, range_rows=range_rows)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == drawn(
        rows, target, longest, 97, 4, 30, 2024)


def test_resampling_hard_rows(hard, empty):
    got = {r.n_features: r for r in resample.resample(hard, empty).collect()}
    assert len(resample.resample(hard, empty).collect()) == len(HARD)
    assert got[0].weight == 0 and all(r.rank is None for r in got.values())
    assert resample.resample(empty, hard).count() == 0


# --- mixing ---

def filled(sizes, weights, percent, most):
    """Targets by sharing again and again what capped sources leave."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        left = sum(sizes.values()) * percent / 100 - sum(most * sizes[s] for s in capped)
        share = sum(w[s] for s in names if s not in capped)
        target = {s: most * sizes[s] if s in capped else left * w[s] / share for s in names}
        over = {s for s in names if s not in capped and target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over


def sourced(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("block,part_rows", [(8, 20_000), (64, 5), (1000, 50)])
def test_mixture_meets_targets(spark, block, part_rows):
    rows = [(i, "w " * (1 + i * 7 % 40), "abcd"[min(i % 9, 3)]) for i in range(400)]
    rows += [(1000, "w " * 5000, "e"), (1001, None, "f"), (1002, "", None), (1003, "solo", None)]
    streams, passages = mixing.mix(sourced(spark, rows), block=block, part_rows=part_rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    want = filled(sizes, (3, 1, 2), 150, 2)
    size_of = {r[0]: len((r[1] or "").split()) for r in rows}
    taken, source_of = defaultdict(int), {r[0]: r[2] for r in rows}
    report = mixing.report(streams, passages).collect()
    assert len(report) == len(rows)
    for r in report:
        assert (r.size, r.source_size) == (size_of[r.doc_id], sizes[source_of[r.doc_id]])
        assert r.target == pytest.approx(want[source_of[r.doc_id]], rel=1e-12)
        assert 0 <= r.taken <= 2 * r.size
        taken[source_of[r.doc_id]] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)
    # passages are within their document, and a slot has at most a block
    found = passages.collect()
    assert all(0 <= p["from"] and p.length > 0 and p["from"] + p.length <= size_of[p.doc_id]
               for p in found)
    slots = defaultdict(int)
    for p in found:
        slots[p.slot] += p.length
    assert max(slots.values()) <= block and sum(slots.values()) == sum(taken.values())
    again = mixing.report(*mixing.mix(sourced(spark, rows).repartition(5), block=block,
                                      part_rows=part_rows))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, report))


def test_every_stretch_holds_the_weights(spark):
    rows = [(i, "w " * 50, "abc"[i % 3]) for i in range(600)]
    streams, passages = mixing.mix(sourced(spark, rows), block=20)
    source = {r.doc_id: r.source for r in streams.collect()}
    slots = sorted((p.slot, source[p.doc_id]) for p in passages.collect())
    order = [s for _, s in sorted(set(slots))]
    share = {s: order.count(s) / len(order) for s in "abc"}
    for at in range(0, len(order) - 200, 200):
        for s in "abc":
            assert abs(order[at:at + 200].count(s) - 200 * share[s]) <= 4


def test_slots_are_numbered_over_parts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PART", 16)
    table = spark.createDataFrame([(0, 700), (1, 100), (2, 3), (3, 0)], "number long, goal long")
    got = mixing.schedule(table, 10).collect()
    for number, goal in ((0, 70), (1, 10), (2, 1)):
        ks = [r.k for r in sorted(got, key=lambda r: r.slot) if r.number == number]
        assert ks == list(range(goal))
    assert len({r.slot for r in got}) == len(got) == 81


def test_mixing_hard_rows(hard, empty):
    got = mixing.report(*mixing.mix(hard)).collect()
    assert len(got) == len(HARD)
    assert sum(r.taken for r in got) == round(1.5 * sum(r.size for r in got))
    assert mixing.report(*mixing.mix(empty)).count() == 0
    blank = mixing.report(*mixing.mix(hard.where("doc_id < 4"))).collect()
    assert {(r.size, r.target, r.taken) for r in blank} == {(0, 0.0, 0)}


# --- infilling ---

def by_units(doc_id, text, seed=1, rate=90, spm_rate=20):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if h4 % 100 < spm_rate:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


def test_infilling_brute_force(documents, hard, empty):
    rows = [(1000 + i, t) for i, t in enumerate(
        [*TEXTS, "has <S> inside", "<", "<P", "ends with <S", "é<M", "𝒳" * 50, "a\nb\r\nc",
         "<<P><", "日本語 mixed ascii 🙂🙂 text " * 50])] + HARD
    rows += [(i, f"Doc {i}: naïve <{'P' * (i % 3)} 東{i}京 end<") for i in range(100)]
    got = infill.round_trip(documents(rows)).collect()
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert sorted(map(tuple, got), key=repr) == sorted((by_units(*r) for r in rows), key=repr)
    apart = infill.restore(infill.transform(documents(rows)))
    assert sorted(r.restored for r in apart.collect()) == sorted(r[1] or "" for r in rows)
    assert infill.round_trip(hard).count() == len(HARD)
    assert infill.round_trip(empty).count() == infill.transform(empty).count() == 0


def test_exception_index_converts_both_ways():
    for text in [*TEXTS, "é", "𝒳é東a" * 20, "ascii only"]:
        data = np.frombuffer(text.encode(), np.uint8)
        index = infill.Exceptions(data)
        assert len(index.at_byte) == sum(ord(c) > 127 for c in text)
        chars = np.arange(len(text) + 1)[:2000]
        cuts = np.array([len(text[:i].encode()) for i in chars])
        assert index.chars(cuts).tolist() == chars.tolist()
        assert index.bytes(chars).tolist() == cuts.tolist()
