"""Secrets, personal data, licences and fingerprints against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import fingerprints, licenses, pii
from tallyhouse.llm import secret_scan as secrets

from .conftest import HARD

# --- secrets ------------------------------------------------------------------------------

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)


def secret_spans(text):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
            if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text)
            if len(m[0]) >= 16]
    return sorted(out)


def joined(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)


def random_text(rng, parts, n=12):
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, n)))


def test_base_secrets_equal_brute_force(documents):
    rng = random.Random(4)
    parts = ["token", "Secret", "API_KEY", "apikey", "PASSWD", '"', "'", " ", "  ", ":", "=", "= ",
             "abcdef012345", "0123456789abcdef", "AKIA", "ABCDEFGHIJKLMN12", "é🙂", "x.y-z", "\n"]
    rows = [(i, random_text(rng, parts)) for i in range(1500)]
    rows += [(5000, "password: token:abcdefghijklmnop"), (5001, "ſecret = abcdefghijklmnop"),
             (5002, "a" * 40_000), (5003, "AKIA" * 5000), (5004, None)]
    got = {r.doc_id: r for r in secrets.report(secrets.scan(documents(rows))).collect()}
    for i, text in rows:
        base = secret_spans(text or "")
        assert got[i].base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest(), text
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(
            sum(s[2] == k for s in base) for k in secrets.KINDS)
        assert set(filter(None, joined(base).split(","))) <= set(got[i].spans.split(","))


def test_op5_base_on_the_table(spark, sf_dir):
    from tallyhouse.llm.queries import QUERIES

    rows = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = {r.doc_id: r for r in QUERIES["op5_secrets"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for r in rows:
        want = joined(secret_spans(r["text"] or ""))
        assert got[r["doc_id"]].base_sha256 == hashlib.sha256(want.encode()).hexdigest()


def brute_p(token):
    """The three tests with exact normal tails."""
    plain = token.replace("-", "+").replace("_", "/").rstrip("=")
    alphabet = next(a for a in secrets.ALPHABETS.values() if set(plain) <= set(a))
    v, n, k = [alphabet.index(c) for c in plain], len(plain), len(alphabet)
    tail = lambda z: math.erfc(z / math.sqrt(2)) / 2
    chi = k / n * sum(v.count(x) ** 2 for x in set(v)) - n
    s = 2 / (9 * (k - 1))
    p1 = tail(((chi / (k - 1)) ** (1 / 3) - (1 - s)) / math.sqrt(s))
    high = [x >= k / 2 for x in v]
    n1 = sum(high)
    both = 2 * n1 * (n - n1)
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    variance = both * (both - n) / (n * n * (n - 1))
    p2 = 2 * tail(abs(runs - both / n - 1) / math.sqrt(variance)) if variance > 0 else 0.0
    m = sum(v) / n
    square = sum((x - m) ** 2 for x in v)
    r = sum((a - m) * (b - m) for a, b in zip(v, v[1:])) / square
    p3 = 2 * tail(abs((r + 1 / n) * math.sqrt(n)))
    return min(1.0, 3 * min(p1, p2, p3))


def test_randomness_tests_equal_brute_force(spark):
    rng = random.Random(9)
    tokens = ["".join(rng.choice(a) for _ in range(rng.randint(20, 80)))
              for a in secrets.ALPHABETS.values() for _ in range(40)]
    tokens += ["abc123" * 6, "0a" * 20, "Zz9" + "a" * 40, "a1-B2_c3" * 5 + "=="]
    df = spark.createDataFrame([(t,) for t in tokens], "token string")
    found = secrets.with_tests(df).collect()
    assert len(found) > 150
    for r in found:
        assert r.p == pytest.approx(brute_p(r.token), abs=1e-6), r.token


def test_step_up_rule_is_not_exceeded(spark):
    rng = random.Random(3)
    values = [("x" * rng.choice((20, 30, 40, 60)), 10 ** -rng.uniform(0, 12)) for _ in range(400)]
    cuts = secrets.rejected_below(spark.createDataFrame(values, "token string, p double"), 0.05)
    for size, (low, high) in enumerate(((0, 24), (24, 32), (32, 48), (48, 99))):
        own = sorted(p for t, p in values if low <= len(t) < high)
        exact = max([p for i, p in enumerate(own, 1) if p <= 0.05 * i / len(own)], default=0.0)
        assert sum(p <= cuts[size] for p in own) <= sum(p <= exact for p in own)
        assert cuts[size] > exact / 1.3


def test_random_tokens_are_added_and_words_are_not(documents):
    rng = random.Random(8)
    base64 = secrets.ALPHABETS["base64"].replace("+", "").replace("/", "")
    planted = ["".join(rng.choice(base64) for _ in range(40)) for _ in range(40)]
    planted = [t for t in planted if any(map(str.isdigit, t))]
    rows = [(i, f"see é {t} there") for i, t in enumerate(planted)]
    clean = ["internationalisation", "AAAAAAAAAAAAAAAAAAAAAAAAAAAA1a", "aaaaaaaaaabbbbbbbbbb1A" * 3,
             "this_is_a_long_name_of_2_things", "1234567890123456789012345", "-" * 60]
    rows += [(1000 + i, t) for i, t in enumerate(clean)]
    got = {r.doc_id: r for r in secrets.report(secrets.scan(documents(rows))).collect()}
    found = sum(got[i].spans == f"random:6:{6 + len(t)}" for i, t in enumerate(planted))
    assert found >= 0.9 * len(planted)
    assert not any("random" in got[1000 + i].spans for i in range(len(clean)))


def test_secret_hard_rows(hard, empty):
    rows = secrets.report(secrets.scan(hard)).collect()
    assert len(rows) == len(HARD) and all(r.spans == "" for r in rows)
    assert secrets.scan(empty).count() == 0


# --- personal data -------------------------------------------------------------------------

def personal_spans(text):
    out = [(0, *m.span()) for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        double = [sum(divmod(2 * int(c), 10)) if i % 2 else int(c)
                  for i, c in enumerate(reversed(digits))]
        if 13 <= len(digits) <= 19 and sum(double) % 10 == 0:
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_personal_data_equals_brute_force():
    rng = random.Random(3)
    parts = ["a", "b@", "@", ".", "1", "22", "255", "4", "-", " ", "+", "(", ")", "é", "c.d", "0",
             "4111111111111111"]
    for _ in range(20_000):
        text = random_text(rng, parts, 25)
        assert pii.base_spans(text) == personal_spans(text), text
    for text in ("1" * 50_000, "a" * 50_000 + "@", "a.b" * 9000, "1.2." * 9000, "+1" * 9000,
                 "@" * 50_000):
        assert pii.base_spans(text) is not None  # linear, else this would not end


def test_op10_base_on_the_table(spark, sf_dir):
    from tallyhouse.llm.queries import QUERIES

    rows = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = {r.doc_id: r for r in QUERIES["op10_pii"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for r in rows:
        base = personal_spans(r["text"] or "")
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert got[r["doc_id"]].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert got[r["doc_id"]].spans.startswith(text)


def bootstrap_rows():
    rows = [(i, f"Dear all, call me at +1 (201) 555-{1000 + i} today") for i in range(6)]
    rows += [(10 + i, f"or call me at 555-{2000 + i}x any time") for i in range(2)]
    rows += [(20 + i, f"in the year {1990 + i}-0{i} it rained") for i in range(9)]
    return rows


def test_contexts_discover_what_no_form_covers(documents):
    found = {r.doc_id: r for r in pii.report(pii.entities(documents(bootstrap_rows()))).collect()}
    assert all(found[i].n_phone == 1 and found[i].spans.startswith("phone:") for i in range(6))
    assert found[10].spans == "id:14:23" and found[10].n_phone == 0
    assert all(found[20 + i].spans == "" for i in range(9))


def test_masking_takes_effect_and_leaves_clean_texts(documents, hard, empty):
    rows = bootstrap_rows() + [(90, "clean text"), (91, None)]
    for few in (200_000, 0):  # contexts by broadcast, and by a join
        out = pii.masked(documents(rows), few)
        got = {r.doc_id: r for r in out.collect()}
        assert out.columns == documents(rows).columns and len(got) == len(rows)
        assert got[0].text == "Dear all, call me at [PHONE] today"
        assert got[0].n_chars == len(got[0].text)
        assert got[10].text == "or call me at [ID] any time"
        assert got[90].text == "clean text" and got[91].text is None
    kept = pii.masked(hard)
    assert kept.columns == hard.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, hard.collect()))
    assert pii.masked(empty).count() == 0


def test_personal_hard_rows(hard, empty):
    rows = pii.report(pii.entities(hard)).collect()
    assert len(rows) == len(HARD) and all(r.spans == "" for r in rows)
    assert pii.entities(empty).count() == 0


# --- licences --------------------------------------------------------------------------------

def found_licenses(documents, texts):
    rows = licenses.report(licenses.scan(documents(list(enumerate(texts))))).collect()
    return [r.licenses for r in sorted(rows, key=lambda r: r.doc_id)]


def test_dice_and_size_bounds(documents):
    texts = ["text\nReleased under the  MIT license\nmore", "the MIT institute released",
             "Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: Apache-2.0\n" * 2,
             "licensed under the terms of a license that nobody here has ever seen",
             "SPDX-License-Identifier: Zebra", "SPDX-License-Identifier: MIT"]
    assert found_licenses(documents, texts) == [
        "MIT", "", "CC-BY-NC-4.0", "Apache-2.0", "", "", "MIT"]


def _plain_scan(text):
    """Every window of the rule, one after the other."""
    found = licenses.pairs(licenses.split_words(text))
    best = []
    for name, marks, template in licenses.TEMPLATES:
        form = licenses.profile(template, marks, licenses.THRESHOLD)
        own, seen = set(form["bigrams"]), []
        for first in (k for k, b in enumerate(found) if b in own):
            for size in form["sizes"]:
                last = max(k for k in range(first, min(first + size, len(found)))
                           if found[k] in own)
                window = set(found[first:last + 1])
                dice = 2 * len(window & own) / (len(window) + len(own))
                if dice >= licenses.THRESHOLD and window >= set(form["marks"]):
                    seen.append((-dice, first, last, name))
        best += [min(seen)] if seen else []
    return ",".join(sorted({x[3] for x in best if not any(
        y[0] < x[0] and y[1] <= x[2] and x[1] <= y[2] for y in best)}))


def test_planted_licenses_wrapped_embedded_and_changed(documents):
    """Every template: alone, wrapped as a comment in prose, with words inserted; and texts
    that share words with licences without being one."""
    texts, names = [], []
    prose = "the rest of this text speaks of software and of a license to use copies of it "
    for k, (name, _, template) in enumerate(licenses.TEMPLATES):
        found = template.split()
        wrapped = "".join(w + ("\n * " if j % 7 == 6 else " ") for j, w in enumerate(found))
        changed = " ".join(found[:-1] + ["indeed"] + found[-1:]) if len(found) > 60 else template
        texts += [template.upper(), prose * 2 + wrapped + prose * 2, prose + changed, prose * (k + 1)]
        names += [name, name, name, ""]
    texts += ["Copyright 2020 X. Licensed under the MIT License.", "Licensed under the Apache",
              "GNU General Public License, version 7", prose + licenses._BSD_START]
    names += ["MIT", "", "", ""]
    got = found_licenses(documents, texts)
    assert got == [_plain_scan(t) for t in texts]
    assert got == names


def test_places_are_of_words(documents):
    row = licenses.scan(documents([(1, "a b c. Released under the MIT License! d")])).collect()[0]
    assert [(x.license, x.dice, x.first_word, x.last_word) for x in row.licenses] == [
        ("MIT", 1.0, 3, 7)]


def test_licence_hard_rows(hard, empty):
    rows = licenses.report(licenses.scan(hard)).collect()
    assert len(rows) == len(HARD) and all((r.n_licenses, r.best_dice) == (0, 0.0) for r in rows)
    assert licenses.scan(empty).count() == 0


# --- fingerprints ------------------------------------------------------------------------------

def test_next_document_and_likeness(documents):
    rng = random.Random(6)
    words = [f"term{i}" for i in range(3000)]
    rows = [(3 * i + 7, " ".join(rng.sample(words, rng.randint(0, 80)))) for i in range(150)]
    rows += [(9000, rows[4][1]), (9001, None)]
    rng.shuffle(rows)
    for ranges in (1, 2, 9):
        found = fingerprints.fingerprints(documents(rows), ranges=ranges).collect()
        got = {r.doc_id: r for r in found}
        ordered = sorted(((i, t or "") for i, t in rows), reverse=True)
        assert len(found) == len(rows)
        for k, (i, text) in enumerate(ordered):
            after, half = ordered[(k + 1) % len(ordered)][1], len(text) // 2
            edited = text[:len(text) - half] + after[:half]
            assert got[i].n_chars == len(text)
            assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[9000].fingerprint == got[19].fingerprint
        long = [r for r in found if r.n_chars > 200]
        assert np.mean([r.near_edited > r.near_next for r in long]) > 0.85
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)


def test_lexicon_band_equals_brute_force(documents):
    rows = [(i, " ".join(["all"] + ["half"] * (i % 2) + [f"own{i}"])) for i in range(40)]
    seen = fingerprints.document_frequencies(documents(rows))
    at = lambda w: int(fingerprints.terms(w)[0] % np.uint64(fingerprints.BUCKETS))
    assert (seen[at("all")], seen[at("half")]) == (40, 20) and seen[at("own7")] >= 1
    inside = fingerprints.lexicon(documents(rows), (0.5, 3.0))
    assert not inside[at("all")] and inside[at("half")] and not inside[at("own7")]


def test_subset_hashes_depend_on_the_set_of_terms():
    inside = np.ones(fingerprints.BUCKETS, bool)
    a = fingerprints.subset_hashes("b a c a", inside)
    assert (a == fingerprints.subset_hashes("C  b\na", inside)).all()
    assert fingerprints.likeness(a, a) == 1.0
    assert fingerprints.likeness(a, fingerprints.subset_hashes("x y z", inside)) < 0.1
    nothing = fingerprints.subset_hashes("", inside)
    assert fingerprints.likeness(nothing, nothing) == 1.0


def test_fingerprint_hard_rows(hard, empty, documents):
    rows = fingerprints.fingerprints(hard).collect()
    assert len(rows) == len(HARD)
    assert fingerprints.fingerprints(empty).count() == 0
    one = fingerprints.fingerprints(documents([(1, "a b")])).collect()
    assert len(one) == 1 and one[0].edited_sha256 == hashlib.sha256(b"a a").hexdigest()


def test_spans_text(spark):
    from tallyhouse.llm.common import spans_text

    df = spark.sql("SELECT array(struct('a' AS kind, 1 AS start, 2 AS end)) AS s")
    assert df.select(spans_text(F.col("s"))).first()[0] == "a:1:2"
