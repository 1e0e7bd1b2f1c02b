"""The lexicon of fingerprints holds terms, however many there are."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np

from tallyhouse.llm import fingerprints


def test_terms_of_the_lexicon_when_terms_outnumber_buckets(documents):
    own = 3 * fingerprints.BUCKETS // 100
    rows = [(i, " ".join([f"band{i % 20}", "all", *(f"rare{i}x{k}" for k in range(own))]))
            for i in range(100)]
    seen = Counter(w for _, text in rows for w in set(text.split()))
    want = [w for w, n in seen.items() if 1.5 <= math.log(len(rows) / n) <= 4.0]
    assert sorted(want) == sorted(f"band{k}" for k in range(20))
    got = fingerprints.lexicon_terms(documents(rows), (1.5, 4.0))
    assert got.tolist() == np.sort(fingerprints.terms(" ".join(want))).tolist()


def test_rare_terms_do_not_change_a_fingerprint(documents):
    rows = [(i, f"band{i % 20} " + " ".join(f"rare{i}x{k}" for k in range(8000)))
            for i in range(100)]
    found = fingerprints.fingerprints(documents(rows), (1.5, 4.0)).collect()
    got = {r.doc_id: r.fingerprint for r in found}
    assert all(got[i] == got[i % 20] for i in got)
