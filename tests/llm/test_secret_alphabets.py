"""Random tokens of every alphabet are found."""

from __future__ import annotations

import random

import pytest

from tallyhouse.llm import secret_scan as secrets


@pytest.mark.parametrize("letters", [
    "0123456789ABCDEF", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789abcdefghijklmnopqrstuvwxyz"])
def test_planted_tokens_of_an_alphabet_are_added(documents, letters):
    rng = random.Random(12)
    planted = ["".join(rng.choice(letters) for _ in range(40)) for _ in range(40)]
    rows = [(i, f"see {t} there") for i, t in enumerate(planted)]
    got = {r.doc_id: r for r in secrets.report(secrets.scan(documents(rows))).collect()}
    assert sum(got[i].spans == "random:4:44" for i in range(len(rows))) >= 0.9 * len(rows)
