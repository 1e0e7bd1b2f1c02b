"""Identifiers at the start of a line, and tokens of any length."""

from __future__ import annotations

import pytest

from tallyhouse.llm import pii


def test_every_token_with_a_digit_or_at_sign_is_an_instance():
    text = "SSN 123-45-6789\nX12 (no 7), mail jo@home and\n\n" + "9" * 80 + "\n= #a1b."
    _, found = pii.scan_text(text)
    assert [(c, text[a:b]) for c, _, _, a, b in found] == [
        ("\n ssn", "123-45-6789"), ("\n \n", "X12"), ("x no", "7"), ("no mail", "jo@home"),
        ("\n \n", "9" * 80), ("= #", "a1b")]
    assert all(len(form) <= 64 for _, form, _, _, _ in found)
    far = "two words" + " ." * 100 + " 12345"
    assert [i[0] for i in pii.scan_text(far)[1]] == ["two words"]
    for text in ("a." * 50_000, "1 " * 50_000, "-a" * 50_000, "a1." * 50_000, "@" * 50_000):
        assert pii.scan_text(text) is not None  # linear, else this would not end


@pytest.mark.parametrize("few", [200_000, 0])
def test_the_first_words_of_a_line_are_a_context(documents, few):
    rows = [(i, f"Contact\nPhone +1 (201) 555-{1000 + i}\n") for i in range(6)]
    rows += [(10 + i, f"Contact\nPhone 555-{2000 + i}x") for i in range(2)]
    rows += [(20, "Phone jo@home"), (21, "Fax 555-7777x")]
    got = {r.doc_id: r.text for r in pii.masked(documents(rows), few).collect()}
    assert got[0] == "Contact\nPhone [PHONE]\n" and got[10] == "Contact\nPhone [ID]"
    assert got[20] == "Phone [ID]" and got[21] == "Fax 555-7777x"
