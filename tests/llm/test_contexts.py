"""Contexts of personal data: who may vouch for whom."""

from __future__ import annotations

from tallyhouse.llm import pii


def added(documents, texts):
    rows = pii.entities(documents(list(enumerate(texts)))).collect()
    return {r.doc_id: [texts[r.doc_id][s["start"]:s["end"]] for s in r.added] for r in rows}


def test_a_context_does_not_vouch_for_itself(documents):
    known = [f"the reference number +1 (201) 555-{1000 + i} stands" for i in range(2)]
    clean = [f"the reference number {2010 + i}-0{i + 1}-17 stands" for i in range(5)]
    assert not any(added(documents, known + clean).values())
    # nor do two such contexts for each other
    other = [t.replace("reference number", "order date").replace("555-1", "555-3")
             for t in known + clean]
    assert not any(added(documents, known + clean + other).values())


def test_found_instances_support_further_contexts(documents):
    texts = [f"please call me at +1 (201) 555-{1000 + i} today" for i in range(9)]
    texts += [f"please call me at 555-{2000 + i}x today" for i in range(3)]
    texts += [f"my pager number 555-{2000 + i}x is on" for i in range(3)]
    got = added(documents, texts)
    assert all(got[i] == [f"555-{2000 + k}x"] for k in range(3) for i in (9 + k, 12 + k))
