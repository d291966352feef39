"""All links between different texts, and their number for each document."""

import pytest

from telmart.llm import jaccard
from tests.llm.test_jaccard import near_copies, shingle_set


@pytest.mark.parametrize("block", [1 << 20, 3000])
def test_every_link(documents, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    rule = jaccard.Rule(3, 70)
    texts = near_copies(9, 120)
    rows = list(enumerate(texts + texts[:15]))
    sets = [shingle_set(text, rule.words) for _, text in rows]
    pairs = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= rule.percent * len(sets[i] | sets[j])
    ]
    number = {i: sum(i in pair for pair in pairs) for i, _ in rows}
    found = jaccard.linked_documents(documents(rows), rule).collect()
    assert {row.doc_id: row.n_links for row in found} == number
    name = {x: min(i for i, y in enumerate(sets) if x == y) for x in sets}
    wanted = {frozenset((name[sets[i]], name[sets[j]])) for i, j in pairs if sets[i] != sets[j]}
    links = [frozenset((row.a_id, row.b_id)) for row in jaccard.links(documents(rows), rule).collect()]
    assert len(links) == len(set(links)) and set(links) == wanted
