"""The Katz model against a plain program on small tables."""

import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from telmart.llm import katz


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["<end>"]


def held(doc_id):
    return crc32(str("" if doc_id is None else doc_id).encode()) % 10 == 0


def discount(counts):
    n = Counter(counts.values())
    k = katz.KATZ_LIMIT
    out = {}
    if n[1] == 0 or (k + 1) * n[k + 1] / n[1] >= 1:
        return out
    common = (k + 1) * n[k + 1] / n[1]
    for r in range(1, k + 1):
        if n[r]:
            value = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common)
            if 0 < value < 1:
                out[r] = value
    return out


def brute(rows):
    train = [tokens(text) for doc_id, text in rows if not held(doc_id)]
    unigram = Counter(word for doc in train for word in doc)
    bigram = Counter(pair for doc in train for pair in zip(["<start>", *doc], doc))
    total = sum(unigram.values())
    d1, d2 = discount(unigram), discount(bigram)

    def share(counts, by):
        size = sum(counts.values())
        used = sum(c * by.get(c, 1) for c in counts.values())
        below = size + 1 if used >= size - 1e-9 else size
        return {w: c * by.get(c, 1) / below for w, c in counts.items()}, (below - used) / below

    p1, unknown = share(unigram, d1) if total else ({}, 1.0)
    after = defaultdict(dict)
    for (h, w), c in bigram.items():
        after[h][w] = c
    model = {}
    for h, counts in after.items():
        p, free = share(counts, d2)
        model[h] = p, free / (1 - sum(p1[w] for w in counts))
    out = []
    for doc_id, text in rows:
        doc = tokens(text)
        score = 0.0
        for h, w in zip(["<start>", *doc], doc):
            p, weight = model.get(h, ({}, 1.0))
            score += math.log10(p[w] if w in p else weight * p1.get(w, unknown))
        base = sum(math.log10((unigram[w] + 0.1) / (total + 0.1 * (len(unigram) + 1))) for w in doc)
        out.append((doc_id, held(doc_id), len(doc), sum(w in unigram for w in doc), total, base, score))
    return out, model, p1, unknown


def same(found, wanted):
    key = lambda row: (row[0] is None, row[0], row[5], row[6])
    found, wanted = sorted(map(tuple, found), key=key), sorted(wanted, key=key)
    assert [row[:5] for row in found] == [row[:5] for row in wanted]
    for a, b in zip(found, wanted):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


def test_odd_texts(documents, odd_texts):
    rows = list(enumerate(odd_texts * 3)) + [(None, "two words"), (None, None), (3, "x"), (3, "x"), (3, "y")]
    same(katz.score(documents(rows)).collect(), brute(rows)[0])


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(row.doc_id, row.text) for row in table.collect()]
    same(katz.score(table).collect(), brute(rows)[0])


@pytest.mark.parametrize("known", [0, 7, 40])
def test_few_known_words_and_split_histories(spark, documents, odd_texts, monkeypatch, known):
    """The number of words known everywhere changes no result; frequent
    histories lie in many blocks."""
    monkeypatch.setattr(katz, "KNOWN_EVERYWHERE", known)
    monkeypatch.setattr(katz, "BLOCKS_PER_PARTITION", 9)
    monkeypatch.setattr(katz, "TOKENS_AT_ONCE", 5000)
    rows = list(enumerate(odd_texts * 2))
    same(katz.score(documents(rows)).collect(), brute(rows)[0])


def test_histories_add_up_to_one():
    texts = ["a b a c a b", "b a d", "c c c a b e", "a b", "f g h i j"]
    rows = [(i, t) for i, t in enumerate(texts) if not held(i)]
    _, model, p1, unknown = brute(rows)
    for p, weight in model.values():
        unseen = sum(q for w, q in p1.items() if w not in p) + unknown
        assert sum(p.values()) + weight * unseen == pytest.approx(1)


def test_empty_table_and_no_training(documents):
    assert katz.score(documents([])).collect() == []
    outside = next(i for i in range(1000) if held(i))
    rows = [(outside, "some words")]
    same(katz.score(documents(rows)).collect(), brute(rows)[0])


def test_discounts_between_zero_and_one():
    by = katz.discounts(np.array([0, 1000, 400, 200, 120, 80, 55]))
    assert by[0] == 1 and all(0 < x < 1 for x in by[1:])
