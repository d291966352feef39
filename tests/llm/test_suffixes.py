"""Repeated strings against a plain program on small tables."""

import hashlib
import random

import pytest

from telmart.llm import suffixes


def brute(texts, length):
    """(bytes, removed, spans, digest of the rest) of each text."""
    data = [(text or "").encode() for text in texts]
    seen = {}
    for i, text in enumerate(data):
        for at in range(len(text) - length + 1):
            seen.setdefault(text[at: at + length], []).append((i, at))
    gone = [bytearray(len(text)) for text in data]
    for places in seen.values():
        if len(places) > 1:
            for i, at in places:
                gone[i][at: at + length] = b"\1" * length
    out = []
    for text, mask in zip(data, gone):
        spans = sum(1 for i, x in enumerate(mask) if x and (i == 0 or not mask[i - 1]))
        kept = bytes(x for x, y in zip(text, mask) if not y)
        out.append((len(text), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(documents, texts, length):
    found = suffixes.remove_repeats(documents(list(enumerate(texts))), length).collect()
    got = {row.doc_id: (row.n_bytes, row.n_removed, row.n_spans, hashlib.sha256(row.kept).hexdigest()) for row in found}
    assert got == dict(enumerate(brute(texts, length)))
    for row in found:
        assert sum(s.stop - s.first for s in row.spans) == row.n_removed


def passages():
    """Texts that share, cut, repeat and change passages."""
    rnd = random.Random(5)

    def prose(n):
        return " ".join("".join(rnd.choice("aeioustrnlé") for _ in range(rnd.randint(1, 7))) for _ in range(n))

    shared = [prose(60) for _ in range(4)]
    texts = []
    for i in range(60):
        parts = [prose(rnd.randint(0, 30)) for _ in range(rnd.randint(1, 3))]
        for _ in range(rnd.randint(0, 3)):
            x = rnd.choice(shared)
            a, b = sorted(rnd.sample(range(len(x) + 1), 2))
            parts.insert(rnd.randint(0, len(parts)), x[a:b] if rnd.random() < 0.6 else x)
        texts.append(" ".join(parts))
    for i in range(30):  # near copies
        text = list(texts[7] + shared[0])
        for _ in range(rnd.randint(0, 3)):
            text[rnd.randrange(len(text))] = "#"
        texts.append("".join(text))
    return texts


@pytest.mark.parametrize("length", [16, 40, 100, 400])
def test_passages(documents, passage_texts, length):
    check(documents, passage_texts, length)


@pytest.fixture(scope="module")
def passage_texts():
    return passages()


def test_odd_texts(documents, odd_texts):
    texts = [text[:9000] if text else text for text in odd_texts]
    check(documents, texts + ["ab" * 700, "a" * 399, "a" * 400, "a" * 401, "abc" * 200 + "x" + "abc" * 200], 400)


def test_long_texts_in_stretches(documents, passage_texts, monkeypatch):
    """The tasks take the constants as they are when the job starts."""
    monkeypatch.setattr(suffixes, "BYTES_AT_ONCE", 500)
    monkeypatch.setattr(suffixes, "STRINGS_AT_ONCE", 300)
    texts = passage_texts[:20] + [" ".join(passage_texts[20:60]), "ab " * 900, " ".join(passage_texts[25:40])]
    check(documents, texts, 100)


def test_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
             for r in suffixes.remove_repeats(frame).collect()}
    assert found == {row.doc_id: x for row, x in zip(rows, brute([row.text for row in rows], 400))}
    assert any(x[1] for x in found.values())


def test_repeated_and_null_rows(documents, passage_texts):
    text = passage_texts[0] + passage_texts[1]
    frame = documents([(1, text), (1, text), (None, text), (None, None), (2, "")])
    found = suffixes.remove_repeats(frame, 50).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in found) == [(0, 0), (0, 0)] + [(len(text.encode()),) * 2] * 3
    assert suffixes.remove_repeats(documents([]), 50).collect() == []


def test_multikey_order():
    import numpy as np

    rnd = np.random.default_rng(1)
    columns = [rnd.integers(0, 4, 500) for _ in range(4)]
    order = suffixes.multikey_order(columns)
    rows = list(zip(*columns))
    assert [rows[i] for i in order] == sorted(rows)
