"""Longer n-grams against a plain recursive program."""

import math
import os
from collections import Counter, defaultdict

import numpy as np
import pytest

from telmart.llm import katz
from tests.llm.test_katz import discount, held, same, tokens


def brute(rows, order):
    train = [tokens(text) for doc_id, text in rows if not held(doc_id)]
    total = sum(map(len, train))

    def grams(doc, n):
        padded = ["<start>"] * (n - 1) + doc
        return [tuple(padded[i: i + n]) for i in range(len(doc))]

    counts = {n: Counter(x for doc in train for x in grams(doc, n)) for n in range(1, order + 1)}
    by = {n: discount(counts[n]) for n in counts}
    after = defaultdict(dict)
    for n in counts:
        for x, c in counts[n].items():
            after[x[:-1]][x[-1]] = c
    shares = {}
    for history, own in after.items():
        d = by[len(history) + 1]
        size, used = sum(own.values()), sum(c * d.get(c, 1) for c in own.values())
        below = size + 1 if used >= size - 1e-9 else size
        shares[history] = {w: c * d.get(c, 1) / below for w, c in own.items()}, (below - used) / below
    weights = {}

    def p(history, w):
        if history not in shares:
            return p(history[1:], w) if history else 1.0
        own, free = shares[history]
        if w in own:
            return own[w]
        if not history:
            return free
        if history not in weights:
            weights[history] = free / (1 - sum(p(history[1:], x) for x in own))
        return weights[history] * p(history[1:], w)

    out = []
    for doc_id, text in rows:
        doc = tokens(text)
        score = sum(math.log10(p(x[:-1], x[-1])) for x in grams(doc, order))
        base = sum(math.log10((counts[1][w,] + 0.1) / (total + 0.1 * (len(counts[1]) + 1))) for w in doc)
        out.append((doc_id, held(doc_id), len(doc), sum((w,) in counts[1] for w in doc), total, base, score))
    return out


def test_longer_context_counts(spark, documents):
    """Texts that differ in longer context only have different scores."""
    train = [i for i in range(40) if not held(i)]
    out = [i for i in range(40, 400) if held(i)][:2]
    rows = [(i, ["a b c", "d b e"][i % 2]) for i in train] + list(zip(out, ["a b c", "a b e"]))
    found = {row.doc_id: row.score for row in katz.score(documents(rows), order=3).collect()}
    assert found[out[0]] > found[out[1]] + 0.5
    same(katz.score(documents(rows), order=3).collect(), brute(rows, 3))


@pytest.mark.parametrize("order", [2, 3])
def test_whole_table(spark, order):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(row.doc_id, row.text) for row in table.collect()]
    same(katz.score(table, order).collect(), brute(rows, order))


@pytest.mark.parametrize("order, known", [(3, 0), (3, 7), (4, 40)])
def test_split_histories(documents, odd_texts, monkeypatch, order, known):
    monkeypatch.setattr(katz, "KNOWN_EVERYWHERE", known)
    monkeypatch.setattr(katz, "BLOCKS_PER_PARTITION", 9)
    monkeypatch.setattr(katz, "TOKENS_AT_ONCE", 5000)
    rows = list(enumerate(odd_texts * 2)) + [(None, "two words")]
    same(katz.score(documents(rows), order).collect(), brute(rows, order))


def test_empty_table(documents):
    assert katz.score(documents([]), 3).collect() == []


def test_only_the_result_tables_stay_and_a_wave_deals_its_own_blocks(spark, documents, monkeypatch):
    """Words, rare pairs, blocks and sums of histories are removed once read."""
    names = []
    real = katz.stored

    def stored(rows, name, **options):
        table, folder = real(rows, name, **options)
        names.append((name, folder.removeprefix("file:")))
        return table, folder

    monkeypatch.setattr(katz, "stored", stored)
    monkeypatch.setattr(katz, "BLOCKS_PER_PARTITION", 9)
    dealt = []
    real_blocks = katz.build_blocks

    def build(pairs, *rest):
        dealt.append({row.block % katz.WAVES for row in pairs.select("block").collect()})
        return real_blocks(pairs, *rest)

    monkeypatch.setattr(katz, "build_blocks", build)
    rows = [(i, " ".join(f"w{(i * j) % 7} x{j % 5}" for j in range(40))) for i in range(60)]
    wanted = brute(rows, 3)
    same(katz.score(documents(rows), order=3).collect(), wanted)
    assert dealt == [{wave} for wave in range(katz.WAVES)]
    assert {name for name, _ in names} >= {"katz-words", "katz-rare", "katz-blocks"}
    assert [name for name, folder in names if os.path.exists(folder)] == []


def test_a_history_is_split_only_beyond_several_shares(documents, monkeypatch):
    """Each block of a split history exchanges sums for every longer history in
    it: one of two shares stays whole and costs none, one of five has two blocks."""
    made = []
    real = katz.stored

    def stored(rows, name, **options):
        table, folder = real(rows, name, **options)
        if name == "katz-sums":
            made.append(table.select("block", "key").collect())
        return table, folder

    monkeypatch.setattr(katz, "stored", stored)

    def exchanged(share):
        # 1,000 tokens a block, nearly; "h" is ``share`` times that of all tokens.
        blocks, n = 32, 360
        monkeypatch.setattr(katz, "BLOCKS_PER_PARTITION", blocks // 8)
        many = round(share * n * 80 / blocks / n)
        rows = [(i, " ".join(f"e{i}x{j} h w{j}" for j in range(many)) + "".join(f" f{i}x{j}" for j in range(79 - 3 * many)))
                for i in range(n)]
        made.clear()
        same(katz.score(documents(rows), order=3).collect(), brute(rows, 3))
        return sum(map(len, made)), len({block for part in made for block, _ in part})

    assert exchanged(2) == (0, 0)
    found, blocks = exchanged(5)
    assert found and blocks == 2


def test_texts_are_taken_apart_twice_only(spark, documents, monkeypatch):
    """Blocks and rare words come from stored codes, not from the texts again."""
    reads = {}

    def stored(rows, name, **options):
        reads[name] = reads.get(name, 0) + ("text#" in rows._jdf.queryExecution().optimizedPlan().toString())
        return kept(rows, name, **options)

    kept = katz.stored
    monkeypatch.setattr(katz, "stored", stored)
    rows = [(i, f"a b{i % 7} c A{i % 3} rare{i}") for i in range(60)]
    same(katz.score(documents(rows), order=3).collect(), brute(rows, 3))
    assert {name for name, count in reads.items() if count} == {"katz-words", "katz-own"}


def test_frequent_words_are_found():
    rng = np.random.default_rng(3)
    for size in (0, 1, 2, 3, 1000):
        hashes = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
        hashes[: min(size, 2)] = [katz.END, katz.START][: min(size, 2)]
        hashes.sort()
        ranks = rng.permutation(len(hashes)).astype(np.int32)
        model = katz.Unigrams(0, 0, np.ones(6), 0.0, 1.0, hashes, ranks, np.zeros(len(hashes), np.int64))
        asked = np.concatenate([hashes, rng.integers(0, 1 << 64, 500, dtype=np.uint64), [np.uint64(0), np.uint64((1 << 64) - 1)]])
        place = dict(zip(hashes.tolist(), ranks.tolist()))
        assert model.find(asked).tolist() == [place.get(x, -1) for x in asked.tolist()]
        assert model.find(model.by_rank).tolist() == list(range(len(hashes)))


@pytest.mark.parametrize("at_once", [1, 50, 1 << 18])
def test_codes_within_numbers(monkeypatch, at_once):
    monkeypatch.setattr(katz, "SORTED_AT_ONCE", at_once)
    rng = np.random.default_rng(4)
    number = np.sort(rng.integers(0, 300, 2000))
    for codes in ([rng.integers(0, 5, 2000).astype(np.uint64)], [rng.integers(0, 3, 2000).astype(np.uint64) for _ in range(2)]):
        order = katz._sorted_within(number, codes)
        assert (number[order] == number).all() and (np.sort(order) == np.arange(2000)).all()
        assert len(katz._groups(number, *(x[order] for x in codes))) == len({*zip(number, *codes)})
