"""Links of similar shingle sets against a plain program on small tables."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from telmart.llm import exact, jaccard
from telmart.llm.shared import numbered


def shingle_set(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i: i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(rows, rule):
    sets = [shingle_set(text, rule.words) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= rule.percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), doc_id if not sets[i] else min(group, default=None)))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


def check(documents, rows, rule):
    found = jaccard.linked_documents(documents(rows), rule).collect()
    assert sorted((tuple(row[:3]) for row in found), key=key) == sorted(brute(rows, rule), key=key)
    return found


def near_copies(seed, count=150):
    """Texts of all lengths with copies that differ in more and more words."""
    rnd = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in ("", "x", "Yz", "é")]
    texts = []
    while len(texts) < count:
        size = rnd.choice([1, 2, 3, 4, 5, 6, 8, 10, 12, 15, 20, 40, 90, 200])
        words = [rnd.choice(vocabulary) for _ in range(size)]
        for _ in range(rnd.randint(1, 8)):
            texts.append(rnd.choice([" ", "  ", "\n"]).join(words))
            change = rnd.random()
            if change < 0.6:
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            elif change < 0.8:
                words.insert(rnd.randrange(len(words) + 1), rnd.choice(vocabulary))
            elif len(words) > 1:
                words.pop(rnd.randrange(len(words)))
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize("rule", [jaccard.Rule(4, 85), jaccard.Rule(5, 80), jaccard.Rule(2, 50), jaccard.Rule(1, 100)])
def test_near_copies(documents, rule):
    check(documents, list(enumerate(near_copies(rule.percent))), rule)


def test_large_neighbourhoods_in_blocks(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 3000)
    check(documents, list(enumerate(near_copies(9))), jaccard.Rule(3, 70))


def chance_passages(seed, count=80, passages=12):
    """Texts of ten-word passages, each of which is in one text of either half
    of the table, so that no task sees it twice."""
    rnd = random.Random(seed)
    half = [[[f"w{rnd.randrange(10 ** 9)}" for _ in range(10)] for _ in range(count // 2 * passages)]]
    half.append(rnd.sample(half[0], len(half[0])))
    return [
        " ".join(word for passage in one[i: i + passages] for word in passage)
        for one in half for i in range(0, len(one), passages)
    ]


def test_chance_passages_make_no_large_neighbourhoods(documents, monkeypatch):
    """A text is dealt out once for each block of its neighbourhood."""
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 3000)
    texts = chance_passages(5)
    rows = list(enumerate([*texts, *near_copies(8, 40), *(x + " more" for x in texts[:9])]))
    check(documents, rows, jaccard.Rule(4, 85))
    placed = jaccard._linked(numbered(documents(list(enumerate(texts)))), jaccard.Rule(4, 85))[2]
    assert placed.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0] <= 2 * len(texts)


def test_blocks_meet_in_parts(documents, monkeypatch):
    """However many blocks a neighbourhood has, about its own bytes meet at a
    time, and every two blocks meet once."""
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 2000)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join([*words[:i], f"x{i}{j}", *words[i + 1:]]) for i in range(60) for j in (0, 1)]
    found = numbered(documents(list(enumerate(texts))))
    _, texts, placed, _ = jaccard._linked(found, jaccard.Rule(4, 85))
    waves = jaccard._waves(placed)
    assert placed.agg(F.min("blocks")).first()[0] > 10 and waves > 10
    both = texts.join(placed, "row")
    parts = [sorted(map(tuple, jaccard._meeting(both, waves, i).collect())) for i in range(waves)]
    assert sorted(x for part in parts for x in part) == sorted(map(tuple, jaccard._meeting(both).collect()))
    assert max(map(len, parts)) <= 2 * 120


def test_odd_texts(documents, odd_texts):
    rows = list(enumerate(odd_texts)) + [(None, "two words"), (None, None), (None, "alone and without name"), (4, "one"), (4, "one")]
    found = check(documents, rows, jaccard.Rule())
    leaders = [(row.component_id, row.n_shingles) for row in found if row["first"] and row.n_shingles]
    assert len(leaders) == len(set(leaders)), "one document of a component comes first"


def test_empty_table_and_no_links(documents):
    assert jaccard.linked_documents(documents([])).collect() == []
    rows = [(1, "all words here differ"), (2, "from those in that text")]
    check(documents, rows, jaccard.Rule())


def test_one_document_of_a_component_stays(documents):
    rows = list(enumerate(near_copies(4))) + [(0, near_copies(4)[0])]
    rule = jaccard.Rule(4, 85)
    kept = jaccard.without_near_copies(documents(rows), rule).collect()
    assert sorted(row.doc_id for row in kept) == sorted({row[2] for row in brute(rows, rule)})
    assert "score" in kept[0].asDict()


def test_columns_named_like_row_numbers_are_kept(documents):
    rows = documents([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)]).selectExpr(
        "*", "'mine' AS _row", "'own' AS __row", "'third' AS __ROW2")
    for kept in (jaccard.without_near_copies(rows), exact.without_copies(rows)):
        assert kept.columns == rows.columns
        found = kept.select("doc_id", "row", "_row", "__row").collect()
        assert sorted(map(tuple, found)) == [(1, "r", "mine", "own"), (3, "r", "mine", "own")]


@pytest.mark.parametrize("percent", [30, 80, 85, 100])
def test_linked_sets_share_a_key(percent):
    """Whatever the frequencies, linked sets have a key in common."""
    rule = jaccard.Rule(4, percent)
    rnd = np.random.default_rng(percent)
    frequency = rnd.integers(0, 4, jaccard.CELLS, dtype=np.uint8)
    for _ in range(300):
        size = int(rnd.integers(1, 120))
        pool = rnd.integers(0, 1 << 63, 3 * size, dtype=np.uint64)
        a = np.unique(pool[:size])
        # As many removed and added as the limit allows.
        removed = int(rnd.integers(0, size + 1))
        b = np.unique(np.concatenate([a[removed:], pool[size: size + int(rnd.integers(0, size))]]))
        if not len(b) or not rule.linked(len(np.intersect1d(a, b)), len(np.union1d(a, b))):
            continue
        keys, before = jaccard.rare_keys(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), rule, frequency)
        one, two = keys[: before[1]], keys[before[1]:]
        assert np.intersect1d(one, two).size
        # The sizes are allowed at the first key that both have.
        row = np.repeat([0, 1], np.diff(before))
        place = np.concatenate([np.arange(len(one)), np.arange(len(two))])
        x, y = jaccard.forest(keys, row, np.where(row, len(b), len(a)), place, rule)
        assert {0, 1} in [{*z} for z in zip(x.tolist(), y.tolist())]


@pytest.mark.parametrize("seed", range(12))
def test_forest_connects_exactly_the_neighbours_at_a_key(seed):
    rnd = np.random.default_rng(seed)
    rule = jaccard.Rule(4, int(rnd.choice([50, 85, 95])))
    key, row = rnd.integers(0, 12, 400).astype(np.uint64), np.arange(400)
    size = rnd.integers(1, int(rnd.choice([20, 60, 400])), 400)
    place = rnd.integers(0, size - -(-size * rule.percent // 100) + 1)
    a, b = jaccard.forest(key, row, size, place, rule)
    most = (size - place) * (100 + rule.percent) // rule.percent - size

    def neighbours(x, y):
        return key[x] == key[y] and size[x] <= most[y] and size[y] <= most[x]

    parent = list(range(400))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        assert neighbours(x, y) and root(x) != root(y)
        parent[root(x)] = root(y)
    for x in range(400):
        for y in range(x):
            if neighbours(x, y):
                assert root(x) == root(y)


def sets_of_all_sizes(seed, count=300):
    """Sets of up to 3,000 shingles in families that differ more and more, some
    of them in a few groups only."""
    rnd = np.random.default_rng(seed)
    sets = []
    while len(sets) < count:
        pool = rnd.integers(0, 1 << 63, 4000, dtype=np.uint64)
        if rnd.random() < 0.3:
            pool = pool[jaccard.mix(pool) >> np.uint64(59) < 2]
        size = int(min(len(pool), 2 ** rnd.uniform(0, 11.5)))
        for _ in range(5):
            start = int(rnd.integers(0, size // 5 + 1))
            sets.append(np.unique(pool[start: start + max(1, int(size * rnd.uniform(0.8, 1)))]))
    return sets


@pytest.mark.parametrize("percent", [30, 80, 85, 100])
def test_signatures_let_all_links_pass(percent):
    rule = jaccard.Rule(4, percent)
    sets = sets_of_all_sizes(percent)
    before = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    signed = jaccard.Signatures(jaccard.signatures(np.concatenate(sets), before), np.diff(before))
    a, b = np.triu_indices(len(sets), 1)
    passed = signed.linked(a, b, rule)
    linked = 0
    for i, j, ok in zip(a, b, passed):
        if 100 * min(len(sets[i]), len(sets[j])) < percent * max(len(sets[i]), len(sets[j])):
            continue
        both = len(np.intersect1d(sets[i], sets[j]))
        if rule.linked(both, len(sets[i]) + len(sets[j]) - both):
            linked += 1
            assert ok
    assert linked > 100
    long = np.array([len(x) > 300 and (jaccard.mix(x) >> np.uint64(59)).max() > 1 for x in sets])
    apart = long[a] & long[b] & (a // 5 != b // 5)
    assert apart.sum() > 100 and (percent == 30 or not passed[apart].any())


@pytest.mark.parametrize("rounds", [1, 2, 1024])
def test_sharp_forest_connects_the_neighbours_that_may_be_linked(rounds, monkeypatch):
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    rnd = np.random.default_rng(rounds)
    rule = jaccard.Rule(4, 80)
    sets = sets_of_all_sizes(7)
    before = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    size = np.diff(before)
    signed = jaccard.Signatures(jaccard.signatures(np.concatenate(sets), before), size)
    key = rnd.integers(0, 40, len(sets)) // 4 * (np.arange(len(sets)) // 5 % 3)
    place = rnd.integers(0, size // 10 + 1)
    a, b = jaccard.sharp_forest(key.astype(np.uint64), size, place, signed, rule)
    most = jaccard.allowed(size, place, rule)
    label = jaccard.connected(a, b, len(sets))
    x, y = np.triu_indices(len(sets), 1)
    near = (key[x] == key[y]) & (size[x] <= most[y]) & (size[y] <= most[x])
    sharp = near & signed.linked(x, y, rule)
    assert sharp.sum() > 100
    assert (key[a] == key[b]).all() and (size[a] <= most[b]).all() and (size[b] <= most[a]).all()
    assert (label[x[sharp]] == label[y[sharp]]).all()
    if rounds == 1024:
        assert signed.linked(a, b, rule).all() and len(a) < len(sets)


@pytest.mark.parametrize("rows", [10, 32, 33, 3000])
def test_a_shared_key_makes_fewer_edges_than_documents(rows):
    """Groups of every size go the same way."""
    size = np.full(rows, 50)
    a, _ = jaccard.forest(np.zeros(rows, np.uint64), np.arange(rows), size, np.zeros(rows, np.int64), jaccard.Rule())
    assert len(a) == rows - 1


def test_no_rows_make_no_edges():
    none = np.zeros(0, np.int64)
    a, b = jaccard.forest(none.astype(np.uint64), none, none, none, jaccard.Rule())
    assert len(a) == len(b) == 0


def test_tree_finds_what_all_pairs_find():
    rnd = np.random.default_rng(2)
    rule = jaccard.Rule(4, 60)
    base = rnd.integers(0, 1 << 63, (40, 80), dtype=np.uint64)
    sets = [np.unique(np.concatenate([row[: rnd.integers(20, 80)], rnd.integers(0, 1 << 63, rnd.integers(0, 20), dtype=np.uint64)]))
            for row in base for _ in range(6)]
    before = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    counts = jaccard.points(np.concatenate(sets), before)
    query, point, bound = jaccard.CountTree(counts, rule).search(counts)
    found = set(zip(query.tolist(), point.tolist()))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            if rule.linked(both, len(a) + len(b) - both):
                assert (i, j) in found
    for q, p, limit in zip(query, point, bound):
        assert len(np.intersect1d(sets[q], sets[p])) <= limit
