import random
import re

import pytest

from telmart.llm import decontaminate


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i: i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, items):
    out = []
    for doc_id, text in rows:
        own = shingle_set(text)
        for item_id, item in items:
            wanted = shingle_set(item)
            if wanted and 5 * len(own & wanted) >= 4 * len(wanted):
                out.append((doc_id, item_id, len(own & wanted), len(wanted)))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.fixture(scope="module")
def planted():
    """Items of all sizes, whole, cut and changed within long documents."""
    rnd = random.Random(8)
    words = [f"{a}{b}" for a in "abcdefghij" for b in "klmnop"]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 3, 5, 6, 9, 12, 20, 50, 120])))) for i in range(60)]
    items += [(None, items[3][1]), (3, None), (3, ""), (7, items[7][1])]
    rows = []
    for i in range(150):
        text = [rnd.choice(words) for _ in range(rnd.choice([0, 5, 50, 500, 5000]))]
        for _ in range(rnd.randint(0, 2)):
            item = (rnd.choice(items)[1] or "").split()
            if item and rnd.random() < 0.6:
                item[rnd.randrange(len(item))] = "changed"
            if rnd.random() < 0.3:
                item = item[: rnd.randint(0, len(item))]
            at = rnd.randint(0, len(text))
            text[at:at] = [x.upper() if rnd.random() < 0.2 else x for x in item]
        rows.append((i, " ".join(text)))
    return rows, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 700])
def test_planted_items(spark, documents, odd_texts, planted, block_bytes):
    rows, items = planted
    rows = rows + list(enumerate(odd_texts)) + [(None, items[9][1]), (5, rows[5][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contained_items(documents(rows), benchmark, block_bytes=block_bytes).collect()
    wanted = brute(rows, items)
    assert sorted(map(tuple, found), key=key) == sorted(wanted, key=key)
    kept = decontaminate.without_items(documents(rows), benchmark, block_bytes=block_bytes).collect()
    clean = [row for row in rows if not brute([row], items)]
    assert sorted((row.doc_id for row in kept), key=lambda x: (x is None, x)) == sorted(
        (row[0] for row in clean), key=lambda x: (x is None, x))


def test_empty_tables(spark, documents):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contained_items(documents([(1, "a b c d e f")]), benchmark).collect() == []
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.contained_items(documents([]), items).collect() == []


def test_short_texts_match_as_a_whole(spark, documents):
    items = spark.createDataFrame([(1, "two words")], "item_id long, text string")
    found = decontaminate.contained_items(documents([(1, "Two  words"), (2, "two words more"), (3, "two")]), items).collect()
    assert [row.doc_id for row in found] == [1]
