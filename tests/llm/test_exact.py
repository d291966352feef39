import re
from hashlib import sha256

from telmart.llm import exact


def brute(rows):
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", text or "") for _, text in rows]
    out, taken = [], set()
    for (doc_id, _), text in zip(rows, normal):
        same = [other for (other, _), content in zip(rows, normal) if content == text]
        keep = min((x for x in same if x is not None), default=None)
        kept = doc_id == keep and text not in taken
        if kept:
            taken.add(text)
        out.append((doc_id, keep, len(same), kept, sha256(text.encode()).hexdigest()))
    return out


def order(row):
    return row[4], row[0] is None, row[0] or 0, not row[3]


def test_odd_texts(documents, odd_texts):
    rows = list(enumerate(odd_texts)) + [(None, "one"), (None, None), (3, " \t"), (4, "one"), (4, "one"), (-2, "two\n\nwords")]
    rows += [(100 + i, "copies " * 50) for i in range(300)]
    found = [tuple(row) for row in exact.exact_copies(documents(rows)).collect()]
    assert sorted(found, key=order) == sorted(brute(rows), key=order)


def test_only_null_identifiers(documents):
    rows = [(None, "x"), (None, "x"), (None, None)]
    found = exact.exact_copies(documents(rows)).collect()
    assert sorted((row.keep_id, row.group_size, row.kept) for row in found) == [(None, 1, True), (None, 2, False), (None, 2, True)]


def test_whole_rows_stay(documents, odd_texts):
    rows = list(enumerate(odd_texts)) + [(4, "one"), (4, "other")]
    kept = exact.without_copies(documents(rows)).collect()
    assert sorted(row.doc_id for row in kept) == sorted(row[0] for row in brute(rows) if row[3])
    assert kept[0].row == "r"


def test_empty_table(documents):
    assert exact.exact_copies(documents([])).collect() == []


def test_no_python(documents):
    plan = exact.exact_copies(documents([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
