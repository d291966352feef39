"""Rows keep their numbers when later scans are split in another way."""

import hashlib

import pytest

from telmart.llm import exact, jaccard, katz, shared, suffixes
from tests.llm.test_exact import brute as copies
from tests.llm.test_jaccard import brute as linked, key
from tests.llm.test_katz import brute as katz_scores, same
from tests.llm.test_suffixes import brute as repeats


@pytest.fixture
def table(spark, tmp_path, monkeypatch):
    """A table whose scan is split anew after each written table."""
    whole = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    # Equal texts and identifiers too.
    rows = whole.unionByName(whole.limit(40))
    rows.coalesce(1).write.option("parquet.block.size", 1 << 15).parquet(str(tmp_path / "documents"))
    names = "spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes"
    before = {name: spark.conf.get(name, None) for name in names}
    sizes = [("64m", "1"), ("300k", "8"), ("37k", "50"), ("1m", "2")]

    def split(size, parts):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], parts)
        spark.conf.set(names[2], "1k")

    def written(*args, **options):
        out = shared_written(*args, **options)
        sizes.append(sizes.pop(0))
        split(*sizes[0])
        return out

    shared_written = shared.written
    for module in (shared, exact, jaccard, katz, suffixes):
        monkeypatch.setattr(module, "written", written)
    split(*sizes[0])
    table = spark.read.parquet(str(tmp_path / "documents"))
    yield table
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def pairs(table):
    return [(row.doc_id, row.text) for row in table.collect()]


def test_repeats(table):
    rows = pairs(table)
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
             for r in suffixes.remove_repeats(table).collect()]
    assert sorted(found) == sorted((doc_id, *x) for (doc_id, _), x in zip(rows, repeats([text for _, text in rows], 400)))


def test_links(table):
    rule = jaccard.Rule(4, 85)
    wanted = linked(pairs(table), rule)
    found = [tuple(row[:3]) for row in jaccard.linked_documents(table, rule).collect()]
    assert sorted(found, key=key) == sorted(wanted, key=key)
    kept = jaccard.without_near_copies(table, rule).collect()
    assert sorted(row.doc_id for row in kept) == sorted({row[2] for row in wanted})


def test_copies(table):
    kept = exact.without_copies(table).collect()
    assert sorted(row.doc_id for row in kept) == sorted(row[0] for row in copies(pairs(table)) if row[3])


def test_scores(table):
    same(katz.score(table).collect(), katz_scores(pairs(table))[0])
