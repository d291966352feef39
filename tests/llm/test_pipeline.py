"""The stages against plain programs on the whole sf0.001 table."""

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from telmart.llm import jaccard, quality, stages
from telmart.llm.shared import remainder, table, vocabulary, written
from tests.llm.test_decontaminate import brute as contained
from tests.llm.test_exact import brute as copies
from tests.llm.test_jaccard import brute as linked, chance_passages

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """What goes into and comes out of each stage, as rows."""
    docs, out = table(spark, SF_DIR, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, SF_DIR), "pipeline-test")
        out.append((docs.collect(), after.collect(), docs.columns, after.columns))
        docs = after
    return out


def pairs(rows):
    return [(row.doc_id, row.text) for row in rows]


def test_columns_stay(steps):
    assert len(corpus_pipeline.STAGES) == 5
    for _, _, before, after in steps[:-1]:
        assert before == after


def test_quality(spark, steps):
    before, after, *_ = steps[0]
    docs = table(spark, SF_DIR, "documents")
    labels = table(spark, SF_DIR, "labels").where(remainder(F.col("doc_id"), 3) != 1)
    scored = quality.score(docs, quality.train(docs, labels)).collect()
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in scored if r.predicted == 1)
    assert 0 < len(after) < len(before)


def test_copies(steps):
    before, after, *_ = steps[1]
    assert sorted(r.doc_id for r in after) == sorted(r[0] for r in copies(pairs(before)) if r[3])


def test_near_copies(steps):
    before, after, *_ = steps[2]
    assert sorted(r.doc_id for r in after) == sorted({r[2] for r in linked(pairs(before), stages.NEAR)})


def test_benchmark(spark, steps):
    before, after, *_ = steps[3]
    items = [(row.item_id, row.text) for row in table(spark, SF_DIR, "benchmark").collect()]
    found = {r[0] for r in contained(pairs(before), items)}
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if r.doc_id not in found)


def test_tokens(steps):
    import sentencepiece

    before, after, *_ = steps[4]
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    ids = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in after}
    assert ids == {r.doc_id: library.encode(r.text, add_bos=True, add_eos=True) for r in before}


def test_run_is_all_stages(spark, steps):
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(found) == sorted(steps[-1][1])


def test_near_copies_deals_a_text_out_about_once(documents, spark, monkeypatch):
    """Though chance passages join all texts, before their blocks would meet."""
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 3000)
    dealt, links = [], jaccard._links

    def counted(texts, hoods, *rest):
        dealt.append(hoods.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0])
        return links(texts, hoods, *rest)

    monkeypatch.setattr(jaccard, "_links", counted)
    texts = chance_passages(6)
    rows = list(enumerate([*texts, *(x + " more" for x in texts[:9])]))
    kept = stages.drop_near_copies(spark, documents(rows), SF_DIR).collect()
    assert sorted(row.doc_id for row in kept) == sorted({row[2] for row in linked(rows, stages.NEAR)}) == list(range(80))
    assert sum(dealt) <= 2 * len(rows)
