import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from telmart.llm import quality, queries
from telmart.llm.shared import flat


def observed(texts):
    return quality.features(*flat(pa.array(texts, pa.string())), np.full(len(texts), -1.0))


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    scored = queries.op7_quality(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").groupBy("quality").agg(
        F.avg("predicted").alias("rate"), F.count("*").alias("n")).collect()
    rate = {row["quality"]: row["rate"] for row in rows}
    assert sum(row["n"] for row in rows) > 1000
    assert rate[1] > 0.99 and rate[0] < 0.05
    assert scored.count() == 10_000
    assert scored.where("score < 0 OR score > 1 OR predicted <> CAST(score >= 0.5 AS int)").count() == 0


def test_scores_do_not_depend_on_names(spark, documents, odd_texts):
    model = quality.fit(*observed(["good words here", "BAD!! $$$ ###"] * 40), np.array([1.0, 0.0] * 40))
    one = {r.doc_id: r.score for r in quality.score(documents(list(enumerate(odd_texts))), model).collect()}
    frame = documents(list(enumerate(odd_texts)))
    other = frame.withColumns({"lang": F.lit("xx"), "source": F.lit(None), "doc_id": F.col("doc_id") + 1000})
    two = {r.doc_id - 1000: r.score for r in quality.score(other, model).collect()}
    assert one == two and len(one) == len(odd_texts)
    assert all(0 <= x <= 1 for x in one.values())
    kept = quality.only_good(frame, model).collect()
    assert sorted(r.doc_id for r in kept) == sorted(i for i, x in one.items() if x >= 0.5)
    assert quality.score(documents([]), model).collect() == []


def test_pairs_are_summed_in_linear_time():
    number, value, before = observed(["a b c A! 1", "", "x"])
    model = quality.fit(number, value, before, np.array([1.0, 0.0, 1.0]))
    raw = model.raw(number, value, before)
    for i in range(3):
        own, x = number[before[i]: before[i + 1]], value[before[i]: before[i + 1]]
        wanted = model.bias + (model.weights[own] * x).sum()
        for a in range(len(own)):
            for b in range(a):
                wanted += model.factors[own[a]] @ model.factors[own[b]] * x[a] * x[b]
        assert raw[i] == pytest.approx(wanted, rel=1e-4, abs=1e-5)


def test_pairs_are_learned():
    """Labels that only a pair of words tells, as no word alone does."""
    texts = ["red round", "blue square", "red square", "blue round"] * 60
    label = np.array([1.0, 1.0, 0.0, 0.0] * 60)
    model = quality.fit(*observed(texts), label)
    assert ((model.raw(*observed(texts[:4])) > 0) == (label[:4] > 0)).all()


def test_few_or_odd_labels(spark, documents):
    labels = "doc_id long, quality int, toxic int"
    rows = documents([(1, "one"), (2, None), (None, "three")])
    for given in ([], [(1, 1, 0)], [(None, 1, 0), (1, None, 0), (1, 7, 0)], [(1, 1, 0), (1, 1, 0), (2, 0, None), (99, 1, 0)]):
        model = quality.train(rows, spark.createDataFrame(given, labels))
        assert quality.score(rows, model).count() == 3
