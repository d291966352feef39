"""The neighbour graph's search against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from telmart.llm import neighbours
from telmart.llm.shared import table

ROWS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
    T.StructField("node", T.StringType()), T.StructField("score", T.StringType()),
])


def nearest(spark, rows, k=20, step=20):
    index = neighbours.build(rows)
    found = neighbours.search(index, rows.where(F.col("vec_id") % step == 0), k)
    result = [tuple(row) for row in found.select("query_id", "rank", "vec_id", "score").collect()]
    index.remove()
    return sorted(result)


def brute(vectors, k=20, step=20):
    """vectors: (vec_id, numbers). Rows as the search's, complete."""
    out = []
    for query, x in vectors:
        if query % step:
            continue
        scored = []
        for vec_id, y in vectors:
            if vec_id != query:
                score = 0.0
                for a, b in zip(x, y):
                    score += a * b
                scored.append((-score, vec_id))
        out += [(query, rank, vec_id, -score) for rank, (score, vec_id) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def test_recall_and_scores(spark):
    rows = table(spark, "/root/testdata/sf0.1", "embeddings")
    data = rows.toPandas()
    vectors = np.stack(data["embedding"].to_numpy()).astype(np.float64)
    place = {int(x): i for i, x in enumerate(data["vec_id"])}
    found = nearest(spark, rows)
    assert len(found) == 20 * (data["vec_id"] % 20 == 0).sum()
    hits = 0
    for query, _, vec_id, score in found:
        scores = vectors @ vectors[place[query]]
        assert score == pytest.approx(scores[place[vec_id]], abs=1e-14)
        scores[place[query]] = -np.inf
        hits += score >= np.sort(scores)[-20] - 1e-12
    assert hits / len(found) >= 0.9


def test_unequal_lengths_are_exact_where_every_node_is_a_start(spark):
    rng = np.random.default_rng(4)
    values = (rng.standard_normal((200, 6)) * rng.uniform(0.1, 9, (200, 1))).round(3)
    vectors = [(i, row.tolist()) for i, row in enumerate(values)]
    rows = spark.createDataFrame([(i, x, "n", "s") for i, x in vectors], ROWS)
    assert nearest(spark, rows, 20, 10) == brute(vectors, 20, 10)


def test_copies_ties_and_unusable_rows(spark):
    nan, inf = float("nan"), float("inf")
    copies = [(i, [1.0, 2.0]) for i in range(0, 120)]
    others = [(200 + i, [2.0, float(i)]) for i in range(5)]
    unusable = [
        (300, None), (301, []), (302, [0.0, 0.0]), (303, [nan, 1.0]), (304, [inf, 1.0]), (305, [None, 1.0]), (306, [1.0]), (None, [5.0, 5.0]),
    ]
    rows = [*copies, *others, *unusable, (7, [1.0, 2.0]), (200, [2.0, 0.0])]
    frame = spark.createDataFrame([(i, x, None, "s") for i, x in rows], ROWS)
    assert nearest(spark, frame) == brute(copies + others)


def test_few_and_no_rows(spark):
    few = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (21, [0.0, 1.0])]
    assert nearest(spark, spark.createDataFrame([(i, x, "n", "s") for i, x in few], ROWS)) == brute(few)
    assert nearest(spark, spark.createDataFrame([(0, [1.0], "n", "s")], ROWS)) == []
    assert nearest(spark, spark.createDataFrame([], ROWS)) == []


def test_queries_from_outside(spark):
    rng = np.random.default_rng(5)
    rows = spark.createDataFrame([(i, x.tolist(), "n", "s") for i, x in enumerate(rng.standard_normal((300, 8)))], ROWS)
    index = neighbours.build(rows)
    queries = [(1000 + i, x.tolist(), "n", "s") for i, x in enumerate(rng.standard_normal((20, 8)))]
    found = neighbours.search(index, spark.createDataFrame(queries, ROWS), 10).collect()
    index.remove()
    vectors = {r["vec_id"]: np.array(r["embedding"]) for r in rows.collect()}
    hits = 0
    for query, x, *_ in queries:
        wanted = sorted(vectors, key=lambda i: (-float(vectors[i] @ np.array(x)), i))[:10]
        hits += len({r["vec_id"] for r in found if r["query_id"] == query} & set(wanted))
    assert len(found) == 200 and hits >= 180


def test_a_list_over_several_batches():
    """The meeting of lists and those who named them does not depend on how
    the sorted rows are cut."""
    import pyarrow as pa

    rng = np.random.default_rng(6)
    node = np.sort(rng.integers(0, 9, 200))
    kind = np.zeros(200, np.int32)
    for n in np.unique(node):
        at = np.flatnonzero(node == n)
        kind[at[len(at) // 2:]] = 1
    codes = neighbours._encode(rng.standard_normal((200, 5)))
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(node), pa.array(kind), pa.array(rng.permutation(200)), pa.array([x.tobytes() for x in codes], pa.binary()),
            pa.array(np.full(200, -1.0, np.float32)), pa.array(rng.random(200) < 0.3),
        ],
        ["node", "kind", "id", "vec", "least", "old"],
    )

    def pairs(batches):
        out = set()
        for found in neighbours._descend(9, 1000)(iter(batches)):
            ids, counts = neighbours._numbers(found.column("ids"), "<i8")
            out |= set(zip(np.repeat(found.column("node").to_numpy(), counts).tolist(), ids.tolist()))
        return out

    whole = pairs([batch])
    assert whole
    for step in (1, 3, 50):
        assert pairs([batch.slice(i, step) for i in range(0, 200, step)]) == whole


def test_last_rounds_shuffle_no_pools(spark):
    """A round of few unopened nodes finds what one that deals all pools out by
    node finds, and deals out no pool."""
    rng = np.random.default_rng(11)
    rows = spark.createDataFrame([(i, x.tolist(), "n", "s") for i, x in enumerate(rng.standard_normal((600, 8)))], ROWS)
    index = neighbours.build(rows)
    seeded = index.nodes.where("node % 7 = 0").select("node", "vec").mapInArrow(neighbours._first_pools(index.n, 12), neighbours.STATE)
    pools, lists = neighbours.written(seeded, "test-pools"), spark.table(index.lists)
    few, all_pools = (neighbours._opening(pools, lists, 5, index.width, x) for x in (True, False))
    plans = [x._jdf.queryExecution().executedPlan().toString() for x in (few, all_pools)]
    # Of the first, only what was found is dealt out by node, before it is sent to all.
    assert ["REPARTITION_BY_COL" in plan for plan in plans] == [False, True]
    assert "SortMergeJoin" not in plans[0] and plans[0].count("BroadcastHashJoin") == 2
    seen = [
        {r["node"]: (bytes(r["ids"]), bytes(r["sims"]), bytes(r["old"])) for r in x.collect()} for x in (few, all_pools)
    ]
    assert seen[0] == seen[1] and len(seen[0]) == 86
    assert neighbours._count_unopened(few, neighbours.POOL)[0] > 0
    index.remove()
