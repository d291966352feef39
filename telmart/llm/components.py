"""Connected components of a table of links, by alternating stars."""

from pyspark.sql import DataFrame, functions as F

from telmart.llm.shared import written


def components(links: DataFrame) -> DataFrame:
    """node, label for every node of links (a, b); the label is the smallest
    node that links lead to.

    Each round hooks a node's larger neighbours to its smallest one, then its
    smaller ones (large star, small star); the number of rounds grows with the
    logarithm of the longest path. Rounds are written tables, minima are found
    by partial sums, and the joins deal out single links, so a node with very
    many links can be split. Links to itself and repeated links add nothing.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
