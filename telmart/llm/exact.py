"""Exact duplicates by a content sort, in DataFrame operations only."""

from pyspark.sql import DataFrame, Window, functions as F

from telmart.llm.shared import SPACE_PATTERN, text_of, unused, written

HEAD = 64


ROW = "__row"


def exact_copies(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after each run of white space has
    become one blank. They are put in content order: sampled splitters deal the
    rows out by ranges of (first characters, digest, part of the identifiers),
    an external sort puts equal texts side by side, and the window operator
    compares whole neighbouring texts. The splitters hold the head of a text
    and its digest, so they stay small for texts of any length, and a common
    head is still spread over ranges. The rows of one text fall into as many
    parts as there are shuffle partitions, so that a text that fills a third of
    the table does not meet in one task; each part yields one short row, and
    these are combined by digest.

    A null text counts as empty; a text of white space only is one blank,
    another group. Of rows that share the smallest identifier one stays. Null
    identifiers never stay while the group has another. Other columns are
    ignored.
    """
    rows = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.lit(0).alias(ROW))
    return _verdicts(rows).drop(ROW)


def without_copies(documents: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    # Written with their numbers: another scan may be split in another way.
    name = unused(documents, "row")
    numbered = written(documents.withColumn(name, F.monotonically_increasing_id()), "exact-rows", compression="zstd")
    kept = _verdicts(numbered.select("doc_id", "text", F.col(name).alias(ROW))).where("kept").select(F.col(ROW).alias(name))
    return numbered.join(kept, name, "left_semi").select(*documents.columns)


def _verdicts(documents: DataFrame) -> DataFrame:
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    normal = documents.select(
        "doc_id", ROW, F.regexp_replace(text_of(), SPACE_PATTERN, " ").alias("content"),
    )
    ranged = normal.select(
        "doc_id", ROW, "content",
        F.substring("content", 1, HEAD).alias("head"),
        F.sha2("content", 256).alias("text_sha256"),
        F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int").alias("part"),
    ).repartitionByRange("head", "text_sha256", "part")
    equal = Window.partitionBy("head", "text_sha256", "part", "content")
    placed = written(ranged.select(
        "doc_id", ROW, "text_sha256",
        F.row_number().over(equal.orderBy(F.col("doc_id").asc_nulls_last(), ROW)).alias("place"),
        F.count("*").over(equal).alias("in_part"),
    ), "exact-places")
    # Written, so that the join deals both sides out and can split a frequent text.
    groups = written(placed.where("place = 1").groupBy("text_sha256").agg(
        F.min("doc_id").alias("keep_id"), F.sum("in_part").alias("group_size")
    ), "exact-groups")
    return placed.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("place") == 1)).alias("kept"),
        "text_sha256", ROW,
    )
