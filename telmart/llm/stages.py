"""The pipeline's stages: documents in, documents of the same columns out; the
last one returns token identifiers."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from telmart.llm import decontaminate, exact, jaccard, pieces, quality
from telmart.llm.shared import remainder, table, vocabulary

NEAR = jaccard.Rule(words=5, percent=80)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier rejects. It learns from the labels of the
    documents with crc32(doc_id) % 3 <> 1, so that the others can test it."""
    labels = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 3) != 1)
    return quality.only_good(docs, quality.train(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return exact.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by similar 5-word shingles, directly or
    through others, the one with the smallest doc_id stays."""
    return jaccard.without_near_copies(docs, NEAR)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded text of every document that is left."""
    return pieces.encode_texts(docs, vocabulary("piece_bpe_32k.model"))
