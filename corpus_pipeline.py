"""From raw documents to token identifiers, in stages that each read what the
stage before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telmart.llm import stages
from telmart.llm.shared import table, written

STAGES = [
    ("quality", stages.keep_good),
    ("exact copies", stages.drop_copies),
    ("near copies", stages.drop_near_copies),
    ("benchmark passages", stages.drop_contaminated),
    ("tokens", stages.encode),
]

# The classifier is trained and the tokenizer is a library's: no SQL for them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
