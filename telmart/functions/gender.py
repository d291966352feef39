"""Spelling-tolerant gender labels as one SQL expression."""

from itertools import combinations

from pyspark.sql import Column, SparkSession, functions as F

MALE = "male"
FEMALE = "female"


def _resembles(word: str, target: str) -> str:
    """True where the similarity of ``word`` and ``target`` rounds to 70 or more.

    Similarity is 200 * M / (len(word) + len(target)), M being the length of
    the longest common subsequence, so 69.5 is the lowest value that counts:
    400 * M >= 139 * (len(word) + len(target)). For each M that leaves a
    longest word that still passes, and M or more letters are shared exactly
    when the word holds one of the target's M-letter subsequences.
    """
    passes = []
    for shared in range(1, len(target) + 1):
        longest = 400 * shared // 139 - len(target)
        if longest < shared:
            continue
        parts = sorted({".*".join(letters) for letters in combinations(target, shared)})
        passes.append(f"(length({word}) <= {longest} AND {word} RLIKE '(?s){'|'.join(parts)}')")
    return " OR ".join(passes)


def _label(raw: str) -> str:
    """The female test runs first: 'fe' also sits in words that hold 'ma'."""
    word = f"lower({raw})"
    return f"""CASE
        WHEN {word} = 'f' OR contains({word}, 'fe') THEN '{FEMALE}'
        WHEN {word} = 'm' OR contains({word}, 'ma') THEN '{MALE}'
        WHEN {_resembles(word, MALE)} THEN '{MALE}'
        WHEN {_resembles(word, FEMALE)} THEN '{FEMALE}'
    END"""


def normalise_gender(column: str) -> Column:
    """male, female or null for the words of a column."""
    return F.expr(_label(column))


def register(spark: SparkSession) -> None:
    """Makes ``normalise_gender(word)`` known to the session's SQL; the
    optimiser inlines it."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION normalise_gender(word STRING) RETURNS STRING "
        f"RETURN {_label('word')}"
    )
