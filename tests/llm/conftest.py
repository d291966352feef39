import random

import pytest
from pyspark.sql import types as T

# The columns of documents, and more that clash with names the operators use.
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    T.StructField("row", T.StringType()),
    T.StructField("keep_id", T.StringType()),
    T.StructField("n", T.StringType()),
    T.StructField("score", T.StringType()),
])


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of (doc_id, text) pairs; languages and lengths
    are null in part, further columns clash with names of results."""
    def make(rows):
        full = [
            (doc_id, text, None if i % 3 else "en", f"src{i % 2}", None if i % 2 else len(text or ""), "r", "k", None, "s")
            for i, (doc_id, text) in enumerate(rows)
        ]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Texts that have gone wrong before: null, empty, blank, one word, very
    long, repeated, with signs beyond ASCII and unusual white space."""
    random.seed(3)
    words = [f"{a}{b}" for a in ("lo", "ra", "ti", "Me", "é") for b in ("n", "x", "", "St")]
    text = " ".join(random.choice(words) for _ in range(400))
    return [
        None, "", " ", "\n\t ", "one", "two words", text, text, text.replace(" ", "\n "), text.upper(),
        text + " more", "x" * 5000, " ".join(["again"] * 600), "a b　c d e", "日本語 テキスト 😀",
        " ".join(random.choice(words) for _ in range(30_000)), "tab\there\x0band\x0cthere", "a\x1cb \x1dc", "▁x ▁ y", "<s> </s>",
    ]
