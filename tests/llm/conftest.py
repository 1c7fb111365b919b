import os

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls in every column, empty and blank texts, ties, repeated rows, and long texts.
ODD = [
    (1, "the cat sat on the mat and the dog sat on the log", "en", "a", 1), (2, "the cat sat on the mat and the dog sat on the log", "en", "a", 1), (2, "the cat sat on the mat and the dog sat on the log", "en", "a", 1),
    (3, None, "en", "b", None), (4, "", None, None, 0), (5, " \t\n ", "en", "", 3), (None, "no id at all here", "en", "a", 1), (6, "one two three", "en", None, 1), (7, "ONE Two three", "en", "b", 1),
    (8, "word " * 30_000, "en", "a", 1), (9, "x" * 100_000, "fr", "b", 1), (10, "été à la plage ñ ß 漢字 \U0001f600 \u2028 \x00 end", "fr", "é", 1), (11, "le chat est sur la table et le chien dort", "fr", "c", 1), (12, "12345 !!! ...", None, "c", 1),
    (13, "<|endoftext|> it's <s> o'sa ▁▁ two  spaces ", "en", "c", 1), (14, None, None, None, None),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(os.path.join("/root/testdata/sf0.001", "documents.parquet"))


@pytest.fixture(scope="session")
def clashing(odd):
    """Extra columns named like results and helpers of the operators."""
    from pyspark.sql import functions as F

    names = ("size", "target", "taken", "copies", "n_tokens", "over_limit", "lang_pred", "score", "keep_id", "sha", "key", "component_id", "sequence_id", "offset", "fp", "bucket")
    return odd.select("*", *[F.lit("mine").alias(c) for c in names])
