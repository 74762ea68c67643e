import pytest
import public_tokenizers
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def tokenizer_path():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text), with extra columns named as the operators' own."""

    def make(rows):
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
        for name in ("id", "key", "n", "score", "spans", "ids", "decoded", "size", "row", "bucket"):
            docs = docs.withColumn(name, F.lit("mine"))
        return docs

    return make


# null and empty texts, white space, repeated rows, no id, a long text, odd characters
EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one two three four five six"),
    (4, "one two three four five six"),
    (None, "one two three four five six"),
    (5, "a" * 300_000),
    (6, "word " * 60_000),
    (7, "\x00﻿​ \U0001f600 é́ ß İ"),
    (-8, "One TWO three four five six"),
]


@pytest.fixture
def edges(frame):
    return frame(EDGES)


@pytest.fixture
def nothing(frame):
    return frame([])
