import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"

# doc_id, text, source: nulls, empty and blank texts, ties, copies, long runs, characters of all lengths
ODD = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from all of the others quickly today again", "a"),
    (2, "the quick Brown fox jumps over the lazy dog and runs away from all of the others quickly today again", "a"),
    (3, None, "a"),
    (4, "", "b"),
    (5, " \t\n\r\x0b\x0c ", "b"),
    (6, "one", None),
    (7, "ONE", None),
    (8, "x " * 300, "c"),
    (9, "abc" * 400, "c"),
    (10, "é中😀\x00\x1f\x85\xa0 ﬁ ▁▁ <s> </s> <0x41> ﻿" * 20, "c"),
    (11, "line one is here\nline one is here\n\n\r\nline 2 is here\nLINE  3 is here\n#*$%&|<>", ""),
    (12, "q" * 130 + " the end", "d"),
    (13, "p" + "q" * 130 + " the end", "d"),
    (-5, "one two three four five six seven eight nine ten " * 6, "d"),
    (14, "one two three four five six seven eight nine ten " * 6 + "and then some", "d"),
    (15, "z", "e"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, some repeated, with columns that clash with what operators add or use inside."""
    rows = spark.createDataFrame([*ODD, ODD[0], ODD[2], ODD[8]], "doc_id long, text string, source string")
    clashes = ["doc", "size", "taken", "n_words", "kept", "block", "line", "host", "content", "value", "_key", "_shard", "ids2"]
    return rows.select("*", *(F.lit(f"own {c}").alias(c) for c in clashes)).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.selectExpr(*columns).collect()), key=lambda r: [(v is None, v) for v in r])
