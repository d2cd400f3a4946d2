"""Fixtures shared by the tests of the training-data operators."""

import os
import random

SF = "/root/testdata/sf0.001"
have_tables = os.path.isdir(SF)

#: Every name here is also used inside an operator.
CLASHING = ["id", "data", "doc", "fp", "h", "n", "c", "s", "c0", "c1", "k0", "k1", "k2", "t", "text_", "n_words", "n_removed",
            "kept", "rest", "whole", "some", "rank", "part", "place", "host", "path", "rule", "verdict", "key", "area"]


def docs(spark, rows, extra=True):
    """A documents table with columns whose names clash."""
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    if extra:
        from pyspark.sql import functions as F
        df = df.select("doc_id", "text", *[F.lit("x").alias(c) for c in CLASHING])
    return df


def prose(seed, words, vocabulary=400):
    """Invented prose."""
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiou')}{rng.randrange(vocabulary)}" for _ in range(words))


def edge_rows():
    """Null and empty texts, null and repeated ids, repeated rows, white space
    only, one word, other scripts, and a long text."""
    long_text = prose(1, 30_000)
    return [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (4, "word"), (4, "other words here"), (None, "a b c"),
            (None, None), (7, prose(7, 120)), (8, prose(7, 120)), (9, "日本語 テキスト é ü 🙂 " * 9), (10, long_text),
            (11, "The " * 500), (12, prose(7, 60) + " " + prose(12, 80))]


def table_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
