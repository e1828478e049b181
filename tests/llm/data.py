"""Small messy documents: nulls everywhere, empty and long texts, repeats, ties, clashing columns."""

import random

from pyspark.sql import functions as F

CLASHES = ["key", "shard", "slot", "size", "text_hash", "_hash", "sid", "unit", "block", "words", "n_words", "start", "score"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, kinds=400):
    r = random.Random(seed)
    return " ".join(f"{r.choice('bcdfgklmnprst')}{r.choice('aeiou')}{r.randrange(kinds)}x" for _ in range(n))


def messy_rows():
    base = words(120, 1)
    near = base.split(" ")
    near[60] = "changed"
    long = words(6000, 2)
    rows = [
        (5, base, "en", "a", 1), (3, base, "en", "b", 1), (9, " ".join(near), "en", None, None),
        (1, long, None, "a", 1), (2, "", "en", "a", 0), (4, None, "en", "b", None), (None, "no id at all here", "en", "a", 1),
        (7, "Two two", "en", "c", 1), (8, "a b c d e", "en", "c", 1), (11, words(40, 3), "en", "a", 1),
        (6, words(50, 4) + " " + " ".join(base.split(" ")[20:60]), "en", "b", 1), (10, "ÀÉ Straße 日本語 ﬁ.\n\n İx Σς", "fr", "é", 1),
        (12, words(90, 5), "en", "a", 1), (12, words(90, 5), "en", "a", 1), (13, "x" * 5000, "en", "a", 1),
        (None, None, None, None, None),
    ]
    return rows


def messy(spark, rows=None):
    df = spark.createDataFrame(messy_rows() if rows is None else rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


def empty(spark):
    return messy(spark, [])
