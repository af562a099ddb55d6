import pytest

#: Columns beside those of ``documents`` whose names clash with the operators' own.
EXTRA = ["kept", "score", "rid", "num", "w", "hash", "component_id"]


def english(n, seed=0):
    return " ".join(f"w{(i * 7919 + seed * 104729) % 5003}" for i in range(n))


def odd_rows():
    """doc_id, text: nulls, empty and very long texts, ties and repeated rows."""
    base = english(120, 1)
    words = base.split()
    return [
        (1, base), (2, base), (3, " ".join(words[:-3] + ["x", "y", "z"])), (4, " ".join(words[:60] + english(60, 2).split())),
        (5, None), (6, ""), (7, " \n\t "), (8, "one"), (9, "one two three"), (9, "one two three"),
        (10, "A b\tc\nd ▁e  f "), (11, "A b\tc\nd ▁e  f "), (None, base), (None, None), (None, "zwei Wörter ß"),
        (12, english(30_000, 3)), (13, "spam spam spam spam spam spam spam spam spam spam spam spam"),
        (14, "ÄÖÜ " + english(40, 4) + "\n" + english(40, 4)), (15, "x" * 9000), (16, "\U0001f600 " * 30),
        (17, "idiot clown " + english(50, 5)), (18, "Licensed under the Apache License, Version 2.0.\n" + english(30, 6)),
        (19, english(80, 7)), (19, english(80, 8)), (20, "#### $$$$ | | | | <> * %% && ## $$ || *** %%%"),
    ]


@pytest.fixture(scope="module")
def odd_docs(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in odd_rows()],
                               "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return df.select("*", *[F.lit("clash").alias(c) for c in EXTRA])


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def odd_labels(spark):
    rows = [(i, int(i not in (13, 15, 20)), int(i == 17)) for i in range(1, 21)] + [(None, 1, 1), (99, 1, 0), (3, None, None), (1, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
