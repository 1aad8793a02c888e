"""Shared rows and the fixture that makes tables of them."""

import pytest

SF = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """docs(rows of (doc_id, text)) with extra columns whose names operators use inside."""

    def docs(rows, extra=True):
        df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
        if extra:
            from pyspark.sql import functions as F

            for c in ("fp", "node", "ids", "length", "base", "row", "new", "hit", "score", "start", "component", "word", "size"):
                df = df.withColumn(c, F.lit(7))
        return df

    return docs


#: Null, empty, blank, repeated, tied and odd texts.
ODD = [
    (5, None), (6, ""), (7, " \t\n"), (1, "one two three four five"), (1, "one two three four five"), (2, "one two three four five"),
    (None, "one two three four five"), (9, "a\u0000b \u001c c d \U0001f600 İΣ <|endoftext|> ﬁ"), (10, "word " * 3000), (11, "x" * 20000), (12, "1" * 5000 + " " + "a.b@" * 500),
]
