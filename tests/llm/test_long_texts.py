"""Texts of some megabytes, repeated labelled rows, extra columns of every table."""

import random

import pytest
from llm_cases import make  # noqa: F401
from pyspark.sql import functions as F

from weft.llm import decontam, packing, pfor, simhash, spelling, substring, token_counts, toxicity


@pytest.fixture(scope="module")
def long_text():
    rnd = random.Random(11)
    words = ["".join(rnd.choices("abcdefghijklmnop", k=rnd.randrange(2, 9))) for _ in range(5000)]
    return " ".join(rnd.choices(words, k=500_000)) + "."


def test_a_text_of_megabytes_in_every_operator(spark, make, tmp_path, long_text):
    item = " ".join(long_text.split(" ")[400_000:400_030])
    docs = make([(1, long_text), (2, "a short text"), (3, long_text), (4, None)])
    path = str(tmp_path / "ids")
    pfor.write_ids(pfor.encode_documents(pfor.in_id_order(docs)), path)
    tokens = {r["doc_id"]: len(r["ids"]) // 4 for r in pfor.read_ids(spark, path).collect()}
    assert tokens[1] == tokens[3] > 500_000 and tokens[4] == 1
    packed = packing.pack_documents(docs, with_ids=False).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert {r["doc_id"]: (r["n"], r["m"]) for r in packed} == {d: (n, n) for d, n in tokens.items()}
    counted = token_counts.section_counts(docs).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in counted}[1] == tokens[1] - 1
    assert {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()} == {1: 1, 3: 1, 2: 2, 4: 4}
    bench = spark.createDataFrame([(7, item, "x", 1)], "item_id long, text string, passage string, doc_id long")
    assert sorted(tuple(r) for r in decontam.contaminated(docs, bench).collect()) == [(1, 7, 0), (3, 7, 0)]
    kept = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substring.remove_repeats(docs).drop("kept_text").collect()}
    assert kept == {1: (500_000, 0), 2: (3, 0), 3: (500_000, 500_000), 4: (0, 0)}
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int")
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert scores[1] == scores[3] and set(scores) == {1, 2, 3, 4}
    assert spelling.vocabulary(docs).agg(F.sum("n")).first()[0] > 100_000


def test_repeated_labelled_rows_teach_once(spark, make):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choices(["fine", "good", "word", "zurkig" if i % 4 == 0 else "nice"], k=30))) for i in range(200)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    once, often = make(rows), make([*rows, *rows[:8] * 50])
    a, b = ({r["doc_id"]: r["score"] for r in toxicity.score(once, toxicity.train(d, x)).collect()} for d, x in ((once, labels), (often, labels.unionByName(labels.where("doc_id < 8")))))
    assert a == b
