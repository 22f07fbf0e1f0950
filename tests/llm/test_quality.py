import numpy as np
import pytest

from voicelens.llm import quality as Q

DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet"), spark.read.parquet(f"{DIR}/labels.parquet")


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    model = Q.train(docs, labels.where("doc_id % 5 != 0"))
    assert (np.diff(model.thresholds) >= 0).all()
    held = Q.graded(labels.where("doc_id % 5 = 0")).join(docs, "doc_id")
    scored = Q.score(held, model).join(Q.graded(labels), "doc_id").toPandas()
    kept = scored.groupby("grade")["kept"].mean()
    print(kept)
    assert kept[2] >= 0.97 and kept[0] <= 0.05 and kept[1] <= 0.6
    assert (scored["expected_grade"] >= 2 * scored["tail_probability"] - 1e-9).all()


def test_held_out_toxic_documents_go(spark, tables):
    docs, labels = tables
    model = Q.train(docs, labels.where("doc_id % 5 != 0"))
    held = Q.graded(labels.where("doc_id % 5 = 0")).join(docs, "doc_id")
    kept = Q.score(held, model).join(Q.graded(labels), "doc_id").toPandas().groupby("grade")["kept"].mean()
    print(kept)
    assert kept[2] >= 0.98 and kept[0] <= 0.05 and kept[1] <= 0.2


def test_a_rare_decisive_word_counts_in_a_long_text():
    fill = [np.unique(np.random.default_rng(i).integers(100, 1 << Q.BITS, 400)) for i in range(200)]
    rows = [(np.r_[7, f] if i % 20 == 0 else f, 1 if i % 20 == 0 else 2) for i, f in enumerate(fill)]
    model = Q.fit(rows)
    long = np.unique(np.random.default_rng(900).integers(100, 1 << Q.BITS, 2000))
    assert model.tails(np.r_[7, long])[-1] < model.tails(long)[-1]


def test_edges(spark):
    schema = "doc_id long, text string, kept int, grade int"
    docs = spark.createDataFrame([(1, None, 0, 0), (2, "", 0, 0), (2, "", 0, 0), (None, "a b", 0, 0), (4, "long " * 200_000, 0, 0)], schema)
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = Q.train(docs, labels)
    assert [r.kept for r in Q.score(docs, model).collect()] == [True] * 5
    assert Q.kept_documents(docs, model).columns == docs.columns
    assert Q.score(docs.limit(0), model).count() == 0
    one = Q.train(docs, spark.createDataFrame([(2, 1, None), (4, 0, 0), (4, 1, 0)], labels.schema))
    assert [r.grade for r in Q.graded(spark.createDataFrame([(4, 0, 0), (4, 1, 0)], labels.schema)).collect()] == [0]
    assert {r.doc_id: r.kept for r in Q.score(docs, one).collect()}[2]


def test_whole_text_counts():
    assert len(np.setdiff1d(Q.features("word " * 50_000 + "rareword"), Q.features("word " * 50_000))) >= 1
