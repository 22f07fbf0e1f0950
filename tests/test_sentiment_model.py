"""SEN-2: texts are split into words once, for the fit and for the prediction."""

import __spark_entry__ as entry
import pytest
from pyspark.ml.feature import RegexTokenizer
from pyspark.sql import functions as F


@pytest.fixture
def folder(spark, tmp_path):
    texts = [("good", 1, 0), ("dull", 0, 0), ("vile", 0, 1)]
    docs = [(i, f"{texts[i % 3][0]} Été n{i % 5}, {texts[i % 3][0]}!", "en", "web", 20) for i in range(60)]
    docs += [(60, "good good", "en", "web", 9), (61, "vile", "fr", "web", 4), (62, "", "en", "web", 0), (None, "dull", "en", "web", 4), (0, "good Été n0, good!", "en", "web", 20)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, texts[i % 3][1], texts[i % 3][2]) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_every_text_is_predicted_and_none_is_split_again(spark, folder, monkeypatch):
    split = []
    real = RegexTokenizer.transform
    monkeypatch.setattr(RegexTokenizer, "transform", lambda self, *a: split.append(1) or real(self, *a))
    out = entry.queries()["sentiment_model"](spark, folder)
    assert split == [1]
    assert "_tok" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = [(r.doc_id, r.emo) for r in out.collect()]
    assert len(got) == 65 and sum(d == 0 for d, _ in got) == 2
    want = {0: 2, 1: 1, 2: 0}
    assert all(e == want[d % 3] for d, e in got if d is not None and d < 60)
    assert {(60, 2), (61, 0), (None, 1)} <= set(got)


def test_counts_are_those_of_the_words(spark):
    from voicelens.operators.sentiment import term_counts
    df = spark.createDataFrame([(1, "Été a-a 12 b"), (2, "")], "doc_id long, text string")
    got = {r.doc_id: sorted(r._tf.values) for r in term_counts(df).orderBy(F.col("doc_id")).collect()}
    assert got == {1: [1.0, 1.0, 2.0], 2: []}
