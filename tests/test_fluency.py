"""CLS-6: the greedy regroup covers every unit exactly once, in order, with spans of 1..window units."""

from pyspark.sql import functions as F

from voicelens.functions.clauses import split_subclauses
from voicelens.operators.fluency import fluency_regroup


def test_spans_cover_units(spark):
    rows = [(1, "the cat sat. the cat ran, a dog sat on the mat! birds fly"), (2, "one"), (3, "x y z w v u t")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = fluency_regroup(df, window=4).orderBy("doc_id", "seq").collect()
    units = {r.doc_id: r.u for r in df.select("doc_id", split_subclauses(F.col("text")).alias("u")).collect()}
    for d, us in units.items():
        sents = [r.sentence for r in got if r.doc_id == d]
        assert "".join(sents) == "".join(us)
        assert len(sents) >= -(-len(us) // 4)
