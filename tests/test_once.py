"""Expensive steps are evaluated once per row, and read once per query."""

from pyspark.sql import functions as F

from voicelens.functions import patterns as P
from voicelens.functions import text as T
from voicelens.functions.clauses import split_clauses
from voicelens.operators import reports as RP


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_clauses_and_repeats_look_at_the_text_once(spark):
    df = spark.createDataFrame([("a. b",)], "s string").repartition(2)
    plan = plan_of(df.select(split_clauses(F.col("s")).alias("x")))
    assert plan.count("regexp_replace(") == 2                       # clean_text and the soft breaks
    assert plan_of(df.select(T.collapse_repeats("s").alias("x"))).count("regexp_extract_all(") == 1


def test_periods_read_the_tagged_table_once(spark):
    df = spark.createDataFrame([(202401, 2024001), (202401, 2024002), (None, 2024002)], "period_m int, period_w int").repartition(2)
    got = RP.distinct_periods(df)
    assert plan_of(got).count("LogicalRDD") == 1
    assert [tuple(r) for r in got.collect()] == [("m", None), ("m", 202401), ("w", 2024001), ("w", 2024002)]


def test_listed_patterns_are_the_same_language():
    import re
    for pattern in (f"[{P.LATIN}]", f"[^{P.LATIN}0-9]", P.LETTER_CLASS, P.CLEAN_RUN, P.TOKEN_PATTERN, P.SPACED_TOKEN_PATTERN, P.RECOMPOSE_KEEP, P.ONE_RUN):
        plain, listed = re.compile(pattern), re.compile(P.listed(pattern))
        assert all(bool(plain.search(chr(c))) == bool(listed.search(chr(c))) for c in [*range(0x400), 0x4E00, 0x9FA5, 0x9FA6])


def test_connectors_stop_at_their_first_place_only(spark):
    df = spark.createDataFrame([("b but, c but d, then e but",), ("but a",), ("a but",)], "s string")
    got = [r[0] for r in df.select(split_clauses(F.col("s"), ["but", "then", "but"])).collect()]
    assert got == [["b。", "but, ", "c ", "but ", "d,。", "then ", "e ", "but"], ["but ", "a"], ["a。", "but"]]


def test_merged_updates_are_in_capitals_of_every_letter(spark, tmp_path):
    from voicelens.plans.registry_io import q_upsert_merge
    spark.createDataFrame([(1, "thon außer bé", "de", "s")], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert {r.keyword for r in q_upsert_merge(spark, str(tmp_path)).collect()} == {"AUẞER!", "BÉ!", "B1"}


def test_governors_of_repeated_clauses(spark, tmp_path):
    from voicelens.plans.registry_ops import q_governor_join
    rows = [(1, "aa bb cc"), (1, "dd"), (None, "xx yy")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.clause_id or 0, r.i, r.word, r.head_word or "") for r in q_governor_join(spark, str(tmp_path)).collect())
    assert got == [(0, 0, "xx", ""), (0, 1, "yy", ""), (10000000, 0, "aa", "bb"), (10000000, 0, "dd", "aa"), (10000000, 0, "dd", "dd"),
                   (10000000, 1, "bb", "aa"), (10000000, 1, "bb", "dd"), (10000000, 2, "cc", "bb")]


def test_terms_are_counted_where_their_text_is(spark):
    from voicelens.operators.vectors import tfidf_matrix
    docs = spark.createDataFrame([(i, "aa bb cc aa bb") for i in range(5)] + [(9, "x")], "doc_id long, text string")
    got = tfidf_matrix(docs, ngram_max=3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(doc_id" in line and "term" in line.split("ENSURE")[0]]
    assert {r.term for r in got.where("doc_id = 0").collect()} == {"aa", "bb", "cc", "aa bb", "bb cc", "cc aa", "aa bb cc", "bb cc aa", "cc aa bb"}


def test_a_refined_word_is_looked_up_once(spark):
    from voicelens.operators import opinions as OP
    df = OP.prepare(spark.createDataFrame([(1, [(0, "a", "v", "HED", 0)])], "clause_id long, tokens array<struct<i:int,word:string,pos:string,rel:string,head:int>>"))
    plan = plan_of(df.select(F.transform("_tok", lambda x: OP.refine_opinion(x["word"], ["not"], "[a-z]")).alias("o"))).splitlines()[0]
    assert plan.count("array_position(") == 1
