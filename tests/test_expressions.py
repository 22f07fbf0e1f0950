"""Literal-row unit tests for column expressions (FIXTURES.md part C)."""

import datetime as dt

from pyspark.sql import functions as F

from voicelens.functions import calendar as C
from voicelens.functions import text as T
from voicelens.functions.clauses import split_clauses, split_subclauses


def one(spark, expr, **cols):
    names = list(cols)
    df = spark.createDataFrame([tuple(cols[n] for n in names)], names) if cols else spark.range(1)
    return df.select(expr.alias("x")).first()["x"]


def test_keep_letters(spark):
    assert one(spark, T.keep_letters("s"), s="好吃!! 123 abc_X") == "好吃abc_X"


def test_keep_letters_idempotent(spark):
    s = "Ab_ 12 éé 好!"
    once = one(spark, T.keep_letters("s"), s=s)
    assert one(spark, T.keep_letters("s"), s=once) == once


def test_period_keys(spark):
    for day, m, w in [("2018-12-31", 201812, 2019001), ("2021-01-01", 202101, 2020053)]:
        got = spark.createDataFrame([(day,)], ["d"]).select(*C.period_keys(F.col("d"))).first()
        assert (got[0], got[1]) == (m, w)


def test_period_bounds(spark):
    for key, first, last in [("2018033", "20180813", "20180819"), ("201802", "20180201", "20180228")]:
        f, l = C.period_bounds(F.col("k"))
        got = spark.createDataFrame([(key,)], ["k"]).select(C.day_text(f), C.day_text(l)).first()
        assert (got[0], got[1]) == (first, last)


def test_period_round_trip(spark):
    days = [(dt.date(2016, 1, 1) + dt.timedelta(days=i)).isoformat() for i in range(0, 1500, 7)]
    df = spark.createDataFrame([(d,) for d in days], ["d"])
    m, w = C.period_keys(F.col("d"))
    df = df.select(C.parse_day("d").alias("day"), m.alias("m"), w.alias("w"))
    fm, lm = C.period_bounds(F.col("m"))
    fw, lw = C.period_bounds(F.col("w"))
    bad = df.filter(~F.col("day").between(fm, lm) | ~F.col("day").between(fw, lw)).count()
    assert bad == 0


def test_irregular_flag(spark):
    rows = [("2024-01-01 08:00:00", None, "2024-01-01 10:00:00", "2024-01-01 11:00:00"),
            ("2024-01-01 08:00:00", None, "2024-01-01 10:00:00", "2024-01-01 09:00:00"),
            ("2024-01-01 08:00:00", None, "2024-01-01 10:00:00", None)]
    df = spark.createDataFrame(rows, "dp string, da string, ap string, aa string")
    got = df.select(C.irregular_flag("dp", "da", "ap", "aa", "reference").alias("r"),
                    C.irregular_flag("dp", "da", "ap", "aa", "late").alias("l")).collect()
    assert [(r.r, r.l) for r in got] == [(1, 0), (0, 1), (0, 0)]


def test_collapse_tokens(spark):
    df = spark.createDataFrame([(["好", "好", "吃"],)], ["t"])
    assert df.select(F.array_join(T.collapse_tokens("t"), "")).first()[0] == "好吃"


def test_split_subclauses(spark):
    assert one(spark, split_subclauses(F.col("s")), s="餐食好，但是慢。") == ["餐食好，", "但是慢。"]


def test_split_clauses_connector(spark):
    assert one(spark, split_clauses(F.col("s")), s="餐食好，但是慢") == ["餐食好。", "但是慢"]


def test_subclauses_are_a_subsequence(spark):
    texts = ["a, b. c d", "Thé, fo; bar!! baz", "  x ", "..,", "ab [cd] \\ ef"]
    df = spark.createDataFrame([(t,) for t in texts], ["s"]).select("s", split_subclauses(F.col("s")).alias("c"))
    for r in df.collect():
        joined = "".join(r.c)
        it = iter(r.s)
        assert all(ch in it for ch in joined)


def test_recompose_and_word_set(spark):
    assert one(spark, T.recompose("s", ["the"]), s="the cat cat sat.") == "catsat."
    assert one(spark, T.word_set("s", ["the"]), s="b a b") == ["a", "b"]
