"""Han text, mixed case, merge and report values on literal rows."""

import json
import random

from pyspark.sql import functions as F

from voicelens.functions import text as T
from voicelens.functions.clauses import split_clauses
from voicelens.operators import aspects as AS
from voicelens.operators import merge as MG
from voicelens.operators import reports as RP
from voicelens.operators import script as SC
from voicelens.operators.ids import dense_index
from voicelens.plans.tagging import TagConfig, tag_reviews


def lookup(spark, rows):
    return AS.AspectLookup.from_dataframe(spark.createDataFrame([(i, k, c) for i, (k, c) in enumerate(rows)], "line_no int, keyword string, code string"))


def one(spark, col, **row):
    return spark.createDataFrame([tuple(row.values())], list(row)).select(col).first()[0]


def test_keywords_of_two_characters_and_of_capitals(spark):
    lk = lookup(spark, [("餐食", "B1"), ("VIP", "B2"), ("WiFi", "B3")])
    df = spark.createDataFrame([(1, "餐食很好", 1), (2, "the vip lounge", 1), (3, "WIFI slow", 1), (4, "餐 食", 1)], "id long, evaluated_text string, irr_f int")
    got = {r.id: r.codes for r in AS.aspect_count(df, lk).collect()}
    assert got == {1: "B1", 2: "B2", 3: "B3", 4: ""}


def test_connectors_of_two_characters(spark):
    assert one(spark, split_clauses(F.col("s")), s="餐食很好，不过起飞慢") == ["餐食很好。", "不过起飞慢"]
    assert one(spark, split_clauses(F.col("s"), terms=["一致"]), s="大家一致好评，反而更好") == ["大家一致好评。", "反而更好"]


def test_tokens_join_back(spark):
    assert one(spark, F.array_join(T.spaced_tokens("s", ["餐食", "很好"]), "|"), s="餐食 很好a1") == "餐食| |很好|a|1"


def test_tagging_of_han_text(spark):
    cfg = TagConfig(lookup=lookup(spark, [("餐食", "B1"), ("座位", "B2")]), stopwords=["的"])
    df = spark.createDataFrame([(1, "餐食很好，不过座位的空间小", "EN1", 1, "Y", "a", "b", "20240101", 202401, 2024001, "EN", 1)],
                               "id long, evaluated_text string, fnum string, irr_f int, user_cabin string, dep_code string, arr_code string, fdate string, period_m int, period_w int, airline string, emo int")
    rows = {r.lable: r for r in tag_reviews(df, cfg).collect()}
    assert set(rows) == {"B1", "B2"} and rows["B1"].view == "餐食很好。" and rows["B2"].view_n == "不过座位空间小"


def test_all_opinions_are_kept(spark):
    words = [f"w{chr(97 + i)}" for i in range(12)]
    cfg = TagConfig(lookup=lookup(spark, [("meal", "B1")]), stopwords=[])
    df = spark.createDataFrame([(1, "meal " + " ".join(words), "EN1", 1, "Y", "a", "b", "20240101", 202401, 2024001, "EN", 1)],
                               "id long, evaluated_text string, fnum string, irr_f int, user_cabin string, dep_code string, arr_code string, fdate string, period_m int, period_w int, airline string, emo int")
    assert tag_reviews(df, cfg).first().hed == words


def script(spark, pairs, texts):
    mapping = spark.createDataFrame(pairs, "from_word string, to_word string")
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "run_id long, text string, run string").repartition(2)
    return [r.text for r in sorted(SC.normalize_script(df, mapping, "text").collect(), key=lambda r: r.run_id)]


def test_script_phrases_and_characters(spark):
    rows = [("後來", "后来"), ("後", "后"), ("頭髮", "头发"), ("來", "来"), ("來", "来x")]
    texts = ["後來頭髮後x來", "", None, "plain", "後來頭髮後x來", "髮頭", "\n後\n"]
    assert script(spark, rows, texts) == ["后来头发后x来", "", None, "plain", "后来头发后x来", "髮頭", "\n后\n"]
    assert script(spark, [], texts) == texts and script(spark, [("", "x"), ("a", None)], ["a"]) == ["a"]


def test_script_takes_the_fewest_units(spark):
    rows = [("ABC", "[abc]"), ("AB", "[ab]"), ("CDE", "[cde]"), ("BC", "[bc]"), ("XY", "1"), ("YZ", "2")]
    assert script(spark, rows, ["ABCDE", "ABC", "ABCD", "XYZ", "zABCDEABC"]) == ["[ab][cde]", "[abc]", "[abc]D", "X2", "z[ab][cde][abc]"]
    assert script(spark, rows, ["ABCDE" * 20_000]) == ["[ab][cde]" * 20_000]


def test_script_against_all_cuts(spark):
    rng = random.Random(5)
    pairs = {"".join(rng.choices("abc", k=rng.randint(1, 4))): f"<{i}>" for i in range(12)}

    def cuts(t):
        if not t:
            yield (), ""
        for n in range(1, min(4, len(t)) + 1):
            if t[:n] in pairs or (n == 1 and t[0] not in pairs):
                for steps, out in cuts(t[n:]):
                    yield (n, *steps), pairs.get(t[:n], t[:n]) + out
    texts = ["".join(rng.choices("abcd", k=rng.randint(0, 11))) for _ in range(80)]
    assert script(spark, list(pairs.items()), texts) == [min(cuts(t), key=lambda c: (len(c[0]), c[0]))[1] for t in texts]


def test_merging_twice_is_merging_once(spark):
    target = spark.createDataFrame([(1, "a", 5, None), (2, "b", None, 7)], "k int, word string, n int, own int")
    source = spark.createDataFrame([(1, "x", 1, 9), (1, "y", 1, 1), (1, "z", 0, 1), (3, "c", 1, None)], "k int, word string, v int, n int")
    merge = lambda t: MG.merge_upsert(t, source, ["k"], ["word"], order_col="v")
    once = merge(target)
    rows = sorted(tuple(r) for r in once.collect())
    assert rows == [(1, "y", 5, 0), (2, "b", 0, 7), (3, "c", 0, 0)]
    assert sorted(tuple(r) for r in merge(once).collect()) == rows


def test_report_counts_are_numbers_and_margins_add_up(spark):
    row = (1, 1, "B1", ["B1"], ['say "hi"', "b"], "EN", "x", "y", 202401, 2024001, 1, 2, "B")
    schema = "id long, chilid int, lable string, codes array<string>, hed array<string>, airline string, dep_code string, arr_code string, period_m int, period_w int, irr_f int, emo int, ADO string"
    rows = [row, (2, *row[1:4], ["b"], *row[5:10], 0, 0, "B")]
    units = RP.report_units(spark.createDataFrame(rows, schema), periods=("m",))
    report = RP.report_table(units, stopkeys=[], script="[a-z]", scope="airline").collect()
    assert len(report) == 1
    data = json.loads(report[0].keywordsdata)
    assert data["detail"]["all"]["B1"]["keywords"] == {"0": [["b", 1]], "1": [], "2": [["b", 1], ['say "hi"', 1]]}
    assert data["overview"]["All"] == {"0": 1, "2": 1, "All": 2} and data["overview"]["1"] == {"0": 0, "2": 1, "All": 1}


def test_dense_index_over_many_partitions(spark):
    df = spark.range(1000).selectExpr("id * 37 % 1009 as k").repartition(7)
    rows = sorted(dense_index(df, "k").collect(), key=lambda r: r.k)
    assert [r.idx for r in rows] == list(range(1000))
