"""TOK-1, JON-2 and SEN-1 by joins: the same tokens, codes and scores as in the row, for lexicons of any size."""

import random
import time

from pyspark.sql import functions as F

from voicelens.functions import text as T
from voicelens.operators import aspects as AS
from voicelens.operators import lexicon as LE

WORDS = ["餐食", "餐", "很好", "好吃", "航站楼", "T3航站楼", "起飞慢", "飞慢", "wifi速度", "plain", "航站"]
TEXTS = ["餐食很好吃", "T3航站楼起飞慢，wifi速度！", "no han at all, 12 times", None, "", "航站楼T3 好 吃", "很很好好吃吃", "xT3航站楼 9wifi速度", "餐食很好吃"]


def texts(spark, rows):
    return spark.createDataFrame([(i, t, 0, "") for i, t in enumerate(rows)], "id long, text string, irr_f int, run string").repartition(3)


def words(spark, rows):
    return spark.createDataFrame([(w,) for w in rows], "word string")


def in_row(spark, df, terms):
    return {r.id: r.t for r in df.select("id", T.tokenize("text", terms=[w.lower() for w in terms]).alias("t")).collect()}


def joined(spark, df, terms):
    return {r.id: r.tokens for r in LE.segment(df, words(spark, terms), "text").collect()}


def test_same_tokens_as_the_pattern(spark):
    df = texts(spark, TEXTS)
    got = joined(spark, df, WORDS)
    assert got == in_row(spark, df, WORDS)
    assert got[0] == ["餐食", "很好", "吃"] and got[1] == ["t3航站楼", "起飞慢", "，", "wifi速度", "！"] and got[3] is None
    assert joined(spark, df, []) == in_row(spark, df, [])


def test_same_tokens_on_random_texts(spark):
    rng = random.Random(4)
    terms = list({"".join(rng.choices("甲乙丙丁a1", k=rng.randint(1, 4))) for _ in range(40)})
    df = texts(spark, ["".join(rng.choices("甲乙丙丁戊a1 b,", k=rng.randint(0, 25))) for _ in range(150)])
    assert joined(spark, df, terms) == in_row(spark, df, [t for t in terms])


def test_time_does_not_follow_the_lexicon(spark):
    rng = random.Random(6)
    df = texts(spark, ["".join(rng.choices([chr(0x4E00 + i) for i in range(400)], k=300)) for _ in range(300)])
    took = []
    for size in (31, 20_000):
        many = list({"".join(chr(0x4E00 + rng.randrange(400)) for _ in range(rng.randint(2, 4))) for _ in range(size)})
        LE.segment(df, words(spark, many), "text").count()
        t0 = time.time()
        out = LE.segment(df, words(spark, many), "text")
        out.select(F.sum(F.size("tokens"))).collect()
        took.append(time.time() - t0)
        assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 30_000
    assert took[1] < 3 * took[0] + 2


def test_aspect_codes_of_any_taxonomy(spark):
    rows = [(i, w, c) for i, (w, c) in enumerate([("餐食", "B1"), ("VIP", "B2"), ("很好", "B9"), ("很好", "B3"), ("vip", "B4"), ("好", "J1")])]
    tax = spark.createDataFrame(rows, "line_no int, keyword string, code string")
    df = spark.createDataFrame([(1, "餐食很好", 1), (2, "餐食很好 vip", 0), (3, "nothing", 1), (4, None, 0), (5, "VIP 好", None)], "id long, evaluated_text string, irr_f int")
    got = {r.id: (r.n_aspects, r.codes) for r in LE.aspect_count(df, tax).collect()}
    want = {r.id: (r.n_aspects, r.codes) for r in AS.aspect_count(df.where("id != 4"), AS.AspectLookup.from_dataframe(tax)).collect()}
    assert got == {**want, 4: (0, "")}
    assert got[1] == (2, "B1、B3") and got[2] == (3, "B1、B2、B9")


def test_polarity_flips_behind_a_negation(spark):
    df = spark.createDataFrame([(1, "good and not good, not bad bad"), (2, None), (3, "服务很好"), (4, "")], "doc_id long, text string")
    pol = spark.createDataFrame([("good", 1), ("bad", -1), ("很好", 2)], "word string, polarity int")
    assert {r.doc_id: r.score for r in LE.polarity_scores(df, pol, ["not"]).collect()} == {1: 0, 2: 0, 3: 2, 4: 0}
