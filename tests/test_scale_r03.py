"""Plans and memory of the round-3 findings on literal rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from voicelens.functions import patterns as P
from voicelens.functions.clauses import emit_chunks, split_subclauses
from voicelens.functions.text import collapse_repeats
from voicelens.llm import jaccard_join as JJ
from voicelens.operators import lexicon as LE
from voicelens.operators import script as SC
from voicelens.operators import summary as SM


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def taxonomy(spark):
    return spark.createDataFrame([(1, "餐食", "B1"), (2, "meal", "B2"), (3, "VIP", "B3")], "line_no int, keyword string, code string")


def test_texts_without_han_take_no_part_in_the_lexicon_join(spark):
    rows = [(1, "The MEAL 12, vip!", 1), (2, None, 1), (3, "", 0), (4, "\x00 x", 0), (None, "meal", 0)]
    df = spark.createDataFrame(rows, "id long, evaluated_text string, irr_f int")
    words = taxonomy(spark).select(F.col("keyword").alias("word"))
    plain = LE.segment(df, words, "evaluated_text")
    assert "Join" not in executed(plain)
    mixed = df.unionByName(spark.createDataFrame([(5, "好餐食 meal", 1)], df.schema))
    got = {r.id: r.tokens for r in LE.segment(mixed, words, "evaluated_text").collect()}
    assert got == {1: ["the", "meal", "12", ",", "vip", "!"], 2: None, 3: [], 4: ["\x00", "x"], None: ["meal"], 5: ["好", "餐食", "meal"]}
    codes = {r.id: (r.n_aspects, r.codes) for r in LE.aspect_count(mixed, taxonomy(spark)).collect()}
    assert codes == {1: (2, "B2、B3"), 2: (0, ""), 3: (0, ""), 4: (0, ""), None: (1, "B2"), 5: (2, "B1、B2")}


def test_a_text_hands_on_distinct_runs_and_only_slices_are_python_objects(spark):
    texts = ["ab cab ab", None, "", "xyz", "ca" * 3, "ab\nab"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.r for r in df.select("i", SC.runs_of(F.col("t"), ["a", "b", "c"]).alias("r")).orderBy("i").collect()]
    assert got == [["ab", "cab"], None, [], [], ["cacaca"], ["ab"]]
    sizes, column = [], pa.array([None, "t"] * 1500)

    class Watched:
        def __len__(self):
            return len(column)

        def slice(self, at, n):
            sizes.append(n)
            return column.slice(at, n)

    assert SC.by_slices(lambda t: t, pa.string(), Watched()).to_pylist() == [None, "t"] * 1500 and max(sizes) == SC.SLICE


def test_script_of_copies_nulls_and_repeated_keys(spark):
    mapping = spark.createDataFrame([("é", "e"), ("éea", "ea")], "from_word string, to_word string")
    rows = [(1, "éeab é x"), (1, "éeab é x"), (None, "é"), (2, None), (3, ""), (4, "plain")]
    got = SC.normalize_script(spark.createDataFrame(rows, "doc_id int, text string"), mapping, "text", "normalized")
    want = [(1, "éeab é x", "eab e x")] * 2 + [(None, "é", "e"), (2, None, None), (3, "", ""), (4, "plain", "plain")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert "Generate explode(_pieces" not in executed(got) and "_pieces" not in executed(got)


def test_text_scores_equal_the_windowed_steps(spark):
    rows = [(1, "latin", ["The cat ", "a dog,", "cat ", "the cat ", "Zz", "a dog,", "É", "cat "]), (2, "東", ["東京 x", "京", "東京 x", "ab"]),
            (3, "all share a", ["a", "a", "ab"]), (4, "x", ["x"]), (5, "none", [])]
    df = spark.createDataFrame(rows, "key long, text string, units array<string>")
    distinct = SM.distinct_units(df)
    want = {(r.key, r.unit): r.score for r in SM.windowed_scores(SM.weight_table(distinct)).join(distinct, ["key", "u"]).collect()}
    for key, text, units in rows[:4]:
        once = list(dict.fromkeys(units))
        low = [u.lower() for u in once]
        got = SM.text_scores("".join(low), np.array([len(u) for u in low]), np.array([float(units.count(u)) for u in once]), key == 2)
        assert np.allclose(got, [want[key, u] for u in once], atol=1e-12)
    tops = [sorted(map(tuple, SM.topk_units(df, 3, long_units=n).collect())) for n in (0, 100)]
    assert tops[0] == tops[1] and len(tops[0]) == 3 + 3 + 3 + 1
    assert "Exchange" not in executed(SM.topk_units(df, 3))


def test_units_with_and_without_repeats(spark):
    texts = ["word next.", "no no. !!, a\n\n, x1x1 11. _ éÉ", "aa..b", "tail", "..", "1. a. 12", "haha!!haha, ok", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    plain = df.select("doc_id", F.transform(split_subclauses("text"), lambda u: collapse_repeats(u)).alias("units"))
    assert sorted(map(tuple, SM.units_of(df).select("doc_id", "units").collect())) == sorted(map(tuple, plain.collect()))
    old = lambda c, d: F.filter(F.regexp_extract_all(F.col(c), F.lit(P.chunk_pattern(d)), 0), lambda x: (~x.rlike(P.delim_class(d) + "$")) | ((F.length(x) > 1) & x.rlike(P.LETTER_CLASS)))
    for d in (P.SUBCLAUSE_DELIMS, P.CLAUSE_DELIMS_ENDERS, P.CLAUSE_DELIMS_COMMAS, P.CLAUSE_DELIMS_BLANK):
        assert df.select(old("text", d).alias("x")).collect() == df.select(emit_chunks("text", d).alias("x")).collect()


def test_a_pair_across_components_is_made_in_one_block(spark):
    placed = [(b, s, s, 1) for b, sets in [*((k, (1, 2, 3)) for k in range(1, 13)), (50, (3, 4))] for s in sets] + [(100 + k, 5, 5, 1) for k in range(20)] + [(900, 5, 5, 1), (900, 6, 6, 1)]
    placed = spark.createDataFrame(placed, "block long, set_id long, part long, size long")
    sets = spark.createDataFrame([(s, 100, [0] * JJ.SKETCH_WORDS) for s in range(1, 7)], "set_id long, n long, sketch array<long>")
    assert sorted(map(tuple, JJ.across_pairs(placed, sets, 80).collect())) == [(1, 2), (1, 3), (2, 3), (3, 4), (5, 6)]
