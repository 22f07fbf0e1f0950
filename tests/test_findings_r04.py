"""The findings of round 4 on literal rows."""

from pyspark.sql import functions as F

from voicelens.operators.aspects import AspectLookup
from voicelens.operators.summary import extractive_summary
from voicelens.plans import tagging as TG


def reviews(spark, texts):
    return spark.createDataFrame([(i, t, 1) for i, t in texts], "id long, evaluated_text string, irr_f int")


def config(spark, *rows):
    taxonomy = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "line_no int, keyword string, code string")
    return TG.TagConfig(lookup=AspectLookup.from_dataframe(taxonomy), stopwords=["the"])


def test_opinions_are_those_of_the_raw_and_of_the_recomposed_clause(spark):
    cfg = config(spark, ("meal", "B1"), ("wifi", "B2"))
    long_ = "the meal was warm and tasty but far too small for a grown man who had not eaten anything since noon"
    rows = [(1, "meal great, the good good"), (1, "meal 7 wifi"), (None, "meal"), (2, long_), (3, "fine")]
    got = sorted(((r.id or 0), r.chilid, r.opinions) for r in TG.union_keywords(reviews(spark, rows), cfg).collect())
    summary = extractive_summary(spark.createDataFrame([(2, long_)], "doc_id long, text string")).first().summary
    assert len(summary.split("/")) == TG.SUMMARY_UNITS
    words = [w for w in summary.replace("/", "").split(" ") if w and w != "the"]
    raw = [w for w in long_.split(" ") if w not in ("the", "meal")]
    again = "".join(w for i, w in enumerate(words) if not i or w != words[i - 1])
    assert got == [(0, 1, ""), (1, 1, ""), (1, 1, "great|good|mealgreat"), (1, 2, ""), (2, 1, "|".join([*raw, again]))]


def test_textrank_shuffles_the_texts_once_and_nothing_else(spark, monkeypatch):
    from test_textrank import brute
    from voicelens.operators import textrank as TR
    monkeypatch.setattr(TR, "WORDS", 5)
    texts = {1: ["cats chase mice and dogs chase cats"], 2: ["birds watch dogs and birds", "dogs watch cats cats"], 3: ["and"], 4: [None], 5: ["b a", ""], None: ["x y z"]}
    df = spark.createDataFrame([(i, t) for i, ts in texts.items() for t in ts], "doc_id int, text string").repartition(3)
    found = TR.textrank_keywords(df, ["and"], span=3, k=3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(doc_id") == 1 and plan.count("Exchange") - plan.count("RoundRobin") == 1 and "Join" not in plan
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r.doc_id, r.rank)):
        got.setdefault(r.doc_id, []).append((r.term, r.score))
    assert set(got) == {1, 2, 5} and [t for t, _ in got[5]] == ["a", "b"]
    want = brute([w for w in texts[1][0].split() if w != "and"], span=3)
    assert got[1] == [(w, round(want[w], 6)) for w in sorted(want, key=lambda w: (-round(want[w], 9), w))[:3]]
    # the texts of a document are one graph, without pairs across them
    two = brute(["birds", "watch", "dogs", "birds", "|0", "|1", "dogs", "watch", "cats", "cats"], span=1)
    assert two == {} and {w for w, _ in got[2]} <= {"birds", "watch", "dogs", "cats"} and len(got[2]) == 3


def test_table_first_classes_are_the_same_language(spark):
    import re
    from voicelens.functions import patterns as P
    patterns = [P.HAN_CLASS, P.LETTER_CLASS, P.LETTER_CLASS[:1] + "^" + P.LETTER_CLASS[1:], P.CLEAN_RUN, P.SOFT_BREAKS, P.ENDER_CLASS, P.COMMA_CLASS, P.WIDE_ASCII_CLASS,
                P.TOKEN_PATTERN, P.SPACED_TOKEN_PATTERN, P.RECOMPOSE_KEEP, P.ONE_RUN, P.LETTER_TOKEN, P.REPEATED, P.delim_class(P.SUBCLAUSE_DELIMS),
                "[^" + P.delim_class(P.SUBCLAUSE_DELIMS)[1:], P.with_terms(P.TOKEN_PATTERN, ["餐[a]\\"]), "[^a-z]"]
    chars = [*range(1, 0x300), *range(0x2010, 0x2030), *range(0x3000, 0x3010), 0x4DFF, 0x4E00, 0x9FA5, 0x9FA6, *range(0xFF00, 0xFF70), 0x1F600, 0x10FFFF]
    df = spark.createDataFrame([(chr(c),) for c in chars] + [("a\n",), ("a a",), ("..",), ("餐[a]\\",)], "s string")
    rows = df.select("s", *[F.col("s").rlike(P.jvm(p)) for p in patterns]).collect()
    wrong = [(p, r[0]) for r in rows for p, got in zip(patterns, r[1:], strict=True) if bool(re.search(p, r[0])) != got]
    assert wrong == []


def test_chunks_and_repeats_need_no_function_per_token(spark):
    import itertools
    import random
    from voicelens.functions import text as T
    from voicelens.functions.clauses import emit_chunks, mark_connectors
    from voicelens.functions.patterns import LETTER_CLASS
    import re

    def emitted(s, delims):
        out, buffer = [], ""
        for ch in s:
            buffer += ch
            if ch in delims:
                if len(buffer) > 1 and re.search(LETTER_CLASS, buffer):
                    out.append(buffer)
                buffer = ""
        return out + [buffer] * bool(buffer)

    rng = random.Random(4)
    texts = ["".join(rng.choice("ab1é餐.., ;]_\n𝒳") for _ in range(rng.randrange(12))) for _ in range(400)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "s string").repartition(2)
    got = df.select("s", emit_chunks("s", ".,] ").alias("c"), T.collapse_repeats("s").alias("r"), T.collapse_repeats("s", ["餐餐"]).alias("h"), mark_connectors("s", ["餐"]).alias("m"))
    plan = df.select(emit_chunks("s", ".,] ").alias("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan
    for r in got.collect():
        if r.s is None:
            assert (r.c, r.r, r.m) == (None, None, None)
            continue
        tokens = re.findall("[a-zé]+|[0-9]+|[^a-z0-9é]", r.s)
        assert r.c == emitted(r.s, ".,] ") and r.r == "".join(k for k, _ in itertools.groupby(tokens))
        at = tokens.index("餐") if "餐" in tokens else 0
        put = at > 0 and not re.match("[.。;；！!？?]", tokens[at - 1])
        if put:
            tokens[at - 1:at] = ["。"] if re.match(r"[.,，、\\ ]", tokens[at - 1]) else [tokens[at - 1], "。"]
        assert r.m == "".join(tokens)
    assert df.where("s like '%餐%'").count() > 100 and [r.h for r in spark.createDataFrame([("餐餐餐餐 餐餐",)], "s string").select(T.collapse_repeats("s", ["餐餐"]).alias("h")).collect()] == ["餐餐 餐餐"]


def test_only_clauses_that_may_have_a_keyword_are_labelled(spark):
    texts = [(1, "meal 7 wifi, nice! l'eau wi'fi. MEAL wifi2"), (2, "éé 12 meal"), (3, "!! wifi"), (4, "wi'fi"), (5, "wi fo"), (None, "12 12 meal wifi")]
    plain = config(spark, ("meal", "B1"), ("wifi", "B2"))
    signs = config(spark, ("meal", "B1"), ("wifi", "B2"), ("12", "B3"), ("!", "B4"))
    assert plain.letters_only and not signs.letters_only

    def rows(cfg):
        got = TG.label_clauses(reviews(spark, texts), cfg).select("id", F.explode("_items").alias("x")).select("id", "x.view", "x.lable").collect()
        return sorted((r.id or 0, r.view, r.lable) for r in got)

    assert rows(plain) == [(0, "meal ", "B1"), (0, "wifi", "B2"), (1, "MEAL ", "B1"), (1, "meal ", "B1"), (1, "wifi, ", "B2"), (1, "wifi2", "B2"),
                           (2, "éé 12 meal", "B1"), (3, "!! wifi", "B2"), (4, "wi'fi", "B2")]
    assert {r for r in rows(signs) if r[0] == 3} == {(3, "wifi", "B2")} and (2, "12 meal", "B1、B3") not in rows(signs)
