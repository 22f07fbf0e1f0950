"""CLS-6 by blocks: the sentences are those of a plain count of the whole corpus, and no token is shuffled by itself."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from voicelens.functions import patterns as P
from voicelens.operators import fluency as FL

ROWS = [(1, "the cat sat. the cat ran, a dog sat on the mat! birds fly"), (2, "one"), (3, "x y z w v u t"), (4, ""), (5, None),
        (6, "ici à la mer é é ça ß à la mer"), (7, "İ a K b x Å y. 12 !!"), (8, "好吃 餐食。cat sat, the cat"), (9, "12. 3"), (None, "the cat é sat on à la")]
SCHEMA = "doc_id long, text string"


def words(text):
    return re.findall(f"[{P.LATIN}]+|[{P.HAN}]", text.lower())


def units(text):
    d = re.escape(P.SUBCLAUSE_DELIMS)
    return [c for c in re.findall(f"[^{d}]*[{d}]|[^{d}]+", text) if re.search(P.LETTER_CLASS, c) or c[-1] not in P.SUBCLAUSE_DELIMS]


def plain(rows, window=4):
    uni, big = Counter(), Counter()
    for _, text in rows:
        w = words(text or "")
        uni.update(w)
        big.update(zip(w, w[1:]))
    n, v = sum(uni.values()), len(uni)

    def score(tokens):
        if not tokens:
            return math.inf
        s = math.log((uni[tokens[0]] + 1) / (n + v)) + sum(math.log((big[a, b] + 1) / (uni[a] + v)) for a, b in zip(tokens, tokens[1:]))
        return round(-s / len(tokens), FL.DECIMALS)

    for doc_id, text in rows:
        us, p, seq = units(text or ""), 0, 0
        while doc_id is not None and p < len(us):
            _, k = min((score([w for u in us[p:p + k] for w in words(u)]), k) for k in range(1, window + 1) if p + k <= len(us))
            yield doc_id, seq, "".join(us[p:p + k])
            p, seq = p + k, seq + 1


def test_sentences_are_those_of_a_plain_count_for_any_size_of_block(spark, monkeypatch):
    df = spark.createDataFrame(ROWS, SCHEMA)
    want = sorted(plain(ROWS))
    for size in (FL.BLOCK, 40):
        monkeypatch.setattr(FL, "BLOCK", size)
        for window in (4, 1):
            assert sorted(map(tuple, FL.fluency_regroup(df, window).collect())) == (want if window == 4 else sorted(plain(ROWS, 1)))


def test_no_token_is_joined_or_grouped_by_itself(spark):
    plan = FL.fluency_regroup(spark.createDataFrame(ROWS, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and "HashAggregate" not in plan


def test_texts_of_one_id_are_scored_together_and_each_returned(spark):
    rows = [(3, "x y z w v u t"), (3, "x y z"), (3, None), (1, "a b"), (1, "a b")]
    got = [tuple(r) for r in FL.fluency_regroup(spark.createDataFrame(rows, SCHEMA)).collect()]
    by_seq = Counter(s for d, s, _ in got if d == 3)
    assert set(by_seq.values()) == {3}                              # each text has each span, a null text as null
    assert Counter(x for d, _, x in got if d == 1) in (Counter({"a ": 2, "b": 2}), Counter({"a b": 2}))


def test_a_block_asks_for_a_pair_once():
    words_of = [["a", "b"] * 500, ["a", "b"]]
    table = pa.table({"block": pa.array([0, 0], pa.int32()), "doc_id": [1, 2], "words": words_of, "scored": pa.array([None, ["b", "b"]], pa.list_(pa.string()))})
    pages = FL._pages(2)(table)
    asked = [(t, int(n)) for x, y in zip(pages["pairs"], pages["n_pairs"]) for t, n in zip(FL._texts(x.as_py()), FL._numbers(y.as_py()))]
    assert sorted(asked) == [("a b", 501), ("b a", 499), ("b b", 0)]
    sums = pa.concat_tables([FL._sums(pages.filter(np.array(pages["share"]) == s)) for s in (0, 1)])
    assert (sum(sums["n"].to_pylist()), sum(sums["v"].to_pylist())) == (1002, 2)
