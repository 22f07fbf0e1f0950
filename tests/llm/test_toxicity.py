import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from voicelens.llm import toxicity as T
from voicelens.llm.queries import op11_toxicity

DIR = "/root/testdata/sf0.01"
BAD = ["idiot", "moron", "stupid", "pathetic", "worthless", "disgusting", "loser", "clown", "trash"]


@pytest.fixture(scope="module")
def table(spark):
    return T.language_model(spark.read.parquet(f"{DIR}/documents.parquet"))


def brute_windows(text):
    found, before = Counter(), (0, 0, 0)
    for ch in text:
        k = int(T.classes(ch)[0])
        if k or before[2]:
            found[(*before, k)] += 1
        before = (*before[1:], k) if k else (0, 0, 0)
    return found


def test_window_counts(spark):
    texts = ["The end.  É là 1d10t", None, "", "ab\ncd\t\tefghi", "漢字 – тест", "x" * 40 + " yes"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    got = {r["at"]: r["n"] for r in T.count_windows(rows).collect()}
    want = Counter()
    for t in texts:
        want += brute_windows((t or "") + "\n")
    code = lambda w: ((w[0] * 28 + w[1]) * 28 + w[2]) * 28 + w[3]
    got_words = {k: n for k, n in got.items() if k % 28}             # ends of texts count once where texts are joined
    assert got_words == {code(w): n for w, n in want.items() if w[3]}
    long = "abc def " * 300_000                                      # longer than a chunk
    assert T.window_counts([long]).sum() == sum(brute_windows(long).values())


def test_costs_are_a_distribution(table):
    assert np.allclose(np.exp(-table.reshape(-1, 28)).sum(axis=1), 1, atol=1e-4)


def price(decoder, reading):
    total, now = 0.0, 0
    for chars, extra, kinds in [*reading, T.option("\n")]:
        total += extra
        for k in kinds:
            if k:
                total += decoder.cost[now * 28 + k]
                now = (now * 28 + k) % 28 ** 3
            elif now:
                total += decoder.cost[now * 28]
                now = 0
    return total


@pytest.mark.parametrize("written", ["1d10t", "m*r0n", "stuuupid", "p@th3t1c", "a1b2", "x!!!y", "5cum", "$$$aaa", "id*ot1", "éé33é", "0"])
def test_viterbi_is_the_cheapest_reading(table, written):
    decoder = T.Decoder(table)
    slots = decoder.lattice(written)
    best = min(price(decoder, r) for r in itertools.product(*slots))
    chosen = decoder.best(slots)
    assert min(abs(price(decoder, r) - best) for r in itertools.product(*slots) if "".join(o[0] for o in r) == chosen) < 1e-3


def bare(word):
    return re.sub(r"(.)\1+", r"\1", word)


def test_disguised_words_are_restored(table):
    decoder = T.Decoder(table)
    for word in BAD:
        leet = "".join({"i": "1", "o": "0", "e": "3", "a": "@", "s": "$"}.get(c, c) for c in word)
        for written in (leet, word.upper(), " ".join(word) + ".", "-".join(word), word[:2] + word[2] * 4 + word[3:], f"({word}!)", word[:2] + "*" + word[3:]):
            got = decoder.words(f"the {written} the")
            assert [bare(w) for w in got] == ["the", bare(word), "the"] or "*" in written, (written, got)
    assert decoder.words("no 2024 ... 3.14 fine, école") == ["no", "2024", "...", "3.14", "fine", "école"]
    assert decoder.words("id*ot m*ron") == ["idiot", "moron"]
    assert decoder.words("Plain words, stay: ÉCOLE über") == ["plain", "words", "stay", "école", "über"]
    assert decoder.words(None) == decoder.words("") == decoder.words(" \n") == []


def test_query_against_plain_python(spark, table):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    out = lambda d: zlib.crc32(str(d).encode()) % 5 == 0
    features = T.Features(T.Decoder(table))
    rows = sorted((zlib.crc32(b"%d" % d), d) for d in labels if d in docs and not out(d))
    model = T.Model(*T.fit([(features(docs[d].text), labels[d]) for _, d in rows]))
    got = op11_toxicity(spark, DIR).collect()
    assert len(got) == len(docs) and got[0].__fields__ == ["doc_id", "held_out", "score", "predicted"]
    for r in got:
        assert r.held_out == out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert r.score == pytest.approx(model.score(features(docs[r.doc_id].text)), abs=1e-4)
    rng = random.Random(3)
    clean = [d for d in docs if labels.get(d) == 0 and out(d)]
    hidden = [docs[d].text + " " + " ".join(rng.choice([w.replace("i", "1").replace("o", "0"), " ".join(w), w[0] + w[1] * 3 + w[2:]]) + " and" for w in rng.choices(BAD, k=8)) for d in clean]
    assert np.mean([model.score(features(t)) >= 0.5 for t in hidden if len(t) < 3000]) > 0.9
    assert np.mean([model.score(features(docs[d].text)) >= 0.5 for d in clean]) < 0.03


def test_held_out_accuracy(spark):
    big = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in op11_toxicity(spark, big).collect()}
    held = [(got[r.doc_id].predicted, r.toxic) for r in spark.read.parquet(f"{big}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert np.mean([p for p, y in held if y]) > 0.85 and np.mean([p for p, y in held if not y]) < 0.01


def test_edges(spark):
    schema = "doc_id long, text string, score string, label int, at int"
    rows = [(1, None, "", 0, 0), (None, "idiot", "", 0, 0), (None, "", "", 0, 0), (2, "a " * 50_000, "", 0, 0), (2, "1" * 100_000 + "a", "", 0, 0), (3, "ab1" * 50_000, "", 0, 0)]
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0)], "doc_id long, toxic int")
    got = T.score(spark.createDataFrame(rows, schema), labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert T.score(spark.createDataFrame([], schema), labels).count() == 0
    none = T.score(spark.createDataFrame(rows, schema), labels.limit(0)).collect()
    assert {r.predicted for r in none} == {0}
    text = T.restored_documents(spark.createDataFrame([(1, "Fooool $tuff"), (2, None)], "doc_id long, text string"), T.costs(np.zeros(28 ** 4))).collect()
    assert text[0].doc_id == 1 and text[1].text is None
