"""KEY-3 against a dense power iteration on a small fixture."""

from collections import Counter

from voicelens.operators.textrank import textrank_keywords


def brute(words, span=5, d=0.85, steps=10):
    w = Counter()
    for i, a in enumerate(words):
        for j in range(i + 1, min(i + span, len(words))):
            if a != words[j]:
                w[(a, words[j])] += 1
                w[(words[j], a)] += 1
    nodes = sorted({a for a, _ in w})
    out = Counter()
    for (a, _), c in w.items():
        out[a] += c
    r = {n: 1.0 / len(nodes) for n in nodes}
    for _ in range(steps):
        r = {n: (1 - d) + d * sum(c / out[a] * r[a] for (a, b), c in w.items() if b == n) for n in nodes}
    return r


def test_textrank_matches_dense(spark):
    text = "cats chase mice and dogs chase cats while birds watch dogs and mice hide from cats"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = {r.term: r.score for r in textrank_keywords(df, ["and"], k=100).collect()}
    words = [t for t in text.split() if t != "and"]
    exp = brute(words)
    assert set(got) == set(exp)
    assert all(abs(got[t] - round(exp[t], 6)) < 1e-6 for t in exp)
