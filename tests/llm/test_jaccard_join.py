import random

import numpy as np

from voicelens.llm import jaccard_join as J


def brute(rows, width=5, percent=80):
    """Component of each row by comparing all pairs of plain Python sets."""
    def words(t):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return [w for w in low.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def run(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(tuple(r) for r in J.jaccard_components(docs, **kw).collect())


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows = []
    for _ in range(60):
        base = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 7, 9, 14, 30, 80, 200, 400]))]
        if rng.random() < 0.4:
            base += passage
        rows.append(base)
        for _ in range(rng.choice([0, 0, 1, 3, 8])):
            near = list(rng.choice(rows[-3:])) or ["z"]
            for _ in range(min(len(near) - 1, rng.randrange(0, max(1, len(near) // 25) + 1))):
                at = rng.randrange(len(near))
                near[at:at + rng.randrange(0, 2)] = [rng.choice(vocab)]
            rows.append(near)
    ids = rng.sample(range(100_000), len(rows))
    return [(i, " ".join(w if rng.random() < 0.9 else w.upper() for w in r)) for i, r in zip(ids, rows, strict=True)]


def test_equals_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        assert run(spark, rows) == brute(rows)
    rows = corpus(3)
    assert run(spark, rows, width=3, percent=60) == brute(rows, 3, 60)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a b"), (5, "A\tb"), (5, "a b"), (6, "a b c d e"), (7, "a b c d e"),
            (8, "a b c d e f"), (9, "a b c d e a b c d e a b c d e"), (10, "x " * 30_000)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    got = run(spark, [(3, "a b c d e f")] * 3)
    assert got == [(3, 2, 3)] * 3


def test_sketch_bounds_difference():
    rng = np.random.default_rng(4)
    bands = J.Bands(80)
    for n in (1, 3, 4, 5, 12, 33, 100, 700, 5000):
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            drop = rng.integers(0, bands.differ(2 * len(a)) + 1)
            b = np.unique(np.r_[a[drop:], rng.integers(0, 2**63, drop // 3).astype(np.uint64)])
            both = len(np.intersect1d(a, b))
            differ = len(a) + len(b) - 2 * both
            ham = sum(int(x).bit_count() for x in (J.parity_sketch(a) ^ J.parity_sketch(b)).view(np.uint64))
            assert ham <= differ
            if len(b) and 100 * both >= 80 * (len(a) + len(b) - both):
                assert set(bands.blocks(a)) & set(bands.blocks(b))


def test_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", 9, 8, 7), (2, "a b c", 9, 8, 7)], "doc_id int, text string, set_id int, block int, n int")
    assert sorted(tuple(r) for r in J.jaccard_components(docs).collect()) == [(1, 1, 1), (2, 1, 1)]
