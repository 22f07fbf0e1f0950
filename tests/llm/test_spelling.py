import re
import zlib
from collections import Counter

from voicelens.llm import spelling as S


def near(a, b):
    """Whether two words differ by exactly one inserted, deleted or replaced character."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    count = Counter()
    for doc, text in rows:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    form, found = {}, {}
    for w, n in words.items():
        others = sorted((-m, v) for v, m in words.items() if abs(len(v) - len(w)) <= 1 and near(w, v))
        best = others[0] if others and -others[0][0] >= 10 * n else None
        form[w] = best[1] if best else None
        found[w] = (n, len(others), -best[0] if best else None)
    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w] or "", root(w), *found[w][:2], found[w][2] or 0) for w in words)


def check(spark, rows):
    docs = spark.createDataFrame([(*r, 0, "") for r in rows], "doc_id long, text string, id int, word string").repartition(3)
    got = S.spelling_variants(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in got.collect())
    assert got == brute(rows)
    return got


def test_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = check(spark, [(r.doc_id, r.text) for r in docs.orderBy("doc_id").limit(90).collect()])
    assert any(r[1] for r in got) and any(r[4] > 1 for r in got)


def test_edits_runs_ties_and_chains(spark):
    words = ["aabbcc%s" % "dd"] * 2 + ["aabbccd"] * 3 + ["abbccdd"] * 30 + ["aaabbccdd"] * 40 + ["aabbccddd"] * 400 + ["xabbccdd"] * 5
    words += ["grundlage"] * 100 + ["grundlagen"] * 100 + ["grundlag"] * 10 + ["grundlagé"] * 2 + ["Grundlage"] * 3 + ["ÿÿÿÿÿÿÿ"] * 2 + ["ÿÿÿÿÿÿÿÿ"] * 20
    check(spark, [(i, f"{w}, {w}") for i, w in enumerate(words)] + [(None, None), (None, "grundlage grundlage"), (7, "")])


def test_long_words_and_their_border(spark):
    base = "abcdefghijklmnopqrstuvwxyz" * 3
    words = [base[:n] for n in (63, 64, 65, 66, 67)] + ["z" + base[1:64], "z" + base[1:65], base[:30] + base[31:66], base[:30] + "é" + base[31:66]]
    check(spark, [(i, f"{w} {w} {base[:65]}") for i, w in enumerate(words * 3)])
    long = "ab" * 20_000
    check(spark, [(1, long + " " + long), (2, long[1:] + " " + long[1:]), (3, f"{long}b {long}b {long[:9000]}x{long[9001:]} {long[:9000]}x{long[9001:]}")])


def test_empty(spark):
    assert check(spark, []) == [] and check(spark, [(1, None), (2, "short words 12")]) == []


def test_gaps_meet_exactly_for_near_words():
    words = ["aabbccd", "abbccd", "abbbccd", "abcbccd", "aabbcc", "baabbccd"]
    for a in words:
        for b in words:
            meet = sum(1 for g, e in S.gaps(a) for h, f in S.gaps(b) if g == h and ((e and f) or e + f == 1))
            assert meet == (near(a, b) if a != b else len(a)), (a, b)
