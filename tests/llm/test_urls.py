import math
from collections import Counter
from itertools import product

import pytest
from pyspark.sql import functions as F

from voicelens.llm import urls as U

URLS = [None, "", "no scheme/x", "http://A.Com", "http://a.com/", "HTTP://WWW.Example.com/en/x?y", "https://example.com/en/1", "https://x.example.com/en/1#f",
        "http://notcom/x", "http://net/es/a", "http://shop.net/es/a", "http://shop.net/fr/", "http://shop.net/fr", "a://b://c.com/x", "x://h?q://z/y", "http://exämple.org/ü",
        "http://a.com/x\ny?z", "http://" + "verylong" * 500 + ".org/" + "a" * 5000]


def plain(url):
    """Host and path by the contract, character by character."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
    path = rest[n:]
    return host, path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]


def plain_rule(host, path):
    fits = [(h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0]), default=(None, None))


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, u, "<p>very long shop words</p>", "x") for i, u in enumerate(URLS)] + [(0, None, None, "x"), (None, "http://q.org/", "", "x")]
    return U.judge(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()


def test_hosts_paths_rules(judged):
    assert len(judged) == len(URLS) + 2
    for r in judged:
        if r.page_id is not None:
            host, path = plain(URLS[r.page_id])
            rule, verdict = plain_rule(host, path)
            assert (r.host, r.path, r.rule) == (host, path, rule)
            assert verdict is None or r.verdict == verdict
        assert r.verdict in ("allow", "block")


def test_segmentation_is_the_most_probable_split(spark):
    counts = {"cheap": 50, "pills": 30, "now": 90, "no": 80, "w": 1, "the": 400, "pill": 20, "s": 3}
    total = sum(counts.values())
    p = lambda w: math.log(counts[w] / total) if w in counts else -math.log(total) - len(w) * math.log(10)
    labels = ["cheappillsnow", "thenow", "zzq", "s"]
    got = U.segment_labels(spark.createDataFrame([(x,) for x in labels], "label string"), spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    for r in got:
        best = max(sum(map(p, split)) for split in (splits(r.label, cuts) for cuts in product([0, 1], repeat=len(r.label) - 1)))
        assert "".join(r.words) == r.label and math.isclose(sum(map(p, r.words)), best)
    assert {r.label: r.words for r in got}["cheappillsnow"] == ["cheap", "pills", "now"]


def splits(label, cuts):
    out = [label[0]]
    for c, cut in zip(label[1:], cuts, strict=True):
        if cut:
            out.append(c)
        else:
            out[-1] += c
    return out


def test_naive_bayes_against_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = U.judge(pages).collect()
    words = {r.page_id: list(r.host_words) + spark_words(r.path) for r in rows}
    tables = {"allow": Counter(), "block": Counter()}
    sizes = Counter(r.verdict for r in rows if r.rule)
    for r in rows:
        if r.rule:
            tables[r.verdict].update(words[r.page_id])
    kinds = len(set(tables["allow"]) | set(tables["block"]))
    for r in rows:
        if not r.rule:
            score = math.log((sizes["allow"] + 1) / (sizes["block"] + 1))
            for w in words[r.page_id]:
                if w in tables["allow"] or w in tables["block"]:
                    score += math.log((tables["allow"][w] + 1) / (sum(tables["allow"].values()) + kinds + 1))
                    score -= math.log((tables["block"][w] + 1) / (sum(tables["block"].values()) + kinds + 1))
            assert math.isclose(score, r.log_odds, abs_tol=1e-9) and r.verdict == ("allow" if score >= 0 else "block")


def spark_words(path):
    import re
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in path)
    return [w for w in re.split(r"[^\w0]+|_", re.sub(r"[0-9]+", " 0 ", low)) if w]


def test_empty(spark):
    assert U.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
