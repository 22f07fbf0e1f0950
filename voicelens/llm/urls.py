"""URL filter: rules, and beyond them words of the host and path under naive Bayes.

A host label such as ``cheappillsnow`` is split into words by Viterbi search over
a unigram model: the split with the largest product of word probabilities wins,
an unknown string of n characters having probability ``1 / (total * 10 ** n)``.
The unigram counts come from the visible words of all pages.  Labels, their
substrings and the unigrams meet in a hash join, so the word table is neither
collected nor broadcast; the search itself runs per distinct label.

Multinomial naive Bayes over segmented host words and path words (numbers count
as one word) is trained on all pages that a rule decides and judges the others.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import small_side, written

# fixed values: the rules of the production query (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LONGEST_WORD = 20
NUMBER = "0"
#: Hosts and tokens up to which their small tables are broadcast.
BROADCAST_ROWS = 100_000
JOIN_SALTS = 16


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url.cast("string"), "(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url.cast("string"), "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        best = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def unigrams(pages: DataFrame) -> DataFrame:
    """(word, n) of the visible lower-case Latin words of all pages."""
    visible = F.regexp_replace(F.coalesce(F.col("html").cast("string"), F.lit("")), "(?is)<(script|style)\\b.*?</\\1\\s*>|<[^>]*>", " ")
    words = pages.select(F.explode(F.split(F.lower(visible), "[^a-z]+")).alias("word"))
    return words.where((F.length("word") > 0) & (F.length("word") <= LONGEST_WORD)).groupBy("word").agg(F.count("*").alias("n"))


def viterbi(label: str, words: dict[tuple[int, int], float], unknown: float) -> list[str]:
    """The most probable split of ``label``; ``words`` has log probabilities by (start, length), ``unknown`` that of no character."""
    best, back = [0.0], [0]
    for end in range(1, len(label) + 1):
        options = [(best[start] + words.get((start, end - start), unknown - (end - start) * math.log(10)), start) for start in range(max(0, end - LONGEST_WORD), end)]
        score, start = max(options, key=lambda o: (o[0], -o[1]))
        best.append(score)
        back.append(start)
    out, end = [], len(label)
    while end:
        out.append(label[back[end]:end])
        end = back[end]
    return out[::-1]


def segment_labels(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """(label, words) of the distinct ``labels`` (column label) under the unigram table (word, n)."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    starts = labels.select("label", F.explode(F.sequence(F.lit(1), F.length("label"))).alias("start"))
    parts = starts.select("label", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("label") - F.col("start") + 1))).alias("size"))
    known = (parts.withColumn("word", F.col("label").substr(F.col("start"), F.col("size"))).join(counts, "word")
             .groupBy("label").agg(F.collect_list(F.struct("start", "size", F.log(F.col("n") / F.lit(float(total))).alias("p"))).alias("known")))

    @F.pandas_udf("array<string>")
    def split(label: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([viterbi(x, {(w["start"] - 1, w["size"]): w["p"] for w in (k if k is not None else ())}, -math.log(total)) for x, k in zip(label, known, strict=True)], dtype=object)

    return labels.join(known, "label", "left").select("label", split("label", "known").alias("words"))


def host_words(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, words) of distinct hosts (column host): their labels, cut at signs and digits, each split into words."""
    labels = hosts.select("host", F.posexplode(F.split("host", "[^a-z]+")).alias("nth", "label")).where("label != ''")
    split = segment_labels(labels.select("label").distinct(), counts)
    words = (labels.join(split, "label").groupBy("host")
             .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("nth", "words"))), lambda x: x["words"])).alias("words")))
    return hosts.join(words, "host", "left").select("host", F.coalesce("words", F.array().cast("array<string>")).alias("words"))


def path_words(path: Column) -> Column:
    """Lower-case words of a path; a run of digits is one number word."""
    words = F.split(F.regexp_replace(F.translate(path, UPPER, LOWER), "[0-9]+", f" {NUMBER} "), "[^\\p{L}0]+")
    return F.filter(words, lambda w: w != "")


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, host_words, log_odds) for each row of ``pages`` (columns page_id, url, html; others are ignored).

    Null urls and urls without ``://`` have empty host and path and no words:
    the class that holds more of the rule-decided pages takes them.  Without
    any such page all others are allowed, as on equal odds.  Repeated rows are
    judged each; an empty table gives no rows.
    """
    url = F.col("url")
    parsed = pages.select(F.monotonically_increasing_id().alias("row_id"), F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    parsed = parsed.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules)).select("row_id", "page_id", "host", "path", "fit.rule", "fit.verdict")
    parsed = written(parsed, "parsed-urls")
    hosts = written(host_words(parsed.select("host").distinct(), written(unigrams(pages), "unigrams")), "host-words")
    if hosts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        rows = parsed.join(F.broadcast(hosts), "host")
    else:
        spread = hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(JOIN_SALTS - 1))))
        rows = parsed.withColumn("salt", F.pmod(F.xxhash64("row_id"), F.lit(JOIN_SALTS)).cast("int")).join(spread, ["host", "salt"]).drop("salt")
    rows = written(rows.withColumn("tokens", F.concat("words", path_words(F.col("path")))), "url-tokens")
    decided = rows.where("verdict is not null")
    sizes = {r.verdict: r.n for r in decided.groupBy("verdict").agg(F.count("*").alias("n")).collect()}  # two rows
    a, b = sizes.get("allow", 0), sizes.get("block", 0)
    is_block = (F.col("verdict") == "block").cast("long")
    tokens = written(decided.select(is_block.alias("block"), F.explode("tokens").alias("token")).groupBy("token")
                     .agg(F.sum(1 - F.col("block")).alias("allowed"), F.sum("block").alias("blocked")), "url-token-counts")
    sums = tokens.agg(F.coalesce(F.sum("allowed"), F.lit(0)), F.coalesce(F.sum("blocked"), F.lit(0)), F.count("*")).first()
    allowed, blocked, kinds = sums
    odds = F.log((F.col("allowed") + 1) / F.lit(float(allowed + kinds + 1))) - F.log((F.col("blocked") + 1) / F.lit(float(blocked + kinds + 1)))
    weights = small_side(tokens.select("token", odds.alias("odds")), BROADCAST_ROWS)
    found = (rows.where("verdict is null").select("row_id", F.explode("tokens").alias("token")).join(weights, "token")
             .groupBy("row_id").agg(F.sum("odds").alias("odds")))
    prior = math.log((a + 1) / (b + 1))
    log_odds = F.coalesce("odds", F.lit(0.0)) + F.lit(prior if a + b else 0.0)
    return rows.join(found, "row_id", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.when(log_odds >= 0, "allow").otherwise("block")).alias("verdict"),
        F.col("words").alias("host_words"), F.when(F.col("rule").isNull(), log_odds).alias("log_odds"))
