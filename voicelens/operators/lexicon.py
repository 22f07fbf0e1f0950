"""TOK-1 and JON-2 with a lexicon of any size: words found by a join, not by a pattern of alternatives.

Only stretches of letters, digits and Han characters that hold a Han character
can contain lexicon words.  Every distinct one of the corpus is worked out once:
its substrings (of those lengths that the lexicon has) are joined with the lexicon
by hash, and of the words found the leftmost, and there the longest, is taken; what
lies between is tokenised by the plain pattern.  The lexicon is never collected
and is in no expression, so the plan and the time per text do not grow with it.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as LX
from ..functions import patterns as P
from ..functions.stage import stage
from ..session import written
from .script import phrase_hits

STRETCH = f"[{P.HAN}{P.LATIN}0-9]+"


def lexicon_words(words: DataFrame, column: str = "word") -> DataFrame:
    """(from_word): the distinct lower-cased words that need a lookup, those of two and more characters with a Han one."""
    word = F.lower(F.col(column))
    return words.select(word.alias("from_word")).where(F.col("from_word").rlike(P.jvm(P.HAN_CLASS)) & (F.length("from_word") > 1)).distinct()


def leftmost_longest(run: str, hits: list[tuple[int, int]]) -> list[str]:
    """Tokens of a stretch; ``hits`` are (place from 1, length) of lexicon words."""
    longest: dict[int, int] = {}
    for at, n in hits:
        longest[at - 1] = max(n, longest.get(at - 1, 0))
    plain, out, i = re.compile(P.TOKEN_PATTERN), [], 0
    while i < len(run):
        end = i + longest[i] if i in longest else plain.match(run, i).end()
        out.append(run[i:end])
        i = end
    return out


def segment(df: DataFrame, words: DataFrame, text_col: str, out_col: str = "tokens", word_col: str = "word") -> DataFrame:
    """``df`` with the lower-cased tokens of ``text_col`` in ``out_col`` (null for a null text).

    The same tokens as ``tokenize`` with the words as its terms.  Rows without a
    Han character take no part in the joins.
    """
    lexicon = written(lexicon_words(words, word_col).withColumn("to_word", F.lit("")), "lexicon")
    pieces = F.regexp_extract_all(F.lower(F.col("_text")), F.lit(f"{STRETCH}|[^{STRETCH[1:-2]}]+"), 0)
    packed = df.select(F.struct(*[df[c] for c in df.columns]).alias("_row"), df[text_col].cast("string").alias("_text"))
    cut = stage(packed.where(F.col("_text").rlike(P.jvm(P.HAN_CLASS))).select(F.sha2("_text", 256).alias("_key"), pieces.alias("_pieces")), "_pieces")
    held = written(cut.select("_key", F.explode(F.array_distinct(F.filter("_pieces", lambda p: p.rlike(P.jvm(P.HAN_CLASS)) & (F.length(p) > 1)))).alias("run")).distinct(), "lexicon-runs")
    runs = held.select("run").distinct().select(F.sha2("run", 256).alias("run_id"), "run")
    hits = phrase_hits(runs, lexicon).groupBy("run_id").agg(F.collect_list(F.struct("at", "n")).alias("hits"))  # the hits of one stretch

    @F.pandas_udf("array<string>")
    def tokens_of(run: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([leftmost_longest(r, [(h["at"], h["n"]) for h in hs]) for r, hs in zip(run, found, strict=True)])

    known = written(runs.join(hits, "run_id").select("run", tokens_of("run", "hits").alias("tokens")), "lexicon-tokens")
    tables = held.join(known, "run").groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("run", "tokens"))).alias("_table"))  # the stretches of one text
    columns = [c for c in df.columns if c != out_col]
    plain = lambda x: F.regexp_extract_all(x, F.lit(P.jvm(P.TOKEN_PATTERN)), 0)
    result = lambda rows, tokens: rows.select(*[F.col(f"_row.`{c}`").alias(c) for c in columns], tokens.alias(out_col))
    if held.isEmpty():                                              # no text takes part
        return result(packed, plain(F.lower(F.col("_text"))))
    # rows without a Han character pass by the join: a key they all shared would send them to one task
    others = result(packed.where(~F.coalesce(F.col("_text").rlike(P.jvm(P.HAN_CLASS)), F.lit(False))), plain(F.lower(F.col("_text"))))
    joined = packed.where(F.col("_text").rlike(P.jvm(P.HAN_CLASS))).withColumn("_key", F.sha2("_text", 256)).join(tables, "_key", "left")
    mixed = F.flatten(F.transform(pieces, lambda p: F.coalesce(F.try_element_at("_table", p), plain(p))))
    return others.unionByName(result(joined, F.when(F.col("_table").isNull(), plain(F.lower(F.col("_text")))).otherwise(mixed)))


def first_codes(taxonomy: DataFrame, irregular_code: str = LX.IRREGULAR_CODE) -> DataFrame:
    """(keyword, regular, code): the first row per keyword, of all rows (regular 0) and without the irregular-flight code (regular 1)."""
    rows = taxonomy.select("line_no", F.lower("keyword").alias("keyword"), "code")
    sides = rows.withColumn("regular", F.explode(F.when(F.col("code") == irregular_code, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))))
    return sides.groupBy("keyword", "regular").agg(F.min_by("code", F.struct("line_no", "code")).alias("code"))


def joined_codes(tokens: DataFrame, taxonomy: DataFrame, keys: list[str], tokens_col: str = "tokens", regular: Column | str = "irr_f") -> DataFrame:
    """(keys, codes): sorted distinct codes of each row's tokens, by one join with the taxonomy and one grouping.

    ``keys`` are the rows' key: rows that repeat it are one.
    """
    regular = F.col(regular) if isinstance(regular, str) else regular
    # a mark of the row's own ahead of its tokens keeps its key (no token of several characters begins so); tokens without a code go before the grouping
    mark = F.concat(F.lit("\u0000"), F.xxhash64(*keys).cast("string"))
    words = F.concat(F.array(mark), F.coalesce(F.array_distinct(tokens_col), F.array().cast("array<string>")))
    rows = stage(tokens.select(*keys, F.when(regular == 1, 1).otherwise(0).alias("regular"), words.alias("_tokens")), "_tokens")
    hits = rows.select(*keys, "regular", F.explode("_tokens").alias("keyword")).join(first_codes(taxonomy), ["keyword", "regular"], "left")
    hits = hits.where(F.col("code").isNotNull() | (F.startswith("keyword", F.lit("\u0000")) & (F.length("keyword") > 1)))
    return hits.groupBy(*keys).agg(F.array_sort(F.collect_set("code")).alias("codes"))


def aspect_count(reviews: DataFrame, taxonomy: DataFrame, text_col: str = "evaluated_text") -> DataFrame:
    """AGG-2 / JON-2: (id, n_aspects, codes) per review for a taxonomy of any size."""
    words = taxonomy.select(F.col("keyword").alias("word"))
    tokens = segment(reviews.select("id", "irr_f", text_col), words, text_col)
    codes = joined_codes(tokens, taxonomy, ["id"])
    return codes.select("id", F.size("codes").cast("long").alias("n_aspects"), F.array_join("codes", "、").alias("codes"))


def polarity_scores(docs: DataFrame, polarity: DataFrame, negations: list[str], text_col: str = "text") -> DataFrame:
    """SEN-1: (doc_id, score): summed polarity of a text's tokens, flipped behind a negation, for a lexicon of any size."""
    words = segment(docs.select("doc_id", text_col), polarity, text_col)
    signed = F.zip_with("tokens", F.concat(F.array(F.lit("")), F.slice("tokens", 1, F.greatest(F.size("tokens") - 1, F.lit(0)))),
                        lambda t, before: F.struct(t.alias("word"), F.when(before.isin(negations), -1).otherwise(1).alias("sign")))
    places = words.select("doc_id", F.explode_outer(F.filter(signed, lambda x: x["word"].isNotNull())).alias("t")).select("doc_id", "t.word", "t.sign")
    first = polarity.select(F.lower("word").alias("word"), "polarity").groupBy("word").agg(F.min("polarity").alias("polarity"))
    return places.join(first, "word", "left").groupBy("doc_id").agg(F.coalesce(F.sum(F.col("polarity") * F.col("sign")), F.lit(0)).cast("int").alias("score"))

