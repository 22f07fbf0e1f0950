"""AGG-6 co-occurrence counts per aspect code.

A pair (a, b), a < b, co-occurs in a clause if both terms appear within
``window`` tokens of each other.  Pairs are generated inside the row, at most
``window`` per token (never all pairs of a long clause), de-duplicated per
clause, and counted with one partially aggregated shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import not_in, tokenize


def window_pairs(tokens, window: int):
    t = tokens
    per_offset = []
    for d in range(1, window + 1):
        other = F.slice(t, d + 1, F.greatest(F.size(t) - d, F.lit(0)))
        per_offset.append(F.zip_with(t, other, lambda a, b: F.when(
            a.isNotNull() & b.isNotNull() & (a != b), F.named_struct(F.lit("a"), F.least(a, b), F.lit("b"), F.greatest(a, b)))))
    return F.filter(F.array_distinct(F.flatten(F.array(*per_offset))), lambda p: p.isNotNull())


def cooccurrence(tagged: DataFrame, stopwords, window: int = 3, min_count: int = 1) -> DataFrame:
    skip = not_in(stopwords)
    words = F.filter(tokenize(F.col("view")), lambda w: w.rlike(P.jvm(P.LETTER_TOKEN)) & skip(w))
    from ..functions.stage import stage
    staged = stage(tagged.select("codes", words.alias("words")))
    rows = staged.select(F.explode("codes").alias("code"), window_pairs(F.col("words"), window).alias("pairs"))
    pairs = rows.select("code", F.explode("pairs").alias("p")).select("code", "p.a", "p.b")
    out = pairs.groupBy("code", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    return out.filter(F.col("n") >= min_count) if min_count > 1 else out
