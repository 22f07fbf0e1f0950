"""KEY-1 keyword rows, WIN-1/3/4 ranking helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import not_in
from ..sources import fixtures as FX


def keyword_array(hed: Column, stopkeys=FX.STOPKEYS, script: str = FX.KEYWORD_SCRIPT) -> Column:
    """Opinion words worth keeping as keywords: holding a script character, not a stop-key."""
    skip = not_in([w.strip().lstrip("﻿") for w in stopkeys])
    return F.filter(hed, lambda k: k.rlike(script) & skip(k))


def explode_keywords(tagged: DataFrame, stopkeys=FX.STOPKEYS, script: str = FX.KEYWORD_SCRIPT) -> DataFrame:
    """KEY-1 (+ WIN-3): one row per kept opinion word, numbered 1.. per tagged row.

    Row-local (filter, then posexplode): no shuffle.  ``uuid`` keeps the
    original text-concatenation key; (id, chilid, seq) is the real key.
    """
    kept = keyword_array(F.col("hed"), stopkeys, script)
    rows = tagged.select("id", "chilid", F.posexplode(kept).alias("_p", "keyword"))
    seq = (F.col("_p") + 1).cast("int")
    uuid = F.concat(F.col("id").cast("string"), F.col("chilid").cast("string"), seq.cast("string"))
    return rows.select(uuid.try_cast("bigint").alias("uuid"), "id", "chilid", seq.alias("seq"), "keyword")


def rank_within(df: DataFrame, keys, count_col: str = "n", item_col: str = "keyword", k: int | None = None) -> DataFrame:
    """WIN-1 / WIN-4: row_number by count descending, ties by item; optional top-k."""
    w = Window.partitionBy(*keys).orderBy(F.col(count_col).desc(), F.col(item_col).asc())
    out = df.withColumn("rank", F.row_number().over(w).cast("int"))
    if k is not None:
        out = out.filter(F.col("rank") <= k)
    return out
