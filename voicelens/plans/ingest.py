"""PIP-2 ingest_clean and its single steps (AGG-1, FLT-2, PRJ-3).

The de-duplication groups on (fnum, fdate, SHA-256 of the text): a hash
aggregation of short rows, partially aggregated map-side, so a key holding many
copies is collapsed before the shuffle; the surviving ids then select the rows.
Everything else is row-local.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import text as T
from ..operators.script import normalize_script

DEDUP_KEY = ["fnum", "fdate", "evaluated_text"]


def dedupe_reviews(raw: DataFrame, key=DEDUP_KEY, order_col: str = "id") -> DataFrame:
    """AGG-1: keep the first row (smallest ``order_col``) per key."""
    short = [F.sha2(F.col(c).cast("binary"), 256).alias(c) if c == "evaluated_text" else F.col(c) for c in key]
    firsts = raw.select(order_col, *short).groupBy(*key).agg(F.min(order_col).alias(order_col)).select(order_col)
    return raw.join(firsts, order_col, "left_semi")


def drop_blank_text(df: DataFrame, text_col: str = "evaluated_text") -> DataFrame:
    """FLT-2: drop rows whose stripped text is blank or holds no Han/letter/underscore (a null, a blank text holds none)."""
    return df.filter(T.has_letter(text_col))


def carrier_code(fnum) -> F.Column:
    """PRJ-3: first two characters of the flight number."""
    return F.substring(T._col(fnum), 1, 2)


INGEST_COLUMNS = ["id", "evaluated_text", "fnum", "irr_f", "user_cabin", "dep_code", "arr_code",
                  "fdate", "period_m", "period_w", "airline"]


def ingest_clean(raw: DataFrame, arrival_gap: str = "reference", crlf: str = "。",
                 script_map=None, extra_cols=("emo",)) -> DataFrame:
    """PIP-2: AGG-1 → FLT-2 → DTE-3 → STR-3 → STR-5 (with a ``script_map`` table) → DTE-1 → PRJ-3 → projection."""
    df = dedupe_reviews(raw)
    df = drop_blank_text(df)
    df = df.withColumn("irr_f", C.irregular_flag("fdplan", "fdactual", "faplan", "faactual", arrival_gap))
    df = df.withColumn("evaluated_text", T.strip_crlf("evaluated_text", crlf))
    if script_map is not None:
        df = normalize_script(df, script_map, "evaluated_text")
    m, w = C.period_keys(F.col("fdate"))
    df = (df.withColumn("period_m", m).withColumn("period_w", w)
            .withColumn("airline", carrier_code("fnum")))
    cols = [F.col("id"), F.col("evaluated_text"), F.col("fnum"), F.col("irr_f"), F.col("user_cabin"),
            F.col("fdep_code").alias("dep_code"), F.col("farr_code").alias("arr_code"),
            F.col("fdate"), F.col("period_m"), F.col("period_w"), F.col("airline")]
    cols += [F.col(c) for c in extra_cols if c in df.columns]
    return df.select(*cols)
