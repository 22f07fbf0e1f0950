"""Adapters from the generated test tables to the review data model.

``reviews_v``   documents ⋈ labels → raw review rows (flight attributes derived
                from doc_id, sentiment class from the labels).
``taxonomy_v``  keyword → code rows with their line number.
``tokens_v``    annotated tokens (word, POS, relation, head) per document.

Everything is a plain DataFrame expression: parquet scans with pruned
columns, one join with the (small, per-document) labels table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as FX
from ..functions.stage import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _clock(day, minutes):
    """'yyyy-MM-dd HH:mm:ss' for a DATE plus minutes after midnight (same day; no time zone involved)."""
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "),
                    F.lpad((minutes / 60).cast("int").cast("string"), 2, "0"), F.lit(":"),
                    F.lpad((minutes % 60).cast("int").cast("string"), 2, "0"), F.lit(":00"))


def reviews_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw review rows (id, fnum, user_cabin, fdate, evaluated_text, codes, times, emo)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    d = docs.join(labels, "doc_id", "left")
    doc_id = F.col("doc_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (doc_id % 60).cast("int"))
    dep_gap = F.when(doc_id % 11 == 0, F.lit(None)).otherwise((doc_id * 13) % 90 - 15)
    arr_gap = F.when(doc_id % 17 == 0, F.lit(None)).otherwise((doc_id * 29) % 120 - 60)
    dep_plan = F.lit(8 * 60)
    arr_plan = F.lit(10 * 60)
    return d.select(
        doc_id.alias("id"),
        F.concat(F.upper("lang"), (100 + doc_id % 50).cast("string")).alias("fnum"),
        F.element_at(F.array(F.lit("F"), F.lit("C"), F.lit("Y")), (doc_id % 3 + 1).cast("int")).alias("user_cabin"),
        F.date_format(day, "yyyyMMdd").alias("fdate"),
        F.col("text").alias("evaluated_text"),
        F.col("source").alias("fdep_code"),
        F.concat(F.lit("src"), ((doc_id * 7) % 20).cast("string")).alias("farr_code"),
        _clock(day, dep_plan).alias("fdplan"),
        _clock(day, arr_plan).alias("faplan"),
        F.when(dep_gap.isNull(), F.lit(None).cast("string")).otherwise(_clock(day, dep_plan + dep_gap)).alias("fdactual"),
        F.when(arr_gap.isNull(), F.lit(None).cast("string")).otherwise(_clock(day, arr_plan + arr_gap)).alias("faactual"),
        F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 2).otherwise(1).cast("int").alias("emo"),
    )


def taxonomy_v(spark: SparkSession, rows=None) -> DataFrame:
    rows = FX.TAXONOMY_ROWS if rows is None else rows
    data = [(i + 1, kw, code, code) for i, (kw, code) in enumerate(rows)]
    return spark.createDataFrame(data, "line_no INT, keyword STRING, code STRING, level1 STRING")


def wordlist(spark: SparkSession, words, name: str = "word") -> DataFrame:
    return spark.createDataFrame([(w,) for w in words], f"{name} STRING")


def polarity_v(spark: SparkSession, rows=None) -> DataFrame:
    rows = FX.POLARITY if rows is None else rows
    return spark.createDataFrame(rows, "word STRING, polarity INT")


def tokens_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotated tokens of each clause of each document: all its letter tokens, lower-cased.

    ``clause_id`` is doc_id * 10**7 + the clause's number.  Relations, POS and
    heads follow a fixed rule (see FIXTURES.md B); ``head`` is 0-based, the
    root's head is 0.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    clauses = docs.select("doc_id", F.posexplode(F.regexp_extract_all(F.lower("text"), F.lit("[^.,!?;]+"), 0)).alias("n", "clause"))
    words = F.regexp_extract_all("clause", F.lit("[a-zà-öø-ÿß]+"), 0)
    base = stage(clauses.select((F.col("doc_id") * 10_000_000 + F.col("n")).alias("clause_id"), words.alias("w"))).where(F.size("w") > 0)
    base = stage(base.withColumn("h", F.floor(F.size("w") / 2).cast("int")))
    h = F.col("h")

    def build(word, i):
        rel = (F.when(i == h, "HED")
                .when(i < h, F.element_at(F.array(*[F.lit(x) for x in ["SBV", "ADV", "ATT", "COO"]]), (i % 4 + 1).cast("int")))
                .when(i % 2 == 0, "VOB").otherwise("ADV"))
        pos = F.when(i == h, "v").otherwise(
            F.element_at(F.array(*[F.lit(x) for x in ["a", "d", "c", "b", "n"]]), (F.length(word) % 5 + 1).cast("int")))
        head = F.when(i == h, 0).when((i < h) & (i % 4 == 2), i + 1).otherwise(h)
        return F.struct(i.cast("int").alias("i"), word.alias("word"), pos.alias("pos"),
                        rel.alias("rel"), head.cast("int").alias("head"))

    return stage(base.select("clause_id", F.transform("w", build).alias("tokens")), "tokens")  # built once, also where they are exploded
