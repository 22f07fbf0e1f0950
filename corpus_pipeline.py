"""A training-data pipeline over ``documents``: five stages, each by one operator of ``voicelens.llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; ``run`` writes each result to the shared folder and reads it again.  All
stages but the last return the columns of ``documents``.

* quality: documents whose grade is probably below the best go
* exact_dedup: of equal texts the document with the largest doc_id stays
* near_dedup: of documents linked by shingle similarity (five words, 0.8) the smallest doc_id stays
* secrets: secrets in the texts are masked, no document goes
* packing: the texts become token sequences; one row per piece
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voicelens.llm import exact_dedup, jaccard_join, packing, quality, secrets
from voicelens.llm.shared import table, written


#: Rows of an Arrow batch: whole texts of a few thousand characters, so a batch has some 10 MB.
ARROW_ROWS = 2000


def _session(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _session(spark)
    return quality.kept_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _session(spark)
    return exact_dedup.kept_documents(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _session(spark)
    return jaccard_join.kept_documents(docs, width=5, percent=80)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _session(spark)
    return secrets.mask_secrets(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _session(spark)
    return packing.pack_documents(docs, max_tokens=2048)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: Tokenisation and the fitted classifier have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
