"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only a local session without the setting gets a scratch folder of its own;
    on a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="voicelens-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` to a new table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also when the body uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for ``df`` when its counted size is at most ``rows``; otherwise Spark shuffles the join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


