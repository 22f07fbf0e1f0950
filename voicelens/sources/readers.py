"""SRC-1..6 readers and SNK-2/3 writers.

All readers return lazy DataFrames whose filters and column lists reach the
scan (parquet pushdown, JDBC pushdown).  JDBC reads are split by ``id`` into
``num_partitions`` range queries, which replaces the original keyset paging.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_COLUMNS = ["id", "fnum", "user_cabin", "fdate", "evaluated_text", "fdep_code", "farr_code",
               "fdplan", "faplan", "fdactual", "faactual"]
RAW_SCHEMA = ("id BIGINT, fnum STRING, user_cabin STRING, fdate STRING, evaluated_text STRING, "
              "fdep_code STRING, farr_code STRING, fdplan STRING, faplan STRING, fdactual STRING, faactual STRING")


def scan_reviews_jdbc(spark: SparkSession, url: str, table: str, lower_id: int, upper_id: int,
                      num_partitions: int, properties: dict | None = None) -> DataFrame:
    """SRC-1 over JDBC: partitioned by id; filters and projections are pushed to the database."""
    return spark.read.jdbc(url, table, column="id", lowerBound=lower_id, upperBound=upper_id,
                           numPartitions=num_partitions, properties=properties or {})


def scan_reviews(raw: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """SRC-1: reviews of a date range (inclusive, 'yyyyMMdd') with a non-empty text."""
    return (raw.filter(F.col("fdate").between(first_day, last_day) & (F.length("evaluated_text") > 0))
            .select(*RAW_COLUMNS))


def read_csv(spark: SparkSession, path: str, schema: str = RAW_SCHEMA, max_rows: int | None = None,
             order_col: str = "id") -> DataFrame:
    """SRC-3: CSV with a header and an explicit schema (no inference).

    ``max_rows`` reproduces the original's row cap after an explicit sort; by
    default every row is read.
    """
    df = (spark.read.schema(schema).option("header", True).option("multiLine", True)
          .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
          .option("ignoreTrailingWhiteSpace", False).option("nullValue", "\\N").option("emptyValue", "").csv(path))
    if max_rows is not None:
        df = df.orderBy(order_col).limit(max_rows)
    return df


def write_csv(df: DataFrame, path: str) -> None:
    """SNK-3: header CSV; quotes doubled so that multi-line texts read back unchanged."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .option("nullValue", "\\N").option("emptyValue", '""').csv(path))


def read_wordlist(spark: SparkSession, path: str, name: str = "word") -> DataFrame:
    """SRC-5: one word per line; byte-order mark and outer whitespace removed, blanks dropped, distinct."""
    w = F.regexp_replace(F.regexp_replace("value", "^﻿", ""), "^[ \\t\\n\\r\\f\\v]+|[ \\t\\n\\r\\f\\v]+$", "")
    return spark.read.text(path).select(w.alias(name)).filter(F.col(name) != "").distinct()


def scan_tagged(spark: SparkSession, path: str, period_col: str, period: int) -> DataFrame:
    """SRC-2: stored tagged rows of one period (partition pruning), irregular-flight flag masked (PRJ-2)."""
    df = spark.read.parquet(path).filter(F.col(period_col) == period)
    return df.withColumn("B9", F.when(F.col("irr_f") == 1, 0).otherwise(F.col("B9")))
