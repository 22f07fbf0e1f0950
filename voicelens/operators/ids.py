"""PRJ-4 surrogate ids: dense 0..n-1 in a given order, without a single-partition window.

The rows are range-partitioned by the order column and written once; each
partition is numbered by a window of its own, shifted by the rows of the
partitions before it (one small row per partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def dense_index(df: DataFrame, order_col: str, out: str = "idx") -> DataFrame:
    parts = written(df.repartitionByRange(order_col).withColumn("_part", F.spark_partition_id()), "ranged")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(order_col))
    return (parts.withColumn("_nth", nth).join(F.broadcast(starts), "_part")  # one row per partition
            .withColumn(out, (F.col("_start") + F.col("_nth") - 1).cast("long")).drop("_part", "_nth", "_start"))
