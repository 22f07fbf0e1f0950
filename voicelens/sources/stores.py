"""SNK-1 on stored tables: column contracts and a merge that reads and rewrites touched partitions only.

A stored table is a parquet folder, partitioned by one column that its key fixes.
``merge_into`` reads those partitions that the source touches, merges them by
``merge_upsert`` and puts them back by dynamic partition overwrite, so the cost of
a batch follows the batch and not the table.

A batch with a name is merged once: its merged partitions are first written to
the table's own ``_batches`` folder, and put in place from there.  A run that
repeats the name after a crash finds them and only puts them in place again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as LX
from ..operators.merge import merge_upsert

#: Rows of the keyword table are partitioned by blocks of review ids; new reviews touch the last blocks.
ID_BLOCK = 1_000_000


@dataclass(frozen=True)
class TableContract:
    """Key, columns that an update may change (the others keep the value of the insert), and the partition column."""

    name: str
    keys: list
    updates: list
    partition: str
    derived: dict = field(default_factory=dict)  # partition columns computed from the key


# FIXED VALUES: keys and update columns of the four sink tables.
TABLES = {
    "tagged": TableContract("tagged", ["id", "chilid"], ["view", "view_n", "lable", "hed", "irr_f", "ADO", "emo", *LX.ALL_CODES[:9], *LX.AIRPORT_CODES], "period_m"),
    "keywords": TableContract("keywords", ["id", "chilid", "seq"], ["keyword"], "id_block", {"id_block": f"id div {ID_BLOCK}"}),
    "month_reports": TableContract("month_reports", ["void", "period_m"], ["keywordsdata"], "period_m"),
    "week_reports": TableContract("week_reports", ["void", "period_w"], ["keywordsdata"], "period_w"),
    # the first review of each (flight, date, text), which keeps later copies out
    "seen": TableContract("seen", ["fdate", "fnum", "text_key"], [], "fdate"),
}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` stands in any store that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def with_partition(df: DataFrame, contract: TableContract) -> DataFrame:
    """``df`` with its partition column, stored as the merge stores it: a null number as 0."""
    df = df.withColumns({c: F.expr(e).cast("long") for c, e in contract.derived.items()})
    return df.fillna(0, subset=[contract.partition])


def stored(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at ``path``; without one, no rows of ``schema``."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)  # a folder of batches alone has no rows


def touched_rows(spark: SparkSession, path: str, source: DataFrame, contract: TableContract) -> DataFrame:
    """The stored rows of those partitions that ``source`` touches; the scan is pruned to them."""
    parts = [r[0] for r in source.select(contract.partition).distinct().collect()]  # partition values of one batch
    own = F.col(contract.partition)
    rows = stored(spark, path, source.schema)
    return rows.where(own.isin([p for p in parts if p is not None]) | (own.isNull() if None in parts else F.lit(False)))


def merge_into(spark: SparkSession, path: str, source: DataFrame, contract: TableContract, batch: str | None = None, order_col: str | None = None) -> None:
    """Merge ``source`` into the table at ``path`` (made if there is none).

    The last source row of a key by ``order_col`` counts; matching rows change in
    the contract's update columns only.  A null number is stored as 0, also in the
    partition column; null texts there are a partition of their own.  An empty
    source changes nothing.
    """
    source = with_partition(source, contract)
    plain = source.drop(order_col) if order_col else source
    staged = f"{path}/_batches/{batch or uuid.uuid4().hex}"
    if not exists(spark, f"{staged}/_SUCCESS"):                     # written in full
        target = touched_rows(spark, path, plain, contract).select(*plain.columns)
        merge_upsert(target, source, contract.keys, contract.updates, order_col=order_col).write.mode("overwrite").parquet(staged)
    merged = spark.read.schema(plain.schema).parquet(staged)
    (merged.repartition(contract.partition, F.pmod(F.xxhash64(*contract.keys), F.lit(16)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(contract.partition).parquet(path))

