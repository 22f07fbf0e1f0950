"""Sharding by sampled splitters, in DataFrame functions alone.

Records have a key, (hash of the text, hash of the row), under which equal texts
are neighbours but no two rows tie, so a group of copies of any size can be cut.
A size-weighted sample of keys gives quantile boundaries of many ranges; records
fall into their range by a lookup of bounded size.  Sums per range are exact, and
inside a range a running sum gives every record its exact position in the whole
order.  A range that reaches over the end of a shard is overfull for it and is
subdivided at that point, so shards are equal to within one record.

The weight of a record in the sample is its size plus the mean size: ranges are
then even in bytes and in rows, and a run of tiny records fills no range alone.
Texts stay where they are read; about 40 bytes a record are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

ROWS_PER_RANGE = 2_000_000
MIN_RANGES, MAX_RANGES = 512, 16_384
SAMPLES_PER_RANGE = 64
#: Buckets of the lookup, by the upper bits of the first hash.
BUCKET_BITS = 12


def records(docs: DataFrame) -> DataFrame:
    """doc_id, size, checksum and key of each row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("k1"))
    return rows.withColumn("k2", F.xxhash64("doc_id", F.monotonically_increasing_id()))


def splitters(rows: DataFrame, n_rows: int, n_bytes: int, ranges: int) -> DataFrame:
    """At most ``ranges`` - 1 boundary keys (k1, k2): quantiles of a weighted sample of keys."""
    mean = n_bytes / max(1, n_rows)
    draws = ranges * SAMPLES_PER_RANGE
    chance = (F.col("size") + mean) * (draws / (2.0 * max(1, n_bytes)))
    uniform = (F.xxhash64("k1", "k2", F.lit("draw")).cast("double") + 2.0 ** 63) / 2.0 ** 64
    sample = rows.where(uniform < chance).select("k1", "k2", F.greatest(chance, F.lit(1.0)).alias("weight"))  # about ``draws`` rows
    order = Window.orderBy("k1", "k2")
    sample = sample.select("k1", "k2", F.sum("weight").over(order).alias("upto"), F.sum("weight").over(Window.partitionBy()).alias("all"))
    tiles = sample.select("k1", "k2", F.floor(F.col("upto") * ranges / F.col("all")).alias("tile"))
    return tiles.groupBy("tile").agg(F.min(F.struct("k1", "k2")).alias("b")).where((F.col("tile") > 0) & (F.col("tile") < ranges)).select("b.k1", "b.k2")


def in_ranges(rows: DataFrame, boundaries: DataFrame) -> DataFrame:
    """``rows`` with the number of boundaries at or below their key, as ``range``."""
    spark, half = rows.sparkSession, 1 << (BUCKET_BITS - 1)
    bucket = lambda k: F.shiftright(k, 64 - BUCKET_BITS)
    listed = boundaries.groupBy(bucket("k1").alias("bucket")).agg(F.collect_list(F.struct("k1", "k2")).alias("bounds"))
    lookup = spark.range(-half, half, numPartitions=1).select(F.col("id").alias("bucket")).join(F.broadcast(listed), "bucket", "left")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    count = F.coalesce(F.size("bounds"), F.lit(0))
    count = F.when(count < 0, 0).otherwise(count)
    lookup = lookup.select("bucket", F.coalesce("bounds", F.array().cast("array<struct<k1:bigint,k2:bigint>>")).alias("bounds"),
                           F.coalesce(F.sum(count).over(before), F.lit(0)).alias("base"))
    passed = F.filter("bounds", lambda b: (b["k1"] < F.col("k1")) | ((b["k1"] == F.col("k1")) & (b["k2"] <= F.col("k2"))))
    joined = rows.withColumn("bucket", bucket("k1")).join(F.broadcast(lookup), "bucket")  # 2 ** BUCKET_BITS rows
    return joined.withColumn("range", (F.col("base") + F.size(passed)).cast("int")).drop("bucket", "bounds", "base")


def shard(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id, text; others are ignored).

    doc_id, size (UTF-8 bytes plus 1), text_crc32, law (always ``bytes``),
    shard, slot (gapless from 0 in its shard), grown_shard (always null).  Null
    text counts as empty; rows with null or repeated doc_id are records of
    their own; an empty table gives no rows.
    """
    rows = written(records(docs), "records")
    total = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    ranges = min(MAX_RANGES, max(MIN_RANGES, total["rows"] // ROWS_PER_RANGE))
    boundaries = written(splitters(rows, total["rows"], total["bytes"], ranges), "splitters")
    placed = in_ranges(rows, boundaries)
    sums = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
                         F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"))
    inside = Window.partitionBy("range").orderBy("k1", "k2")
    ordered = (placed.select("doc_id", "size", "text_crc32", "range",
                             F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("upto"),
                             F.row_number().over(inside).alias("nth"))
               .join(F.broadcast(starts), "range"))  # at most MAX_RANGES rows
    middle = 2 * (F.col("bytes_before") + F.col("upto")) - F.col("size")
    at = F.least(F.lit(shards - 1), F.floor(middle * shards / (2 * max(1, total["bytes"])))).cast("int")
    ordered = written(ordered.select("doc_id", "size", "text_crc32", at.alias("shard"), (F.col("rows_before") + F.col("nth") - 1).alias("place")), "placed")
    first = ordered.groupBy("shard").agg(F.min("place").alias("first"))
    return ordered.join(F.broadcast(first), "shard").select(  # one row per shard
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
