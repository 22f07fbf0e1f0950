"""STM-1 daily_incremental: new review files → clean + tag → merged into the stored tables, batch by batch.

The stream reads arriving files; every micro-batch runs through ``foreachBatch``:
blank filter, flight regularity, text strip, period keys, carrier, tagging, then a
merge into the tagged and the keyword table (``stores.merge_into``), which reads and
rewrites only the partitions that the batch touches.  Of reviews with equal (flight,
date, text) the first one counts: a compact table of the keys seen so far, read for the
batch's dates only, keeps later copies out.

A batch is named by the stream's batch id, so a batch that is run again after a
crash, in whole or from the middle, changes nothing more.  The checkpoint and the
tables stand in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import text as T
from ..operators.keywords import explode_keywords
from ..plans.ingest import carrier_code, drop_blank_text
from ..plans.tagging import TagConfig, tag_reviews
from ..session import written
from ..sources.stores import TABLES, merge_into, touched_rows


def clean_stream(raw: DataFrame, arrival_gap: str = "reference", crlf: str = "。") -> DataFrame:
    df = drop_blank_text(raw)
    df = df.withColumn("irr_f", C.irregular_flag("fdplan", "fdactual", "faplan", "faactual", arrival_gap))
    df = df.withColumn("text_key", F.sha2(F.col("evaluated_text").cast("binary"), 256))
    df = df.withColumn("evaluated_text", T.strip_crlf("evaluated_text", crlf))
    m, w = C.period_keys(F.col("fdate"))
    return df.select("id", "evaluated_text", "text_key", "fnum", "irr_f", "user_cabin",
                     F.col("fdep_code").alias("dep_code"), F.col("farr_code").alias("arr_code"), "fdate",
                     m.alias("period_m"), w.alias("period_w"), carrier_code("fnum").alias("airline"), "emo")


def new_reviews(spark: SparkSession, cleaned: DataFrame, tables: str) -> tuple[DataFrame, DataFrame]:
    """The first review (smallest id) of each key of the batch that no earlier batch has, and their keys."""
    firsts = cleaned.groupBy("fdate", "fnum", "text_key").agg(F.min("id").alias("id"))
    seen = touched_rows(spark, f"{tables}/seen", firsts, TABLES["seen"]).withColumnRenamed("id", "seen_id")
    firsts = firsts.join(seen, ["fdate", "fnum", "text_key"], "left").where("seen_id is null or seen_id = id").select("fdate", "fnum", "text_key", "id")
    return cleaned.join(firsts.select("id"), "id", "left_semi"), firsts


def merge_batch(spark: SparkSession, raw: DataFrame, batch_id: int, tables: str, cfg: TagConfig, after: Callable[[str], None] | None = None) -> None:
    """One micro-batch; ``after`` is told of each table that is merged (tests stop there)."""
    cleaned = written(clean_stream(raw.repartition("id")), "batch-reviews")  # a file may be one task's; the tagging is not
    fresh, firsts = new_reviews(spark, cleaned, tables)
    firsts = written(firsts, "batch-keys")
    tagged = written(tag_reviews(fresh.drop("text_key"), cfg, keep_comment=False), "batch-tagged")
    rows = {"tagged": tagged, "keywords": explode_keywords(tagged).select("id", "chilid", "seq", "keyword"), "seen": firsts}
    for name, source in rows.items():                               # the keys come last: a batch without them is not done
        merge_into(spark, f"{tables}/{name}", source, TABLES[name], batch=f"{batch_id}")
        if after:
            after(name)


def run_increment(spark: SparkSession, input_dir: str, schema: str, tables: str, checkpoint_dir: str, cfg: TagConfig,
                  files_per_batch: int | None = None, after: Callable[[str], None] | None = None) -> None:
    """Merge the files that have arrived since the last run."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    q = (reader.parquet(input_dir).writeStream
         .foreachBatch(lambda df, n: merge_batch(df.sparkSession, df, n, tables, cfg, after))
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()
