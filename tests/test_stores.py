"""SNK-1 on stored tables and STM-1: touched partitions only, a batch twice is a batch once, restart in the middle."""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE
from voicelens.plans import registry as R
from voicelens.plans import registry_io  # noqa: F401
from voicelens.plans.tagging import TagConfig
from voicelens.sources import adapters as A
from voicelens.sources import stores as ST
from voicelens.streaming import daily

KEYWORDS = ST.TableContract("k", ["id", "chilid", "seq"], ["keyword"], "id_block", {"id_block": "id div 10"})
SCHEMA = "id long, chilid int, seq int, keyword string, n int, version int"


def rows_of(spark, path):
    return sorted((r.id, r.chilid, r.seq, r.keyword, r.n) for r in spark.read.parquet(path).collect())


def test_merge_follows_the_contract(spark):
    path = tempfile.mkdtemp() + "/t"
    ST.merge_into(spark, path, spark.createDataFrame([(1, 1, 1, "a", 5, 0), (1, 1, 2, "b", None, 0), (25, 1, 1, "c", 7, 0)], SCHEMA), KEYWORDS, batch="1", order_col="version")
    assert rows_of(spark, path) == [(1, 1, 1, "a", 5), (1, 1, 2, "b", 0), (25, 1, 1, "c", 7)]
    more = spark.createDataFrame([(1, 1, 1, "x", 9, 1), (1, 1, 1, "y", 8, 2), (2, 1, 1, "new", None, 1)], SCHEMA)
    want = [(1, 1, 1, "y", 5), (1, 1, 2, "b", 0), (2, 1, 1, "new", 0), (25, 1, 1, "c", 7)]
    for batch in ("2", "2", "3"):                                    # the same name again, and the same rows under another name
        ST.merge_into(spark, path, more, KEYWORDS, batch=batch, order_col="version")
        assert rows_of(spark, path) == want
    ST.merge_into(spark, path, more.limit(0), KEYWORDS, batch="4", order_col="version")
    assert rows_of(spark, path) == want


def test_null_partitions_are_kept(spark):
    contract = ST.TableContract("p", ["k"], ["v"], "part")
    path = tempfile.mkdtemp() + "/t"
    ST.merge_into(spark, path, spark.createDataFrame([(1, "a", None), (2, "b", 3)], "k int, v string, part int"), contract)
    ST.merge_into(spark, path, spark.createDataFrame([(4, "c", None)], "k int, v string, part int"), contract)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "part").collect()) == [(1, "a", 0), (2, "b", 3), (4, "c", 0)]
    path = tempfile.mkdtemp() + "/t"
    ST.merge_into(spark, path, spark.createDataFrame([(1, "a", None), (2, "b", "x")], "k int, v string, part string"), contract)
    ST.merge_into(spark, path, spark.createDataFrame([(4, "c", None)], "k int, v string, part string"), contract)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v").collect()) == [(1, "a"), (2, "b"), (4, "c")]


def test_only_touched_partitions_are_read_and_written(spark):
    path = tempfile.mkdtemp() + "/t"
    first = spark.range(0, 100).selectExpr("id", "1 as chilid", "1 as seq", "'a' as keyword", "1 as n")
    ST.merge_into(spark, path, first, KEYWORDS, batch="1")
    files = {r[0] for r in spark.read.parquet(path).where("id_block != 3").select(F.input_file_name()).distinct().collect()}
    source = ST.with_partition(first.where("id = 35").withColumn("keyword", F.lit("z")), KEYWORDS)
    plan = ST.touched_rows(spark, path, source, KEYWORDS)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "id_block" in plan.split("PartitionFilters: [")[1].split("]")[0]
    ST.merge_into(spark, path, source, KEYWORDS, batch="2")
    after = spark.read.parquet(path)
    assert after.count() == 100 and [r.id for r in after.where("keyword = 'z'").collect()] == [35]
    assert {r[0] for r in after.where("id_block != 3").select(F.input_file_name()).distinct().collect()} == files


class Crash(Exception):
    pass


def test_stream_restarts_in_the_middle_and_drops_later_copies(spark):
    base = tempfile.mkdtemp()
    raw = A.reviews_v(spark, SMOKE)
    copies = raw.where("id % 4 = 0").withColumn("id", F.col("id") + 1_000_000)               # arrive later, equal otherwise
    for part in (raw.where("id < 90"), raw.where("id >= 90"), copies):                        # files arrive one after another
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
    schema = raw.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    cfg = TagConfig(lookup=R.lookup(spark))
    done = []

    def crash(name):
        done.append(name)
        if len(done) == 4:                                           # in the second batch, behind its first table
            raise Crash(name)

    run = lambda after: daily.run_increment(spark, f"{base}/in", schema, f"{base}/tables", f"{base}/ckpt", cfg, files_per_batch=1, after=after)
    with pytest.raises(Exception, match="Crash"):
        run(crash)
    run(None)
    run(None)                                                       # nothing has arrived
    cols = ["id", "chilid", "view", "lable", "period_m", "ADO", "emo", "B1", "J2"]
    got = sorted(map(tuple, spark.read.parquet(f"{base}/tables/tagged").select(*cols).collect()))
    want = sorted(map(tuple, R.tagged(spark, SMOKE).select(*cols).collect()))
    assert got == want
    assert spark.read.parquet(f"{base}/tables/keywords").count() == R.QUERIES["explode_keywords"](spark, SMOKE).count()
