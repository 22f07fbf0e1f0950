"""Pipeline-level tests: tagging invariants, plan shape, crosstab margins, oracles."""

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SMOKE
from voicelens.operators import aspects as AS
from voicelens.operators import keywords as KW
from voicelens.operators import reports as RP
from voicelens.plans import registry as R
from voicelens.plans import registry_ops  # noqa: F401
from voicelens.sources import adapters as A


def test_target_object_b9_only(spark):
    df = spark.createDataFrame([(["B9"],), (["B1", "J2"],), (["J6"],), (["JGP"],)], ["codes"])
    assert [r[0] for r in df.select(AS.target_object_of("codes")).collect()] == ["", "BJ", "J", "B"]


def test_clause_number(spark):
    df = spark.createDataFrame([(["x", "y", "x"],)], ["c"])
    got = df.select(F.transform("c", lambda s: F.array_position(F.col("c"), s))).first()[0]
    assert got == [1, 2, 1]


def test_keyword_uuid_collision_kept_apart(spark):
    t = spark.createDataFrame([(1, 11, ["thwo"]), (11, 1, ["thwo"])], "id long, chilid int, hed array<string>")
    rows = KW.explode_keywords(t).collect()
    assert rows[0].uuid == rows[1].uuid
    assert len({(r.id, r.chilid, r.seq) for r in rows}) == 2


def test_overview_crosstab_margins(spark):
    base = spark.createDataFrame([(0, 1, 1), (1, 1, 2), (1, 0, 3)], "emo int, irr_f int, id long")
    units = base.select(F.lit("airline").alias("scope"), F.lit("EN").alias("void"), F.lit("m").alias("period_kind"),
                        F.lit(202401).alias("period"), "*")
    got = {(r.emo, r.irr_f): r.n for r in RP.overview_crosstab(units).collect()}
    assert got[("0", "0")] == 0 and got[("0", "1")] == 1 and got[("1", "0")] == 1 and got[("1", "1")] == 1
    assert got[("0", "All")] == 1 and got[("1", "All")] == 2
    assert got[("All", "0")] == 1 and got[("All", "1")] == 2 and got[("All", "All")] == 3


def test_first_taxonomy_row_wins(spark):
    lk = AS.AspectLookup.from_dataframe(A.taxonomy_v(spark))
    df = spark.createDataFrame([(["thon"],)], ["t"])
    assert df.select(AS.codes_of("t", lk.m_all())).first()[0] == ["B1"]


def test_tagging_plan_is_narrow(spark):
    plan = R.tagged(spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # only the de-duplication shuffles (the labels join is broadcast by size)
    assert plan.count("Exchange hashpartitioning") <= 1


def test_tagged_row_invariants(spark):
    t = R.tagged(spark, SMOKE).cache()
    assert t.count() > 0
    assert t.groupBy("id", "chilid").count().filter("count > 1").count() == 0
    assert t.groupBy("id", "lable").count().filter("count > 1").count() == 0
    assert t.filter(F.size("codes") == 0).count() == 0
    t.unpersist()


ORACLE_SAMPLE = ["aspect_count", "ingest_clean", "split_subclauses", "period_bounds", "tag_reviews"]


@pytest.mark.parametrize("name", ORACLE_SAMPLE)
def test_oracle_matches(spark, name):
    con = duckdb.connect()
    for t in ["documents", "labels"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    sdf = R.QUERIES[name](spark, SMOKE).toPandas()
    odf = con.execute(R.ORACLES[name]).df()
    cols = sorted(sdf.columns)
    assert cols == sorted(odf.columns)
    norm = lambda df: sorted(tuple(str(v) for v in r) for r in df[cols].itertuples(index=False, name=None))
    assert norm(sdf) == norm(odf)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
