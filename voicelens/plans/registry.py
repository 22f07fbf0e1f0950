"""Registered queries: name → (Spark plan builder, DuckDB oracle SQL).

Every query reads the test tables under ``sf_dir`` (or data Spark derives
from them) in full.  Builders return DataFrames; those with intermediate tables, model fits or
streams run these while the query is built, and collect bounded dimensions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import lexicon as LX
from ..functions import text as T
from ..functions.clauses import split_clauses, split_subclauses
from ..operators import aspects as AS
from ..operators import keywords as KW
from ..operators import lexicon as LE
from ..operators import reports as RP
from ..sources import adapters as A
from ..sources import fixtures as FX
from . import oracle as O
from .ingest import dedupe_reviews, drop_blank_text, ingest_clean
from .tagging import TagConfig, tag_reviews

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# --- shared plan pieces --------------------------------------------------------

def lookup(spark: SparkSession) -> AS.AspectLookup:
    return AS.AspectLookup.from_dataframe(A.taxonomy_v(spark))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_clean(A.reviews_v(spark, sf_dir))


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_reviews(clean(spark, sf_dir), TagConfig(lookup=lookup(spark)))


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.report_units(tagged(spark, sf_dir))


TAG = (O.BASE_CTES, O.tagging_ctes())

# --- PIP-2 ingest ----------------------------------------------------------------

INGEST_COLS = "id, evaluated_text, fnum, irr_f, user_cabin, dep_code, arr_code, fdate, period_m, period_w, airline, emo"


@register("ingest_clean", O.with_ctes(O.BASE_CTES, body=f"SELECT {INGEST_COLS} FROM clean"))
def q_ingest_clean(spark, sf):
    return clean(spark, sf)


@register("dedupe_reviews", O.with_ctes(O.BASE_CTES, body="SELECT id, fnum, fdate, evaluated_text FROM dedup"))
def q_dedupe(spark, sf):
    return dedupe_reviews(A.reviews_v(spark, sf)).select("id", "fnum", "fdate", "evaluated_text")


# --- AGG-2 aspect_count --------------------------------------------------------------

@register("aspect_count", O.with_ctes(O.BASE_CTES, O.codes_cte("rc", "clean", ["id"], "evaluated_text"), body="""
SELECT c.id, CAST(coalesce(len(rc.codes), 0) AS BIGINT) AS n_aspects,
       coalesce(array_to_string(rc.codes, '、'), '') AS codes
FROM clean c LEFT JOIN rc ON rc.id = c.id"""))
def q_aspect_count(spark, sf):
    return LE.aspect_count(clean(spark, sf), A.taxonomy_v(spark))


# --- PIP-3 tag_reviews -------------------------------------------------------------------

TAGGED_COLS = ("id, chilid, view, view_n, lable, array_to_string(hed, '、') AS hed, fnum, irr_f, dep_code, arr_code, "
               "fdate, period_m, period_w, airline, " + ", ".join(LX.ALL_CODES) + ", ADO, emo")


@register("tag_reviews", O.with_ctes(*TAG, body=f"SELECT {TAGGED_COLS} FROM tagged"))
def q_tag_reviews(spark, sf):
    t = tagged(spark, sf)
    return t.select("id", "chilid", "view", "view_n", "lable", F.array_join("hed", "、").alias("hed"), "fnum",
                    "irr_f", "dep_code", "arr_code", "fdate", "period_m", "period_w", "airline", *LX.ALL_CODES,
                    "ADO", "emo")


# --- KEY-1 ----------------------------------------------------------------------------

@register("explode_keywords", O.with_ctes(*TAG, O.keyword_rows_cte(), body="SELECT uuid, id, chilid, seq, keyword FROM keywords"))
def q_explode_keywords(spark, sf):
    return KW.explode_keywords(tagged(spark, sf))


# --- reports ----------------------------------------------------------------------------

REPORT_KEYS = "scope, void, period_kind, period"


@register("comments_by_sentiment", O.with_ctes(*TAG, O.UNITS_CTE, body=f"""
SELECT {REPORT_KEYS}, status, code, emo, CAST(count(*) AS BIGINT) AS n
FROM (SELECT DISTINCT {REPORT_KEYS}, status, code, emo, lable, id FROM sc_units)
GROUP BY ALL"""))
def q_comments_by_sentiment(spark, sf):
    return RP.comments_by_sentiment(units(spark, sf))


@register("keyword_counts", O.with_ctes(*TAG, O.UNITS_CTE, body=f"""
SELECT *, CAST(row_number() OVER (PARTITION BY {REPORT_KEYS}, status, code, emo ORDER BY n DESC, keyword) AS INTEGER) AS rank
FROM (
  SELECT {REPORT_KEYS}, status, code, emo, keyword, CAST(count(*) AS BIGINT) AS n
  FROM (SELECT DISTINCT {REPORT_KEYS}, status, code, emo, id, chilid, keyword
        FROM (SELECT *, unnest(list_filter(hed, lambda k: regexp_matches(k, {O.q(FX.KEYWORD_SCRIPT)})
                                              AND NOT list_contains({O.arr(FX.STOPKEYS)}, k))) AS keyword FROM sc_units))
  GROUP BY ALL)"""))
def q_keyword_counts(spark, sf):
    return RP.keyword_counts(units(spark, sf))


@register("overview_crosstab", O.with_ctes(*TAG, O.UNITS_CTE, f"""
base AS (SELECT DISTINCT {REPORT_KEYS}, irr_f, emo, id FROM units),
cells AS (
  SELECT {REPORT_KEYS}, CAST(emo AS VARCHAR) AS emo, CAST(irr_f AS VARCHAR) AS irr_f, count(*) AS n FROM base GROUP BY ALL
  UNION ALL SELECT {REPORT_KEYS}, CAST(emo AS VARCHAR), 'All', count(*) FROM base GROUP BY ALL
  UNION ALL SELECT {REPORT_KEYS}, 'All', CAST(irr_f AS VARCHAR), count(*) FROM base GROUP BY ALL
  UNION ALL SELECT {REPORT_KEYS}, 'All', 'All', count(*) FROM base GROUP BY ALL),
emos AS (SELECT DISTINCT {REPORT_KEYS}, CAST(emo AS VARCHAR) AS emo FROM base UNION SELECT DISTINCT {REPORT_KEYS}, 'All' FROM base),
irrs AS (SELECT DISTINCT {REPORT_KEYS}, CAST(irr_f AS VARCHAR) AS irr_f FROM base UNION SELECT DISTINCT {REPORT_KEYS}, 'All' FROM base)""", body=f"""
SELECT e.scope, e.void, e.period_kind, e.period, e.emo, i.irr_f, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM emos e JOIN irrs i USING (scope, void, period_kind, period)
LEFT JOIN cells c ON c.scope = e.scope AND c.void = e.void AND c.period_kind = e.period_kind AND c.period = e.period
                 AND c.emo = e.emo AND c.irr_f = i.irr_f"""))
def q_overview_crosstab(spark, sf):
    return RP.overview_crosstab(units(spark, sf))


@register("distinct_periods", O.with_ctes(*TAG, body="""
SELECT DISTINCT 'm' AS period_kind, period_m AS period FROM tagged
UNION SELECT DISTINCT 'w', period_w FROM tagged"""))
def q_distinct_periods(spark, sf):
    return RP.distinct_periods(tagged(spark, sf))


@register("report_table")
def q_report_table(spark, sf):
    return RP.report_table(units(spark, sf))
