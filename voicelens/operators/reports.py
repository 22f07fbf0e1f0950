"""AGG-3..7, RPT-1..3: per-carrier / per-airport roll-ups.

The original loops over carriers, airports, statuses, codes and sentiment
classes and scans the frame once per combination.  Here every tagged row is
exploded once into its report units (scope × carrier/airport × period ×
status × code), and each measure is one shuffle aggregation over those
units.  Distinct counts are done as an explicit ``distinct`` on keys plus the
row identity (which spreads a hot carrier over all tasks) followed by a
partially aggregated ``count``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as LX
from ..functions.text import _array_lit
from .keywords import keyword_array, rank_within
from ..session import written
from ..sources import fixtures as FX

REPORT_KEYS = ["scope", "void", "period_kind", "period"]


def _by_key(arr, key: str):
    """Sort an array of structs by one string field (maps inside cannot be compared)."""
    return F.array_sort(arr, lambda a, b: F.when(a[key] < b[key], -1).when(a[key] > b[key], 1).otherwise(0))


def _pair(x):
    """``["word", n]`` as JSON text: the word quoted, the count a number."""
    return F.concat(F.regexp_replace(F.to_json(F.array(x["keyword"])), "\\]$", ""), F.lit(","), x["n"].cast("string"), F.lit("]"))


def report_units(tagged: DataFrame, periods=("m", "w")) -> DataFrame:
    """Explode tagged rows into (scope, void, period_kind, period) units.

    Airline scope: ADO in (B, BJ), void = carrier.  Airport scope: ADO in
    (J, BJ), void = each distinct airport of the row (JON-5: departure or
    arrival, counted once), without an OR join.
    """
    airline = F.when(F.col("ADO").isin("B", "BJ"),
                     F.array(F.struct(F.lit("airline").alias("scope"), F.col("airline").alias("void"))))
    airports = F.transform(F.array_distinct(F.array("dep_code", "arr_code")),
                           lambda a: F.struct(F.lit("airport").alias("scope"), a.alias("void")))
    airport = F.when(F.col("ADO").isin("J", "BJ"), airports)
    scopes = F.concat(F.coalesce(airline, F.array().cast("array<struct<scope:string,void:string>>")),
                      F.coalesce(airport, F.array().cast("array<struct<scope:string,void:string>>")))
    per = []
    if "m" in periods:
        per.append(F.struct(F.lit("m").alias("period_kind"), F.col("period_m").alias("period")))
    if "w" in periods:
        per.append(F.struct(F.lit("w").alias("period_kind"), F.col("period_w").alias("period")))
    return (tagged.withColumn("_s", F.explode(scopes)).withColumn("_p", F.explode(F.array(*per)))
            .select("*", "_s.scope", "_s.void", "_p.period_kind", "_p.period").drop("_s", "_p"))


def _status_code_units(units: DataFrame) -> DataFrame:
    """(… status, code) per unit: status 'all' plus 'normal' (irr_f=1) or 'abnormal' (irr_f=0);
    codes of the unit's scope only."""
    status = F.array(F.lit("all"), F.when(F.col("irr_f") == 1, "normal").when(F.col("irr_f") == 0, "abnormal"))
    scope_codes = F.when(F.col("scope") == "airline", _array_lit(LX.AIRLINE_CODES)).otherwise(
        _array_lit(LX.AIRPORT_CODES))
    return (units.withColumn("status", F.explode(F.filter(status, lambda s: s.isNotNull())))
            .withColumn("code", F.explode(F.array_intersect(F.col("codes"), scope_codes))))


def comments_by_sentiment(units: DataFrame) -> DataFrame:
    """AGG-3: per unit × status × code × emo: distinct (lable, emo, id) count."""
    keys = REPORT_KEYS + ["status", "code", "emo"]
    sc = _status_code_units(units).select(*keys, "lable", "id").distinct()
    return sc.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def keyword_counts(units: DataFrame, stopkeys=FX.STOPKEYS, script: str = FX.KEYWORD_SCRIPT,
                   top_k: int | None = None) -> DataFrame:
    """AGG-4 + WIN-1: per unit × status × code × emo × keyword: number of tagged rows
    (distinct id, chilid) holding the keyword, ranked by count then keyword."""
    keys = REPORT_KEYS + ["status", "code", "emo"]
    sc = _status_code_units(units).select(*keys, "id", "chilid", F.explode(keyword_array(F.col("hed"), stopkeys, script)).alias("keyword"))
    counts = sc.distinct().groupBy(*keys, "keyword").agg(F.count(F.lit(1)).alias("n"))
    return rank_within(counts, keys, "n", "keyword", top_k)


def overview_crosstab(units: DataFrame) -> DataFrame:
    """AGG-5: emo × irr_f counts of distinct (irr_f, emo, id) with margins 'All'.

    Only observed emo and irr_f values of a unit form its grid; missing cells are 0.
    """
    base = units.select(*REPORT_KEYS, "irr_f", "emo", "id").distinct()  # one shuffle of the units; the cells are few
    with_all = lambda c: F.explode(F.array(F.col(c).cast("string"), F.lit("All")))
    cells = (base.select(*REPORT_KEYS, with_all("emo").alias("emo"), "irr_f").select(*REPORT_KEYS, "emo", with_all("irr_f").alias("irr_f"))
             .groupBy(*REPORT_KEYS, "emo", "irr_f").agg(F.count(F.lit(1)).alias("n")))
    cells = written(cells, "overview-cells")                        # read three times below
    # every observed value has a margin cell, so the margins are the axes of the grid
    emos = cells.where("irr_f = 'All'").select(*REPORT_KEYS, "emo")
    irrs = cells.where("emo = 'All'").select(*REPORT_KEYS, "irr_f")
    return (emos.join(irrs, REPORT_KEYS).join(cells, REPORT_KEYS + ["emo", "irr_f"], "left")
            .select(*REPORT_KEYS, "emo", "irr_f", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def distinct_periods(tagged: DataFrame) -> DataFrame:
    """AGG-7 + WIN-6: distinct month and week keys, ascending."""
    both = F.array(*[F.struct(F.lit(kind).alias("period_kind"), F.col(f"period_{kind}").alias("period")) for kind in "mw"])
    pairs = tagged.select("period_m", "period_w").distinct().select(F.explode(both).alias("p"))  # the table is read once
    return pairs.select("p.period_kind", "p.period").distinct().orderBy("period_kind", "period")


def report_table(units: DataFrame, stopkeys=FX.STOPKEYS, script: str = FX.KEYWORD_SCRIPT, scope: str | None = None) -> DataFrame:
    """RPT-1/2/3: one JSON report per (scope, void, period_kind, period), of one ``scope`` or of both.

    ``{"overview": {irr_f: {emo: n}}, "detail": {status: {code: {"com_num": {emo: n},
    "keywords": {emo: [[keyword, n], ...]}}}}}`` — built by successive
    aggregations, each over data already reduced by the previous one.
    """
    # the three measures read the same units: write the slim rows once instead of tagging three times
    if scope is not None:
        units = units.where(F.col("scope") == scope)
    units = units.select(*REPORT_KEYS, "irr_f", "emo", "id", "chilid", "lable", "codes", "hed")
    units = written(units, "report-units")
    com = comments_by_sentiment(units)
    kw = keyword_counts(units, stopkeys, script)
    kw_lists = (kw.groupBy(*REPORT_KEYS, "status", "code", "emo")
                .agg(F.array_sort(F.collect_list(F.struct("rank", "keyword", "n"))).alias("_l"))
                .select(*REPORT_KEYS, "status", "code", F.col("emo").cast("string").alias("emo"),
                        F.parse_json(F.concat(F.lit("["), F.array_join(F.transform("_l", _pair), ","), F.lit("]"))).alias("kw")))
    com = com.select(*REPORT_KEYS, "status", "code", F.col("emo").cast("string").alias("emo"), "n")
    # every emo class of the code gets a keyword list, [] when it has none
    per_emo = com.join(kw_lists, REPORT_KEYS + ["status", "code", "emo"], "left")
    per_code = (per_emo.groupBy(*REPORT_KEYS, "status", "code").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("emo", "n")))).alias("com_num"),
        F.map_from_entries(_by_key(F.collect_list(F.struct(
            "emo", F.coalesce("kw", F.parse_json(F.lit("[]"))).alias("kw"))), "emo")).alias("keywords")))
    # keyword lists for every sentiment class (0, 1, 2), [] where a class has none, as the original
    kw_all = F.map_from_entries(F.transform(F.array(F.lit("0"), F.lit("1"), F.lit("2")), lambda e: F.struct(
        e.alias("emo"), F.coalesce(F.try_element_at(F.col("keywords"), e), F.parse_json(F.lit("[]"))).alias("kw"))))
    per_code = per_code.withColumn("keywords", kw_all)
    per_status = (per_code.groupBy(*REPORT_KEYS, "status").agg(
        F.map_from_entries(_by_key(F.collect_list(F.struct(
            "code", F.struct("com_num", "keywords"))), "code")).alias("codes")))
    detail = per_status.groupBy(*REPORT_KEYS).agg(
        F.map_from_entries(_by_key(F.collect_list(F.struct("status", "codes")), "status")).alias("detail"))
    ov = overview_crosstab(units)
    ov_irr = ov.groupBy(*REPORT_KEYS, "irr_f").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("emo", "n")))).alias("_m"))
    overview = ov_irr.groupBy(*REPORT_KEYS).agg(
        F.map_from_entries(_by_key(F.collect_list(F.struct("irr_f", "_m")), "irr_f")).alias("overview"))
    rep = overview.join(detail, REPORT_KEYS, "left")
    return rep.select(*REPORT_KEYS, F.to_json(F.struct(
        "overview", F.coalesce("detail", F.create_map().cast("map<string,map<string,struct<com_num:map<string,bigint>,keywords:map<string,variant>>>>")).alias("detail")),
        {"ignoreNullFields": "false"}).alias("keywordsdata"))
