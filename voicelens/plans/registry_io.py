"""Registered queries for sources, sinks, merge, sentiment, co-occurrence, opinions and the stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import lexicon as LX
from ..functions import patterns as P
from ..functions import text as T
from ..operators import aspects as AS
from ..operators import cooccur as CO
from ..operators import keywords as KW
from ..operators import lexicon as LE
from ..operators import merge as MG
from ..operators import opinions as OP
from ..operators import reports as RP
from ..operators import sentiment as SE
from ..session import scratch_path, written
from ..sources import adapters as A
from ..sources import fixtures as FX
from ..sources import readers as RD
from ..sources import stores as ST
from . import oracle as O
from .registry import ORACLES, TAG, clean, lookup, register, tagged
from .registry_ops import TOKENS_V_SQL, docs
from .tagging import TagConfig


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:10]}")


RAW_SQL = ("SELECT id, fnum, user_cabin, fdate, evaluated_text, fdep_code, farr_code, fdplan, faplan, fdactual, "
           "faactual FROM reviews_v")


@register("scan_reviews", O.with_ctes(O.BASE_CTES, body=RAW_SQL + " WHERE fdate BETWEEN '20240101' AND '20240131' AND length(evaluated_text) > 0"))
def q_scan_reviews(spark, sf):
    return RD.scan_reviews(A.reviews_v(spark, sf), "20240101", "20240131")


@register("scan_csv", O.with_ctes(O.BASE_CTES, body=RAW_SQL))
def q_scan_csv(spark, sf):
    path = _scratch(spark, "reviews-csv")
    RD.write_csv(A.reviews_v(spark, sf).select(*RD.RAW_COLUMNS), path)
    return RD.read_csv(spark, path)


@register("write_csv", O.with_ctes(*TAG, body="SELECT id, chilid, view, lable, fnum, irr_f, period_m, period_w, ADO FROM tagged"))
def q_write_csv(spark, sf):
    path = _scratch(spark, "tagged-csv")
    cols = ["id", "chilid", "view", "lable", "fnum", "irr_f", "period_m", "period_w", "ADO"]
    RD.write_csv(tagged(spark, sf).select(*cols), path)
    return RD.read_csv(spark, path, "id BIGINT, chilid INT, view STRING, lable STRING, fnum STRING, irr_f INT, "
                                    "period_m INT, period_w INT, ADO STRING")


@register("wordlist_dim", f"""SELECT DISTINCT w AS word FROM (
  SELECT regexp_replace(unnest(string_split(text, chr(10))), {O.q(P.OUTER_BLANKS)}, '', 'g') AS w FROM documents)
WHERE w <> ''""")
def q_wordlist_dim(spark, sf):
    path = _scratch(spark, "wordlist")
    docs(spark, sf).select(F.col("text").alias("value")).write.mode("overwrite").text(path)
    return RD.read_wordlist(spark, path)


@register("taxonomy_dim", "SELECT keyword, arg_min(code, line_no) AS code, CAST(min(line_no) AS INTEGER) AS line_no FROM "
          + O.taxonomy_values() + " t WHERE keyword IN (SELECT DISTINCT unnest(" + O.tokens("text") + ") FROM documents) GROUP BY keyword")
def q_taxonomy_dim(spark, sf):
    path = _scratch(spark, "taxonomy-csv")
    A.taxonomy_v(spark).write.mode("overwrite").option("header", True).csv(path)
    tax = spark.read.schema("line_no INT, keyword STRING, code STRING, level1 STRING").option("header", True).csv(path)
    seen = docs(spark, sf).select(F.explode(F.array_distinct(T.tokenize("text"))).alias("keyword")).distinct()
    return AS.first_keyword_rows(tax).select("keyword", "code", "line_no").join(seen, "keyword", "left_semi")


@register("scan_tagged", O.with_ctes(*TAG, body="SELECT id, chilid, lable, irr_f, CASE WHEN irr_f = 1 THEN 0 ELSE B9 END AS B9, period_m FROM tagged WHERE period_m = 202401"))
def q_scan_tagged(spark, sf):
    path = _scratch(spark, "tagged-parquet")
    tagged(spark, sf).drop("comment").write.mode("overwrite").partitionBy("period_m").parquet(path)
    return RD.scan_tagged(spark, path, "period_m", 202401).select("id", "chilid", "lable", "irr_f", "B9", "period_m")


@register("reports_by_period")
def q_reports_by_period(spark, sf):
    path = _scratch(spark, "tagged-parquet")
    tagged(spark, sf).drop("comment").write.mode("overwrite").partitionBy("period_m").parquet(path)
    stored = RD.scan_tagged(spark, path, "period_m", 202401)
    return RP.report_table(RP.report_units(stored, periods=("m",)))


@register("report_json")
def q_report_json(spark, sf):
    return RP.report_table(RP.report_units(tagged(spark, sf)))


@register("airline_report")
def q_airline_report(spark, sf):
    return RP.report_table(RP.report_units(tagged(spark, sf)), scope="airline")


@register("airport_report")
def q_airport_report(spark, sf):
    return RP.report_table(RP.report_units(tagged(spark, sf)), scope="airport")


# --- SNK-1 merge --------------------------------------------------------------------

@register("upsert_merge", O.with_ctes(*TAG, O.keyword_rows_cte(), """
tgt AS (SELECT id, chilid, seq, keyword, length(keyword) AS n FROM keywords),
src AS (
  SELECT id, chilid, seq, upper(keyword) || '!' AS keyword, NULL AS n FROM tgt WHERE keyword < 'c'
  UNION ALL SELECT id, chilid, 0, lable, NULL FROM tagged)""", body="""
SELECT coalesce(t.id, s.id) AS id, coalesce(t.chilid, s.chilid) AS chilid, coalesce(t.seq, s.seq) AS seq,
       CASE WHEN s.id IS NOT NULL THEN s.keyword ELSE t.keyword END AS keyword,
       CAST(coalesce(CASE WHEN t.id IS NOT NULL THEN t.n ELSE s.n END, 0) AS INTEGER) AS n
FROM tgt t FULL OUTER JOIN src s ON t.id = s.id AND t.chilid = s.chilid AND t.seq = s.seq"""))
def q_upsert_merge(spark, sf):
    """Two versions of each update (the last wins), inserts with a null count, a count that updates leave alone."""
    t = written(tagged(spark, sf).select("id", "chilid", "lable", "hed"), "tagged")
    target = KW.explode_keywords(t).select("id", "chilid", "seq", "keyword", F.length("keyword").alias("n"))
    hit = target.filter(F.col("keyword") < "c").withColumn("n", F.lit(None).cast("int"))
    versions = hit.withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))
    capitals = F.upper(F.replace("keyword", F.lit("ß"), F.lit("ẞ")))   # one capital a letter, as in the SQL
    updates = versions.withColumn("keyword", F.concat(capitals, F.when(F.col("version") == 2, "!").otherwise("")))
    inserts = t.select("id", "chilid", F.lit(0).alias("seq"), F.col("lable").alias("keyword"), F.lit(None).cast("int").alias("n"), F.lit(1).alias("version"))
    return MG.merge_upsert(target, updates.unionByName(inserts), ["id", "chilid", "seq"], ["keyword"], order_col="version")


MERGED = [c for c in ST.TABLES["tagged"].updates if c != "hed"]
STORED = ["id", "chilid", *MERGED, "JGP", "fnum", "airline", "period_m"]


@register("upsert_tagged", O.with_ctes(*TAG, body=f"""
SELECT id, chilid, {', '.join(MERGED)}, CASE WHEN id % 3 = 0 THEN JGP ELSE 7 END AS JGP, CASE WHEN id % 3 = 0 THEN fnum ELSE 'old' END AS fnum, airline, period_m
FROM tagged"""))
def q_upsert_tagged(spark, sf):
    """The tagged table: two thirds stored with other values, then all rows merged month by month; columns outside the contract keep the stored values."""
    path = _scratch(spark, "stored-tagged")
    t = written(tagged(spark, sf).select(*STORED), "tagged")
    old = t.where("id % 3 != 0").withColumns({"view": F.lit("old"), "lable": F.lit(None).cast("string"), "emo": F.lit(9), "B1": F.lit(5), "JGP": F.lit(7), "fnum": F.lit("old")})
    ST.merge_into(spark, path, old, ST.TABLES["tagged"], batch="first")
    for batch in ("even", "odd", "odd"):                            # the repeated batch changes nothing
        part = t.where(F.col("period_m") % 2 == (0 if batch == "even" else 1))
        ST.merge_into(spark, path, part, ST.TABLES["tagged"], batch=batch)
    return spark.read.parquet(path).select(*STORED)


@register("upsert_reports", O.with_ctes(*TAG, O.UNITS_CTE, body="""
SELECT DISTINCT period_kind, void, CAST(period AS INTEGER) AS period, CASE WHEN period_kind = 'm' THEN 'new' ELSE 'old' END AS state FROM units
WHERE period_kind = 'm' OR period % 2 = 1
UNION SELECT DISTINCT 'w', void, CAST(period AS INTEGER), 'new' FROM units WHERE period_kind = 'w' AND period % 2 = 0"""))
def q_upsert_reports(spark, sf):
    """Month and week reports: stored once, then all months and the even weeks merged anew."""
    u = written(RP.report_units(tagged(spark, sf)), "units")
    reports = RP.report_table(u).select("void", "period", "keywordsdata")
    reports = written(reports, "reports")
    out = None
    for kind, name in (("m", "month_reports"), ("w", "week_reports")):
        path, column = _scratch(spark, name), f"period_{kind}"
        own = reports.where(F.col("period") < 1_000_000 if kind == "m" else F.col("period") >= 1_000_000).withColumnRenamed("period", column)
        ST.merge_into(spark, path, own.withColumn("keywordsdata", F.lit("old")), ST.TABLES[name], batch="first")
        ST.merge_into(spark, path, own if kind == "m" else own.where(F.col(column) % 2 == 0), ST.TABLES[name], batch="again")
        state = F.when(F.col("keywordsdata") == "old", "old").otherwise("new")
        rows = spark.read.parquet(path).select(F.lit(kind).alias("period_kind"), "void", F.col(column).cast("int").alias("period"), state.alias("state"))
        out = rows if out is None else out.unionByName(rows)
    return out


# --- SEN-1 ----------------------------------------------------------------------------

_POL = ", ".join(f"({O.q(w)}, {p})" for w, p in FX.POLARITY)


@register("sentiment_lexicon", f"""
WITH pol(word, polarity) AS (VALUES {_POL}),
toks AS (SELECT doc_id, unnest({O.tokens('text')}) AS t, unnest(range(1, len({O.tokens('text')}) + 1)) AS i FROM documents),
scored AS (
  SELECT doc_id, coalesce(p.polarity, 0) * CASE WHEN lag(t) OVER (PARTITION BY doc_id ORDER BY i) IN (SELECT unnest({O.arr(FX.NEGATIONS)})) THEN -1 ELSE 1 END AS s
  FROM toks LEFT JOIN pol p ON p.word = toks.t)
SELECT d.doc_id, CAST(coalesce(sum(s), 0) AS INTEGER) AS score,
       CAST(CASE WHEN coalesce(sum(s), 0) > 0 THEN 2 WHEN coalesce(sum(s), 0) < 0 THEN 0 ELSE 1 END AS INTEGER) AS emo
FROM documents d LEFT JOIN scored USING (doc_id) GROUP BY d.doc_id""")
def q_sentiment_lexicon(spark, sf):
    scores = LE.polarity_scores(docs(spark, sf), A.polarity_v(spark), FX.NEGATIONS)
    return scores.select("doc_id", "score", SE.emo_class(F.col("score")).alias("emo"))


@register("sentiment_model")
def q_sentiment_model(spark, sf):
    """Three sentiment classes, learned from the reviews that carry a label, predicted for all."""
    d = written(SE.term_counts(A.table(spark, sf, "documents").select("doc_id", "text")), "term-counts")  # words once, for fit and prediction
    rated = A.table(spark, sf, "labels").select("doc_id").distinct()
    emo = A.reviews_v(spark, sf).select(F.col("id").alias("doc_id"), F.col("emo").cast("double").alias("label")).join(rated, "doc_id", "left_semi")
    model = SE.sentiment_model(written(d.join(emo, "doc_id"), "rated-reviews"))
    return model.transform(d).select("doc_id", F.col("prediction").cast("int").alias("emo"))


# --- AGG-6 ----------------------------------------------------------------------------

@register("cooccurrence", O.with_ctes(*TAG, f"""
w AS (SELECT id, chilid, codes, list_filter({O.tokens('view')}, lambda t: regexp_matches(t, {O.q(P.LETTER_TOKEN)})
          AND NOT list_contains({O.arr(FX.STOPWORDS)}, t)) AS ws FROM tagged),
pos AS (SELECT id, chilid, codes, unnest(ws) AS t, unnest(range(1, len(ws) + 1)) AS i FROM w),
pairs AS (SELECT DISTINCT x.id, x.chilid, x.codes, least(x.t, y.t) AS a, greatest(x.t, y.t) AS b
          FROM pos x JOIN pos y ON x.id = y.id AND x.chilid = y.chilid AND y.i > x.i AND y.i <= x.i + 3
          WHERE x.t <> y.t)""", body="""
SELECT code, a, b, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(codes) AS code, a, b FROM pairs) GROUP BY ALL"""))
def q_cooccurrence(spark, sf):
    return CO.cooccurrence(tagged(spark, sf), FX.STOPWORDS, window=3)


# --- OPN-1 / OPN-6 ---------------------------------------------------------------------

@register("head_index", O.with_ctes(TOKENS_V_SQL, body="""
SELECT clause_id, i, CAST(CASE WHEN head = 0 THEN 0 ELSE head END AS INTEGER) AS head0,
       rel = 'HED' AS is_root FROM tokens_v"""))
def q_head_index(spark, sf):
    tv = A.tokens_v(spark, sf)
    # parser convention: 1-based heads, 0 = root
    one_based = F.transform("tokens", lambda t: F.when(t["rel"] == "HED", 0).otherwise(t["head"] + 1))
    df = tv.select("clause_id", F.col("tokens.i").alias("ii"), one_based.alias("h1"))
    df = df.select("clause_id", "ii", OP.head_index("h1").alias("h0"), OP.is_root("h1").alias("root"))
    z = df.select("clause_id", F.explode(F.arrays_zip("ii", "h0", "root")).alias("z"))
    return z.select("clause_id", F.col("z.ii").alias("i"), F.col("z.h0").alias("head0"), F.col("z.root").alias("is_root"))


@register("negated_opinion", O.with_ctes(TOKENS_V_SQL, body=f"""
SELECT clause_id, word || nxt AS keyword FROM (
  SELECT clause_id, word, lead(word) OVER (PARTITION BY clause_id ORDER BY i) AS nxt FROM tokens_v)
WHERE word IN (SELECT unnest({O.arr(FX.NEGATIONS)})) AND nxt IS NOT NULL AND regexp_matches(nxt, {O.q(FX.KEYWORD_SCRIPT)})"""))
def q_negated_opinion(spark, sf):
    tv = A.tokens_v(spark, sf)
    return tv.select("clause_id", F.explode(OP.negated_opinions("tokens", FX.NEGATIONS, FX.KEYWORD_SCRIPT)).alias("keyword"))


# --- CLS-3 / STM-1 ----------------------------------------------------------------------

@register("clause_cascade", O.with_ctes(*TAG, body="SELECT id, CAST(pos AS INTEGER) AS pos, sent AS clause FROM sents"))
def q_clause_cascade(spark, sf):
    from .tagging import clause_cascade
    c = clean(spark, sf)
    lk = lookup(spark)
    cc = c.select("id", F.posexplode(clause_cascade(F.col("evaluated_text"), F.col("irr_f"), TagConfig(lookup=lk))).alias("pos", "clause"))
    return cc.select("id", (F.col("pos") + 1).cast("int").alias("pos"), "clause")


@register("daily_incremental", ORACLES["tag_reviews"])
def q_daily_incremental(spark, sf):
    """Three sets of files arrive, one a batch, each merged into the stored tables."""
    from ..streaming.daily import run_increment
    base = _scratch(spark, "daily")
    raw = A.reviews_v(spark, sf)
    low, high = raw.agg(F.min("id"), F.max("id")).first()
    schema = raw.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    cfg = TagConfig(lookup=lookup(spark))
    for k in range(3):                                              # in the order of ids, each by as many tasks as the table has
        own = F.floor((F.col("id") - F.lit(low or 0)) * 3 / F.lit((high or 0) - (low or 0) + 1))
        raw.where(own == k).write.mode("append").parquet(f"{base}/in")
        run_increment(spark, f"{base}/in", schema, f"{base}/tables", f"{base}/ckpt", cfg)
    t = spark.read.parquet(f"{base}/tables/tagged")
    return t.select("id", "chilid", "view", "view_n", "lable", F.array_join("hed", "、").alias("hed"), "fnum",
                    "irr_f", "dep_code", "arr_code", "fdate", "period_m", "period_w", "airline", *LX.ALL_CODES,
                    "ADO", "emo")


# --- STR-5 / VEC-1 / KEY-2 / CLU-1 ------------------------------------------------------

from ..operators import script as SC  # noqa: E402
from ..operators import vectors as VE  # noqa: E402


@register("script_normalize", O.script_sql("text", FX.CHAR_MAP))
def q_script_normalize(spark, sf):
    mapping = spark.createDataFrame(FX.CHAR_MAP, "from_word STRING, to_word STRING")
    return SC.normalize_script(docs(spark, sf).select("doc_id", "text"), mapping, "text", "normalized").select("doc_id", "normalized")


_WORDS = f"list_filter({O.tokens('text')}, lambda t: regexp_matches(t, {O.q(P.LETTER_TOKEN)}))"
TFIDF_SQL = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
terms AS (SELECT doc_id, unnest(ws) AS term FROM w
          UNION ALL SELECT doc_id, array_to_string(ws[k:k + n - 1], ' ') AS term
          FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM w, (SELECT unnest([2, 3, 4, 5]) AS n))),
tf AS (SELECT doc_id, term, count(*) AS n FROM terms GROUP BY ALL),
nd AS (SELECT count(*) AS n_docs FROM documents),
dfreq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
m AS (SELECT tf.doc_id, tf.term, (1 + ln(tf.n)) * (ln((1 + nd.n_docs) / (1 + d.df)) + 1) AS w
      FROM tf JOIN dfreq d USING (term), nd WHERE d.df >= 3 AND d.df <= floor(0.9 * nd.n_docs))
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS w FROM m"""


@register("tfidf_matrix", TFIDF_SQL)
def q_tfidf_matrix(spark, sf):
    m = VE.tfidf_matrix(docs(spark, sf), ngram_max=5, min_df=3, max_df=0.9)
    return m.select("doc_id", "term", F.round("w", 6).alias("w"))


@register("tfidf_keywords", f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
tf AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS term FROM w) GROUP BY ALL),
nd AS (SELECT count(*) AS n_docs FROM documents),
dfreq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
m AS (SELECT tf.doc_id, tf.term, (1 + ln(tf.n)) * (ln((1 + nd.n_docs) / (1 + d.df)) + 1) AS w FROM tf JOIN dfreq d USING (term), nd),
mn AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS wn FROM m),
r AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY wn DESC, term) AS rank FROM mn)
SELECT doc_id, term, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10 AND term NOT IN (SELECT unnest({O.arr(FX.STOPWORDS)}))""")
def q_tfidf_keywords(spark, sf):
    return VE.tfidf_keywords(docs(spark, sf), FX.STOPWORDS, k=10)


@register("kmeans_clusters")
def q_kmeans_clusters(spark, sf):
    return VE.kmeans_clusters(docs(spark, sf), k=100, seed=1)


# --- SUM-1 / WIN-5 / PIP-1 -----------------------------------------------------------------

from ..operators import summary as SM  # noqa: E402


SUMMARY = (10, SM.STEPS, SM.ALPHA, SM.DECIMALS)


@register("extractive_summary", O.with_ctes(O.summary_ctes("documents", *SUMMARY), body="SELECT doc_id, summary FROM su_abstract"))
def q_extractive_summary(spark, sf):
    return SM.extractive_summary(docs(spark, sf), size=10)


@register("topk_units", O.with_ctes(O.summary_ctes("documents", *SUMMARY), body="SELECT doc_id, CAST(u AS INTEGER) AS u, CAST(rank AS INTEGER) AS rank FROM su_top"))
def q_topk_units(spark, sf):
    rows, long_ = SM.long_texts(docs(spark, sf), 10)
    return rows.join(SM.topk_units(long_, 10), "key").select("doc_id", "u", "rank")


@register("clean_and_summarize", O.with_ctes(O.BASE_CTES, f"""
stripped AS (
  SELECT id AS doc_id, {O.strip_crlf('evaluated_text', '')} AS text FROM reviews_v
  WHERE evaluated_text IS NOT NULL AND regexp_replace(evaluated_text, {O.q(P.OUTER_BLANKS)}, '', 'g') <> ''
    AND {O.keep_letters(f"regexp_replace(evaluated_text, {O.q(P.OUTER_BLANKS)}, '', 'g')")} <> ''),
simple AS MATERIALIZED (SELECT doc_id, normalized AS text FROM ({O.script_sql('text', FX.CHAR_MAP, 'stripped')}))""", O.summary_ctes("simple", *SUMMARY), body=f"""
SELECT doc_id, array_to_string({O.word_set('text')}, ' ') AS words, {O.word_line('text')} AS comment, {O.word_line('summary')} AS abstract
FROM simple JOIN su_abstract USING (doc_id)"""))
def q_clean_and_summarize(spark, sf):
    """PIP-1: blank filter → strip → script → word set / word line → summary → word line of the summary."""
    from ..plans.ingest import drop_blank_text
    d = drop_blank_text(A.reviews_v(spark, sf)).select(F.col("id").alias("doc_id"),
                                                       T.strip_crlf("evaluated_text", "").alias("text"))
    mapping = spark.createDataFrame(FX.CHAR_MAP, "from_word STRING, to_word STRING")
    d = written(SC.normalize_script(d, mapping, "text"), "simple-reviews")
    out = d.join(SM.extractive_summary(d, size=10), "doc_id")
    return out.select("doc_id", F.array_join(T.word_set("text", FX.STOPWORDS), " ").alias("words"),
                      T.word_line("text", FX.STOPWORDS).alias("comment"),
                      T.word_line("summary", FX.STOPWORDS).alias("abstract"))


# --- OPN-2..5 on annotated tokens ---------------------------------------------------------

def _opn_base(spark, sf):
    return OP.prepare(A.tokens_v(spark, sf))


@register("aspect_opinion")
def q_aspect_opinion(spark, sf):
    lk = lookup(spark)
    m = lk.m_all()
    df = _opn_base(spark, sf)
    hits = F.filter("_tok", lambda x: F.array_contains(F.map_keys(m), x["word"]))
    per = F.transform(hits, lambda x: F.named_struct(
        F.lit("i"), x["i"], F.lit("word"), x["word"], F.lit("code"), F.try_element_at(m, x["word"]),
        F.lit("ops"), OP.aspect_opinion(x["i"], x["word"])))
    e = df.select("clause_id", F.explode(per).alias("a"))
    return e.select("clause_id", F.col("a.i").alias("i"), F.col("a.word").alias("word"),
                    F.col("a.code").alias("code"), F.array_join("a.ops", "|").alias("opinions"))


@register("refine_opinion")
def q_refine_opinion(spark, sf):
    df = _opn_base(spark, sf)
    per = F.transform("_tok", lambda x: F.named_struct(
        F.lit("i"), x["i"], F.lit("word"), x["word"],
        F.lit("ops"), OP.refine_opinion(x["word"], FX.NEGATIONS, FX.KEYWORD_SCRIPT)))
    e = df.select("clause_id", F.explode(per).alias("a"))
    return e.select("clause_id", F.col("a.i").alias("i"), F.col("a.word").alias("word"),
                    F.array_join("a.ops", "|").alias("refined"))


@register("refine_predicate")
def q_refine_predicate(spark, sf):
    df = _opn_base(spark, sf)
    return df.select("clause_id", F.array_join(OP.refine_predicate(FX.NEGATIONS, FX.KEYWORD_SCRIPT), "|").alias("opinions"))


@register("clause_opinions")
def q_clause_opinions(spark, sf):
    lk = lookup(spark)
    flags = clean(spark, sf).select("id", "irr_f")
    tv = A.tokens_v(spark, sf).withColumn("id", F.floor(F.col("clause_id") / 10_000_000)).join(flags, "id")
    words = F.col("tokens.word")
    route = AS.routed_map(words, F.array_join(words, ""), F.col("irr_f"), lk, FX.FACILITY_WORDS)
    out = OP.clause_opinions(tv, route, FX.NEGATIONS, FX.KEYWORD_SCRIPT)
    return out.select("clause_id", F.array_join("codes", "、").alias("codes"),
                      F.array_join("opinions", "、").alias("opinions"))


# --- KEY-3 ---------------------------------------------------------------------------------

@register("textrank_keywords")
def q_textrank_keywords(spark, sf):
    from ..operators.textrank import textrank_keywords
    return textrank_keywords(docs(spark, sf), FX.STOPWORDS, span=5, steps=10, k=10)


# --- CLS-6 ---------------------------------------------------------------------------------

_LETTERS = f"lambda t: regexp_matches(t, {O.q(P.LETTER_TOKEN)})"
_SPANS = " UNION ALL ".join(
    f"""SELECT doc_id, p, {n} AS L, sum(m) OVER s AS m, sum(total) OVER s AS total, first_value(f IGNORE NULLS) OVER s AS f, first_value(x IGNORE NULLS) OVER s AS x, count(*) OVER s AS have
    FROM per WINDOW s AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)""" for n in range(1, 5))


@register("fluency_regroup", f"""
WITH RECURSIVE l AS MATERIALIZED (SELECT doc_id, text, {O.split_subclauses('text')} AS units FROM documents),
u AS (SELECT doc_id, unnest(units) AS unit, unnest(range(0, len(units))) AS p FROM l),
ut AS (SELECT doc_id, p, unnest(w) AS b, unnest(range(0, len(w))) AS k FROM (SELECT doc_id, p, list_filter({O.tokens('unit')}, {_LETTERS}) AS w FROM u)),
tok AS MATERIALIZED (SELECT doc_id, p, k, b, lag(b) OVER (PARTITION BY doc_id ORDER BY p, k) AS a FROM ut),
xt AS (SELECT doc_id, unnest(w) AS b, unnest(range(0, len(w))) AS k FROM (SELECT doc_id, list_filter({O.tokens('text')}, {_LETTERS}) AS w FROM l)),
xp AS MATERIALIZED (SELECT b, lag(b) OVER (PARTITION BY doc_id ORDER BY k) AS a FROM xt),
uni AS MATERIALIZED (SELECT b, count(*) AS c FROM xp GROUP BY b),
big AS MATERIALIZED (SELECT a, b, count(*) AS c FROM xp WHERE a IS NOT NULL GROUP BY a, b),
n AS (SELECT sum(c)::DOUBLE AS n, count(*)::DOUBLE AS v FROM uni),
sc AS (SELECT doc_id, p, k, ln((coalesce(ub.c, 0) + 1) / (n + v)) AS f,
              CASE WHEN tok.a IS NULL THEN 0 ELSE ln((coalesce(big.c, 0) + 1) / (coalesce(ua.c, 0) + v)) END AS x
       FROM tok LEFT JOIN uni ub ON ub.b = tok.b LEFT JOIN uni ua ON ua.b = tok.a LEFT JOIN big ON big.a = tok.a AND big.b = tok.b, n),
g AS (SELECT doc_id, p, count(*) AS m, sum(x) AS total, arg_min(f, k) AS f, arg_min(x, k) AS x FROM sc GROUP BY doc_id, p),
per AS MATERIALIZED (SELECT doc_id, p, coalesce(m, 0) AS m, coalesce(total, 0) AS total, f, x FROM u LEFT JOIN g USING (doc_id, p)),
spans AS ({_SPANS}),
best AS MATERIALIZED (
  SELECT doc_id, p, arg_min(L, (CASE WHEN m > 0 THEN round(-(f - x + total) / m, 9) ELSE 'inf'::DOUBLE END, L)) AS L FROM spans WHERE have = L GROUP BY doc_id, p),
chain AS (
  SELECT doc_id, 0::BIGINT AS p, 0 AS seq, L FROM best WHERE p = 0
  UNION ALL SELECT c.doc_id, c.p + c.L, c.seq + 1, b.L FROM chain c JOIN best b ON b.doc_id = c.doc_id AND b.p = c.p + c.L)
SELECT doc_id, CAST(seq AS INTEGER) AS seq, array_to_string(units[p + 1:p + L], '') AS sentence FROM chain JOIN l USING (doc_id)""")
def q_fluency_regroup(spark, sf):
    from ..operators.fluency import fluency_regroup
    return fluency_regroup(docs(spark, sf), window=4)
