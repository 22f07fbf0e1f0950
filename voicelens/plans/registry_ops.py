"""Registered single-operator queries (text, dates, filters, joins, sets, windows).

Each reads whole test tables; the oracle SQL is written independently.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import lexicon as LX
from ..functions import patterns as P
from ..functions import text as T
from ..functions.clauses import split_clauses, split_subclauses
from ..operators import aspects as AS
from ..operators import keywords as KW
from ..operators import reports as RP
from ..operators import summary as SM
from ..session import written
from ..sources import adapters as A
from ..sources import fixtures as FX
from . import oracle as O
from .ingest import carrier_code, drop_blank_text
from .registry import TAG, clean, lookup, register, tagged
from .tagging import SUMMARY_UNITS, TagConfig, opinion_candidates, union_keywords

DOCS = "documents"
STOP = FX.STOPWORDS


def docs(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", "text")


# --- STR ----------------------------------------------------------------------------

@register("keep_letters", f"SELECT doc_id, {O.keep_letters('text')} AS letters FROM documents")
def q_keep_letters(spark, sf):
    return docs(spark, sf).select("doc_id", T.keep_letters("text").alias("letters"))


@register("clean_text", f"SELECT doc_id, {O.clean_text('text')} AS cleaned FROM documents")
def q_clean_text(spark, sf):
    return docs(spark, sf).select("doc_id", T.clean_text("text").alias("cleaned"))


@register("strip_crlf", f"SELECT doc_id, {O.strip_crlf('text')} AS stripped FROM documents")
def q_strip_crlf(spark, sf):
    return docs(spark, sf).select("doc_id", T.strip_crlf("text").alias("stripped"))


@register("escape_quotes", "SELECT doc_id, regexp_replace(text, '([''\"])', '\\\\\\1', 'g') AS escaped FROM documents")
def q_escape_quotes(spark, sf):
    return docs(spark, sf).select("doc_id", T.escape_quotes("text").alias("escaped"))


# --- TOK ----------------------------------------------------------------------------

@register("tokenize", f"SELECT doc_id, array_to_string({O.tokens('text')}, ' ') AS tokens, "
                      f"CAST(len({O.tokens('text')}) AS INTEGER) AS n_tokens FROM documents")
def q_tokenize(spark, sf):
    t = T.tokenize("text")
    return docs(spark, sf).select("doc_id", F.array_join(t, " ").alias("tokens"), F.size(t).alias("n_tokens"))


_stop_sql = O.arr(list(STOP) + [" ", "\t", "\n"])


@register("remove_stopwords", f"SELECT doc_id, array_to_string(list_filter({O.spaced_tokens('text')}, "
                              f"lambda t: NOT list_contains({_stop_sql}, t)), '') AS kept FROM documents")
def q_remove_stopwords(spark, sf):
    return docs(spark, sf).select("doc_id", T.remove_stopwords("text", STOP).alias("kept"))


@register("collapse_repeats", f"SELECT doc_id, {O.collapse_repeats('text')} AS collapsed FROM documents")
def q_collapse_repeats(spark, sf):
    return docs(spark, sf).select("doc_id", T.collapse_repeats("text").alias("collapsed"))


@register("recompose", f"SELECT doc_id, {O.recompose('text')} AS recomposed FROM documents")
def q_recompose(spark, sf):
    return docs(spark, sf).select("doc_id", T.recompose("text", STOP).alias("recomposed"))


_han_words_sql = (f"list_filter({O.spaced_tokens('text')}, lambda t: regexp_matches(t, {O.q(P.HAN_CLASS)}) "
                  f"AND NOT list_contains({_stop_sql}, t))")
_wide_sql = f"regexp_extract_all(text, {O.q(P.WIDE_ASCII_CLASS + '+')})"


@register("word_set", f"""SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(
  CASE WHEN regexp_matches(text, {O.q(P.HAN_CLASS)}) THEN list_concat({_han_words_sql}, {_wide_sql})
       ELSE string_split(text, ' ') END, lambda t: t <> ' '))), '|') AS words FROM documents""")
def q_word_set(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_join(T.word_set("text", STOP), "|").alias("words"))


@register("word_line", f"""SELECT doc_id, CASE WHEN regexp_matches(text, {O.q(P.HAN_CLASS)})
  THEN array_to_string(list_concat({_han_words_sql}, {_wide_sql}), ' ') ELSE text END AS line FROM documents""")
def q_word_line(spark, sf):
    return docs(spark, sf).select("doc_id", T.word_line("text", STOP).alias("line"))


# --- CLS-1/2 --------------------------------------------------------------------------

@register("split_clauses", f"""SELECT doc_id, CAST(pos AS INTEGER) AS pos, clause FROM (
  SELECT doc_id, unnest(l) AS clause, unnest(range(0, len(l))) AS pos
  FROM (SELECT doc_id, {O.split_clauses('text')} AS l FROM documents))""")
def q_split_clauses(spark, sf):
    return docs(spark, sf).select("doc_id", F.posexplode(split_clauses(F.col("text"))).alias("pos", "clause"))


@register("split_subclauses", f"""SELECT doc_id, CAST(pos AS INTEGER) AS pos, clause FROM (
  SELECT doc_id, unnest(l) AS clause, unnest(range(0, len(l))) AS pos
  FROM (SELECT doc_id, {O.split_subclauses('text')} AS l FROM documents))""")
def q_split_subclauses(spark, sf):
    return docs(spark, sf).select("doc_id", F.posexplode(split_subclauses(F.col("text"))).alias("pos", "clause"))


# --- DTE ----------------------------------------------------------------------------

@register("period_keys", O.with_ctes(O.BASE_CTES, body="""
SELECT id, fdate, CAST(strftime(strptime(fdate, '%Y%m%d'), '%Y%m') AS INTEGER) AS period_m,
       CAST(strftime(strptime(fdate, '%Y%m%d'), '%G0%V') AS INTEGER) AS period_w FROM reviews_v"""))
def q_period_keys(spark, sf):
    r = A.reviews_v(spark, sf)
    m, w = C.period_keys(F.col("fdate"))
    return r.select("id", "fdate", m.alias("period_m"), w.alias("period_w"))


@register("period_bounds", O.with_ctes(O.BASE_CTES, body="""
SELECT period, strftime(first_day, '%Y%m%d') AS first_day, strftime(last_day, '%Y%m%d') AS last_day FROM (
  SELECT period,
         CASE WHEN length(CAST(period AS VARCHAR)) = 7
              THEN date_trunc('week', make_date(CAST(period // 1000 AS INTEGER), 1, 4)) + INTERVAL (7 * ((period % 1000) - 1)) DAY
              ELSE make_date(CAST(period // 100 AS INTEGER), CAST(period % 100 AS INTEGER), 1) END AS first_day,
         CASE WHEN length(CAST(period AS VARCHAR)) = 7
              THEN date_trunc('week', make_date(CAST(period // 1000 AS INTEGER), 1, 4)) + INTERVAL (7 * ((period % 1000) - 1) + 6) DAY
              ELSE last_day(make_date(CAST(period // 100 AS INTEGER), CAST(period % 100 AS INTEGER), 1)) END AS last_day
  FROM (SELECT DISTINCT period_m AS period FROM clean UNION SELECT DISTINCT period_w FROM clean))"""))
def q_period_bounds(spark, sf):
    c = clean(spark, sf)
    p = c.select(F.col("period_m").alias("period")).union(c.select(F.col("period_w").alias("period"))).distinct()
    first, last = C.period_bounds(F.col("period"))
    return p.select("period", C.day_text(first).alias("first_day"), C.day_text(last).alias("last_day"))


@register("irregular_flag", O.with_ctes(O.BASE_CTES, body="""
SELECT id,
  CAST(CASE WHEN arr_gap IS NULL THEN 0 WHEN -arr_gap > 30 OR coalesce(dep_gap > 30, FALSE) THEN 0 ELSE 1 END AS INTEGER) AS irr_reference,
  CAST(CASE WHEN arr_gap IS NULL THEN 0 WHEN arr_gap > 30 OR coalesce(dep_gap > 30, FALSE) THEN 0 ELSE 1 END AS INTEGER) AS irr_late
FROM reviews_v"""))
def q_irregular_flag(spark, sf):
    r = A.reviews_v(spark, sf)
    args = ("fdplan", "fdactual", "faplan", "faactual")
    return r.select("id", C.irregular_flag(*args, arrival_gap="reference").alias("irr_reference"),
                    C.irregular_flag(*args, arrival_gap="late").alias("irr_late"))


@register("epoch_to_text", "SELECT doc_id, strftime(make_timestamp(CAST((1500000000 + doc_id * 3607) * 1000000 AS BIGINT)), "
                           "'%Y-%m-%d %H:%M:%S') AS ts_text FROM documents")
def q_epoch_to_text(spark, sf):
    return docs(spark, sf).select("doc_id", C.epoch_to_text(F.lit(1500000000) + F.col("doc_id") * 3607).alias("ts_text"))


@register("due_periods", O.with_ctes(O.BASE_CTES, body="""
SELECT fdate, array_to_string(CASE
  WHEN day(d) = 1 AND isodow(d) = 1 THEN [strftime(d - INTERVAL 1 MONTH, '%Y%m'), strftime(d - INTERVAL 7 DAY, '%G0%V')]
  WHEN day(d) = 1 THEN [strftime(d - INTERVAL 1 MONTH, '%Y%m')]
  WHEN isodow(d) = 1 THEN [strftime(d - INTERVAL 7 DAY, '%G0%V')]
  ELSE []::VARCHAR[] END, ',') AS due
FROM (SELECT DISTINCT fdate, CAST(strptime(fdate, '%Y%m%d') AS DATE) AS d FROM reviews_v)"""))
def q_due_periods(spark, sf):
    r = A.reviews_v(spark, sf).select("fdate").distinct()
    d = C.parse_day(F.col("fdate"))
    return r.select("fdate", F.array_join(C.due_periods(d).cast("array<string>"), ",").alias("due"))


@register("valid_period", O.with_ctes(O.BASE_CTES, body="""
SELECT period, (period BETWEEN 202401 AND 202401) OR (period BETWEEN 2024001 AND 2024006) AS valid
FROM (SELECT DISTINCT period_m AS period FROM clean UNION SELECT DISTINCT period_w FROM clean)"""))
def q_valid_period(spark, sf):
    c = clean(spark, sf)
    p = c.select(F.col("period_m").alias("period")).union(c.select(F.col("period_w").alias("period"))).distinct()
    return p.select("period", C.valid_period(F.col("period"), F.lit("2024-02-15").cast("date")).alias("valid"))


# --- PRJ / FLT ------------------------------------------------------------------------

@register("carrier_code", O.with_ctes(O.BASE_CTES, body="SELECT id, substr(fnum, 1, 2) AS airline FROM reviews_v"))
def q_carrier_code(spark, sf):
    return A.reviews_v(spark, sf).select("id", carrier_code("fnum").alias("airline"))


@register("surrogate_id", O.with_ctes(O.BASE_CTES, body="SELECT id, CAST(row_number() OVER (ORDER BY id) - 1 AS BIGINT) AS idx FROM clean"))
def q_surrogate_id(spark, sf):
    from ..operators.ids import dense_index
    return dense_index(clean(spark, sf).select("id"), "id", "idx")


@register("period_filter", O.with_ctes(O.BASE_CTES, body="SELECT id, fdate FROM clean WHERE fdate BETWEEN '20240108' AND '20240114'"))
def q_period_filter(spark, sf):
    first, last = C.period_bounds(F.lit(2024002))
    return clean(spark, sf).filter(F.col("fdate").between(C.day_text(first), C.day_text(last))).select("id", "fdate")


@register("drop_blank_text", O.with_ctes(O.BASE_CTES, body=f"""
SELECT id FROM reviews_v WHERE evaluated_text IS NOT NULL
  AND regexp_replace(evaluated_text, {O.q(P.OUTER_BLANKS)}, '', 'g') <> ''
  AND {O.keep_letters(f"regexp_replace(evaluated_text, {O.q(P.OUTER_BLANKS)}, '', 'g')")} <> ''"""))
def q_drop_blank_text(spark, sf):
    return drop_blank_text(A.reviews_v(spark, sf)).select("id")


@register("mask_b9", O.with_ctes(*TAG, body="SELECT id, chilid, irr_f, CASE WHEN irr_f = 1 THEN 0 ELSE B9 END AS B9 FROM tagged"))
def q_mask_b9(spark, sf):
    t = tagged(spark, sf)
    return t.select("id", "chilid", "irr_f", F.when(F.col("irr_f") == 1, 0).otherwise(F.col("B9")).alias("B9"))


@register("drop_unlabelled", O.with_ctes(*TAG, body="SELECT id, chilid, lable FROM tagged WHERE lable IS NOT NULL AND trim(lable) NOT IN ('', '~') AND view_n IS NOT NULL"))
def q_drop_unlabelled(spark, sf):
    t = tagged(spark, sf)
    return t.filter(F.col("lable").isNotNull() & ~F.trim("lable").isin("", "~") & F.col("view_n").isNotNull()).select(
        "id", "chilid", "lable")


@register("scope_filter", O.with_ctes(*TAG, body="""
SELECT 'airline' AS scope, id, chilid FROM tagged WHERE ADO IN ('B', 'BJ') AND period_m = 202401
UNION ALL SELECT 'airport', id, chilid FROM tagged WHERE ADO IN ('J', 'BJ') AND period_m = 202401"""))
def q_scope_filter(spark, sf):
    t = tagged(spark, sf).filter(F.col("period_m") == 202401)
    a = t.filter(F.col("ADO").isin("B", "BJ")).select(F.lit("airline").alias("scope"), "id", "chilid")
    j = t.filter(F.col("ADO").isin("J", "BJ")).select(F.lit("airport").alias("scope"), "id", "chilid")
    return a.unionByName(j)


@register("aspect_context_filter", O.with_ctes(O.BASE_CTES, O.routed_cte("rc", "clean", ["id"], "evaluated_text"), body=f"""
SELECT c.id, (list_has_any({O.tokens('c.evaluated_text')}, {O.arr(FX.FACILITY_WORDS)}) OR contains(c.evaluated_text, {O.q(LX.AIRPORT_SUBSTRING)})) AS airport_ctx,
       coalesce(array_to_string(rc.codes, '、'), '') AS codes
FROM clean c LEFT JOIN rc ON rc.id = c.id"""))
def q_aspect_context_filter(spark, sf):
    c = clean(spark, sf)
    lk = lookup(spark)
    toks = T.tokenize("evaluated_text")
    return c.select("id", AS.airport_context(toks, F.col("evaluated_text"), FX.FACILITY_WORDS).alias("airport_ctx"),
                    F.array_join(AS.routed_codes(toks, F.col("evaluated_text"), F.col("irr_f"), lk, FX.FACILITY_WORDS), "、").alias("codes"))


# --- JON ----------------------------------------------------------------------------

@register("join_aspect_keywords", O.with_ctes(O.BASE_CTES, body=f"""
SELECT DISTINCT d.doc_id, d.keyword, f.code FROM (SELECT doc_id, unnest({O.tokens('text')}) AS keyword FROM documents) d
JOIN (SELECT keyword, arg_min(code, line_no) AS code FROM tax GROUP BY keyword) f ON f.keyword = d.keyword"""))
def q_join_aspect_keywords(spark, sf):
    first = AS.first_keyword_rows(A.taxonomy_v(spark)).select("keyword", "code")
    toks = docs(spark, sf).select("doc_id", F.explode(F.array_distinct(T.tokenize("text"))).alias("keyword"))
    # Spark broadcasts the taxonomy when its size allows, otherwise the join shuffles
    return toks.join(first, "keyword").select("doc_id", "keyword", "code")


@register("first_match", "SELECT keyword, arg_min(code, line_no) AS code, CAST(min(line_no) AS INTEGER) AS line_no FROM "
          + O.taxonomy_values() + " t WHERE keyword IN (SELECT DISTINCT unnest(" + O.tokens("text") + ") FROM documents) GROUP BY keyword")
def q_first_match(spark, sf):
    first = AS.first_keyword_rows(A.taxonomy_v(spark)).select("keyword", "code", "line_no")
    seen = docs(spark, sf).select(F.explode(F.array_distinct(T.tokenize("text"))).alias("keyword")).distinct()
    return first.join(seen, "keyword", "left_semi")


@register("anti_stopwords", f"""SELECT doc_id, CAST(pos AS INTEGER) AS pos, token FROM (
  SELECT doc_id, unnest({O.tokens('text')}) AS token, unnest(range(0, len({O.tokens('text')}))) AS pos FROM documents)
WHERE token NOT IN (SELECT unnest({O.arr(STOP)}))""")
def q_anti_stopwords(spark, sf):
    toks = docs(spark, sf).select("doc_id", F.posexplode(T.tokenize("text")).alias("pos", "token"))
    stop = A.wordlist(spark, STOP, "token")
    return toks.join(stop, "token", "left_anti").select("doc_id", "pos", "token")


@register("join_clause_review", O.with_ctes(*TAG, O.keyword_rows_cte(), body="""
SELECT k.id, k.chilid, k.seq, k.keyword, c.fnum, c.irr_f, c.airline FROM keywords k LEFT JOIN clean c ON c.id = k.id"""))
def q_join_clause_review(spark, sf):
    kw = KW.explode_keywords(tagged(spark, sf))
    rv = clean(spark, sf).select("id", "fnum", "irr_f", "airline")
    return kw.join(rv, "id", "left").select("id", "chilid", "seq", "keyword", "fnum", "irr_f", "airline")


@register("join_clause_keywords", O.with_ctes(*TAG, O.keyword_rows_cte(), body="""
SELECT t.id, t.chilid, t.emo, CAST(count(k.keyword) AS BIGINT) AS n_keywords
FROM (SELECT DISTINCT id, chilid, emo FROM tagged) t LEFT JOIN keywords k ON k.id = t.id AND k.chilid = t.chilid
GROUP BY ALL"""))
def q_join_clause_keywords(spark, sf):
    t = written(tagged(spark, sf).select("id", "chilid", "emo", "hed"), "tagged")  # tagged once for both sides
    kw = KW.explode_keywords(t)
    pairs = t.select("id", "chilid", "emo").distinct()
    return (pairs.join(kw, ["id", "chilid"], "left").groupBy("id", "chilid", "emo")
            .agg(F.count("keyword").alias("n_keywords")))


@register("join_airport_role", O.with_ctes(*TAG, body="""
SELECT DISTINCT id, chilid, unnest(list_distinct([dep_code, arr_code])) AS airport FROM tagged WHERE ADO IN ('J', 'BJ')"""))
def q_join_airport_role(spark, sf):
    t = tagged(spark, sf).filter(F.col("ADO").isin("J", "BJ"))
    return t.select("id", "chilid", F.explode(F.array_distinct(F.array("dep_code", "arr_code"))).alias("airport"))


TOKENS_V_SQL = """
tokens_v AS MATERIALIZED (
  SELECT clause_id, i, word,
         CASE WHEN i = h THEN 'v' ELSE (['a','d','c','b','n'])[length(word) % 5 + 1] END AS pos,
         CASE WHEN i = h THEN 'HED' WHEN i < h THEN (['SBV','ADV','ATT','COO'])[i % 4 + 1]
              WHEN i % 2 = 0 THEN 'VOB' ELSE 'ADV' END AS rel,
         CAST(CASE WHEN i = h THEN 0 WHEN i < h AND i % 4 = 2 THEN i + 1 ELSE h END AS INTEGER) AS head
  FROM (SELECT clause_id, unnest(w) AS word, CAST(unnest(range(0, len(w))) AS INTEGER) AS i, CAST(len(w) // 2 AS INTEGER) AS h
        FROM (SELECT doc_id * 10000000 + n AS clause_id, regexp_extract_all(clause, '[a-zà-öø-ÿß]+') AS w
              FROM (SELECT doc_id, unnest(c) AS clause, unnest(range(0, len(c))) AS n
                    FROM (SELECT doc_id, regexp_extract_all(lower(text), '[^.,!?;]+') AS c FROM documents)))
        WHERE len(w) > 0))
"""


@register("governor_join", O.with_ctes(TOKENS_V_SQL, body="""
SELECT c.clause_id, c.i, c.word, c.rel, p.word AS head_word FROM tokens_v c
LEFT JOIN tokens_v p ON p.clause_id = c.clause_id AND p.i = c.head"""))
def q_governor_join(spark, sf):
    tv = A.tokens_v(spark, sf)                                      # joined by clause, a token's number is its place
    heads = tv.select("clause_id", F.col("tokens.word").alias("words"))
    rows = tv.join(heads, "clause_id", "left").select("clause_id", "words", F.explode("tokens").alias("t"))
    found = rows.where(F.col("words").isNull() | (F.col("t.head") < F.size("words")))
    return found.select("clause_id", "t.i", "t.word", "t.rel", F.try_element_at("words", F.col("t.head") + 1).alias("head_word"))


# --- AGG aliases on the tagged table --------------------------------------------------

@register("target_object", O.with_ctes(*TAG, body="SELECT id, chilid, lable, ADO FROM tagged"))
def q_target_object(spark, sf):
    return tagged(spark, sf).select("id", "chilid", "lable", "ADO")


@register("onehot_aspects", O.with_ctes(*TAG, body="SELECT id, chilid, " + ", ".join(LX.ALL_CODES) + " FROM tagged"))
def q_onehot_aspects(spark, sf):
    return tagged(spark, sf).select("id", "chilid", *LX.ALL_CODES)


@register("merge_same_label", O.with_ctes(*TAG, body="SELECT id, chilid, lable, view, view_n FROM tagged"))
def q_merge_same_label(spark, sf):
    return tagged(spark, sf).select("id", "chilid", "lable", "view", "view_n")


@register("explode_labels", O.with_ctes(*TAG, body="""
SELECT id, chilid, CAST(pos AS INTEGER) AS pos, code FROM (
  SELECT id, chilid, unnest(string_split(lable, '、')) AS code, unnest(range(0, len(string_split(lable, '、')))) AS pos FROM tagged)"""))
def q_explode_labels(spark, sf):
    t = tagged(spark, sf)
    return t.select("id", "chilid", F.posexplode(T.split_labels("lable")).alias("pos", "code"))


@register("clause_number", O.with_ctes(*TAG, body="SELECT id, chilid, view FROM tagged"))
def q_clause_number(spark, sf):
    return tagged(spark, sf).select("id", "chilid", "view")


@register("label_clause", O.with_ctes(*TAG, body="SELECT id, chilid, lable FROM tagged"))
def q_label_clause(spark, sf):
    return tagged(spark, sf).select("id", "chilid", "lable")


@register("project_contract", O.with_ctes(*TAG, body="SELECT id, chilid, view, view_n, lable, array_to_string(hed, '、') AS hed, fnum, irr_f, "
          "user_cabin AS fspace, dep_code, arr_code, fdate, period_m, period_w, airline, "
          + ", ".join(LX.ALL_CODES[:9] + LX.AIRPORT_CODES + ["JGP"]) + ", ADO FROM tagged"))
def q_project_contract(spark, sf):
    from .tagging import tagged_contract
    return tagged_contract(tagged(spark, sf)).drop("comment")


@register("rank_keywords", "SELECT scope, void, period_kind, period, status, code, emo, keyword, rank FROM ("
          + __import__("voicelens.plans.registry", fromlist=["ORACLES"]).ORACLES["keyword_counts"] + ")")
def q_rank_keywords(spark, sf):
    return RP.keyword_counts(RP.report_units(tagged(spark, sf))).select(
        *RP.REPORT_KEYS, "status", "code", "emo", "keyword", "rank")


@register("keyword_seq", O.with_ctes(*TAG, O.keyword_rows_cte(), body="SELECT id, chilid, seq, keyword FROM keywords"))
def q_keyword_seq(spark, sf):
    return KW.explode_keywords(tagged(spark, sf)).select("id", "chilid", "seq", "keyword")


@register("sort_periods", O.with_ctes(*TAG, body="""
SELECT DISTINCT 'm' AS period_kind, period_m AS period FROM tagged UNION SELECT DISTINCT 'w', period_w FROM tagged"""))
def q_sort_periods(spark, sf):
    return RP.distinct_periods(tagged(spark, sf))


@register("topk_terms", f"""SELECT doc_id, term, n, CAST(rank AS INTEGER) AS rank FROM (
  SELECT doc_id, term, CAST(count(*) AS BIGINT) AS n,
         row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, term) AS rank
  FROM (SELECT doc_id, unnest({O.tokens('text')}) AS term FROM documents)
  WHERE regexp_matches(term, {O.q(P.LETTER_TOKEN)}) AND term NOT IN (SELECT unnest({O.arr(STOP)}))
  GROUP BY doc_id, term) WHERE rank <= 10""")
def q_topk_terms(spark, sf):
    skip = T.not_in(STOP)
    terms = docs(spark, sf).select("doc_id", F.explode(F.filter(T.tokenize("text"),
                                   lambda t: t.rlike(P.jvm(P.LETTER_TOKEN)) & skip(t))).alias("term"))
    counts = terms.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n"))
    return KW.rank_within(counts, ["doc_id"], "n", "term", k=10)


# --- SET ----------------------------------------------------------------------------

@register("union_all_frames", O.with_ctes(O.BASE_CTES, body="SELECT id, airline FROM clean WHERE airline = 'EN' UNION ALL SELECT id, airline FROM clean WHERE airline <> 'EN'"))
def q_union_all_frames(spark, sf):
    c = clean(spark, sf).select("id", "airline")
    return c.filter(F.col("airline") == "EN").unionByName(c.filter(F.col("airline") != "EN"))


@register("airport_universe", O.with_ctes(O.BASE_CTES, body="SELECT dep_code AS airport FROM clean UNION SELECT arr_code FROM clean"))
def q_airport_universe(spark, sf):
    c = clean(spark, sf)
    return c.select(F.col("dep_code").alias("airport")).union(c.select(F.col("arr_code").alias("airport"))).distinct()


@register("intersect_words", f"""SELECT doc_id,
  array_to_string(list_sort(list_intersect({O.tokens('text')}, {O.arr(FX.FACILITY_WORDS + FX.NEGATIONS)})), '|') AS shared
FROM documents""")
def q_intersect_words(spark, sf):
    shared = F.array_sort(F.array_intersect(T.tokenize("text"), T._array_lit(FX.FACILITY_WORDS + FX.NEGATIONS)))
    return docs(spark, sf).select("doc_id", F.array_join(shared, "|").alias("shared"))


@register("union_keywords", O.with_ctes(O.BASE_CTES, O.tagging_ctes(summary=(SUMMARY_UNITS, SM.STEPS, SM.ALPHA, SM.DECIMALS)),
                                        body="SELECT id, chilid, array_to_string(hed, '|') AS opinions FROM tagged"))
def q_union_keywords(spark, sf):
    return union_keywords(clean(spark, sf), TagConfig(lookup=lookup(spark)))
