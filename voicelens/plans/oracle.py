"""DuckDB oracle SQL for the registered queries.

The oracle is written relationally (unnest, joins, GROUP BY, window
functions) where the Spark side works in-row with higher-order functions,
so the two are independent implementations of the same semantics.  The
same regular expressions (``functions.patterns``) are used on both sides.
"""

from __future__ import annotations

from ..functions import lexicon as LX
from ..functions import patterns as P
from ..sources import fixtures as FX


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def arr(words) -> str:
    words = list(dict.fromkeys(words))
    return "[" + ", ".join(q(w) for w in words) + "]::VARCHAR[]"


# --- scalar / list expressions ------------------------------------------------

def tokens(x: str, lower: bool = True) -> str:
    src = f"lower({x})" if lower else x
    return f"regexp_extract_all({src}, {q(P.TOKEN_PATTERN)})"


def spaced_tokens(x: str) -> str:
    return f"regexp_extract_all({x}, {q(P.SPACED_TOKEN_PATTERN)})"


def collapse(lst: str) -> str:
    """Drop elements equal to their predecessor (zip with the shifted list; no capture)."""
    pairs = f"list_zip({lst}, list_prepend(NULL, ({lst})[1:len({lst}) - 1]))"
    kept = f"list_transform(list_filter({pairs}, lambda p: p[2] IS NULL OR p[1] <> p[2]), lambda p: p[1])"
    return f"list_filter({kept}, lambda x: x IS NOT NULL)"


def keep_letters(x: str) -> str:
    return f"regexp_replace({x}, {q('[^' + P.LETTER_CLASS[1:] + '+')}, '', 'g')"


def clean_text(x: str) -> str:
    return f"regexp_replace({x}, {q(P.CLEAN_RUN)}, ' ', 'g')"


def strip_crlf(x: str, repl: str = "。") -> str:
    return f"replace(regexp_replace({x}, {q(P.OUTER_BLANKS)}, '', 'g'), chr(13) || chr(10), {q(repl)})"


def collapse_repeats(x: str) -> str:
    return f"array_to_string({collapse(spaced_tokens(x))}, '')"


def emit(x: str, delims: str) -> str:
    cls = P.delim_class(delims)
    return (f"list_filter(regexp_extract_all({x}, {q(P.chunk_pattern(delims))}), lambda c: "
            f"NOT regexp_matches(c, {q(cls + '$')}) OR (length(c) > 1 AND regexp_matches(c, {q(P.LETTER_CLASS)})))")


def script_sql(x: str, rows, source: str = "documents") -> str:
    """STR-5 over ``source`` (doc_id and the text ``x``): every cut of each distinct run of mapped characters is enumerated; the one of fewest units, then of shortest first units, counts."""
    pairs = dict(sorted(rows, reverse=True))
    table = ", ".join(f"({q(a)}, {q(b)})" for a, b in pairs.items())
    inside = "".join(sorted({c for a in pairs for c in a}))
    return f"""WITH RECURSIVE map(a, b) AS (VALUES {table}),
toks AS (SELECT doc_id, unnest(t) AS t, unnest(range(0, len(t))) AS i FROM (SELECT doc_id, regexp_extract_all({x}, {q(f"[{inside}]+|[^{inside}]+")}) AS t FROM {source})),
runs AS (SELECT DISTINCT t AS run FROM toks WHERE regexp_matches(t, {q(f"^[{inside}]")})),
cuts AS (
  SELECT run, 1 AS place, []::INTEGER[] AS steps, '' AS out FROM runs
  UNION ALL
  SELECT run, CAST(place + n AS INTEGER), list_append(steps, CAST(n AS INTEGER)), out || w
  FROM (SELECT c.*, m.b AS w, length(m.a) AS n FROM cuts c JOIN map m ON substr(c.run, c.place, length(m.a)) = m.a
        UNION ALL SELECT c.*, substr(c.run, c.place, 1), 1 FROM cuts c WHERE c.place <= length(c.run) AND substr(c.run, c.place, 1) NOT IN (SELECT a FROM map))),
best AS (SELECT run, arg_min(out, (len(steps), steps)) AS converted FROM cuts WHERE place = length(run) + 1 GROUP BY run)
SELECT doc_id, coalesce(string_agg(coalesce(converted, t), '' ORDER BY i), '') AS normalized
FROM {source} LEFT JOIN toks USING (doc_id) LEFT JOIN best ON best.run = toks.t GROUP BY doc_id"""


def split_clauses(x: str) -> str:
    s = f"regexp_replace({clean_text(x)}, {q(P.SOFT_BREAKS)}, ';', 'g')"
    return (f"CASE WHEN regexp_matches({s}, {q(P.ENDER_CLASS)}) THEN {emit(s, P.CLAUSE_DELIMS_ENDERS)} "
            f"WHEN regexp_matches({s}, {q(P.COMMA_CLASS)}) THEN {emit(s, P.CLAUSE_DELIMS_COMMAS)} "
            f"ELSE {emit(s, P.CLAUSE_DELIMS_BLANK)} END")


def split_subclauses(x: str) -> str:
    return emit(x, P.SUBCLAUSE_DELIMS)


def recompose(x: str, stopwords=FX.STOPWORDS) -> str:
    stop = arr(list(stopwords) + [" ", "\t", "\n"])
    kept = (f"list_filter({spaced_tokens(x)}, lambda t: regexp_matches(t, {q(P.RECOMPOSE_KEEP)}) "
            f"AND NOT list_contains({stop}, t))")
    pieces = (f"list_filter(string_split({x}, ' '), lambda t: regexp_matches(t, {q(P.WIDE_ASCII_CLASS)}) "
              f"AND NOT list_contains({stop}, t))")
    return (f"CASE WHEN regexp_matches({x}, {q(P.RECOMPOSE_KEEP)}) THEN array_to_string({collapse(kept)}, '') "
            f"ELSE array_to_string({collapse(pieces)}, ' ') END")


def _han_words(x: str, stopwords) -> str:
    kept = f"list_filter({spaced_tokens(x)}, lambda t: regexp_matches(t, {q(P.HAN_CLASS)}) AND NOT list_contains({arr([*stopwords, ' ', chr(9), chr(10)])}, t))"
    return f"list_concat({kept}, regexp_extract_all({x}, {q(P.WIDE_ASCII_CLASS + '+')}))"


def word_set(x: str, stopwords=FX.STOPWORDS) -> str:
    return (f"list_sort(list_distinct(list_filter(CASE WHEN regexp_matches({x}, {q(P.HAN_CLASS)}) THEN {_han_words(x, stopwords)} "
            f"ELSE string_split({x}, ' ') END, lambda t: t <> ' ')))")


def word_line(x: str, stopwords=FX.STOPWORDS) -> str:
    return f"CASE WHEN regexp_matches({x}, {q(P.HAN_CLASS)}) THEN array_to_string({_han_words(x, stopwords)}, ' ') ELSE {x} END"


def summary_ctes(source: str, size: int, steps: int, alpha: float, decimals: int) -> str:
    """SUM-1 over ``source`` (doc_id, text): joins and grouped sums, a pair for each rank step.

    ``su_top`` has the top units (doc_id, u, unit, rank) of texts with more than ``size`` units, ``su_n`` the number of units.
    """
    even = f"({alpha}::DOUBLE * loose * xl + (1 - {alpha}::DOUBLE)) / n"
    rank_steps = "".join(f""",
su_z{k} AS MATERIALIZED (SELECT doc_id, t, sum(w * m.r * x / d) AS z FROM su_m m JOIN su_x{k - 1} USING (doc_id, unit) WHERE d > 0 GROUP BY ALL),
su_x{k} AS MATERIALIZED (
  SELECT doc_id, unit, u, n, r, d, loose, {alpha}::DOUBLE * coalesce(s, 0) + {even} AS x, {even} AS xl
  FROM su_x{k - 1} LEFT JOIN (SELECT doc_id, unit, sum(w * z) AS s FROM su_m JOIN su_z{k} USING (doc_id, t) GROUP BY ALL) USING (doc_id, unit))""" for k in range(1, steps + 1))
    return f"""
su_n AS (SELECT doc_id, text, len({split_subclauses('text')}) AS n FROM {source}),
su_u AS MATERIALIZED (
  SELECT doc_id, u, han, {collapse_repeats('c')} AS unit
  FROM (SELECT doc_id, regexp_matches(text, {q(P.HAN_CLASS)}) AS han, unnest(l) AS c, unnest(range(0, len(l))) AS u
        FROM (SELECT doc_id, text, {split_subclauses('text')} AS l FROM {source}) WHERE len(l) > {size})),
su_d AS MATERIALIZED (SELECT doc_id, han, unit, count(*) AS r, min(u) AS u, sum(count(*)) OVER (PARTITION BY doc_id) AS n FROM su_u GROUP BY doc_id, han, unit),
su_t AS (
  SELECT doc_id, unit, r, n, han, t, count(*) AS tf FROM (
    SELECT doc_id, unit, r, n, han, unnest(string_split(lower(unit), '')) AS t FROM su_d
    UNION ALL SELECT doc_id, unit, r, n, han, substr(lower(unit), i, 2) FROM (SELECT *, unnest(range(1, length(unit))) AS i FROM su_d WHERE han))
  WHERE t <> '' GROUP BY ALL),
su_f AS (SELECT doc_id, t, sum(r) AS df FROM su_t GROUP BY ALL),
su_i AS (SELECT doc_id, unit, r, t, tf, ln((1 + n) / (1 + df)) + 1 AS idf FROM su_t JOIN su_f USING (doc_id, t) WHERE han OR df <= 0.9::DOUBLE * n),
su_w AS (SELECT doc_id, unit, r, t, idf, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id, unit)) * idf AS w FROM su_i),
su_m AS MATERIALIZED (SELECT doc_id, unit, r, t, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id, unit)) AS w FROM su_w),
su_c AS (SELECT doc_id, t, sum(w * r) AS c FROM su_m GROUP BY ALL),
su_g AS (SELECT doc_id, unit, sum(w * c) AS d FROM su_m JOIN su_c USING (doc_id, t) GROUP BY ALL),
su_x0 AS MATERIALIZED (
  SELECT doc_id, unit, u, n, r, coalesce(d, 0) AS d, coalesce(sum(r) FILTER (coalesce(d, 0) <= 0) OVER (PARTITION BY doc_id), 0) AS loose, 1 / n AS x, 1 / n AS xl
  FROM su_d LEFT JOIN su_g USING (doc_id, unit)){rank_steps},
su_best AS (SELECT doc_id, unit, round(x, {decimals}) AS score FROM su_x{steps} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(x, {decimals}) DESC, u) <= {size}),
su_top AS (SELECT doc_id, u, unit, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, u) AS rank FROM su_u JOIN su_best USING (doc_id, unit) QUALIFY rank <= {size}),
su_s AS (SELECT doc_id, string_agg(unit, '/' ORDER BY rank) AS summary FROM su_top GROUP BY doc_id),
su_abstract AS (SELECT doc_id, CASE WHEN n <= {size} THEN text ELSE summary END AS summary FROM su_n LEFT JOIN su_s USING (doc_id))"""


def ordered_distinct(lst: str) -> str:
    """Distinct elements in first-seen order (``lst`` should be a column: it is captured)."""
    z = f"list_zip({lst}, range(1, len({lst}) + 1))"
    return f"list_transform(list_filter({z}, lambda p: list_position({lst}, p[1]) = p[2]), lambda p: p[1])"


# --- CTE building blocks -----------------------------------------------------

def taxonomy_values(rows=FX.TAXONOMY_ROWS) -> str:
    vals = ", ".join(f"({i + 1}, {q(k.lower())}, {q(c)})" for i, (k, c) in enumerate(rows))
    return f"(SELECT * FROM (VALUES {vals}) t(line_no, keyword, code))"


def _first(where: str) -> str:
    return f"(SELECT keyword, arg_min(code, line_no) AS code FROM tax WHERE {where} GROUP BY keyword)"


AIR = ", ".join(q(c) for c in LX.AIRPORT_CONTEXT_CODES)
B9 = q(LX.IRREGULAR_CODE)

BASE_CTES = f"""
tax AS {taxonomy_values()},
m_count AS (SELECT keyword, code, 0 AS reg FROM {_first('TRUE')} a
            UNION ALL SELECT keyword, code, 1 AS reg FROM {_first(f'code <> {B9}')} b),
m_route AS (SELECT keyword, code, 1 AS airport, -1 AS reg FROM {_first(f'code IN ({AIR})')} a
            UNION ALL SELECT keyword, code, 0, 0 FROM {_first(f'code NOT IN ({AIR})')} b
            UNION ALL SELECT keyword, code, 0, 1 FROM {_first(f'code NOT IN ({AIR}, {B9})')} c),
reviews_v AS (
  SELECT d.doc_id AS id,
         upper(d.lang) || CAST(100 + d.doc_id % 50 AS VARCHAR) AS fnum,
         (['F','C','Y'])[CAST(d.doc_id % 3 AS INTEGER) + 1] AS user_cabin,
         strftime(DATE '2024-01-01' + CAST(d.doc_id % 60 AS INTEGER), '%Y%m%d') AS fdate,
         d.text AS evaluated_text, d.source AS fdep_code,
         'src' || CAST((d.doc_id * 7) % 20 AS VARCHAR) AS farr_code,
         strftime(CAST(DATE '2024-01-01' + CAST(d.doc_id % 60 AS INTEGER) AS TIMESTAMP) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS fdplan,
         strftime(CAST(DATE '2024-01-01' + CAST(d.doc_id % 60 AS INTEGER) AS TIMESTAMP) + INTERVAL 10 HOUR, '%Y-%m-%d %H:%M:%S') AS faplan,
         CASE WHEN d.doc_id % 11 = 0 THEN NULL ELSE strftime(CAST(DATE '2024-01-01' + CAST(d.doc_id % 60 AS INTEGER) AS TIMESTAMP) + INTERVAL 8 HOUR + to_minutes(CAST((d.doc_id * 13) % 90 - 15 AS BIGINT)), '%Y-%m-%d %H:%M:%S') END AS fdactual,
         CASE WHEN d.doc_id % 17 = 0 THEN NULL ELSE strftime(CAST(DATE '2024-01-01' + CAST(d.doc_id % 60 AS INTEGER) AS TIMESTAMP) + INTERVAL 10 HOUR + to_minutes(CAST((d.doc_id * 29) % 120 - 60 AS BIGINT)), '%Y-%m-%d %H:%M:%S') END AS faactual,
         CAST(CASE WHEN l.toxic = 1 THEN 0 WHEN l.quality = 1 THEN 2 ELSE 1 END AS INTEGER) AS emo,
         CASE WHEN d.doc_id % 11 = 0 THEN NULL ELSE (d.doc_id * 13) % 90 - 15 END AS dep_gap,
         CASE WHEN d.doc_id % 17 = 0 THEN NULL ELSE (d.doc_id * 29) % 120 - 60 END AS arr_gap
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
dedup AS (SELECT * FROM reviews_v QUALIFY row_number() OVER (PARTITION BY fnum, fdate, evaluated_text ORDER BY id) = 1),
clean AS (
  SELECT id, {strip_crlf('evaluated_text')} AS evaluated_text, fnum,
         CAST(CASE WHEN arr_gap IS NULL THEN 0 WHEN -arr_gap > 30 OR coalesce(dep_gap > 30, FALSE) THEN 0 ELSE 1 END AS INTEGER) AS irr_f,
         user_cabin, fdep_code AS dep_code, farr_code AS arr_code, fdate,
         CAST(strftime(strptime(fdate, '%Y%m%d'), '%Y%m') AS INTEGER) AS period_m,
         CAST(strftime(strptime(fdate, '%Y%m%d'), '%G0%V') AS INTEGER) AS period_w,
         substr(fnum, 1, 2) AS airline, emo
  FROM dedup
  WHERE evaluated_text IS NOT NULL
    AND regexp_replace(evaluated_text, {q(P.OUTER_BLANKS)}, '', 'g') <> ''
    AND {keep_letters(f"regexp_replace(evaluated_text, {q(P.OUTER_BLANKS)}, '', 'g')")} <> '')
"""


def codes_cte(name: str, src: str, keys: list[str], text: str) -> str:
    """Distinct sorted codes (count map: B9 out on normal flights) per key of ``src``."""
    k = ", ".join(keys)
    return f"""{name} AS (
  SELECT {k}, list_sort(list_distinct(list(m.code))) AS codes
  FROM (SELECT {k}, irr_f, unnest({tokens(text)}) AS t FROM {src}) x
  JOIN m_count m ON m.keyword = x.t AND m.reg = CASE WHEN x.irr_f = 1 THEN 1 ELSE 0 END
  GROUP BY {k})"""


def routed_cte(name: str, src: str, keys: list[str], text: str, facility=FX.FACILITY_WORDS) -> str:
    """Codes with airport-context routing per key of ``src``; tokens and context are made before the unnest."""
    k = ", ".join(keys)
    return f"""{name}_toks AS MATERIALIZED (
  SELECT {k}, irr_f, {tokens(text)} AS toks, contains({text}, {q(LX.AIRPORT_SUBSTRING)}) AS named FROM {src}),
{name}_ctx AS MATERIALIZED (
  SELECT {k}, irr_f, toks, CASE WHEN named OR list_has_any(toks, {arr(facility)}) THEN 1 ELSE 0 END AS airport FROM {name}_toks),
{name} AS (
  SELECT {k}, list_sort(list_distinct(list(m.code))) AS codes
  FROM (SELECT {k}, irr_f, airport, unnest(toks) AS t FROM {name}_ctx) x
  JOIN m_route m ON m.keyword = x.t AND m.airport = x.airport
       AND (x.airport = 1 OR m.reg = CASE WHEN x.irr_f = 1 THEN 1 ELSE 0 END)
  GROUP BY {k})"""


def multi(codes: str) -> str:
    return f"(coalesce(len({codes}), 0) > 1 AND NOT (len({codes}) = 2 AND list_contains({codes}, {B9})))"


def tagging_ctes(stopwords=FX.STOPWORDS, summary: tuple | None = None) -> str:
    """CTEs from ``clean`` to ``tagged`` (one row per merged labelled clause).

    With the settings ``summary`` of SUM-1 long clauses are recomposed from their summaries, and ``hed`` has the
    opinions of the raw and of the recomposed clause.
    """
    kws = [k.lower() for k, _ in FX.TAXONOMY_ROWS]
    skip = arr(kws + list(stopwords))
    opinions = lambda x: f"list_filter({tokens(x)}, lambda t: regexp_matches(t, {q(P.LETTER_TOKEN)}) AND NOT list_contains({skip}, t))"
    hed_raw = opinions("sent")
    sents2 = f"""
sents2 AS (
  SELECT id, irr_f, sent, pos, CAST(min(pos) OVER (PARTITION BY id, sent) AS INTEGER) AS chilid,
         {recompose('sent', stopwords)} AS view_n, {hed_raw} AS hed_raw
  FROM sents WHERE {keep_letters('sent')} <> ''),"""
    if summary:
        sents2 = f"""
su_in AS MATERIALIZED (SELECT row_number() OVER () AS doc_id, sent AS text FROM (SELECT DISTINCT sent FROM sents)),{summary_ctes('su_in', *summary)},
sents1 AS (
  SELECT id, irr_f, sent, pos, CAST(min(pos) OVER (PARTITION BY id, sent) AS INTEGER) AS chilid, {recompose('summary', stopwords)} AS view_n
  FROM sents JOIN su_in ON su_in.text = sents.sent JOIN su_abstract USING (doc_id) WHERE {keep_letters('sent')} <> ''),
sents2 AS (SELECT *, list_concat({hed_raw}, {opinions('view_n')}) AS hed_raw FROM sents1),"""
    return f"""
{codes_cte('r_codes', 'clean', ['id'], 'evaluated_text')},
lvl1 AS (
  SELECT c.*, {multi('rc.codes')} AS multi_r,
         CASE WHEN {multi('rc.codes')} THEN {split_clauses(collapse_repeats('c.evaluated_text'))}
              ELSE [c.evaluated_text] END AS l1
  FROM clean c LEFT JOIN r_codes rc ON rc.id = c.id),
l1_rows AS (SELECT id, irr_f, multi_r, unnest(l1) AS c1, unnest(range(1, len(l1) + 1)) AS p1 FROM lvl1),
{codes_cte('c1_codes', 'l1_rows', ['id', 'p1'], 'c1')},
lvl2 AS (
  SELECT r.id, r.irr_f, r.p1,
         CASE WHEN r.multi_r AND {multi('cc.codes')} THEN {split_subclauses(collapse_repeats('r.c1'))} ELSE [r.c1] END AS l2
  FROM l1_rows r LEFT JOIN c1_codes cc ON cc.id = r.id AND cc.p1 = r.p1),
l2_rows AS (SELECT id, irr_f, p1, unnest(l2) AS sent, unnest(range(1, len(l2) + 1)) AS p2 FROM lvl2),
sents AS (
  SELECT id, irr_f, sent, row_number() OVER (PARTITION BY id ORDER BY p1, p2) AS pos FROM l2_rows),{sents2}
sents3 AS (SELECT * EXCLUDE (hed_raw), {ordered_distinct('hed_raw')} AS hed FROM sents2),
{routed_cte('codes_n', 'sents3', ['id', 'pos'], 'view_n')},
{routed_cte('codes_s', 'sents3', ['id', 'pos'], 'sent')},
labelled AS (
  SELECT s.*, CASE WHEN len(cn.codes) > 0 THEN cn.codes ELSE cs.codes END AS codes
  FROM sents3 s LEFT JOIN codes_n cn ON cn.id = s.id AND cn.pos = s.pos
                LEFT JOIN codes_s cs ON cs.id = s.id AND cs.pos = s.pos
  WHERE coalesce(len(cn.codes), 0) > 0 OR coalesce(len(cs.codes), 0) > 0),
merged AS (
  SELECT id, array_to_string(codes, '、') AS lable, any_value(codes) AS codes,
         arg_min(chilid, pos) AS chilid,
         string_agg(sent, '' ORDER BY pos) AS view,
         string_agg(view_n, '' ORDER BY pos) AS view_n,
         flatten(list(hed ORDER BY pos)) AS hed_all
  FROM labelled GROUP BY id, array_to_string(codes, '、')),
tagged AS (
  SELECT m.id, m.chilid, m.view, m.view_n, m.lable, m.codes, {ordered_distinct('m.hed_all')} AS hed,
         c.fnum, c.irr_f, c.user_cabin, c.dep_code, c.arr_code, c.fdate, c.period_m, c.period_w, c.airline,
         {', '.join(f"CAST(list_contains(m.codes, {q(code)}) AS INTEGER) AS {code}" for code in LX.ALL_CODES)},
         CASE WHEN len(list_intersect(m.codes, {arr(LX.ADO_AIRLINE_CODES)})) > 0 AND len(list_intersect(m.codes, {arr(LX.ADO_AIRPORT_CODES)})) = 0 THEN 'B'
              WHEN len(list_intersect(m.codes, {arr(LX.ADO_AIRLINE_CODES)})) = 0 AND len(list_intersect(m.codes, {arr(LX.ADO_AIRPORT_CODES)})) > 0 THEN 'J'
              WHEN len(list_intersect(m.codes, {arr(LX.ADO_AIRLINE_CODES)})) > 0 AND len(list_intersect(m.codes, {arr(LX.ADO_AIRPORT_CODES)})) > 0 THEN 'BJ'
              ELSE '' END AS ADO,
         c.emo
  FROM merged m JOIN clean c ON c.id = m.id)
"""


def with_ctes(*parts: str, body: str) -> str:
    return "WITH " + ",".join(p.strip().rstrip(",") for p in parts if p.strip()) + "\n" + body


def keyword_rows_cte(stopkeys=FX.STOPKEYS, script: str = FX.KEYWORD_SCRIPT) -> str:
    kept = f"list_filter(hed, lambda k: regexp_matches(k, {q(script)}) AND NOT list_contains({arr(stopkeys)}, k))"
    return f"""
kw_lists AS (SELECT id, chilid, {kept} AS kl FROM tagged),
keywords AS (
  SELECT TRY_CAST(CAST(id AS VARCHAR) || CAST(chilid AS VARCHAR) || CAST(seq AS VARCHAR) AS BIGINT) AS uuid,
         id, chilid, seq, keyword
  FROM (SELECT id, chilid, unnest(kl) AS keyword, CAST(unnest(range(1, len(kl) + 1)) AS INTEGER) AS seq FROM kw_lists))
"""


UNITS_CTE = f"""
units AS (
  SELECT 'airline' AS scope, airline AS void, 'm' AS period_kind, period_m AS period, * FROM tagged WHERE ADO IN ('B', 'BJ')
  UNION ALL SELECT 'airline', airline, 'w', period_w, * FROM tagged WHERE ADO IN ('B', 'BJ')
  UNION ALL SELECT 'airport', ap, 'm', period_m, * EXCLUDE (ap)
    FROM (SELECT *, unnest(list_distinct([dep_code, arr_code])) AS ap FROM tagged WHERE ADO IN ('J', 'BJ'))
  UNION ALL SELECT 'airport', ap, 'w', period_w, * EXCLUDE (ap)
    FROM (SELECT *, unnest(list_distinct([dep_code, arr_code])) AS ap FROM tagged WHERE ADO IN ('J', 'BJ'))),
sc_units AS (
  SELECT u.*, s.status, c.code
  FROM units u
  JOIN (SELECT 'all' AS status, NULL AS irr UNION ALL SELECT 'normal', 1 UNION ALL SELECT 'abnormal', 0) s
    ON s.irr IS NULL OR s.irr = u.irr_f
  JOIN (SELECT unnest({arr(LX.AIRLINE_CODES)}) AS code, 'airline' AS sc
        UNION ALL SELECT unnest({arr(LX.AIRPORT_CODES)}), 'airport') c
    ON c.sc = u.scope AND list_contains(u.codes, c.code))
"""
