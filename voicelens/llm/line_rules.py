"""Quality rules by cross-document line frequency, in DataFrame functions alone.

Lines are normalised (words joined by one blank, lower case) and hashed.  A line
found in more than a limit of distinct documents of its host (``source``) is
boilerplate and is removed; a document of which too few words remain is
depleted and rejected.  Documents with equal text count once, so a document
that was copied does not turn into boilerplate of itself.

The texts are read once, in place: counts over words, windows and lines are array
expressions inside the row.  What is shuffled is one hash per distinct line of a
document.  Frequent lines are few by definition (a line in more than a share of a
host's documents takes that share of its lines); they are broadcast only after a
count, otherwise joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import let, small_side, written

# fixed values: ASCII white space, the pattern between words, symbol characters
BLANKS = " \t\n\x0b\f\r"
BETWEEN = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A line is boilerplate from this many documents of a host on, if they are this share of the host's documents.
LINE_DOCUMENTS, LINE_PERCENT = 50, 2
#: A document is depleted when fewer of its words than this percentage remain.
REMAIN_PERCENT = 30
BROADCAST_LINES = 200_000


def repeated_words(words: Column, n: int = WINDOW) -> Column:
    """Words that lie in ``n``-word windows which the text holds twice or more."""
    def covered(grams: Column) -> Column:
        order = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        again = let(order, lambda s: F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["g"] == x["g"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["g"] == x["g"], F.lit(False))))
        starts = F.array_sort(F.transform(again, lambda x: x["i"]))
        steps = let(starts, lambda p: F.transform(p, lambda x, j: F.least(F.lit(n), F.coalesce(F.get(p, j + 1) - x, F.lit(n)))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    grams = let(hashes, lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(n)))))
    found = let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(covered(g)))
    return F.when(F.size(words) > n, found).otherwise(F.lit(0)).cast("long")


def text_stats(docs: DataFrame) -> DataFrame:
    """Base counts of each row, and hash and word count of each of its lines."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bare = text
    for symbol in SYMBOLS:
        bare = F.replace(bare, F.lit(symbol), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")

    def counts(lines: Column) -> Column:
        line_words = F.transform(lines, lambda x: F.split(F.btrim(x, F.lit(BLANKS)), BETWEEN))

        def of_words(parts: Column) -> Column:
            return let(F.flatten(parts), lambda words: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
                repeated_words(words).alias("n_repeat_words"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                F.transform(parts, lambda p: F.struct(F.xxhash64(F.lower(F.array_join(p, " "))).alias("line"), F.size(p).alias("words"))).alias("lines")))

        return let(line_words, of_words)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("host"), F.xxhash64(text).alias("text_hash"),
                       (F.octet_length(text) - F.octet_length(bare)).cast("long").alias("n_symbols"), let(lines, counts).alias("c"))
    return rows.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "host", "text_hash", "n_symbols", "c.*")


def frequent_lines(stats: DataFrame) -> DataFrame:
    """(host, line) of lines in more distinct documents of a host than the limits allow."""
    host = F.coalesce("host", F.lit(""))
    of_host = (stats.select(host.alias("host"), "text_hash").distinct().groupBy("host").agg(F.count("*").alias("documents"))
               .withColumnRenamed("host", "h"))
    lines = stats.select(host.alias("host"), "text_hash", F.explode(F.array_distinct("lines.line")).alias("line"))
    counted = lines.distinct().groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= LINE_DOCUMENTS)
    return (counted.join(of_host, F.col("host") == F.col("h")).where(F.col("n") * 100 > F.col("documents") * LINE_PERCENT)
            .select(F.col("host").alias("f_host"), F.col("line").alias("f_line")))


def line_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id, text, source; others are ignored).

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_removed_words (of boilerplate lines), base_failed, kept.  Null text has no
    words and fails the base rules; a null source is a host of its own; repeated
    rows are judged each; an empty table gives no rows.
    """
    stats = written(text_stats(docs), "text-stats")
    frequent = small_side(written(frequent_lines(stats), "frequent-lines"), BROADCAST_LINES)
    lines = stats.select("row_id", F.coalesce("host", F.lit("")).alias("host"), F.explode("lines").alias("l")).select("row_id", "host", "l.line", "l.words")
    removed = (lines.join(frequent, (F.col("host") == F.col("f_host")) & (F.col("line") == F.col("f_line")))
               .groupBy("row_id").agg(F.sum("words").alias("n_removed_words")))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    gone = F.coalesce("n_removed_words", F.lit(0)).cast("long")
    depleted = (F.col("n_words") - gone) * 100 < F.col("n_words") * REMAIN_PERCENT
    return (stats.drop("lines").join(removed, "row_id", "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", gone.alias("n_removed_words"),
                    failed.alias("base_failed"), (~failed & ~depleted).alias("kept")))


ORACLE_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
l AS (SELECT rid, host, t, x FROM (SELECT rid, host, t, unnest(string_split(t, chr(10))) AS x FROM d)
      WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]')),
n AS (SELECT rid, host, t, x, regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+') AS p FROM l),
m AS (SELECT rid, host, t, x, len(p) AS words, lower(array_to_string(p, ' ')) AS line FROM n),
hosts AS (SELECT host, count(DISTINCT t) AS documents FROM d GROUP BY host),
freq AS (SELECT host, line FROM (SELECT host, line, count(DISTINCT t) AS c FROM m GROUP BY host, line) JOIN hosts USING (host)
         WHERE c >= 50 AND c * 100 > documents * 2),
removed AS (SELECT rid, sum(words) AS gone FROM m JOIN freq USING (host, line) GROUP BY rid),
dup AS (SELECT rid, count(*) - count(DISTINCT x) AS n_dup_lines FROM m GROUP BY rid),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS p FROM d),
g AS (SELECT rid, i, array_to_string(p[i:i + 7], ' ') AS gram FROM (SELECT rid, p, unnest(range(1, len(p) - 6)) AS i FROM w)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS c FROM g) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM r, range(8) AS k(k) GROUP BY rid),
s AS (SELECT rid, doc_id, CAST(len(p) AS BIGINT) AS n_words, CAST(length(array_to_string(p, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(gone, 0) AS BIGINT) AS n_removed_words
      FROM w LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN removed USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words,
       n_words < 20 OR n_repeat_words * 100 > n_words * 30 AS base_failed,
       NOT (n_words < 20 OR n_repeat_words * 100 > n_words * 30) AND NOT ((n_words - n_removed_words) * 100 < n_words * 30) AS kept
FROM s
"""
