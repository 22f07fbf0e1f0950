"""Text scalars and token-array operators as Spark column expressions.

All functions take and return ``Column`` objects and use only built-in
functions (regex, higher-order array functions), so they stay inside the
JVM and run row by row without any shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .stage import bind


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _array_lit(words: Iterable[str]) -> Column:
    words = list(dict.fromkeys(words))
    if not words:
        return F.array().cast("array<string>")
    return F.array(*[F.lit(w) for w in words])


def not_in(words: Iterable[str]):
    """Predicate factory: token not in a literal word list."""
    words = list(dict.fromkeys(words))
    return lambda t: ~t.isin(words)


# --- STR-1..4, STR-6 -------------------------------------------------------

def keep_letters(c) -> Column:
    """STR-1: keep only Han, underscore and ASCII letters (digits are dropped)."""
    return F.regexp_replace(_col(c), P.jvm(P.LETTER_CLASS[:1] + "^" + P.LETTER_CLASS[1:] + "+"), "")


def clean_text(c) -> Column:
    """STR-2: each run outside digits, letters, Han and the kept punctuation → one blank."""
    return F.regexp_replace(_col(c), P.jvm(P.CLEAN_RUN), " ")


def strip_crlf(c, replacement: str = "。") -> Column:
    """STR-3: strip outer whitespace, then CRLF → ``replacement``."""
    return F.replace(F.regexp_replace(_col(c), P.OUTER_BLANKS, ""), F.lit("\r\n"), F.lit(replacement))


def escape_quotes(c) -> Column:
    """STR-4: backslash before single and double quotes."""
    return F.regexp_replace(_col(c), "(['\"])", "\\\\$1")


def split_labels(c, sep: str = "、") -> Column:
    """STR-6: split a joined label / opinion string into an array."""
    return F.split(_col(c), sep)


# --- TOK-1..6 ---------------------------------------------------------------

def tokenize(c, lower: bool = True, terms: Iterable[str] = ()) -> Column:
    """TOK-1: letter runs, digit runs, Han words of ``terms`` and single other characters, blanks dropped."""
    x = _col(c)
    if lower:
        x = F.lower(x)
    return _tokens(x, P.TOKEN_PATTERN, terms)


def _tokens(x: Column, pattern: str, terms: Iterable[str]) -> Column:
    """Matches of ``pattern``; only texts with a Han character are held against the lexicon's words."""
    full = P.with_terms(pattern, terms)
    found = lambda t, p: F.regexp_extract_all(t, F.lit(P.jvm(p)), 0)
    return found(x, pattern) if full == pattern else bind(x, lambda t: F.when(t.rlike(P.jvm(P.HAN_CLASS)), found(t, full)).otherwise(found(t, pattern)))


def spaced_tokens(c, terms: Iterable[str] = ()) -> Column:
    """Tokens that keep every whitespace character, so ``array_join(t, '')`` = text."""
    return _tokens(_col(c), P.SPACED_TOKEN_PATTERN, terms)


def shift_right(arr) -> Column:
    """[a, b, c] → [NULL, a, b]: the previous element at each position."""
    return bind(_col(arr), lambda a: F.concat(F.array(F.lit(None).cast("string")), F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))))


def shift_left(arr) -> Column:
    """[a, b, c] → [b, c]: zipped with the array, the next element (NULL at the end)."""
    return bind(_col(arr), lambda a: F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0))))


def collapse_tokens(tokens) -> Column:
    """Drop a token equal to its predecessor (equal to comparing with the last kept one).

    The array is bound and zipped with its own shift, so it is evaluated once and
    no lambda refers back to the whole array.
    """
    kept = bind(_col(tokens), lambda t: F.zip_with(t, shift_right(t), lambda a, b: F.when(b.isNull() | (a != b), a)))
    return F.filter(kept, lambda x: x.isNotNull())


def collapse_repeats(c, terms: Iterable[str] = ()) -> Column:
    """TOK-3: text → tokens → drop repeats → joined by ''.

    Without Han words only single characters can repeat, which a replacement drops without making tokens.
    """
    return bind(_col(c), lambda x: F.when(x.rlike(P.jvm(P.HAN_CLASS)), F.array_join(collapse_tokens(spaced_tokens(x, terms)), "")).otherwise(
        F.regexp_replace(x, P.jvm(P.REPEATED), "$1")))


def remove_stopwords(c, stopwords: Iterable[str]) -> Column:
    """TOK-2: tokens not in the stopword list, joined by ''."""
    keep = not_in(list(stopwords) + [" ", "\t", "\n"])
    return F.array_join(F.filter(spaced_tokens(c), keep), "")


def recompose(c, stopwords: Iterable[str], terms: Iterable[str] = ()) -> Column:
    """TOK-4: keep text-bearing, non-stopword tokens, collapse repeats, join ''.

    If the text has no text-bearing character at all: split on blanks, keep the
    wide-ASCII pieces, collapse, join with ' '.
    """
    x = _col(c)
    stop = not_in(list(stopwords) + [" ", "\t", "\n"])
    kept = F.filter(spaced_tokens(x, terms), lambda t: t.rlike(P.jvm(P.RECOMPOSE_KEEP)) & stop(t))
    pieces = F.filter(F.split(x, " "), lambda t: t.rlike(P.jvm(P.WIDE_ASCII_CLASS)) & stop(t))
    return (F.when(x.rlike(P.jvm(P.RECOMPOSE_KEEP)), F.array_join(collapse_tokens(kept), ""))
             .otherwise(F.array_join(collapse_tokens(pieces), " ")))


def _han_words(x: Column, stopwords: Iterable[str]) -> Column:
    stop = not_in(list(stopwords) + [" ", "\t", "\n"])
    return F.filter(spaced_tokens(x), lambda t: t.rlike(P.jvm(P.HAN_CLASS)) & stop(t))


def word_set(c, stopwords: Iterable[str]) -> Column:
    """TOK-5: distinct Han non-stopword tokens plus wide-ASCII runs (sorted).

    Without Han: the distinct blank-split pieces.
    """
    x = _col(c)
    with_han = F.concat(_han_words(x, stopwords),
                        F.regexp_extract_all(x, F.lit(P.jvm(P.WIDE_ASCII_CLASS + "+")), 0))
    without = F.split(x, " ")
    out = F.when(x.rlike(P.jvm(P.HAN_CLASS)), with_han).otherwise(without)
    return F.array_sort(F.array_distinct(F.filter(out, lambda t: t != " ")))


def word_line(c, stopwords: Iterable[str]) -> Column:
    """TOK-6: as word_set, order and repeats kept, joined by blanks."""
    x = _col(c)
    with_han = F.concat(_han_words(x, stopwords),
                        F.regexp_extract_all(x, F.lit(P.jvm(P.WIDE_ASCII_CLASS + "+")), 0))
    return F.when(x.rlike(P.jvm(P.HAN_CLASS)), F.array_join(with_han, " ")).otherwise(x)


def has_letter(c) -> Column:
    return _col(c).rlike(P.jvm(P.LETTER_CLASS))
