"""CLS-1 / CLS-2: clause splitting as column expressions.

The character-by-character splitter of the original ("append the character,
on a delimiter emit the buffer if it is longer than one character and holds
a letter, then reset; at the end emit what is left") is expressed as one
``regexp_extract_all`` of delimiter-terminated chunks plus a ``filter``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .lexicon import CONNECTORS
from .stage import bind
from .text import _array_lit, _col, clean_text, shift_right, spaced_tokens


def emit_chunks(c, delims: str) -> Column:
    """Split ``c`` into delimiter-terminated chunks with the original emit rule."""
    # every chunk is looked at once; those without a group are none (no delimiter is a letter)
    return F.array_remove(F.regexp_extract_all(_col(c), F.lit(P.jvm(P.emitted_pattern(delims))), 1), "")


def mark_connectors(c, connectors: Iterable[str] = CONNECTORS, terms: Iterable[str] = ()) -> Column:
    """CLS-1 step 2: a full stop before the first occurrence of each connector.

    If the token before it is sentence-final nothing changes; if it is of the
    comma class it is replaced by '。'; otherwise '。' is inserted.  Texts
    without any connector are returned unchanged without further work.  The text,
    its tokens and the connectors' first places are evaluated once each.
    """
    conn = _array_lit(connectors)
    starts = P.jvm("[" + "".join(sorted({re.escape(w[0]) for w in connectors if w})) + "]") if any(connectors) else ""

    def marked(toks, places):
        def out(z, i):
            # token i (i > 0) is the first occurrence of a connector if its place, from 1, is among ``places``
            t, p, f, nf = z["t"], z["p"], (i > 0) & F.array_contains(places, i + 1), F.array_contains(places, i + 2)
            replaced = F.when(nf & ~t.rlike(P.jvm(P.ENDER_CLASS)) & t.rlike(P.jvm(P.COMMA_CLASS)), F.lit("。")).otherwise(t)
            insert = f & ~p.rlike(P.jvm(P.ENDER_CLASS)) & ~p.rlike(P.jvm(P.COMMA_CLASS))
            return F.when(insert, F.concat(F.lit("。"), replaced)).otherwise(replaced)

        pairs = F.zip_with(toks, shift_right(toks), lambda t, p: F.struct(t.alias("t"), p.alias("p")))
        return F.array_join(F.transform(pairs, out), "")

    def with_stops(x):
        return bind(spaced_tokens(x, [*connectors, *terms]), lambda toks: F.when(F.arrays_overlap(toks, conn), bind(
            F.transform(conn, lambda w: F.array_position(toks, w).cast("int")), lambda places: marked(toks, places))).otherwise(x))

    # a text without the first letter of any connector has none
    return bind(_col(c), lambda x: F.when(x.rlike(starts), with_stops(x)).otherwise(x)) if starts else _col(c)


def split_clauses(c, connectors: Iterable[str] = CONNECTORS, terms: Iterable[str] = ()) -> Column:
    """CLS-1: clean, mark connectors, pick the delimiter set, emit chunks.

    ``terms`` are further words of the language: a connector inside one of them is no connector.
    """
    s = F.regexp_replace(clean_text(c), P.jvm(P.SOFT_BREAKS), ";")
    return bind(mark_connectors(s, list(connectors), list(terms)), lambda x: (
        F.when(x.rlike(P.jvm(P.ENDER_CLASS)), emit_chunks(x, P.CLAUSE_DELIMS_ENDERS))
         .when(x.rlike(P.jvm(P.COMMA_CLASS)), emit_chunks(x, P.CLAUSE_DELIMS_COMMAS))
         .otherwise(emit_chunks(x, P.CLAUSE_DELIMS_BLANK))))


def split_subclauses(c) -> Column:
    """CLS-2: finer split on the sub-clause delimiters, same emit rule."""
    return emit_chunks(c, P.SUBCLAUSE_DELIMS)
