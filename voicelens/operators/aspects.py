"""Aspect taxonomy lookup and per-row aspect operators.

The taxonomy is a user-supplied dimension (keyword → code, first row per
keyword wins).  It does not grow with the review data; its size is checked
before it is turned into in-row lookup maps, so that tagging stays a narrow
(shuffle-free) transformation over the review rows.  ``operators.lexicon`` counts
aspects by joins, for a taxonomy of any size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as LX
from ..functions.stage import bind
from ..functions.text import _array_lit, _col, tokenize

MAX_LOOKUP_ENTRIES = 200_000


def first_keyword_rows(taxonomy: DataFrame) -> DataFrame:
    """SRC-4 / WIN-2: first taxonomy row per keyword (by line number), lower-cased as the tokens are."""
    taxonomy = taxonomy.withColumn("keyword", F.lower("keyword"))
    w = Window.partitionBy("keyword").orderBy("line_no")
    return (taxonomy.withColumn("_rn", F.row_number().over(w))
            .filter("_rn = 1").drop("_rn"))


@dataclass
class AspectLookup:
    """In-row lookup maps, one per keyword subset used by the original rules.

    A subset is taken first and the first row per keyword is chosen inside
    it (a keyword listed under an excluded code falls through to its next row).
    """

    rows: list  # [(line_no, keyword, code)] sorted by line_no
    irregular_code: str = LX.IRREGULAR_CODE
    airport_codes: tuple = tuple(LX.AIRPORT_CONTEXT_CODES)

    @classmethod
    def from_dataframe(cls, taxonomy: DataFrame, max_entries: int = MAX_LOOKUP_ENTRIES, **kw) -> "AspectLookup":
        n = taxonomy.count()
        if n > max_entries:
            raise ValueError(
                f"taxonomy has {n} rows, above the in-row lookup bound {max_entries}; "
                "operators.lexicon works by joins")
        rows = sorted((r["line_no"], r["keyword"].lower(), r["code"])
                      for r in taxonomy.select("line_no", "keyword", "code").collect())
        return cls(rows=rows, **kw)

    def _map(self, keep) -> Column:
        first = {}
        for _, kw, code in self.rows:
            if keep(code) and kw not in first:
                first[kw] = code
        if not first:
            return F.create_map().cast("map<string,string>")
        keys, vals = list(first.keys()), list(first.values())
        return F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[F.lit(v) for v in vals]))

    @property
    def keywords(self) -> list:
        return list(dict.fromkeys(kw for _, kw, _ in self.rows))

    def m_all(self):
        return self._map(lambda c: True)

    def m_regular(self):
        return self._map(lambda c: c != self.irregular_code)

    def m_airport(self):
        return self._map(lambda c: c in self.airport_codes)

    def m_other(self):
        return self._map(lambda c: c not in self.airport_codes)

    def m_other_regular(self):
        return self._map(lambda c: c not in self.airport_codes and c != self.irregular_code)


def codes_of(tokens, lookup_map: Column) -> Column:
    """Sorted distinct codes of the tokens found in ``lookup_map``.

    The hash-based intersection with the keywords comes first, so only hits
    (few per clause) are looked up.
    """
    hits = F.array_intersect(_col(tokens), F.map_keys(lookup_map))
    return F.array_sort(F.array_distinct(F.transform(hits, lambda t: F.try_element_at(lookup_map, t))))


def known_words(tokens, lookup: AspectLookup) -> Column:
    """The tokens that are keywords at all (one hashed set for all rows); no others have codes."""
    return F.filter(_col(tokens), lambda t: t.isin(lookup.keywords))


def count_codes(tokens, irr_f, lookup: AspectLookup) -> Column:
    """AGG-2 core: distinct codes; the irregular-flight code is left out on normal flights."""
    return bind(known_words(tokens, lookup), lambda t: F.when(F.size(t) == 0, t).when(_col(irr_f) == 1, codes_of(t, lookup.m_regular())).otherwise(
        codes_of(t, lookup.m_all())))


def is_multi_aspect(codes: Column, irregular_code: str = LX.IRREGULAR_CODE) -> Column:
    """More than one aspect, not counting the pair (x, irregular-flight)."""
    return bind(codes, lambda c: (F.size(c) > 1) & ~((F.size(c) == 2) & F.array_contains(c, irregular_code)))


def airport_context(tokens, text, facility_words=LX.FACILITY_WORDS, substring: str = LX.AIRPORT_SUBSTRING) -> Column:
    """FLT-5: a clause with a facility word, or the airport substring, is airport context."""
    hit = F.arrays_overlap(_col(tokens), _array_lit(facility_words))
    hit = F.coalesce(hit, F.lit(False))
    if substring:
        hit = hit | F.coalesce(F.instr(_col(text), substring) > 0, F.lit(False))
    return hit


def routed_map(tokens, text, irr_f, lookup: AspectLookup, facility_words=LX.FACILITY_WORDS,
               substring: str = LX.AIRPORT_SUBSTRING) -> Column:
    """FLT-5: the keyword map of a clause's context."""
    other = F.when(_col(irr_f) == 1, lookup.m_other_regular()).otherwise(lookup.m_other())
    return F.when(airport_context(tokens, text, facility_words, substring), lookup.m_airport()).otherwise(other)


def routed_codes(tokens, text, irr_f, lookup: AspectLookup, facility_words=LX.FACILITY_WORDS,
                 substring: str = LX.AIRPORT_SUBSTRING) -> Column:
    """FLT-5 + JON-2: airport context → airport-context codes only; otherwise the
    other codes, without the irregular-flight code on normal flights."""
    def routed(t):
        def codes(known):
            other = F.when(_col(irr_f) == 1, codes_of(known, lookup.m_other_regular())).otherwise(codes_of(known, lookup.m_other()))
            return (F.when(F.size(known) == 0, known)
                     .when(airport_context(t, text, facility_words, substring), codes_of(known, lookup.m_airport())).otherwise(other))

        return bind(known_words(t, lookup), codes)

    return bind(_col(tokens), routed)


def aspect_count(reviews: DataFrame, lookup: AspectLookup, text_col: str = "evaluated_text") -> DataFrame:
    """AGG-2: (id, n_aspects, codes) per review; a narrow transformation."""
    codes = count_codes(tokenize(F.col(text_col), terms=lookup.keywords), F.col("irr_f"), lookup)
    return reviews.select(
        "id",
        F.size(codes).cast("long").alias("n_aspects"),
        F.array_join(codes, "、").alias("codes"),
    )


def onehot_aspects(codes, code_list=LX.ALL_CODES) -> list:
    """AGG-9: one 0/1 INT column per code."""
    return [F.array_contains(_col(codes), c).cast("int").alias(c) for c in code_list]


def target_object(airline_sum: Column, airport_sum: Column) -> Column:
    """AGG-8: 'B', 'J', 'BJ' or '' from the two code sums."""
    return (F.when((airline_sum > 0) & (airport_sum == 0), "B")
             .when((airline_sum == 0) & (airport_sum > 0), "J")
             .when((airline_sum > 0) & (airport_sum > 0), "BJ")
             .otherwise(""))


def target_object_of(codes, airline_codes=LX.ADO_AIRLINE_CODES, airport_codes=LX.ADO_AIRPORT_CODES) -> Column:
    c = _col(codes)
    a = F.size(F.array_intersect(c, _array_lit(airline_codes)))
    j = F.size(F.array_intersect(c, _array_lit(airport_codes)))
    return target_object(a, j)
