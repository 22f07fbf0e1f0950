"""OPN operators on annotated tokens (ARRAY<STRUCT<i, word, pos, rel, head>>).

All rules work inside the clause row with higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import _array_lit, _col


def head_index(heads) -> Column:
    """OPN-1: 1-based parser heads → 0-based; root (0) stays 0 (see ``is_root``)."""
    return F.transform(_col(heads), lambda h: F.greatest(h - 1, F.lit(0)))


def is_root(heads) -> Column:
    return F.transform(_col(heads), lambda h: h == 0)


def negated_opinions(tokens, negations, script: str) -> Column:
    """OPN-6: a negation word followed by a script-bearing word → the two as one keyword."""
    t = _col(tokens)
    words = F.transform(t, lambda x: x["word"])
    nxt = F.concat(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), F.array(F.lit(None).cast("string")))
    neg = _array_lit(negations)
    pairs = F.zip_with(words, nxt, lambda w, n: F.when(
        F.array_contains(neg, w) & n.isNotNull() & n.rlike(script), F.concat(w, n)))
    return F.filter(pairs, lambda x: x.isNotNull())


# --- OPN-2 / OPN-3 / OPN-4 / OPN-5 -------------------------------------------------------
#
# Index conventions: tokens are 0-based; ``head`` values are compared as
# given (the root's head 0 equals "child of token 0", as in the original).
# A neighbour index of -1 is "no neighbour" (the original wrapped to the last
# token).  Child sets are taken in index order.

from pyspark.sql import DataFrame  # noqa: E402

from ..functions.stage import bind, stage  # noqa: E402
from ..functions import lexicon as LX  # noqa: E402


def prepare(df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """Row-level helper arrays (materialised, so lambdas refer to columns only)."""
    t = F.col(tokens_col)
    df = stage(df.select("*",
                         F.transform(t, lambda x: x["word"]).alias("_w"),
                         F.transform(t, lambda x: x["pos"]).alias("_p"),
                         F.transform(t, lambda x: x["rel"]).alias("_r"),
                         F.transform(t, lambda x: x["head"]).alias("_h")))
    return stage(df.select("*", t.alias("_tok"), (F.array_position("_r", "HED") - 1).cast("int").alias("_hed"),
                           (F.array_position("_r", "VOB") - 1).cast("int").alias("_vob"),
                           F.size("_w").alias("_n")))


def _at(arr: str, i):
    """0-based element, NULL when out of range."""
    i = i.cast("int") if isinstance(i, Column) else F.lit(i)
    return F.when((i >= 0) & (i < F.size(arr)), F.try_element_at(F.col(arr), i + 1))


def _children(i):
    return F.filter(F.col("_tok"), lambda y: y["head"] == i)


def _hed_rule():
    h = F.col("_hed")
    tail_vob = F.array_contains(F.slice("_r", F.greatest(h + 2, F.lit(1)), F.greatest(F.col("_n"), F.lit(1))), "VOB")
    joined = F.concat(_at("_w", h), _at("_w", h + 1), _at("_w", F.col("_vob")))
    return (F.when(h < 0, F.array().cast("array<string>"))
             .when(h + 1 >= F.col("_n"), F.array().cast("array<string>"))
             .when((_at("_r", h + 1) == "ADV") & tail_vob & (F.col("_vob") >= 0), F.array(joined))
             .otherwise(F.array(_at("_w", h))))


def aspect_opinion(i, ec) -> Column:
    """OPN-2: opinion words of the aspect token at 0-based index ``i`` (word ``ec``)."""
    lg = _at("_r", i)
    none = F.array().cast("array<string>")

    # *OB / HED: adjectival or verbal children; the smallest key compared as text wins
    def cand(c):
        verb = c["pos"] == "v"
        kids = F.filter(F.col("_tok"), lambda y: (y["head"] == c["i"]) & (y["word"] != ec))
        kw = F.when(verb, F.concat(c["word"], F.array_join(F.transform(kids, lambda y: y["word"]), "")))\
              .otherwise(c["word"])
        key = F.when(verb, c["i"].cast("string")).otherwise((c["i"] - i).cast("string"))
        return F.named_struct(F.lit("key"), key, F.lit("neg_i"), -c["i"], F.lit("kw"), kw)

    cands = F.transform(F.filter(F.col("_tok"), lambda y: (y["head"] == i) & y["pos"].isin(*LX.CHILD_POS_ASPECT)), cand)

    def of_best(least):
        best = F.element_at(least, 1)["kw"]
        return (F.when(F.size(least) > 0,
                       F.when(best != ec, F.array(best))
                        .when((lg == "HED") & (F.col("_vob") >= 0), F.array(_at("_w", F.col("_vob"))))
                        .otherwise(none))
                 .when(lg.endswith("OB") & (F.col("_hed") >= 0), _hed_rule())
                 .otherwise(none))

    ob = bind(F.array_sort(cands), of_best)

    # SBV: the governor, with a preceding adverb, or by the governor's relation
    p = _at("_h", i)
    pw = _at("_w", p)
    coo = F.array_join(F.transform(F.filter(F.col("_tok"), lambda y: (y["i"] == p) | (y["head"] == p)),
                                   lambda y: y["word"]), "")
    vobs = F.array_join(F.transform(F.filter(F.col("_tok"), lambda y: y["rel"] == "VOB"), lambda y: y["word"]), "")
    sbv = (F.when((p - 1 >= 0) & (_at("_r", p - 1) == "ADV"), F.array(F.concat(_at("_w", p - 1), pw)))
            .when(_at("_r", p) == "VOB", F.array(vobs))
            .when(_at("_r", p) == "HED", _hed_rule())
            .when(_at("_r", p) == "COO", F.array(coo))
            .otherwise(F.array(pw)))
    first_i = (F.array_position("_w", ec) - 1).cast("int")
    sbv = F.when(F.size(sbv) > 0, sbv).otherwise(F.array(_at("_w", _at("_h", first_i))))

    # ATT: the governor (first occurrence of its word) decides
    pidx = (F.array_position("_w", pw) - 1).cast("int")
    pn = _at("_h", pidx)
    att = (F.when(_at("_r", pidx) == "COO", F.array(pw))
            .when(_at("_r", pidx) == "SBV",
                  F.when((pn - 1 >= 0) & (_at("_r", pn - 1) == "ADV"), F.array(F.concat(_at("_w", pn - 1), _at("_w", pn))))
                   .otherwise(F.array(_at("_w", pn))))
            .when(F.col("_hed") >= 0, F.array(_at("_w", F.col("_hed"))))
            .otherwise(none))

    # COO: children and grandchildren
    coo_kids = F.flatten(F.transform(_children(i), lambda c: F.concat(
        F.array(c["word"]), F.transform(F.filter(F.col("_tok"), lambda y: y["head"] == c["i"]), lambda y: y["word"]))))

    out = (F.when(lg.endswith("OB") | (lg == "HED"), ob)
            .when(lg == "SBV", sbv)
            .when(lg == "ATT", att)
            .when(lg == "COO", coo_kids)
            .otherwise(none))
    return F.filter(out, lambda x: x.isNotNull())


def refine_opinion(st, negations, script: str, special=LX.SPECIAL_OPINIONS) -> Column:
    """OPN-3: refine a candidate word ``st`` of the clause; its first place is looked for once."""
    return bind((F.array_position("_w", st) - 1).cast("int"), lambda idx: _refined_at(idx, st, negations, script, special))


def _kept(out, st) -> Column:
    """The opinion words sorted and distinct; without any, the word itself."""
    return bind(F.filter(out, lambda x: x.isNotNull() & (x != " ")), lambda o: F.array_sort(F.array_distinct(F.when(F.size(o) > 0, o).otherwise(F.array(st)))))


def _refined_at(idx, st, negations, script: str, special) -> Column:
    pos = _at("_p", idx)
    nb = F.array(*[F.lit(x) for x in LX.NEIGHBOUR_POS])
    nxt = _at("_w", idx + 1)
    neg = F.when(nxt.isNotNull() & nxt.rlike(script), F.array(F.concat(st, nxt))).otherwise(F.array().cast("array<string>"))
    prev_ok = (idx - 1 >= 0) & F.array_contains(nb, F.coalesce(_at("_p", idx - 1), F.lit("")))
    spec = _array_lit(special)

    def around(c, cls):
        before = F.when((c["i"] - 1 >= 0) & F.array_contains(cls, F.coalesce(_at("_p", c["i"] - 1), F.lit(""))),
                        F.array(_at("_w", c["i"] - 1))).otherwise(F.array().cast("array<string>"))
        after = F.when(F.array_contains(cls, F.coalesce(_at("_p", c["i"] + 1), F.lit(""))),
                       F.array(_at("_w", c["i"] + 1))).otherwise(F.array().cast("array<string>"))
        return F.concat(before, F.array(c["word"]), after)

    verb_kids = F.filter(F.col("_tok"), lambda y: (y["head"] == idx) & (
        y["pos"].isin(*LX.CHILD_POS_ADJECTIVAL) | F.array_contains(spec, y["word"])
        | (y["rel"].endswith("OB") & (y["pos"] != "n"))))
    verb = F.when(prev_ok, F.array(F.concat(_at("_w", idx - 1), st))).otherwise(
        F.flatten(F.transform(verb_kids, lambda c: around(c, nb))))
    conn_kids = F.filter(F.col("_tok"), lambda y: (y["head"] == idx) & y["pos"].isin(*LX.CHILD_POS_ADJECTIVAL))
    conn = F.flatten(F.transform(conn_kids, lambda c: around(c, F.array(F.lit("n")))))
    out = (F.when(F.array_contains(_array_lit(negations), st), neg)
            .when((pos == "v") & ~F.array_contains(spec, st), verb)
            .when(pos == "c", conn)
            .otherwise(F.array().cast("array<string>")))
    return _kept(out, st)


def refine_predicate(negations, script: str, special=LX.SPECIAL_OPINIONS) -> Column:
    """OPN-4: opinion words around the root predicate (HED)."""
    h = F.col("_hed")
    st = _at("_w", h)
    found = bind((F.array_position("_w", st) - 1).cast("int"), lambda idx: _predicate_at(idx, h, st, negations, script, special))
    return F.when(h < 0, F.array().cast("array<string>")).otherwise(found)


def _predicate_at(idx, h, st, negations, script: str, special) -> Column:
    pos = _at("_p", idx)
    nxt = _at("_w", idx + 1)
    spec = _array_lit(special)
    neg = F.when(nxt.isNotNull() & nxt.rlike(script), F.array(F.concat(st, nxt))).otherwise(F.array().cast("array<string>"))
    kids = F.transform(F.filter(F.col("_tok"), lambda y: (y["head"] == h) & (
        y["pos"].isin(*LX.CHILD_POS_PREDICATE) | y["rel"].endswith("OB"))), lambda y: y["word"])
    conn_kids = F.filter(F.col("_tok"), lambda y: (y["head"] == idx) & y["pos"].isin(*LX.CHILD_POS_PREDICATE))
    conn = F.concat(F.flatten(F.transform(conn_kids, lambda c: F.concat(
        F.when((c["i"] - 1 >= 0) & (_at("_p", c["i"] - 1) == "n"), F.array(_at("_w", c["i"] - 1))).otherwise(F.array().cast("array<string>")),
        F.array(c["word"]),
        F.when(_at("_p", c["i"] + 1) == "n", F.array(_at("_w", c["i"] + 1))).otherwise(F.array().cast("array<string>"))))),
        F.array(st))
    out = (F.when(F.array_contains(_array_lit(negations), st), neg)
            .when((pos == "v") | ((pos == "n") & ~F.array_contains(spec, st)), kids)
            .when(pos == "c", conn)
            .otherwise(F.array().cast("array<string>")))
    return _kept(out, st)


def clause_opinions(df: DataFrame, keyword_map: Column, negations, script: str,
                    tokens_col: str = "tokens") -> DataFrame:
    """OPN-5: aspect codes and opinion words of each clause (distinct, sorted).

    ``keyword_map`` is the taxonomy lookup, as a rule that of the clause's
    context (``routed_map``).  Only tokens that it holds are worked on; each
    aspect token's opinions (OPN-2) are refined (OPN-3) when they are other
    words of the clause.
    """
    df = stage(prepare(df, tokens_col).withColumn("_map", keyword_map).withColumn(
        "_hits", F.filter("_tok", lambda x: F.array_contains(F.map_keys("_map"), x["word"]))), "_map", "_hits")

    def per_token(x):
        code = F.try_element_at(F.col("_map"), x["word"])
        ops = aspect_opinion(x["i"], x["word"])
        refined = F.flatten(F.transform(ops, lambda k: F.when(
            (k != x["word"]) & F.array_contains(F.col("_w"), k), refine_opinion(k, negations, script))
            .otherwise(F.array(k))))
        return F.named_struct(F.lit("code"), code, F.lit("ops"), refined)

    df = stage(df.withColumn("_found", F.transform("_hits", per_token)), "_found")
    hits = F.col("_found")
    return df.select("*", F.array_sort(F.array_distinct(F.transform(hits, lambda s: s["code"]))).alias("codes"),
                     F.array_sort(F.array_distinct(F.flatten(F.transform(hits, lambda s: s["ops"])))).alias("opinions"))
