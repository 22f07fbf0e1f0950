"""PIP-3 tag_reviews: clause cascade, labels, opinions, merge, flags.

All per-review work happens inside the review row with higher-order array
functions (CLS-3 cascade, CLS-4 clause numbers, CLS-5 labels, AGG-10 merge),
then one ``explode`` emits the tagged rows.  No shuffle: review attributes
travel with the row, so the join of clauses with reviews (JON-1) is free and
a carrier or airport holding a third of the rows causes no skew here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as LX
from ..functions import patterns as P
from ..functions.clauses import split_clauses, split_subclauses
from ..functions.stage import bind, stage
from ..functions.text import _array_lit, collapse_repeats, has_letter, recompose, tokenize
from ..operators.aspects import (AspectLookup, codes_of, count_codes, is_multi_aspect, known_words, onehot_aspects,
                                 routed_codes, target_object_of)
from ..operators.summary import extractive_summary
from ..session import written
from ..sources import fixtures as FX

#: Clauses of more units are summarised before they are recomposed (SUM-1).
SUMMARY_UNITS = 10


@dataclass
class TagConfig:
    lookup: AspectLookup
    stopwords: list = field(default_factory=lambda: list(FX.STOPWORDS))
    facility_words: list = field(default_factory=lambda: list(FX.FACILITY_WORDS))
    airport_substring: str = LX.AIRPORT_SUBSTRING
    connectors: list = field(default_factory=lambda: list(LX.CONNECTORS))
    lexicon: list = field(default_factory=list)  # further Han words that tokens may be

    @property
    def letters_only(self) -> bool:
        """No keyword is a number or a single sign of ASCII, so a keyword in one run of letters is the run."""
        return all(not k.isascii() or k.isalpha() for k in self.lookup.keywords)

    @property
    def terms(self) -> list:
        return [*self.lookup.keywords, *self.facility_words, *self.connectors, *self.stopwords, *self.lexicon]


def clause_cascade(text: Column, irr_f: Column, cfg: TagConfig) -> Column:
    """CLS-3: the list of clauses of a review.

    Whole text if it has at most one aspect (or two with the irregular-flight
    code); else clauses of the collapsed text, each multi-aspect clause split
    again into sub-clauses of its collapsed form.
    """
    def multi(x):
        return is_multi_aspect(count_codes(tokenize(x, terms=cfg.terms), irr_f, cfg.lookup))

    def multi_clause(c):
        return ~c.rlike(P.jvm(P.ONE_RUN)) & multi(c) if cfg.letters_only else multi(c)  # one run is one keyword at most

    level1 = F.when(multi(text), split_clauses(collapse_repeats(text, cfg.terms), cfg.connectors, cfg.terms)).otherwise(F.array(text))
    return bind(level1, lambda l1: F.when(F.exists(l1, multi_clause), F.flatten(F.transform(
        l1, lambda c: F.when(multi_clause(c), split_subclauses(collapse_repeats(c, cfg.terms))).otherwise(F.array(c))))).otherwise(l1))


def opinion_candidates(tokens: Column, cfg: TagConfig) -> Column:
    """Opinion words of a clause without a parse: its letter tokens that are no
    aspect keyword and no stopword, distinct, in order."""
    words = F.filter(tokens, lambda t: t.rlike(P.jvm(P.LETTER_TOKEN)))
    return F.array_except(words, _array_lit(cfg.lookup.keywords + list(cfg.stopwords)))


def summarised_clauses(df: DataFrame, cfg: TagConfig, text_col: str = "evaluated_text") -> DataFrame:
    """(id, irr_f, comment, _summaries): the clause lists, and of each clause of more than ``SUMMARY_UNITS`` units its place and summary.

    Rows with equal or null ids keep a row each.
    """
    rows = written(df.select("id", "irr_f", clause_cascade(F.col(text_col), F.col("irr_f"), cfg).alias("comment"),
                             F.monotonically_increasing_id().alias("_row")), "review-clauses")
    clauses = rows.select("_row", F.posexplode("comment").alias("pos", "text"))
    # a unit has a character at least
    long_ = clauses.where((F.length("text") > SUMMARY_UNITS) & (F.size(split_subclauses(F.col("text"))) > SUMMARY_UNITS))
    summaries = extractive_summary(long_.select(F.struct("_row", "pos").alias("doc_id"), "text"), size=SUMMARY_UNITS)
    lists = summaries.groupBy(F.col("doc_id._row").alias("_row")).agg(
        F.collect_list(F.struct(F.col("doc_id.pos").alias("pos"), "summary")).alias("_summaries"))  # of one review
    return rows.join(lists, "_row", "left").select("id", "irr_f", "comment", "_summaries")


def label_clauses(df: DataFrame, cfg: TagConfig, text_col: str = "evaluated_text", summaries: str | None = None) -> DataFrame:
    """Adds ``comment`` (the clause list) and ``_items``: labelled clause structs.

    With the column ``summaries`` of ``summarised_clauses`` long clauses are recomposed from their summaries, and
    the opinions of a clause are those of the raw and of the recomposed clause (SET-3).
    """
    if summaries is None:
        df = stage(df.withColumn("comment", clause_cascade(F.col(text_col), F.col("irr_f"), cfg)), "comment")
    irr = F.col("irr_f")

    def codes_in(s):
        return routed_codes(tokenize(s, terms=cfg.terms), s, irr, cfg.lookup, cfg.facility_words, cfg.airport_substring)

    def hopeful(s):
        # a clause of one run has a keyword as it is or has none recomposed either
        if cfg.letters_only:
            return F.lower(F.regexp_extract(s, P.jvm(P.THE_RUN), 1)).isin(["", *cfg.lookup.keywords])  # "": more than one run
        return ~s.rlike(P.jvm(P.ONE_RUN)) | (F.size(known_words(tokenize(s), cfg.lookup)) > 0)

    def item(s, i):
        short = s if summaries is None else F.coalesce(F.get(F.filter(summaries, lambda x: x["pos"] == i), 0)["summary"], s)
        return F.when(hopeful(s) & has_letter(s), F.struct(i.alias("pos"), s.alias("view"), recompose(short, cfg.stopwords, cfg.terms).alias("view_n")))

    def labelled(x):
        codes = bind(codes_in(x["view_n"]), lambda c: F.when(F.size(c) > 0, c).otherwise(codes_in(x["view"])))
        return F.struct(x["pos"].alias("pos"), x["view"].alias("view"), x["view_n"].alias("view_n"), codes.alias("codes"))

    def numbered(x):
        # CLS-4: clause number = first position of an equal clause; like the opinions only for labelled clauses
        opinions = [opinion_candidates(tokenize(x[c], terms=cfg.terms), cfg) for c in ("view", "view_n")]
        hed = opinions[0] if summaries is None else F.array_union(*opinions)
        return F.struct(x["pos"].alias("pos"), x["view"].alias("view"), x["view_n"].alias("view_n"), x["codes"].alias("codes"),
                        hed.alias("hed"),
                        F.array_position(F.col("comment"), x["view"]).cast("int").alias("chilid"),
                        F.array_join(x["codes"], "、").alias("lable"))

    items = F.filter(F.transform("comment", item), lambda x: x.isNotNull())
    items = F.filter(F.transform(items, labelled), lambda x: F.size(x["codes"]) > 0)
    return df.withColumn("_items", F.transform(items, numbered))


def merge_same_label(items: Column) -> Column:
    """AGG-10: clauses of a review with equal labels → one entry, in first-seen order.

    Texts are concatenated in clause order, the clause number is the first
    one's, opinions are the ordered union.
    """
    labels = F.array_distinct(F.transform(items, lambda x: x["lable"]))

    def merged(lab, g):
        first = F.element_at(g, 1)
        return F.struct(
            first["chilid"].alias("chilid"),
            F.array_join(F.transform(g, lambda x: x["view"]), "").alias("view"),
            F.array_join(F.transform(g, lambda x: x["view_n"]), "").alias("view_n"),
            lab.alias("lable"),
            first["codes"].alias("codes"),
            F.array_distinct(F.flatten(F.transform(g, lambda x: x["hed"]))).alias("hed"),
        )

    return F.transform(labels, lambda lab: bind(F.filter(items, lambda x: x["lable"] == lab), lambda g: merged(lab, g)))


def union_keywords(clean: DataFrame, cfg: TagConfig) -> DataFrame:
    """SET-3: (id, chilid, opinions): the opinion words of the raw clauses and of the recomposed ones, in their order, per merged row."""
    df = stage(label_clauses(summarised_clauses(clean, cfg), cfg, summaries="_summaries"), "_items")
    rows = df.select("id", F.explode(merge_same_label(F.col("_items"))).alias("m"))
    return rows.select("id", F.col("m.chilid").alias("chilid"), F.array_join("m.hed", "|").alias("opinions"))


TAGGED_ATTRS = ["fnum", "irr_f", "user_cabin", "dep_code", "arr_code", "fdate", "period_m", "period_w",
                "airline"]


def tag_reviews(clean: DataFrame, cfg: TagConfig, keep_comment: bool = True, extra_cols=("emo",)) -> DataFrame:
    """PIP-3: cleaned reviews → tagged clause rows (PRJ-1 contract order)."""
    df = stage(label_clauses(clean, cfg), "_items")
    extras = [c for c in extra_cols if c in clean.columns]
    keep = ["id"] + (["comment"] if keep_comment else []) + [c for c in TAGGED_ATTRS if c in clean.columns] + extras
    # exploded as an expression: of a column Spark would infer a filter that merges once more
    rows = df.select(*keep, F.explode(merge_same_label(F.col("_items"))).alias("m"))
    flags = onehot_aspects(F.col("m.codes"))
    out = rows.select(
        "id",
        *(["comment"] if keep_comment else []),
        F.col("m.chilid").alias("chilid"),
        F.col("m.view").alias("view"),
        F.col("m.view_n").alias("view_n"),
        F.col("m.lable").alias("lable"),
        F.col("m.codes").alias("codes"),
        F.col("m.hed").alias("hed"),
        *[c for c in TAGGED_ATTRS if c in clean.columns],
        *flags,
        target_object_of(F.col("m.codes")).alias("ADO"),
        *extras,
    )
    return out


def tagged_contract(tagged: DataFrame) -> DataFrame:
    """PRJ-1: the 32-column output contract (joined strings at the sink only)."""
    cols = ["id", F.col("comment"), "chilid", "view", "view_n", "lable",
            F.array_join("hed", "、").alias("hed"), "fnum", "irr_f", F.col("user_cabin").alias("fspace"),
            "dep_code", "arr_code", "fdate", "period_m", "period_w", "airline", *LX.ALL_CODES[:9],
            *LX.AIRPORT_CODES, "JGP", "ADO"]
    return tagged.select(*cols)
