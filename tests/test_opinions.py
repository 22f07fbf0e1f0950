"""OPN-2..6 on literal annotated clauses; the expected words follow from the rules as SURVEY states them."""

import pytest
from pyspark.sql import functions as F

from voicelens.operators import aspects as AS
from voicelens.operators import opinions as OP
from voicelens.sources import fixtures as FX

SCHEMA = "clause_id long, tokens array<struct<i:int,word:string,pos:string,rel:string,head:int>>"

# one clause per rule: (word, pos, relation, head), the aspect's place, its opinion words
ASPECT_CASES = {
    "subject of a predicate preceded by an adverb": ([("food", "n", "SBV", 2), ("very", "d", "ADV", 2), ("good", "a", "HED", 0)], 0, ["verygood"]),
    "subject of the root": ([("food", "n", "SBV", 1), ("tastes", "v", "HED", 0), ("good", "a", "CMP", 1)], 0, ["tastes"]),
    "subject of a coordinated word": ([("x", "n", "HED", 0), ("food", "n", "SBV", 2), ("warm", "a", "COO", 0), ("fresh", "a", "RAD", 2)], 1, ["foodwarmfresh"]),
    "subject of an object": ([("say", "v", "HED", 0), ("food", "n", "SBV", 2), ("cold", "a", "VOB", 0)], 1, ["cold"]),
    "attribute of a subject": ([("meal", "n", "ATT", 1), ("taste", "n", "SBV", 2), ("good", "a", "HED", 0)], 0, ["good"]),
    "attribute of an object": ([("like", "v", "HED", 0), ("meal", "n", "ATT", 2), ("taste", "n", "VOB", 0)], 1, ["like"]),
    "attribute of a coordinated word": ([("like", "v", "HED", 0), ("meal", "n", "ATT", 2), ("taste", "n", "COO", 0)], 1, ["taste"]),
    "object with an adjective": ([("have", "v", "HED", 0), ("warm", "a", "ATT", 2), ("meal", "n", "VOB", 0)], 2, ["warm"]),
    "object without an adjective": ([("like", "v", "HED", 0), ("this", "r", "ATT", 2), ("meal", "n", "VOB", 0)], 2, ["like"]),
    "coordinated with a child": ([("seat", "n", "HED", 0), ("meal", "n", "COO", 0), ("warm", "a", "ATT", 1)], 1, ["warm"]),
    "another relation": ([("meal", "n", "POB", 9), ("x", "n", "RAD", 9)], 1, []),
}


def clause(spark, tokens):
    rows = [(1, [(i, *t) for i, t in enumerate(tokens)])]
    return OP.prepare(spark.createDataFrame(rows, SCHEMA))


@pytest.mark.parametrize("case", ASPECT_CASES)
def test_aspect_opinion(spark, case):
    tokens, at, expected = ASPECT_CASES[case]
    got = clause(spark, tokens).select(OP.aspect_opinion(F.lit(at), F.lit(tokens[at][0])).alias("o")).first().o
    assert got == expected


def test_refine_opinion(spark):
    tokens = [("not", "d", "ADV", 1), ("good", "a", "HED", 0), ("very", "d", "ADV", 3), ("run", "v", "COO", 1), ("and", "c", "LAD", 1)]
    df = clause(spark, tokens)
    refined = lambda w: df.select(OP.refine_opinion(F.lit(w), ["not"], "[a-z]").alias("o")).first().o
    assert refined("not") == ["notgood"]         # a negation takes the next word
    assert refined("run") == ["veryrun"]         # a verb takes the adverb before it
    assert refined("good") == ["good"]           # anything else stays
    assert refined("and") == ["and"]             # a connective without adjectival children stays


def test_refine_predicate(spark):
    get = lambda tokens: clause(spark, tokens).select(OP.refine_predicate(["not"], "[a-z]").alias("o")).first().o
    assert get([("we", "r", "SBV", 1), ("got", "v", "HED", 0), ("help", "v", "VOB", 1)]) == ["help"]
    assert get([("not", "d", "HED", 0), ("good", "a", "ADV", 0)]) == ["notgood"]
    assert get([("good", "a", "HED", 0)]) == ["good"]
    assert get([("x", "n", "SBV", 5)]) == []     # no root


def test_clause_opinions(spark):
    rows = [(1, [(0, "Meal", "n", "SBV", 2), (1, "very", "d", "ADV", 2), (2, "good", "a", "HED", 0)]),
            (2, [(0, "nothing", "n", "HED", 0)])]
    df = spark.createDataFrame(rows, SCHEMA)
    lookup = AS.AspectLookup(rows=[(1, "Meal", "B1")])
    got = {r.clause_id: (r.codes, r.opinions) for r in OP.clause_opinions(df, lookup.m_all(), FX.NEGATIONS, "[a-z]").collect()}
    assert got == {1: (["B1"], ["verygood"]), 2: ([], [])}


def test_negated_opinions(spark):
    df = clause(spark, [("no", "d", "ADV", 1), ("meal", "n", "HED", 0), ("not", "d", "ADV", 0)])
    assert df.select(OP.negated_opinions("tokens", ["no", "not"], "[a-z]").alias("o")).first().o == ["nomeal"]
