import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from voicelens.llm import prefix_trie as T


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(r, t) for _, r, _, t in sorted(x)] for c, x in own.items()}
    member = defaultdict(list)
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
        for d in range(len(made[c]) + 1):
            member[made[c][:d]].append(c)
    kids = defaultdict(int)
    for p in member:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in member.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1].encode()) if p else 0)
    end = defaultdict(list)
    for c in sorted(made):
        end[made[c]].append(str(c))
    return sorted((min(m), len(p), min(member[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(",".join(end[p]).encode()).hexdigest()) for p, m in member.items())


def check(spark, rows):
    df = spark.createDataFrame([(*r, 0, 1) for r in rows], "conv_id long, turn long, role string, text string, d int, k int").repartition(3)
    got = T.conversation_trie(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in got.collect())
    assert got == brute(rows)
    return got


def test_whole_table_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert len(check(spark, rows)) > 100


def test_edges_of_the_contract(spark):
    check(spark, [])
    check(spark, [(None, 1, "user", "no conversation")])
    got = check(spark, [(3, None, None, None), (3, 0, "user", ""), (3, 0, "user", ""), (8, 1, "a", "b"), (8, None, "user", "ü" * 50)])
    assert got[0][1] == 0
    check(spark, [(c, 0, "user", "only") for c in range(40)])                                  # many become turnless


def test_hot_copies_chains_and_long_conversations(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 300, 5) for t in range(12)]             # one conversation, copied
    rows += [(c, t, "user", f"turn {t}" if t < c % 11 else f"{c} {t}") for c in range(1000, 1040) for t in range(14)]
    rows += [(c, t, "user", f"long {t}" if t < c - 2000 else "left") for c in range(2000, 2060, 5) for t in range(60)]
    rows += [(9_000, t, "user", f"long {t}") for t in range(700)] + [(4611686018427387900 + c, 0, "x", "same first") for c in range(8)]
    check(spark, rows)


@pytest.mark.parametrize("a,b,f", [(0, 1, 1), (0, 5, 4), (4, 5, 5), (4, 7, 6), (3, 9, 8), (8, 15, 12), (5, 6, 6)])
def test_two_fattest(spark, a, b, f):
    assert spark.range(1).select(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")).select(T.fattest("a", "b")).first()[0] == f


def test_handles_are_unique_and_searches_find_every_string(spark):
    turns = T.numbered_turns(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))
    convs, rebuilt = T.rebuilt_turns(T.written(turns, "test-turns"))
    whole = T.prefix_strings(convs, rebuilt).withColumnRenamed("conv_id", "sid")
    strings = T.written(whole.select("*", T.at("pa", "k").alias("ka")).dropDuplicates(["k", "ka"]).drop("ka"), "test-strings")
    nodes = T.build(strings)
    handles = nodes.where("f > 0").select("f", "fa", "fb")
    assert handles.count() == handles.distinct().count() == nodes.count() - 1 <= 2 * strings.count()
    found = T.locate(strings.where("k > 0").withColumn("a", F.lit(0).cast("long")), nodes, 4)
    assert found.where("l != k or exit_d is not null").count() == 0
