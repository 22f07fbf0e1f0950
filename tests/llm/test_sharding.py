import zlib
from collections import defaultdict

from voicelens.llm import sharding as S


def check(spark, rows, shards=16):
    docs = spark.createDataFrame(rows, "doc_id long, text string, size string, range int").repartition(3)
    got = S.shard(docs, shards).collect()
    size = lambda t: len((t or "").encode()) + 1
    crc = lambda t: zlib.crc32((t or "").encode())
    key = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=key) == sorted(((d, size(t), crc(t)) for d, t, *_ in rows), key=key)
    held, slots = defaultdict(int), defaultdict(list)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        held[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if got:
        largest, mean = max(r.size for r in got), sum(held.values()) / shards
        assert all(abs(held[k] - mean) <= largest for k in range(shards))
    return held


def test_sizes_are_near_equal(spark):
    check(spark, [(i, "x" * (i * 7919 % 3000), "", 0) for i in range(4000)])
    check(spark, [(i, "copied " * 30 if i % 3 else f"own text {i}", "", 0) for i in range(6000)])
    check(spark, [(5, "same row", "", 0)] * 900 + [(None, None, "", 0)] * 300)


def test_edges(spark):
    check(spark, [])
    check(spark, [(1, None, "", 0), (1, "", "", 0), (2, "é" * 100_000, "", 0)], shards=3)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = S.records(docs)
    n, b = rows.count(), rows.groupBy().sum("size").first()[0]
    cuts = S.splitters(rows, n, b, 64)
    assert 40 <= cuts.count() <= 63
    assert S.in_ranges(rows, cuts).groupBy("range").count().agg({"count": "max"}).first()[0] < 8 * n / 64
