import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from voicelens.llm import exact_dedup as D


def slow_hash(data):
    out = [0, 0]
    for byte in data:
        out = [(h * b + byte) % p for h, b, p in zip(out, D.BASES, D.PRIMES, strict=True)]
    return tuple(out)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=400), st.binary(max_size=400))
def test_hash_composes(a, b):
    one = lambda d: D.chunk_hash(np.frombuffer(d, np.uint8))
    assert one(a) == slow_hash(a)
    assert D.combine(one(a), one(b), len(b)) == one(a + b)


def test_long_text_by_chunks():
    data = bytes(range(256)) * 1000
    h = slow_hash(data)
    assert D.fingerprint(data) == h[0] << 31 | h[1]


def brute(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    least = float("-inf")
    return sorted((d, max(groups[t or ""], key=lambda x: least if x is None else x), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows)


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = D.exact_dedup(docs).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r[:3]) + (r[3],)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) == sorted(brute(rows), key=key)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({t or "" for _, t in rows}) and all(r.doc_id == r.keep_id for r in kept)


def test_equals_brute_force(spark):
    rows = [(i, f"text {i % 37}" * (i % 5 + 1)) for i in range(600)] + [(1000 + i, "hot") for i in range(1300)]
    check(spark, rows + [(5000, None), (5001, ""), (5002, " "), (7, "text 7"), (7, "text 7"), (8, "é" * 200_000), (9, "é" * 200_000)])
    assert D.exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_unequal_texts_under_one_fingerprint(spark, monkeypatch):
    rows = [(i, f"{i % 3:04d}") for i in range(30)] + [(90, "12345")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    keys = D.text_keys
    monkeypatch.setattr(D, "text_keys", lambda d: keys(d).selectExpr("row_id", "doc_id", "n_bytes", "0L as fingerprint", "text_sha256"))

    def differing(docs, groups):
        rows = [(0, 4, hashlib.sha256(f"{k:04d}".encode()).hexdigest()) for k in (1, 2)]
        return spark.createDataFrame(rows, "fingerprint long, n_bytes long, text_sha256 string")
    monkeypatch.setattr(D, "_differing", differing)
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in D.exact_dedup(docs).collect())
    assert got == brute(rows)


def test_comparison_finds_differing_texts(spark):
    docs = spark.createDataFrame([(i, "é" * 70_000 + str(i % 2)) for i in range(8)] + [(20, "b")], "doc_id long, text string")
    keys = D.text_keys(docs).toPandas()
    real = dict(zip(keys["doc_id"], keys["fingerprint"], strict=True))
    groups = [(real[0], 140_001, 4, 6), (real[1], 140_001, 4, 7)]
    schema = "fingerprint long, n_bytes long, group_size long, keep_id long"
    assert D._differing(docs, spark.createDataFrame(groups, schema)).count() == 0


def test_comparison_stands_behind_the_fingerprint():
    texts = ["é" * 40_000, "é" * 40_000, "é" * 39_999 + "è", "other group", "other grouq", "é" * 40_000]
    groups = [(1, 80_000, 0), (1, 80_000, 0), (1, 80_000, 0), (2, 11, 0), (2, 11, 0), (1, 80_000, 1)]
    columns = [pa.array(c) for c in zip(*groups, strict=True)]
    batch = pa.RecordBatch.from_arrays([*columns[:2], pa.array([t.encode() for t in texts]), columns[2]], names=["fingerprint", "n_bytes", "bytes", "salt"])
    found = [r for b in D.differing_texts(iter([batch.slice(0, 1), batch.slice(1, 3), batch.slice(4)])) for r in b.to_pylist()]
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert found == [{"fingerprint": 1, "n_bytes": 80_000, "text_sha256": digest(texts[2])}, {"fingerprint": 2, "n_bytes": 11, "text_sha256": digest(texts[4])}]


def test_parts_and_pipeline_rows(spark):
    parts = spark.createDataFrame([(1, 0, "ab"), (1, 1, None), (1, 2, "cé"), (2, 0, "abcé"), (3, 0, "")], "doc long, part int, text string")
    got = {r.doc: (r.n_bytes, r.fingerprint) for r in D.fingerprint_parts(parts, "doc", "part", "text").collect()}
    assert got[1] == got[2] == (5, D.fingerprint("abcé".encode())) and got[3] == (0, 0)
    docs = spark.createDataFrame([(1, "x", "a", 3), (2, "x", "b", 3), (2, "x", "b", 3), (3, "y", "c", 3), (3, "z", "c", 3), (None, "q", "c", 3)], "doc_id long, text string, kept string, fingerprint int")
    rows = D.kept_documents(docs)
    assert rows.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in rows.collect()) == [("2", "x"), ("3", "y"), ("3", "z"), ("None", "q")]
