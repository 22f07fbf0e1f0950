import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from voicelens.llm import packing as K

TEXTS = ["", " ", "  ", "a  b", "a \n b", "\n", "a\n b ", " a", "x\t y", "don't  stop", " b", "é ü  ", "<|endoftext|> a<|endoftext|>", "日本 x", "word " * 5000]


def reference():
    t = Tokenizer.from_file(K.default_tokenizer())
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_read_as_the_library_reads_them():
    assert list(OWN("a <|endoftext|>b")) == [64, 220, 50256, 65]


REF, OWN = reference(), K.ranked_encoder(K.default_tokenizer())


@settings(max_examples=150, deadline=None)
@given(st.text())
def test_ids_equal_the_library(text):
    assert list(OWN(text)) == REF(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=80), st.integers(1, 6), st.integers(4096, 9000), st.sampled_from(["norm", "dot"]))
def test_capacities_hold_and_offsets_are_gapless(lengths, most, attention, rule):
    lengths = np.array(lengths)
    seq, off = K.best_fit(lengths, np.array([64, most, attention]), np.array([1.0, 0.3, 0.3]), rule)
    for s in set(seq.tolist()):
        own = seq == s
        assert lengths[own].sum() <= 64 and own.sum() <= most and (lengths[own] ** 2).sum() <= attention
        at = 0
        for o, n in sorted(zip(off[own].tolist(), lengths[own].tolist(), strict=True)):
            assert o == at
            at += n


def test_too_large_piece_is_an_error():
    with pytest.raises(ValueError):
        K.best_fit(np.array([65]), np.array([64, 9, 99999]), np.ones(3), "norm")


def test_query_rows(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(100, None, "x", 1), (None, "a", "x", 1), (3, "a  b", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece string, length int")
    got = K.pack_documents(docs, rows_per_group=5).collect()
    expected = []
    for d, t, *_ in rows:
        ids = [*REF(t or ""), 0]
        for k, (s, n) in enumerate(K.cut_points(len(ids), 2048)):
            expected.append((d, k, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())))
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(expected, key=key)
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in held.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= 2048
    assert K.pack_documents(docs.limit(0)).count() == 0


def test_few_sequences(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = K.pack_documents(docs).toPandas()
    assert got["sequence_id"].nunique() <= -(-got["length"].sum() // 2048) + 1


def test_other_capacities_bind_and_equal_rows_spread(spark):
    docs = spark.createDataFrame([(7, "same words")] * 3000, "doc_id long, text string").repartition(4)
    got = K.pack_documents(docs, max_documents=3, rows_per_group=300).toPandas()
    assert len(got) == 3000 and got.groupby("sequence_id").size().max() == 3
    assert got["sequence_id"].nunique() <= 1000 + 10
    got = K.pack_documents(docs, max_attention=2048 ** 2, max_documents=2048, rule="dot", rows_per_group=300).toPandas()
    length = got["length"].iloc[0]
    tight = K.pack(K.tokenise(docs), max_attention=int(5 * length ** 2), rows_per_group=300).toPandas()
    assert tight.groupby("sequence_id").size().max() == 5
    groups = K.pack(K.tokenise(docs), rows_per_group=300).toPandas()["sequence_id"] % 10
    assert groups.value_counts().max() < 600
