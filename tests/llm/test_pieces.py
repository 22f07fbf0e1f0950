import math
from collections import Counter

import numpy as np
import pytest

from voicelens.llm import pieces as P

TEXTS = ["", " ", "a  b", " a", "a\nb\t", "▁x y▁ ▁▁", "   ", "日本語 é😀", "the thing", "word " * 30_000, "x" * 3000, "ein Wort, noch eins.", "\u00a0 \u2028"]


@pytest.fixture(scope="module")
def model():
    return P.Pieces(P.default_model(), 1.0)


def test_every_text_comes_back(model):
    for ids, text in zip(model.encode(TEXTS, list(range(len(TEXTS))), 7), TEXTS, strict=True):
        assert model.decode(ids.tolist()) == text


def paths(model, word):
    """Weight of each segmentation of a word by listing all of them."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=P.default_model())
    weight = {sp.id_to_piece(i): (i, math.exp(model.weight[i])) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}

    def walk(rest):
        if not rest:
            yield (), 1.0
        for n in range(1, len(rest) + 1):
            if rest[:n] in weight:
                for ids, w in walk(rest[n:]):
                    yield (weight[rest[:n]][0], *ids), w * weight[rest[:n]][1]
    return dict(walk("▁" + word))


def test_samples_follow_the_lattice(model):
    expected = paths(model, "thing")
    total = sum(expected.values())
    n = 20_000
    seen = Counter(tuple(i.tolist()) for i in model.encode(["thing"] * n, list(range(n)), 3))
    assert set(seen) <= set(expected)
    for ids, w in expected.items():
        p = w / total
        assert abs(seen[ids] / n - p) <= 5 * math.sqrt(p * (1 - p) / n) + 1e-9


def test_reproducible_by_row_key(spark, model):
    rows = [(i, t, 5) for i, t in enumerate(TEXTS)] + [(3, " a", 5), (None, "the thing", 5), (77, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    one = {(r.doc_id, r.n_pieces): r.ids for r in P.sample_pieces(docs).collect()}
    two = {(r.doc_id, r.n_pieces): r.ids for r in P.sample_pieces(docs.repartition(5)).collect()}
    assert one == two
    got = P.sample_pieces(docs)
    assert got.where("not restored").count() == 0 and got.where("doc_id = 77").first().n_pieces == 0
    alone = model.encode([TEXTS[11]], [11], 7)[0].tolist()
    assert got.where("doc_id = 11").first().ids == alone
    texts = {r.doc_id: r.text for r in P.decode_pieces(got.where("doc_id is not null")).collect()}
    assert all(texts[i] == t for i, t in enumerate(TEXTS))
    assert P.sample_pieces(docs.limit(0)).count() == 0
    assert model.encode(["the thing " * 50], [1], 7)[0].tolist() != model.encode(["the thing " * 50], [2], 7)[0].tolist()


def test_unequal_words_with_equal_hashes_are_kept_apart(model, monkeypatch):
    monkeypatch.setattr(np, "unique", lambda h, **k: (h[:1], np.zeros(1, int), np.zeros(len(h), int)))
    ids = model.encode(["one two three"], [1], 7)[0]
    assert model.decode(ids.tolist()) == "one two three"
