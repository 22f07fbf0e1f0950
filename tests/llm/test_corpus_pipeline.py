import corpus_pipeline as P
from tests.llm.test_jaccard_join import brute as near_brute
from voicelens.llm import packing, quality, secrets

DIR = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    out = docs
    seen = {}
    for name, stage in P.STAGES:
        out = stage(spark, out, DIR)
        seen[name] = out.collect()
        if name != "packing":
            assert out.columns == docs.columns
        if name == "quality":
            out = spark.createDataFrame(seen[name], docs.schema)
    model = quality.train(docs, spark.read.parquet(f"{DIR}/labels.parquet"))
    good = [d for d, r in rows.items() if model.tails(quality.features(r.text))[-1] >= 0.5]
    assert sorted(r.doc_id for r in seen["quality"]) == sorted(good) and len(good) < len(rows)
    last = {}
    for d in good:
        last[rows[d].text] = max(d, last.get(rows[d].text, -1))
    assert sorted(r.doc_id for r in seen["exact_dedup"]) == sorted(last.values())
    near = near_brute([(d, rows[d].text) for d in last.values()])
    stay = sorted(d for d, _, c in near if d == c)
    assert sorted(r.doc_id for r in seen["near_dedup"]) == stay
    assert {r.doc_id: r.text for r in seen["secrets"]} == {d: secrets.masked(rows[d].text) for d in stay}
    assert all(r.n_chars == len(r.text) for r in seen["secrets"] if r.text != rows[r.doc_id].text)
    encode = packing.ranked_encoder(packing.default_tokenizer())
    held = {}
    for r in seen["packing"]:
        held[r.doc_id] = held.get(r.doc_id, 0) + r.length
    assert held == {d: len(encode(secrets.masked(rows[d].text))) + 1 for d in stay}


def test_run_and_empty(spark):
    rows = P.run(spark, DIR).collect()
    assert rows and rows[0].__fields__ == [c.split()[0] for c in packing.PACKED_SCHEMA.split(", ")]
    empty = spark.read.parquet(f"{DIR}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        empty = stage(spark, empty, DIR)
        assert empty.count() == 0
