"""The pipeline's stages against brute force, and the whole of it."""

from collections import Counter

import corpus_pipeline as pipeline
import pytest

from transit_prices.llm import mixing, quality, simhash
from transit_prices.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages(spark, odd_docs):
    docs = odd_docs
    columns, seen = docs.columns, []
    extra = columns[5:]  # no stage changes columns that it does not own
    values = {tuple(r[c] for c in extra) for r in docs.collect()}
    for name, stage in pipeline.STAGES:
        before = docs.collect()
        docs = pipeline.written(stage(spark, docs, SF))
        seen.append((name, before, docs.collect()))
        if name != "encode":
            assert docs.columns == columns
            assert {tuple(r[c] for c in extra) for r in docs.collect()} <= values
    kept = {n: after for n, _, after in seen}
    rows = seen[0][1]
    good = [r for r in rows if quality.measure([(r["text"] or "").encode()])[0][0] >= 50]
    assert {r["doc_id"] for r in kept["quality_rules"]} <= {r["doc_id"] for r in good}
    # no two near copies stay, and every group keeps one
    before = {r["doc_id"]: simhash.fingerprint(r["text"].encode()) for r in kept["quality_rules"]}
    after = [r["doc_id"] for r in kept["near_duplicates"]]
    assert len(after) == len(set(after))
    fps = {d: before[d] for d in after}
    assert all((fps[a] ^ fps[b]).bit_count() > 3 for a in fps for b in fps if a < b)
    assert {r["doc_id"] for r in kept["substring_dedup"]} == set(after)
    for r in kept["substring_dedup"]:
        assert r["n_chars"] == len(r["text"])
    plan = Counter({r["doc_id"]: r["copies"] for r in mixing.mix(spark.createDataFrame(kept["substring_dedup"], odd_docs.schema)).collect() if r["size"]})
    assert Counter(r["doc_id"] for r in kept["mix_sources"]) == +plan
    assert len(kept["encode"]) == len(kept["mix_sources"]) and all(r["n_tokens"] == len(r["ids"]) for r in kept["encode"])


def test_empty_table(spark, no_docs):
    docs = no_docs
    for _, stage in pipeline.STAGES:
        docs = pipeline.written(stage(spark, docs, SF))
    assert docs.count() == 0


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "op13_negatives"])
def test_queries_return_every_row(spark, name):
    got = QUERIES[name](spark, SF)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    n = {"op10_top_k": 50, "op11_repair": spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()}.get(name, n)
    assert got.count() == n
