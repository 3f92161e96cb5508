"""The pipeline, stage by stage, against what each stage must do."""

import hashlib

import corpus_pipeline
from starkpi.llm import simhash
from tests.conftest import SF_SMALL


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    seen, columns = [docs], docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_SMALL).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        seen.append(docs)
        assert docs.columns == columns or i == len(corpus_pipeline.STAGES) - 1
    given, clean, single, safe, mixed, coded = [[r.asDict() for r in d.collect()] for d in seen]
    assert 0 < len(clean) < len(given)
    # near duplicates: one row of each component, with its smallest id
    fps = [simhash.text_fingerprint(r["text"]) for r in clean]
    low = list(range(len(clean)))
    for _ in clean:
        new = [min((low[j] for j in range(len(clean)) if (fps[i] ^ fps[j]).bit_count() <= 3)) for i in range(len(clean))]
        if new == low:
            break
        low = new
    keep = {min(r["doc_id"] for r, k in zip(clean, low) if k == root) for root in set(low)}
    assert sorted(r["doc_id"] for r in single) == sorted(keep)
    # secrets: the same documents, some with placeholders
    before = {r["doc_id"]: r["text"] for r in single}
    assert sorted(before) == sorted(r["doc_id"] for r in safe)
    assert all(r["text"] == before[r["doc_id"]] or "[SECRET]" in r["text"] for r in safe)
    # mixing: whole documents, at most twice
    texts = {r["doc_id"]: r["text"] for r in safe}
    times = [sum(m["doc_id"] == i for m in mixed) for i in texts]
    assert max(times) <= 2 and all(m["text"] == texts[m["doc_id"]] for m in mixed)
    # tokens: a row per mixed row, decoding to its text
    assert sorted(r["decoded_sha256"] for r in coded) == sorted(hashlib.sha256(m["text"].encode()).hexdigest() for m in mixed)
    assert all(r["n_tokens"] == len(r["ids"]) for r in coded)


def test_run_is_repeatable(spark):
    first = corpus_pipeline.run(spark, SF_SMALL)
    again = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted(r.ids_sha256 for r in first.collect()) == sorted(r.ids_sha256 for r in again.collect())
