"""The corpus pipeline: documents through filtering, de-duplication, scrubbing, mixing and
tokenizing, every stage a call of one operator of ``starkpi.llm``.

``run`` applies STAGES one after the other; each result is written as Parquet under
``spark.checkpoint.dir`` and read again, so that a lost executor costs at most the stage
it was in."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from starkpi.llm import bpe, mixing, secret_scan, simhash, toxicity
from starkpi.llm.queries import vocabulary
from starkpi.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, takes for toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near duplicates stays: that with the smallest id."""
    return simhash.keep_first(docs, shingle=3, radius=3)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets and the credentials linked to them become a placeholder."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by code point weigh 3, 1, 2, repeating, and share one and a half times all words."""
    return mixing.mix(docs, [3, 1, 2], budget=1.5, max_repeat=2.0)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256): the ids of each text, and the digest
    of what they decode to, which is the text's own."""
    return bpe.digests(bpe.roundtrip(docs, vocabulary("byte_bpe_50k.tiktoken")), "doc_id", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
    ("byte_bpe", tokenize),
]

# Hashing with XXH64 and the toxicity model have no SQL form; tests/llm holds the run
# against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{root}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
