"""op8 learns from every labelled row outside the held-out fold."""

import dataclasses

import numpy as np
from pyspark.sql import functions as F

from starkpi.llm import toxicity


def _texts(spark, n):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("aeioubdklmnrst"), 5)) for _ in range(50)]
    # every toxic text has one of twelve words of its own that share no beginning
    bad = [c * 3 + "qx" for c in "abcdefghijkl"]
    rows = []
    for i in range(n):
        t = list(rng.choice(words, 12))
        if i % 3 == 0:
            t[rng.integers(12)] = bad[i // 3 % len(bad)]
        rows.append((i, " ".join(t), int(i % 3 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return rows, docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")


def test_counts_come_from_every_labelled_row(spark):
    n = 9_900  # above the 8,000 rows that a shard has
    rows, docs, labels = _texts(spark, n)
    model = toxicity.fit(docs, labels)
    used = toxicity.training_rows(docs, labels)
    held = docs.where(toxicity.in_fold(F.col("doc_id"))).count()
    assert used.count() == n - held and used.select("__id").distinct().count() == n - held
    key = toxicity.keys_of(rows[0][1].split()[0])[0]
    got = {r.key % 2 ** 64: (r["has"], r.toxic) for r in toxicity.key_counts(used).collect()}
    train = {r[0] for r in used.select("__id").collect()}
    having = [y for i, t, y in rows if i in train and rows[0][1].split()[0] in t.split()]
    assert got[key] == (len(having), sum(having)) and key in model.keys


def test_shards_learn_together(spark):
    rows, docs, labels = _texts(spark, 1200)
    settings = dataclasses.replace(toxicity.Settings(), shard_rows=150, block_words=500)
    model = toxicity.fit(docs, labels, settings)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = {r.doc_id for r in docs.where(toxicity.in_fold(F.col("doc_id"))).collect()}
    assert np.mean([(got[i] >= 0.5) == (y == 1) for i, _, y in rows if i in held]) > 0.95
    again = toxicity.fit(docs, labels, settings)
    assert np.allclose(again.table, model.table, atol=1e-6) and np.array_equal(again.threshold, model.threshold)


def test_texts_without_a_label_are_not_shuffled(spark):
    docs = spark.range(-3000, 3000).selectExpr("id AS __id", "concat('text ', id) AS __text")
    for kind in ("long", "string"):
        texts = docs.withColumn("__id", F.col("__id").cast(kind))
        lab = texts.where("pmod(cast(__id as long), 7) = 3").select("__id")
        left = {r[0] for r in toxicity.labelled_first(texts, lab).select("__id").collect()}
        wanted = {r[0] for r in lab.collect()}
        assert wanted <= left and len(left) < len(wanted) + 10
    # keys of two types are equal to the join but not to a hash
    assert toxicity.labelled_first(docs, lab).count() == docs.count()


def test_every_labelled_text_is_learnt_whatever_the_sieve_lets_through(spark, monkeypatch):
    rows, docs, labels = _texts(spark, 300)
    labels = labels.where("doc_id % 4 < 2").unionByName(labels.where("doc_id % 8 = 0"))
    docs = docs.unionByName(docs.where("doc_id % 5 = 1").withColumn("text", F.concat(F.lit("a "), "text")))
    wanted = sorted(map(str, toxicity.training_rows(docs, labels).collect()))
    monkeypatch.setattr(toxicity, "_SIEVE", 8)
    assert sorted(map(str, toxicity.training_rows(docs, labels).collect())) == wanted
    monkeypatch.setattr(toxicity, "labelled_first", lambda texts, lab: texts)
    assert sorted(map(str, toxicity.training_rows(docs, labels).collect())) == wanted
