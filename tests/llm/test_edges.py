"""NULLs, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from starkpi.llm import bpe, licenses, mixing, order_minhash, secret_scan, simhash, simple8b, toxicity, url_reputation
from starkpi.llm.common import components
from tests.llm.conftest import TEXTS

BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def rows(df):
    return df.collect()


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 3), (9, 9), (None, 4), (20, 21), (30, 20)] + [(100, i) for i in range(101, 200)]
    links += [(i, i + 1) for i in range(300, 340)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {k: got[k] for k in (1, 2, 3, 9, 20, 21, 30)} == {1: 1, 2: 1, 3: 1, 9: 1, 20: 20, 21: 20, 30: 20}
    assert all(got[i] == 100 for i in range(100, 200)) and all(got[i] == 300 for i in range(300, 341))
    assert 4 not in got and len(got) == 7 + 100 + 41
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_mixing(odd_docs, no_docs):
    out = rows(mixing.decide(odd_docs, [3, 1, 2], keep=["doc_id", "key", "score"]))
    assert len(out) == len(TEXTS) and {r["__size"] for r in out if r.doc_id in (3, 4, 5)} == {0}
    assert [r["__copies"] for r in out if r.doc_id == 6] in ([0, 0], [1, 1], [2, 2])
    mixed = mixing.mix(odd_docs, [3, 1, 2])
    assert mixed.columns == odd_docs.columns
    again = sorted((str(r.doc_id), str(r.text)[:20]) for r in mixed.repartition(5).collect())
    assert again == sorted((str(r.doc_id), str(r.text)[:20]) for r in mixing.mix(odd_docs.repartition(7), [3, 1, 2]).collect())
    assert rows(mixing.mix(no_docs, [3, 1, 2])) == []


def test_plan_reshares_what_caps_cut_off(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 0)], "source string, source_size long")
    weights = spark.createDataFrame([("a", 5.0), ("b", 1.0), ("c", 0.5), (None, 1.0)], "source string, weight double")
    got = {r.source: r.target for r in mixing.plan(sizes, weights, budget=1.0).collect()}
    assert got["a"] == 20 and got[None] == 0 and abs(got["b"] + got["c"] - 1990) < 1e-9 and abs(got["b"] - 2 * got["c"]) < 1e-9
    got = {r.source: r.target for r in mixing.plan(sizes, weights.where("source <> 'b'"), budget=9.0).collect()}
    assert got == {"a": 20, "b": 0, "c": 2000, None: 0}  # all full, and b without a weight


def test_simhash(odd_docs, no_docs):
    out = {(r.doc_id, r.fp): r.component_id for r in simhash.near_duplicates(odd_docs).collect()}
    by_id = {i: c for (i, _), c in out.items() if i is not None}
    assert by_id == {1: 1, 2: 1, 3: 3, 4: 3, 5: 3, 6: 6, 7: 7, 8: 8, 9: 9}
    assert {c for (i, _), c in out.items() if i is None} == {None, 3}
    kept = simhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [
        (False, 1), (False, 3), (False, 6), (False, 7), (False, 8), (False, 9), (True, None)]
    assert rows(simhash.near_duplicates(no_docs)) == [] == rows(simhash.keep_first(no_docs))


def test_fingerprints_of_texts():
    assert simhash.text_fingerprint(None) == simhash.text_fingerprint(" \n") == 0
    assert simhash.text_fingerprint("A b") == simhash.text_fingerprint("a  B\n") != simhash.text_fingerprint("É b")
    assert simhash.text_fingerprint("É b") != simhash.text_fingerprint("é b")  # only A-Z is lower-cased


def test_secrets(odd_docs, no_docs):
    out = rows(secret_scan.scan(odd_docs))
    assert len(out) == len(TEXTS)
    nine = next(r for r in out if r.doc_id == 9)
    assert (nine.n_assign, nine.n_access, nine.n_hex) == (1, 1, 0) and "account" in nine.spans and "endpoint" in nine.spans
    assert all(r.spans == "" for r in out if r.doc_id != 9)
    clean = secret_scan.redact(odd_docs)
    assert clean.columns == odd_docs.columns and clean.schema == odd_docs.schema
    name = lambda r: (r.doc_id, r.doc_id is None and r.text)
    after = {name(r): r for r in clean.collect()}
    for r in odd_docs.collect():
        new = after[name(r)]
        if r.doc_id == 9:
            assert "hunter2" not in new.text and "AKIA" not in new.text and new.n_chars == len(new.text)
            assert new.text.startswith(secret_scan.PLACEHOLDER)  # the account beside the password
        else:
            assert new == r
    assert rows(secret_scan.scan(no_docs)) == [] == rows(secret_scan.redact(no_docs))


def test_redaction_of_many_and_overlapping_spans(spark):
    text = "é token=abcdef01 " * 300 + "password=0123456789abcdef0123456789abcdef"
    out = secret_scan.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().text
    assert out == ("é [SECRET] " * 300 + "[SECRET]")


def test_bpe(odd_docs, no_docs):
    out = rows(bpe.digests(bpe.roundtrip(odd_docs, BPE), "doc_id"))
    assert len(out) == len(TEXTS)
    assert sorted(r.decoded_sha256 for r in out) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t, _, _ in TEXTS)
    coded = bpe.encode(odd_docs, BPE)
    back = bpe.decode(coded, BPE).select("doc_id", F.col("decoded").cast("string").alias("t"))
    assert sorted(r.t for r in back.collect()) == sorted(t or "" for _, t, _, _ in TEXTS)
    assert rows(bpe.roundtrip(no_docs, BPE)) == []
    nothing = coded.withColumn("ids", F.lit(None).cast("array<int>"))
    assert {bytes(r.decoded) for r in bpe.decode(nothing, BPE).collect()} == {b""}


def test_order_minhash(odd_docs, no_docs):
    out = rows(order_minhash.compare_edited(odd_docs))
    assert len(out) == len(TEXTS)
    one, two = (next(r for r in out if r.doc_id == i) for i in (1, 2))
    assert one.fingerprint == two.fingerprint and one.near_next == 1.0
    nine = next(r for r in out if r.doc_id == 9)
    t = dict((i, t) for i, t, _, _ in TEXTS)
    assert nine.edited == t[9][:len(t[9]) - len(t[9]) // 2] + t[1][:len(t[9]) // 2]  # the first follows the last
    bare = next(r for r in out if r.doc_id is None and r.n_chars)
    assert bare.edited == "a row without an id but with text"[:17]
    assert rows(order_minhash.compare_edited(no_docs)) == []
    alone = order_minhash.compare_edited(odd_docs.where("doc_id = 1")).first()
    assert alone.edited == t[1][:len(t[1]) - len(t[1]) // 2] + t[1][:len(t[1]) // 2]


@pytest.mark.parametrize("n", [1, 2, 700])
def test_successors_over_buckets(spark, n):
    ids = sorted(int(x) for x in np.random.default_rng(n).choice(10 ** 12, n, replace=False))
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string").repartition(5)
    got = {r.id: r.next_text for r in order_minhash.with_successor(df, rows_per_bucket=16)[0].where("__guard = 0").collect()}
    assert got == {i: f"t{ids[(k + 1) % n]}" for k, i in enumerate(ids)}


def test_simple8b(spark, odd_docs, no_docs):
    path = simple8b.scratch(spark)
    simple8b.write(odd_docs, WORDS, path)
    out = simple8b.read(spark, path)
    assert out.columns == ["doc_id", "start", "ids"]
    got = sorted(rows(out), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, 1, 2, 3, 4, 5, 6, 6, 7, 8, 9]
    assert all(r.ids[-1] == 1 for r in got) and got[4].ids == [1]
    assert [r.start for r in got] == np.cumsum([0] + [len(r.ids) for r in got])[:-1].tolist()
    empty = simple8b.scratch(spark)
    simple8b.write(no_docs, WORDS, empty)
    assert rows(simple8b.read_checksums(spark, empty)) == []


def test_toxicity(spark, odd_docs, no_docs):
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("aeioubdklmnrst"), 5)) for _ in range(300)]
    texts, y = [], []
    for i in range(400):
        t = list(rng.choice(words, 60))
        if i % 4 == 0:
            t[rng.integers(60)] = "vile" + "".join(rng.choice(list("abcde"), 3))
        texts.append(" ".join(t))
        y.append(int(i % 4 == 0))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, t, 1) for i, t in enumerate(y)] + [(None, 1, 1), (5, None, 0), (9999, 1, 0)],
                                   "doc_id long, toxic int, quality int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [r.doc_id for r in docs.where(toxicity.in_fold(F.col("doc_id"))).collect()]
    assert sum((got[i] >= 0.5) == (y[i] == 1) for i in held) >= 0.95 * len(held)
    odd = rows(toxicity.score(odd_docs, model))
    assert len(odd) == len(TEXTS) and all(0 <= r.score <= 1 for r in odd)
    clean = toxicity.keep_clean(docs, model)
    assert clean.columns == docs.columns and clean.count() == sum(s < 0.5 for s in got.values())
    assert toxicity.keep_clean(odd_docs, model).schema == odd_docs.schema
    assert rows(toxicity.score(no_docs, model)) == [] == rows(toxicity.keep_clean(no_docs, model))
    none = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    scorer, short = toxicity.Scorer(model), toxicity.Scorer(model, longest=7)
    assert np.allclose(scorer.scores(texts[:9] + ["", None]), short.scores(texts[:9] + ["", None]), atol=1e-5)


def test_licenses(odd_docs, no_docs):
    out = rows(licenses.scan(odd_docs))
    assert len(out) == len(TEXTS) and all(r.license is None and r.n_notices == 0 for r in out)
    assert rows(licenses.scan(no_docs)) == []


def test_url_reputation(spark):
    pages = [(1, "https://a.com/x", "p", 1), (1, "https://a.com/x", "p", 1), (None, None, None, 2), (2, "", "", 3)]
    df = spark.createDataFrame(pages, "page_id long, url string, host string, n int")
    seen = spark.createDataFrame([(1, True), (1, None), (None, True), (2, False)], "page_id long, bad boolean")
    out = rows(url_reputation.judge(df, seen, [("block", "com/")]))
    assert sorted((str(r.page_id), r.host, r.verdict) for r in out) == [
        ("1", "a.com", "block"), ("1", "a.com", "block"), ("2", "", "allow"), ("None", "", "allow")]
    assert rows(url_reputation.judge(df.limit(0), seen, [("block", "com/")])) == []
    assert len(rows(url_reputation.judge(df, seen.limit(0), []))) == 4


def test_longer_licenses_headers_and_notices_behind_a_copyright(spark):
    folder = "/usr/share/common-licenses"
    files = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    texts = {name: open(f"{folder}/{f}", encoding="utf-8").read() for f, name in files.items()}
    own = "A licence of our own.\nDo as you like."
    docs = [(n, t) for n, t in texts.items()] + [(n + " bare", t[:t.index("END OF TERMS AND CONDITIONS") + 27])
                                                 for n, t in texts.items() if "END OF TERMS AND CONDITIONS" in t]
    lines = {'Licensed under the Apache License, Version 2.0 (the "License");': "Apache-2.0",
             "Copyright (c) 2020 X. Released under the MIT License.": "MIT",
             "(C) J. Smith, Inc. All rights reserved. Licensed under the Apache License, Version 2.0": "Apache-2.0",
             "Copyright 2020 X. Released under the MIT License. All rights reserved.": "MIT",
             "Copyright 2020 X. Released under the MIT License or another.": "", "Copyright 2020 Released": ""}
    docs += [(line, f"code\n{line}\nmore") for line in lines] + [("own", own)]
    df = spark.createDataFrame(docs, "doc_id string, text string")
    digest = hashlib.sha256(b"a license of our own do as you like").hexdigest()
    more = spark.createDataFrame([(digest, "Own"), (digest, "Own")], "digest string, license string")
    got = {r.doc_id: r for r in licenses.scan(df, texts=more).collect()}
    assert len(got) == len(docs) and got["own"].license == "Own"
    assert {i: got[i].license for i, _ in docs[:len(docs) - len(lines) - 1]} == {i: i.split(" ")[0] for i, _ in docs[:len(docs) - len(lines) - 1]}
    assert {line: got[line].notices for line in lines} == lines
    assert all(got[line].n_notices == bool(n) for line, n in lines.items())


NAMES = ["__id", "__fp", "fp", "id", "doc", "root", "label_fp", "component_id", "n", "__size", "__copies", "__copy", "__rate",
         "__source", "__source_size", "__target", "__draw", "__own_source", "__row", "__key", "__cuts", "__clean", "key", "cuts",
         "clean", "row", "with.dot", "rank", "start", "stop", "shard", "low", "weight", "cap"]


def _clashing(spark, texts):
    """(doc_id, text, source, n_chars) with a column of every name that the operators use."""
    rows = [(i, t, s, len(t or ""), *(f"{n}-{at}" for n in NAMES)) for at, (i, t, s) in enumerate(texts)]
    fields = ", ".join(f"`{n}` string" for n in NAMES)
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, n_chars long, {fields}")


def test_stages_keep_columns_of_any_name(spark):
    texts = [(1, "some words of a text with password=abcdefgh in it", "a"), (2, None, "b"), (3, "", None), (None, "no id here", "a")]
    docs = _clashing(spark, texts)
    given = {tuple(r) for r in docs.collect()}
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and {tuple(r) for r in kept.collect()} <= given and kept.count() == 3
    mixed = mixing.mix(docs, [3, 1, 2])
    assert mixed.columns == docs.columns and {tuple(r) for r in mixed.collect()} <= given
    safe = secret_scan.redact(docs)
    assert safe.columns == docs.columns and safe.dtypes == docs.dtypes
    got = {r["doc_id"]: r for r in safe.collect()}
    for at, (i, t, _) in enumerate(texts):
        assert all(got[i][n] == f"{n}-{at}" for n in NAMES)
        assert got[i]["text"] == (t.replace("password=abcdefgh", secret_scan.PLACEHOLDER) if i == 1 else t)
        assert got[i]["n_chars"] == len(got[i]["text"] or "")
    with pytest.raises(ValueError):
        mixing.decide(docs, [1])


def test_keep_first_tells_rows_of_one_id_apart(spark):
    def kept(*rows):
        df = spark.createDataFrame(list(rows), "doc_id long, text string")
        return sorted(((r.doc_id, r.text) for r in simhash.keep_first(df).collect()), key=str)

    a, b, c = ("alpha beta gamma delta epsilon", "one two three four five six", "nothing like the others at all")
    assert kept((1, a), (1, b), (2, c)) == [(1, a), (1, b), (2, c)]
    # the second row of id 2 is a copy of id 1's text: it goes, the first stays
    assert kept((1, a), (2, b), (2, a)) == [(1, a), (2, b)]
    assert kept((1, a), (1, a), (None, b), (None, b), (None, a)) == [(1, a), (None, b)]
    assert kept((5, "X y z " + a.upper()), (5, "x y z " + a)) == [(5, "X y z " + a.upper())]  # one fingerprint: the smaller text
