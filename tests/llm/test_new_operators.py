"""Operators 7, 11, 12 and 13 against brute force and on odd tables."""

import glob
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starkpi.llm import importance, lexical, packing, simple8b
from starkpi.llm.queries import QUERIES
from starkpi.llm.word_ids import Words, runs, with_end
from tests.conftest import SF_SMALL
from tests.llm.conftest import TEXTS

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = ["It's DON'T we'll x's's \"quoted,\" (a) b!! C# ÉCOLE straße STRASSE Ǆ ﬁ", "á ́b ée <|endoftext|> <|startoftext|>x y<|endoftext|>",
       "12 3a b4c\x1c\x1dq\x85z k  \n\t", "", None, "漢字 😀ok ½² İI ΑΣ ΣΑΣ", " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)),
       "ab×cd÷ef ÀÖØÞßöøÿ", "x" * 5000, "a1b22c !?.,x'y 'm"]


def _library(texts):
    tk = Tokenizer.from_file(WORD_BPE)
    return [tk.encode(t or "", add_special_tokens=False).ids for t in texts]


# ---- words, op7 -------------------------------------------------------------


def _ids(words, texts):
    flat, ends = words.encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(flat, ends)[:-1]]


def test_words_cut_like_whole_texts():
    with open(WORD_BPE, "rb") as f:
        data = f.read()
    words = Words(data, entries=40)
    assert words.plain
    want = _library(ODD)
    assert _ids(words, ODD) == want
    assert _ids(words, ODD[::-1]) == want[::-1]
    assert _ids(words, []) == [] and _ids(words, [None, ""]) == [[], []]
    flat, ends = with_end(*words.encode(pa.array(["a", None, "b"])), 7)
    assert ends.tolist() == [2, 3, 5] and flat[ends - 1].tolist() == [7, 7, 7]


def test_words_random_scripts():
    rng = np.random.default_rng(5)
    letters = [chr(c) for c in [*range(0, 0x180), *range(0x2000, 0x2040), 0x3A3, 0x301, 0x4E00, 0x1F600]] + list("'''  abstvelmd.,!") * 8
    texts = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(4000)]
    with open(WORD_BPE, "rb") as f:
        assert _ids(Words(f.read()), texts) == _library(texts)


def test_runs_hold_every_value():
    column = pa.array(["a" * n for n in (5, 0, 20, 3, 3, 3)] + [None]).slice(1)
    parts = list(runs(column, limit=8))
    assert [x for p in parts for x in p.to_pylist()] == column.to_pylist() and len(parts) > 2


def test_hot_ids_span_files_in_order(spark):
    """A third of the ids NULL, a third one id: the rows and numbers hold over several files."""
    texts = [f"word{i} " * (i % 7) for i in range(300)]
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, t) for i, t in enumerate(texts)] + [(5, "copy")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    path = simple8b.scratch(spark)
    simple8b.write(docs, WORD_BPE, path, ids_per_file=100)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    assert files.count() > 20
    got = sorted(simple8b.read(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id is not None for r in got] == sorted(r.doc_id is not None for r in got)
    ids = [r.doc_id for r in got if r.doc_id is not None]
    assert ids == sorted(ids)
    assert [r.start for r in got] == np.cumsum([0] + [len(r.ids) for r in got])[:-1].tolist()
    want = Counter((i, tuple(x + [1])) for (i, _), x in zip(rows, _library([t for _, t in rows])))
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want


# ---- op11 -------------------------------------------------------------------


def _importance(docs, target, buckets=10_000):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    fold = {c: c + 32 for c in range(65, 91)}

    def features(text):
        return [zlib.crc32(w.encode()) % buckets for w in word.findall((text or "").translate(fold))]

    s = Counter(b for _, t in docs for b in features(t))
    t = Counter(b for x in target for b in features(x))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for i, text in docs:
        f = features(text)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, r in enumerate(able[:10 * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r) for r in out), key=lambda r: (r[0] is not None, r))


def test_importance(spark, small_docs):
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op11_importance"](spark, SF_SMALL).collect()), key=lambda r: (r[0] is not None, r))
    assert got == _importance(small_docs, target)
    assert sum(r[4] is not None for r in got) >= 10


def test_importance_ties_and_odd_rows(spark, odd_docs, no_docs):
    target = spark.createDataFrame([("the quick brown fox",), (None,)], "text string")
    out = importance.resample(odd_docs, target, percent=50, least_words=2)
    assert out.columns == ["doc", "n_words", "n_features", "weight", "score", "rank"]
    assert set(odd_docs.columns) <= set(out.select("doc.*").columns)
    rows = out.collect()
    assert len(rows) == len(TEXTS) and sum(r.rank is not None for r in rows) == sum(r.n_words >= 2 for r in rows) // 2
    assert all(r.weight == 0 and r.rank is None for r in rows if not r.n_words)
    assert importance.resample(no_docs, target).collect() == []
    assert importance.resample(odd_docs, target.limit(0), percent=100, least_words=0).where("rank is null").count() == 0
    # one score shared by most rows: only the ids tell them apart
    same = spark.range(2000).select(F.struct(F.col("id").alias("doc_id")).alias("doc"), F.lit(30).cast("long").alias("n_words"),
                                    F.when(F.col("id") < 50, 9).otherwise(5).cast("long").alias("score"))
    drawn = importance.draw(same, percent=10).where("rank is not null").orderBy("rank").collect()
    assert [(r.rank, r.doc.doc_id) for r in drawn] == [(i + 1, i) for i in range(200)]


def test_importance_longer_features():
    found = list(importance.buckets_of("A b, c D", 3, 1 << 32))
    assert found[0][0] == 4
    assert Counter(found[0][1].tolist()) == Counter(zlib.crc32(x) for x in (b"a", b"b", b"c", b"d", b"a b", b"b c", b"c d", b"a b c", b"b c d"))
    text = "one two three " * 5
    whole = np.concatenate([f for _, f in importance.buckets_of(text, 3, 997)])
    importance_words = importance.words_of
    try:
        importance.words_of = lambda t: importance_words(t, at_once=7)
        cut = np.concatenate([f for _, f in importance.buckets_of(text, 3, 997)])
    finally:
        importance.words_of = importance_words
    assert sorted(cut) == sorted(whole)


def test_bracket_widens(spark):
    scores = spark.createDataFrame([(int(x),) for x in np.random.default_rng(1).integers(0, 50, 3000)], "score long")
    ordered = sorted((r.score for r in scores.collect()), reverse=True)
    for k in (1, 300, 1500, 3000):
        low, high, above = importance.bracket(scores, k, 3000, accuracy=50)
        assert low <= ordered[k - 1] <= high and above == sum(x > high for x in ordered)


# ---- op12 -------------------------------------------------------------------


def _packed(rows, capacity=4096):
    """Sequences are gapless, documents whole; gives the padding as a share of all ids."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append((r.start, r.length, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    size = [sum(n for _, n in s) for s in sequences.values()]
    return docs, sum(0 if n & (n - 1) == 0 else capacity - n for n in size) / sum(size)


def test_packing(spark, small_docs):
    rows = QUERIES["op12_packing"](spark, SF_SMALL).collect()
    docs, padding = _packed(rows)
    assert padding < 0.01
    raw = {i: np.array(x + [2], "<u4") for (i, _), x in zip(small_docs, _library([t for _, t in small_docs]))}
    assert set(docs) == set(raw)
    for i, pieces in docs.items():
        at = 0
        for start, length, total in sorted(pieces):
            assert start == at and total == len(raw[i])
            at += length
        assert at == len(raw[i])
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(raw[r.doc_id][r.start:r.start + r.length].tobytes())


def test_packing_odd_rows(spark, odd_docs, no_docs):
    rows = packing.pack(odd_docs, WORD_BPE, capacity=64).collect()
    assert _packed(rows, 64)[1] < 0.05
    assert sum(r.length for r in rows) == sum(len(x) + 1 for x in _library([t for _, t, _, _ in TEXTS]))
    assert sum(r.start == 0 for r in rows) == len(TEXTS)
    assert packing.pack(no_docs, WORD_BPE).collect() == []


@pytest.mark.parametrize("capacity, slack", [(4096, 0), (4096, 1 / 64), (1000, 1 / 16), (1, 0)])
def test_parts_are_classes(capacity, slack):
    for n in range(1, 2 * capacity + 50):
        parts = packing.parts(n, capacity, slack)
        assert sum(x for _, x in parts) == n and all(j * x <= capacity < (j + 1) * x or x == capacity for j, x in parts if slack == 0)
        assert all(j * x <= capacity for j, x in parts) and len(parts) <= n // capacity + 5


def test_packer_wastes_little():
    rng = np.random.default_rng(3)
    packer, rows, total = packing.Packer(4096, 1 / 64), [], 0
    for i, n in enumerate(np.exp(rng.normal(5.8, 1.1, 5000)).astype(int) + 1):
        rows += packer.add(i, np.arange(n, dtype="<u4"))
        total += n
    assert len(packer.open) <= 128
    rows += packer.finish()
    used = Counter()
    for _, start, ids, _, sequence, offset in rows:
        assert (ids == np.arange(start, start + len(ids))).all() and used[sequence] == offset
        used[sequence] += len(ids)
    assert sum(used.values()) == total
    assert sum(0 if n & (n - 1) == 0 else 4096 - n for n in used.values()) < 0.01 * total
    assert len(rows) < 2 * 5000


# ---- op13 -------------------------------------------------------------------


def _lexical(docs, items, top=20):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    fold = {c: c + 32 for c in range(65, 91)}
    texts = [(i, Counter(x.translate(fold) for x in term.findall(t or ""))) for i, t in docs]
    texts = [(i, c, sum(c.values())) for i, c in texts if c]
    N, L = len(texts), sum(n for _, _, n in texts)
    df = Counter(x for _, c, _ in texts for x in c)
    out = []
    for item, text in items:
        asked = Counter(x.translate(fold) for x in term.findall(text or ""))
        scores = []
        for i, c, n in texts:
            m = 100 - 25 + (25 * n * N) // L
            s = sum(q * math.floor(1000 * math.log((2 * N + 2) / (2 * df[x] + 1))) * ((1000000000 * c[x]) // (1000 * c[x] + 12 * m))
                    for x, q in asked.items() if x in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scores)[:top], 1)]
    return out


def _sorted(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1]))


def test_lexical(spark, small_docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    got = QUERIES["op13_lexical"](spark, SF_SMALL)
    assert got.dtypes == [(a, b) for a, b in zip(["item_id", "rank", "doc_id", "score"], [got.dtypes[0][1], "int", "bigint", "bigint"])]
    assert _sorted(map(tuple, got.collect())) == _sorted(_lexical(small_docs, items))


def test_lexical_many_small_shards_and_blocks(spark, small_docs):
    docs = spark.createDataFrame(small_docs, "doc_id long, text string").repartition(3)
    items = [(i, t[:120]) for i, (_, t) in enumerate(small_docs[:30]) if t]
    path = lexical.build(docs, postings=1500)
    assert spark.read.parquet(path).count() > 8
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(spark, path, asked, top=5, block_bytes=4000)
    assert _sorted(map(tuple, got.collect())) == _sorted(_lexical(small_docs, items, 5))


def test_lexical_shards_are_small(spark):
    """Of one task's 740,000 cells, and of its 18 MB of terms, no row of the index and no row group is large."""
    cells = [(i, " ".join(f"w{(i * 17 + j * j) % 20_011}" for j in range(300))) for i in range(2500)]
    long_terms = [(i, f"{i % 3} " + f"漢{i}" * 100_000) for i in range(40)]
    for texts, asked, shards in ((cells, [cells[7][1][:90], cells[2400][1], "w5 w5 w20010 absent"], 2),
                                 (long_terms, ["2 1 1", long_terms[39][1], "漢"], 3)):
        path = lexical.build(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1))
        files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/*.parquet")]
        groups = [m.row_group(g) for m in files for g in range(m.num_row_groups)]
        assert [g.num_rows for g in groups] == [1] * shards and max(g.total_byte_size for g in groups) < 10 << 20
        items = list(enumerate(asked))
        got = lexical.search(spark, path, spark.createDataFrame(items, "item_id int, text string"))
        assert _sorted(map(tuple, got.collect())) == _sorted(_lexical(texts, items))


def test_lexical_odd_rows(spark, odd_docs, no_docs):
    docs = [(i, t) for i, t, _, _ in TEXTS]
    items = [(1, "The FOX dog; the wood"), (1, "word"), (2, None), (3, ""), (4, "absent"), (None, "one ½ 漢字 <|x")]
    asked = spark.createDataFrame([(*r, 1, "x") for r in items], "item_id int, text string, rank int, item string")
    got = lexical.search(spark, lexical.build(odd_docs), asked, top=3).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[3])
    assert sorted(map(tuple, got), key=key) == sorted(_lexical(docs, items, 3), key=key)
    assert lexical.search(spark, lexical.build(no_docs), asked).collect() == []
    assert lexical.search(spark, lexical.build(odd_docs), asked.limit(0)).collect() == []


@pytest.mark.parametrize("n_rows, n_cols", [(1, 1), (5, 700), (3000, 40), (300, 300)])
def test_treap_finds_the_best(n_rows, n_cols):
    rng = np.random.default_rng(n_rows)
    grid = rng.integers(1, 50, (n_rows, n_cols)) * (rng.random((n_rows, n_cols)) < 0.3)
    grid[0, 0] = 7
    rows, cols = np.nonzero(grid)
    treap = lexical.Treap(lexical.build_treap(rows, cols, grid[rows, cols], max(1, (n_cols - 1).bit_length())))
    for top in (1, 20):
        asked = np.unique(rng.integers(0, n_rows, 8))
        weights = rng.integers(1, 9, len(asked))
        found = lexical.Best(top)
        found.ids = list(range(n_cols))
        treap.search(asked, weights, found, at_once=4)
        scores = weights @ grid[asked]
        want = sorted((-int(s), False, c) for c, s in enumerate(scores) if s > 0)[:top]
        assert sorted(found.rows)[:top] == want
