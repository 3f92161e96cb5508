"""Queries without an SQL form against brute force on whole small tables."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import xxhash
from pyspark.sql import functions as F

from starkpi.llm import bpe, embedding_dedup, order_minhash, simhash, simple8b, toxicity
from starkpi.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def _components(n, close):
    low = list(range(n))
    for _ in range(n):
        new = [min([low[i]] + [low[j] for j in close(i)]) for i in range(n)]
        if new == low:
            return low
        low = new
    return low


# ---- op1 --------------------------------------------------------------------


def _cosine_truth(vectors, threshold):
    x = np.array(vectors, float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = x @ x.T >= threshold
    np.fill_diagonal(hit, False)
    return hit.sum(1).tolist(), _components(len(x), lambda i: np.flatnonzero(hit[i]))


def test_embeddings(spark):
    rows = sorted(QUERIES["op1_embedding_dedup"](spark, SF_SMALL).collect())
    table = sorted((r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect())
    links, low = _cosine_truth([v for _, v in table], 0.9)
    ids = [i for i, _ in table]
    assert [tuple(r) for r in rows] == [(i, n, ids[k], ids[k] == i) for i, n, k in zip(ids, links, low)]


def test_embeddings_chains_groups_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=8)
    vectors = [(centre + rng.normal(scale=0.05, size=8)).tolist() for _ in range(300)]  # beyond the window
    angle = np.arange(0, 3, 0.2)  # a chain: neighbours link, ends do not
    vectors += [[float(np.cos(a)), float(np.sin(a))] + [0.0] * 6 for a in angle]
    vectors += [vectors[0]] * 3 + [(2 * np.array(vectors[1])).tolist()]
    vectors += rng.normal(size=(50, 8)).tolist()
    odd = [None, [0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7, [], [1.0, 2.0, 3.0]]
    rows = [(i, v, None, -1) for i, v in enumerate(vectors + odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node int")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, window=16).collect()}
    links, low = _cosine_truth(vectors, 0.9)
    assert [got[i].n_links for i in range(len(vectors))] == links
    assert [got[i].component_id for i in range(len(vectors))] == low
    for i in range(len(vectors), len(rows)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert embedding_dedup.near_duplicates(df.limit(0)).collect() == []


def test_embeddings_of_repeated_and_null_ids(spark):
    """Rows that repeat an id are vectors of their own; columns may have any name."""
    a, b, c = [1.0, 0.0, 0.0], [0.99, 0.01, 0.0], [0.0, 0.0, 1.0]
    rows = [(7, a), (7, c), (7, a), (3, b), (None, c), (None, None), (5, None)]
    df = spark.createDataFrame([(i, v, "x", "y", "z", 0) for i, v in rows],
                               "vec_id long, embedding array<double>, root string, pivot string, vec string, id long")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in embedding_dedup.near_duplicates(df).collect())
    # a, a and b are one component named 3, both c another, named 7
    assert got == sorted([(7, 2, 3, False), (7, 1, 7, True), (7, 2, 3, False), (3, 2, 3, True), (0, 1, 7, False),
                          (0, 0, 0, False), (5, 0, 5, True)])


def _beside(x, cosine, rng):
    """For each unit vector one at the given cosine."""
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    return cosine * x + np.sqrt(1 - cosine ** 2) * side


def _unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def test_embeddings_large_groups_are_not_compared_all_against_all(spark, monkeypatch):
    rng = np.random.default_rng(8)
    centre = _unit(rng.normal(size=64))
    near = _unit(centre + rng.normal(scale=0.11 / 8, size=(2000, 64)))
    vectors = np.concatenate([near, rng.normal(size=(2000, 64))]).tolist()
    compared = []
    whole = embedding_dedup.block_links
    monkeypatch.setattr(embedding_dedup, "block_links", lambda nodes, rows, *a: compared.extend(
        r.vec for r in nodes.select("vec").collect()) or whole(nodes, rows, *a))
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    links, low = _cosine_truth(vectors, 0.9)
    assert min(links[:2000]) > 1900 and not any(_unit(np.array(v)) @ centre > 0.9 for v in compared)
    assert [(got[i].n_links, got[i].component_id) for i in range(len(vectors))] == list(zip(links, low))


def test_embedding_groups_linked_by_members_and_by_single_vectors(spark):
    """Pivots of groups too far apart to link, whose outermost members do; a vector that only
    one member links with; a group that nothing links with."""
    rng = np.random.default_rng(9)
    first = _unit(rng.normal(size=(1, 32)))
    other = _beside(first, np.cos(np.arccos(0.9) + 0.12), rng)
    far = _beside(first, -0.5, rng)
    groups = [_beside(np.repeat(c, 300, 0), np.cos(0.06), rng) for c in (first, other, far)]
    # on the way from one group to the other: a member of each, at the threshold
    step = _unit(other - (other @ first.T) * first)
    reach = [np.cos(w) * first + np.sin(w) * step for w in (0.065, np.arccos(0.9) + 0.055, -np.arccos(0.9) + 0.01)]
    alone = _beside(groups[2][:1], 0.901, rng)
    vectors = np.concatenate([*groups, *reach, alone]).tolist()
    links, low = _cosine_truth(vectors, 0.9)
    schema = "vec array<double>, dim int, node long, worth double, rate double"
    nodes = spark.createDataFrame([(v, 32, i, 0.0, 0.0) for i, v in enumerate(vectors)], schema)
    within = spark.createDataFrame([(i, i // 300 * 300) for i in range(900)] + [(900, 0), (901, 300)], "a long, b long")
    placed = embedding_dedup.crowds(nodes, within, 0.9, 16)
    assert placed.where("pivot is not null").count() == 902 and placed.count() == len(vectors)
    pairs = [(r.a, r.b) for r in embedding_dedup.crowd_links(placed, within.where("a <> b"), 0.9, block=128).collect()]
    truth = np.array(vectors) @ np.array(vectors).T
    assert all(truth[a, b] >= 0.9 - 1e-9 for a, b in pairs)
    # groups 0 and 300 meet by one pair of members; two single vectors are left to further passes
    one, two = [*range(300), 900], [*range(300, 600), 901]
    across = [(one[i], two[j]) for i, j in np.argwhere(truth[np.ix_(one, two)] >= 0.9)]
    assert across and not any(truth[a, b] >= 0.9 for a, b in ((0, 300), (0, 301), (1, 300)))
    partners = [[] for _ in vectors]
    pairs += [(902, 903)] if truth[902, 903] >= 0.9 else []
    for a, b in pairs:
        partners[a].append(b)
        partners[b].append(a)
    assert _components(len(vectors), partners.__getitem__) == low


def test_embeddings_in_a_crowd_of_no_duplicates(spark):
    """Half of all vectors stand around one centre without being duplicates; of the pairs just
    above the threshold among them no more are missed than anywhere."""
    rng = np.random.default_rng(5)

    def unit(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    off = unit(rng.normal(size=(1500, 63)))  # where a vector stands beside the centre
    side = rng.normal(size=(150, 63))
    side = unit(side - (side * off[:150]).sum(1, keepdims=True) * off[:150])
    off = np.concatenate([off, 0.62 * off[:150] + np.sqrt(1 - 0.62 ** 2) * side])  # pairs of cosine 0.905
    crowd = np.hstack([np.full((len(off), 1), np.sqrt(0.75)), 0.5 * off])
    vectors = np.concatenate([crowd, rng.normal(size=(1500, 64))]).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    links, low = _cosine_truth(vectors, 0.9)
    assert sum(links) >= 300
    assert sum(got[i].n_links for i in range(len(vectors))) >= 0.98 * sum(links)
    assert sum(got[i].component_id == low[i] for i in range(1500, 1650)) >= 0.98 * 150


def test_passes_of_many_vectors_follow_the_recall():
    agree = 1 - np.arccos(0.9) / np.pi
    for rows in (10 ** 5, 3 * 10 ** 7, 10 ** 8, 10 ** 9):
        n = embedding_dedup.pass_count(rows, 0.9, 64)
        assert 1 - (1 - agree ** np.log2(rows / 64)) ** n >= 0.98


def test_recall_holds_over_rounds_of_few_passes(spark, monkeypatch):
    """Passes that one round cannot hold go on in the next, the last few vectors block by block."""
    monkeypatch.setattr(embedding_dedup, "PASSES_AT_A_TIME", 3)
    monkeypatch.setattr(embedding_dedup, "_PRODUCT_GAIN", 0.5)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    vectors = np.concatenate([x, 0.905 * x + np.sqrt(1 - 0.905 ** 2) * side]).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = sum(r.n_links for r in embedding_dedup.near_duplicates(df, window=16).collect())
    assert got >= 0.98 * sum(_cosine_truth(vectors, 0.9)[0])


def test_keys_of_few_vectors_and_passes(spark):
    """A vector's key in a pass does not depend on the vectors it comes with."""
    x = np.random.default_rng(11).normal(size=(40, 24))
    df = spark.createDataFrame([(v.tolist(), 24, i) for i, v in enumerate(x)], "vec array<double>, dim int, node long").coalesce(1)
    for passes in (1, 2, 5):
        whole = {(r["pass"], r.node): r.key for r in embedding_dedup.keyed(df, passes, 42).collect()}
        some = {(r["pass"], r.node): r.key for i in (0, 39) for r in embedding_dedup.keyed(df.where(F.col("node") == i), passes, 42).collect()}
        assert len(whole) == 40 * passes and some == {k: whole[k] for k in some}


def test_windows_reach_over_more_partitions_than_rows(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(60, 16))
    nodes = [(v.tolist(), 16, i) for i, v in enumerate(x)]
    df = spark.createDataFrame(nodes, "vec array<double>, dim int, node long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "150")
        # 120 sorted rows, windows of 64: one pass compares every vector with every other
        links, worth = embedding_dedup.pass_links(df, 60, 0.1, 64, 2, 42)
        linked = [(r.a, r.b) for r in links.collect()]
        certain = [r.gained for r in worth.collect()]
        got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df.select(
            F.col("node").alias("vec_id"), F.col("vec").alias("embedding")), threshold=0.5).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    _, low = _cosine_truth(x, 0.1)
    low_of = _components(60, lambda i: [b if a == i else a for a, b in linked if i in (a, b)])
    assert low_of == low and min(certain) > 100
    links, low = _cosine_truth(x, 0.5)
    assert [(got[i].n_links, got[i].component_id) for i in range(60)] == list(zip(links, low))


# ---- op3 --------------------------------------------------------------------


def test_simhash(spark, small_docs):
    got = {r.doc_id: r for r in QUERIES["op3_simhash"](spark, SF_SMALL).collect()}

    def slow(text):
        words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
            {c: " " for c in range(9, 14)}).split(" ") if w]
        parts = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, min(len(words), 1)))]
        h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    ids, fps = [i for i, _ in small_docs], [slow(t) for _, t in small_docs]
    low = _components(len(ids), lambda i: [j for j in range(len(ids)) if (fps[i] ^ fps[j]).bit_count() <= 3])
    smallest = {}
    for i, k in zip(ids, low):
        smallest[k] = min(smallest.get(k, i), i)
    assert {i: (g.fingerprint, g.component_id) for i, g in got.items()} == {
        i: (format(f, "016x"), smallest[k]) for i, f, k in zip(ids, fps, low)}


def test_forest_finds_every_pair_within_the_radius():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    near = base[:, None] ^ (np.uint64(1) << rng.integers(0, 64, (60, 5)).astype(np.uint64))
    fp = np.unique(np.concatenate([base, near.ravel()]))
    tree = np.sort(rng.integers(0, 3, len(fp)))
    forest = simhash.build_forest(fp, tree)
    for radius in (0, 1, 3, 10):
        found = set()
        for q, n in simhash.search_forest(fp, forest, fp, tree, radius):
            found |= set(zip(q.tolist(), n.tolist()))
        assert found == {(i, j) for i in range(len(fp)) for j in range(len(fp))
                         if tree[i] == tree[j] and int(fp[i] ^ fp[j]).bit_count() <= radius}


def test_crowded_shards_are_split_without_losing_links(spark):
    rng = np.random.default_rng(2)
    flips = {int(sum(1 << int(b) for b in rng.choice(20, rng.integers(0, 9), replace=False))) for _ in range(400)}
    fps = [0x0123456789ABCDEF ^ f for f in flips] + [int(x) for x in rng.integers(0, 1 << 62, 50)]
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for limit in (16, 5000):
        links = simhash.link_fingerprints(df, 3, tree_limit=limit).collect()
        assert all((a ^ b) & ((1 << 64) - 1) for a, b in links)
        at = {f: i for i, f in enumerate(fps)}
        want = _components(len(fps), lambda i: [j for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= 3])
        joined = [[] for _ in fps]
        for a, b in links:
            joined[at[a]].append(at[b])
            joined[at[b]].append(at[a])
        assert _components(len(fps), lambda i: joined[i]) == want


def test_more_blocks_link_alike(spark, monkeypatch):
    rng = np.random.default_rng(4)
    fps = [int(x) for x in rng.integers(0, 1 << 62, 40)]
    fps += [f ^ (1 << 3) ^ (1 << 40) ^ (1 << 61) for f in fps[:20]] + [f ^ (1 << 2) ^ (1 << 4) ^ (1 << 6) ^ (1 << 8) for f in fps[20:]]
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for blocks in (4, 5, 6):
        monkeypatch.setattr(simhash, "block_count", lambda rows, radius, b=blocks: b)
        links = {frozenset(r) for r in simhash.link_fingerprints(df).collect()}
        assert links == {frozenset((fps[i], fps[40 + i])) for i in range(20)}


# ---- op5 --------------------------------------------------------------------


def _tiktoken():
    import tiktoken
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_matches_tiktoken(spark, small_docs):
    enc = _tiktoken()
    got = {r.doc_id: r for r in QUERIES["op5_bpe"](spark, SF_SMALL).collect()}
    for i, t in small_docs:
        ids = enc.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_of_any_character_and_a_small_cache():
    enc = _tiktoken()
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        codec = bpe.Codec(bpe.read_ranks(f.read()), cache_entries=50)
    assert bpe.PATTERN == public_tokenizers.PATTERN
    every = [chr(c) for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(every), " ".join(every), "  \n\n a  b\t\tc 12ab's we'll'd  ", "x" * 3000, "", None, "\u00a0\u2003 x\x1c\x1d y\x85",
             "ab12 " * 50, "漢字かな交じり文 😀😀 ½²Ⅷ٣", "_a_ __b' 's'S"]
    ids = codec.encode(texts)
    assert [np.frombuffer(x, "<i4").tolist() for x in ids] == [enc.encode_ordinary(t or "") for t in texts]
    assert codec.decode(ids) == [(t or "").encode() for t in texts]


def test_bpe_decodes_sparse_and_unknown_ids():
    codec = bpe.Codec({b"a": 3, b"b": 40, b"ab": 7_000_000, b"\xff\x00": 5})
    rows = [[7_000_000, 3, 40, 5], [], [1, -1, 2**31 - 1, 3, -2**31], [4, 6], [40] * 3]
    got = codec.decode([np.array(r, "<i4").tobytes() for r in rows])
    assert got == [b"abab\xff\x00", b"", b"a", b"", b"bbb"]


def test_bpe_slices_of_a_long_text(monkeypatch):
    monkeypatch.setattr(bpe, "_SLICE", 64)
    monkeypatch.setattr(bpe, "_TOGETHER", 256)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        codec = bpe.Codec(bpe.read_ranks(f.read()))
    text = "Some words  and   blanks, it's\n\n 123 é " * 40
    assert np.frombuffer(codec.encode([text])[0], "<i4").tolist() == _tiktoken().encode_ordinary(text)


# ---- op6 --------------------------------------------------------------------


def _order_minhash(text, k=3, bins=64):
    def chained(parts, seed=42):
        for raw in parts:
            seed = xxhash.xxh64_intdigest(raw, seed)
        return seed

    words = (text or "").translate({c: " " for c in range(9, 14)}).split(" ")
    words = [w for w in words if w]
    grams = [chained(w.encode() for w in words[i:i + k]) for i in range(max(len(words) - k + 1, min(1, len(words))))]
    seen, dealt, mask = {}, [], ((1 << 64) - 1) ^ order_minhash._POSITION
    for i, g in enumerate(grams):
        n = seen[g & mask] = seen.get(g & mask, -1) + 1
        h = chained([(g & mask).to_bytes(8, "little"), n.to_bytes(4, "little")])
        dealt.append((h & mask) | i)
    entries = [None] * bins
    for b in range(bins):
        # over the whole text, counted round the circle from the entry's own point
        own = sorted(dealt, key=lambda x: (x - (b << 58)) % (1 << 64))[:2]
        if own:
            picked = [grams[p] for p in sorted(x & order_minhash._POSITION for x in own)]
            entries[b] = chained(g.to_bytes(8, "little") for g in picked) & 0xFFFFFFFF
    return entries


def _likeness(a, b):
    either = [(x, y) for x, y in zip(a, b) if x is not None or y is not None]
    return sum(x == y for x, y in either) / len(either) if either else 1.0


def test_order_minhash(spark, small_docs):
    got = {r.doc_id: r for r in QUERIES["op6_order_minhash"](spark, SF_SMALL).collect()}
    rows = sorted(small_docs)
    sketches = [_order_minhash(t) for _, t in rows]
    show = lambda e: "" if all(x is None for x in e) else ",".join("" if x is None else format(x, "08x") for x in e)
    for n, (i, t) in enumerate(rows):
        follow = rows[(n + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + follow[:half]
        other = _order_minhash(edited)
        g = got[i]
        assert (g.n_chars, g.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (g.fingerprint, g.edited_fingerprint) == (show(sketches[n]), show(other))
        assert abs(g.near_edited - _likeness(sketches[n], other)) < 1e-12
        assert abs(g.near_next - _likeness(sketches[n], sketches[(n + 1) % len(rows)])) < 1e-12


def test_order_minhash_sees_order_where_bags_agree(spark):
    from pyspark.sql import functions as F
    words = [f"w{i}" for i in range(400)]
    blocks = [words[i:i + 20] for i in range(0, 400, 20)]
    swapped = " ".join(w for b in blocks[::-1] for w in b)
    rows = [("same", " ".join(words)), ("little", " ".join(words[:200] + ["new"] + words[201:])), ("swapped", swapped)]
    df = spark.createDataFrame(rows, "id string, text string")
    first = df.where("id = 'same'").select(order_minhash.entries(F.col("text")).alias("a"))
    near = {r.id: r.n for r in df.crossJoin(first).select(
        "id", order_minhash.likeness(F.col("a"), order_minhash.entries(F.col("text"))).alias("n")).collect()}
    assert near["same"] == 1 and near["little"] > 0.9 > 0.75 > near["swapped"]


def test_order_minhash_sees_order_in_short_texts(spark):
    """Swapped halves of 20 to 100 words: well below the share of k-mers that both have."""
    from pyspark.sql import functions as F
    rng = np.random.default_rng(8)
    rows = []
    for n in (20, 52, 100):
        for i in range(60):
            words = [f"w{x}" for x in rng.integers(0, 10 ** 6, n)]
            rows.append((n, " ".join(words), " ".join(words[n // 2:] + words[:n // 2])))
    df = spark.createDataFrame(rows, "n int, a string, b string")
    near = {r.n: r.x for r in df.groupBy("n").agg(F.avg(order_minhash.likeness(
        order_minhash.entries(F.col("a")), order_minhash.entries(F.col("b")))).alias("x")).collect()}
    for n, x in near.items():
        shared = (n - 4) / (n - 2)  # k-mers of three words, of which two bridge the cut
        plain = shared / (2 - shared)
        assert x < plain - 0.25, (n, x, plain)


# ---- op7 --------------------------------------------------------------------


def test_simple8b_files(spark, small_docs):
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = sorted(QUERIES["op7_simple8b"](spark, SF_SMALL).collect())
    at = 0
    for r, (i, t) in zip(got, sorted(small_docs), strict=True):
        ids = np.array(tk.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        assert tuple(r) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_simple8b_words():
    rng = np.random.default_rng(0)
    cases = [[], [0], [2 ** 64 - 1], list(range(2000)), [0] * 1000, rng.integers(0, 2, 700).tolist(), [15 << 60] * 9 + [1] * 3,
             [2 ** 61, 1, 2 ** 63, 5] * 300, (2.0 ** rng.uniform(0, 63.9, 3000)).astype(np.uint64).tolist()]
    for ids in cases:
        ids = np.array(ids, np.uint64)
        words, offsets = simple8b.pack(ids)
        assert (simple8b.unpack(words, offsets, len(ids)) == ids).all()
    assert len(simple8b.pack(np.zeros(512, np.uint64))[0]) == 9


# ---- op8 --------------------------------------------------------------------


def _forward(model, text):
    """The network's score of one text, a position and a filter width at a time."""
    known = {int(k): i for i, k in enumerate(model.keys)}
    words = toxicity.words_of(text)
    emb = [sum((model.table[known[k]].astype(float) for k in toxicity.keys_of(w) if k in known),
               np.zeros(model.settings.dim)) for w in words]
    pooled = []
    for width, conv, bias in zip(model.settings.widths, model.conv, model.bias):
        best = np.zeros(model.settings.filters)
        for at in range(len(words)):
            seen = bias + sum(emb[at + j] @ conv[j] for j in range(width) if at + j < len(words))
            best = np.maximum(best, seen)  # what is below zero counts as zero
        pooled += list(best)
    marks = [toxicity._LANGUAGE_OF[w] for w in words if w in toxicity._LANGUAGE_OF]
    lang = max(range(len(toxicity.LANGUAGES)), key=lambda i: (marks.count(i), -i)) if marks else len(toxicity.LANGUAGES) - 1
    z = float(np.dot(pooled, model.out) + model.out_bias - model.threshold[lang])
    return 1 / (1 + np.exp(-min(max(z, -30), 30)))


def test_toxicity_scores_are_the_networks(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    assert model.constant is None
    got = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, SF_SMALL).collect()}
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        assert abs(got[i].score - _forward(model, text)) < 1e-3, i
        assert got[i].predicted == int(got[i].score >= 0.5)
