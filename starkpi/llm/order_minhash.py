"""Document fingerprints: Order MinHash.

A text's words form overlapping k-mers; each is numbered by its occurrence, so that repeats
count.  A hash of (k-mer, number) places them on a circle.  Every entry of the fingerprint
has a point of its own on it and selects, over the whole text, the ``tuple_size`` k-mers that
are smallest when counted from there: its order is the hash order, rotated to begin at its
point.  It puts them back into text order and hashes the tuple.  Texts agree on an entry only
where they share the selected k-mers *in the same order*, which makes the share of equal
entries sensitive to edit distance, where plain MinHash sees a bag of k-mers.  Entries whose
points have no k-mer between them select the same tuple: one order serves all entries,
instead of one hash of every k-mer for each.

Everything per text is array functions in the JVM: hashes and positions are packed into
one long, so that two sorts of an array of longs find the occurrence numbers and the
selections; a repeated k-mer finds the start of its run by binary steps.  No text is
exploded into rows.  Equal texts have equal fingerprints; NULL and empty texts have no
entries, the fingerprint '', and are fully alike; a text with fewer than k words forms one
k-mer, and a tuple holds as many k-mers as there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkpi.llm.common import SPACE

# A packed long is hash bits above, position bits below; texts of up to 2 ** 28 words.
POSITION_BITS = 28
_POSITION = (1 << POSITION_BITS) - 1


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def entries(text: Column, k: int = 3, bins: int = 64, tuple_size: int = 2) -> Column:
    """array<long> of ``bins`` (a power of two) entries, all NULL where there is no k-mer."""
    long_mask, pos_mask = F.lit(~_POSITION), F.lit(_POSITION)

    def words_to_entries(words: Column) -> Column:
        count = F.greatest(F.size(words) - (k - 1), F.least(F.size(words), F.lit(1)))
        starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        # beyond the end F.get gives NULL, which XXH64 passes over
        grams = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))
        return _let(grams, grams_to_entries)

    def grams_to_entries(grams: Column) -> Column:
        packed = F.transform(grams, lambda g, i: g.bitwiseAND(long_mask).bitwiseOR(i.cast("long")))
        return _let(F.sort_array(packed), lambda run: numbered_to_entries(grams, run))

    def numbered_to_entries(grams: Column, run: Column) -> Column:
        def same(i: Column, x: Column) -> Column:
            return (i >= 0) & (F.get(run, i).bitwiseAND(long_mask) == x.bitwiseAND(long_mask))

        def first_of_run(x: Column, i: Column) -> Column:
            steps = F.array(*[F.lit(1 << s) for s in reversed(range(POSITION_BITS))])
            return F.aggregate(steps, i, lambda at, s: F.when(same(at - s, x), at - s).otherwise(at))

        def order(x: Column, i: Column) -> Column:
            number = F.when(same(i - 1, x), i - first_of_run(x, i)).otherwise(F.lit(0))
            return F.xxhash64(x.bitwiseAND(long_mask), number).bitwiseAND(long_mask).bitwiseOR(x.bitwiseAND(pos_mask))

        return _let(F.sort_array(F.transform(run, order)), lambda dealt: dealt_to_entries(grams, dealt))

    def bin_of(x: Column) -> Column:
        # entry b's point is where bin b, a range of the hash, begins
        return F.shiftrightunsigned(x, 64 - (bins.bit_length() - 1)).cast("int")

    def dealt_to_entries(grams: Column, dealt: Column) -> Column:
        size = F.size(dealt)

        def opens(i: Column) -> Column:
            return (i == 0) | (bin_of(F.get(dealt, i - 1)) != bin_of(F.get(dealt, i)))

        def entry(i: Column) -> Column:
            # longs sort as signed numbers, which on a circle is the same order
            places = [F.when(F.lit(j) < size, F.get(dealt, F.pmod(i + j, size)).bitwiseAND(pos_mask).cast("int"))
                      for j in range(tuple_size)]
            in_text_order = F.array_sort(F.array(*places))
            picked = [F.get(grams, F.get(in_text_order, F.lit(j))) for j in range(tuple_size)]
            return F.struct(bin_of(F.get(dealt, i)).alias("bin"), F.xxhash64(*picked).bitwiseAND(F.lit(0xFFFFFFFF)).alias("entry"))

        places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
        return F.array_sort(F.transform(F.filter(places, opens), entry))

    def filled(found: Column) -> Column:
        """Every point up to a bin with k-mers selects what that bin's does; those behind the
        last go on at the first."""
        def upto(f: Column, i: Column) -> Column:
            return F.array_repeat(f["entry"], f["bin"] - F.coalesce(F.get(found, i - 1)["bin"], F.lit(-1)))

        behind = F.array_repeat(F.get(found, F.lit(0))["entry"], F.lit(bins - 1) - F.element_at(found, -1)["bin"])
        return F.when(F.size(found) > 0, F.concat(F.flatten(F.transform(found, upto)), behind)).otherwise(
            F.array_repeat(F.lit(None).cast("long"), bins))

    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACE}|{SPACE}$", "")
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE, -1))
    return _let(_let(words, words_to_entries), filled)


def as_string(fingerprint: Column) -> Column:
    """Entries as hex, comma-joined; '' where there is none."""
    empty = F.forall(fingerprint, lambda e: e.isNull())
    hexed = F.transform(fingerprint, lambda e: F.coalesce(F.lpad(F.lower(F.hex(e)), 8, "0"), F.lit("")))
    return F.when(empty, F.lit("")).otherwise(F.array_join(hexed, ","))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries; 1 where neither has any."""
    def tally(at: Column, e: Column) -> Column:
        x, y = e["x"], e["y"]
        return F.struct((at["same"] + F.when(x == y, 1).otherwise(0)).alias("same"),
                        (at["any"] + F.when(x.isNotNull() | y.isNotNull(), 1).otherwise(0)).alias("any"))

    pairs = F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    zero = F.struct(F.lit(0).alias("same"), F.lit(0).alias("any"))
    return F.aggregate(pairs, zero, tally, lambda t: F.when(t["any"] == 0, F.lit(1.0)).otherwise(t["same"] / t["any"]))


def with_successor(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   rows_per_bucket: int = 256, max_buckets: int = 1 << 16) -> tuple[DataFrame, Window]:
    """(id, text, next_text, __bucket, __guard, __tie) and the window in which it is ordered.

    The successor in ascending id order, the first after the last, without a window over
    all rows: the rows are cut into buckets at approximate quantiles of the id.  Every bound
    is itself an id, so the rows that open a bucket are known beforehand and stand as guards
    at the end of the bucket before.  One shuffle.  The bounds are at most ``max_buckets``
    numbers.  Rows without an id have no successor and stay apart, spread by their text."""
    ids = docs.select(F.col(id_col).alias("id")).where(F.col("id").isNotNull())
    total, low = ids.agg(F.count(F.lit(1)), F.min("id")).first()
    n = max(1, min(max_buckets, -(-total // rows_per_bucket)))
    bounds = []
    if total and n > 1:
        quantiles = [i / n for i in range(1, n)]
        bounds = sorted(set(ids.agg(F.percentile_approx("id", quantiles, max(10_000, 4 * n))).first()[0]))
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    coarse = F.from_json(F.lit(str([g[0] for g in groups])), "array<bigint>")
    fine = F.from_json(F.lit(str(groups)), "array<array<bigint>>")

    def bucket(x: Column) -> Column:
        """Bounds at or below x, counted in two steps."""
        if not bounds:
            return F.lit(0)
        above = F.size(F.filter(coarse, lambda b: b <= x))
        inner = F.size(F.filter(F.get(fine, above - 1), lambda b: b <= x))
        return F.when(above == 0, F.lit(0)).otherwise((above - 1) * F.lit(step) + inner).cast("int")

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = bucket(F.col("id"))
    opens = F.array_contains(F.get(fine, F.size(F.filter(coarse, lambda b: b <= F.col("id"))) - 1), F.col("id")) if bounds         else F.lit(False)
    places = F.array_compact(F.array(
        F.struct(own.alias("bucket"), F.lit(0).alias("guard")),
        F.when(opens, F.struct((own - 1).alias("bucket"), F.lit(1).alias("guard"))),
        F.when(F.col("id") == F.lit(low), F.struct(F.lit(len(bounds)).alias("bucket"), F.lit(2).alias("guard")))))
    bare = F.array(F.struct((-1 - F.pmod(F.xxhash64("text"), F.lit(n))).cast("int").alias("bucket"), F.lit(3).alias("guard")))
    dealt = rows.withColumn("__place", F.explode(F.when(F.col("id").isNull(), bare).otherwise(places)))
    dealt = dealt.select("id", "text", F.col("__place.bucket").alias("__bucket"), F.col("__place.guard").alias("__guard"),
                         F.xxhash64("text").alias("__tie"))
    order = Window.partitionBy("__bucket").orderBy("__guard", "id", "__tie")
    return dealt.withColumn("next_text", F.when(F.col("id").isNotNull(), F.lead("text").over(order))), order


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   k: int = 3, bins: int = 64, tuple_size: int = 2) -> DataFrame:
    """Per row of ``docs``: (id, n_chars, edited, fingerprint, edited_fingerprint, near_edited,
    near_next); the fingerprints as arrays.  ``edited`` is the text with the last half of its
    code points replaced by the first as many of its successor."""
    rows, order = with_successor(docs, id_col, text_col)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half),
                      F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    keys = ["__bucket", "__guard", "__tie", "id"]
    rows = rows.select(*keys, F.length("text").cast("long").alias("n_chars"), edited.alias("edited"),
                       entries(F.col("text"), k, bins, tuple_size).alias("fingerprint"))
    rows = rows.withColumn("edited_fingerprint", F.when(F.col("__guard").isin(0, 3), entries(F.col("edited"), k, bins, tuple_size)))
    rows = rows.withColumn("next", F.when(F.col("id").isNotNull(), F.lead("fingerprint").over(order)))
    none = F.array_repeat(F.lit(None).cast("long"), bins)
    return rows.where(F.col("__guard").isin(0, 3)).select(
        F.col("id").alias(id_col), "n_chars", "edited", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.coalesce("next", none)).alias("near_next"))
