"""Secret scans with multipart credential linking.

Patterns find *parts*: keyword assignments, access-key identifiers and long hex runs
(reported as they are), and weak candidates that mean little alone: account names, mixed
tokens without a keyword, and endpoints.  A weak candidate is reported only when a
complementary part lies in the same scope, at most ``reach`` code points away: secrets
need an identifier or an endpoint, identifiers and endpoints need a secret.

The co-occurrence is an interval join: every part covers bins of a few hundred code points,
secrets also those of their scope, and parts of one text that share a bin are compared.
How many parts fit into a scope is bounded by its length, so no text or corpus, however
long, makes all pairs of its parts.  Only texts with parts are exploded, and only narrow
rows (positions, no text) are shuffled.

All of it is regular expressions, joins, windows and aggregates in the JVM.  Positions come
from the lengths of matches and of the gaps between them, summed in a window per text.
NULL texts count as empty; rows that repeat id and text share one result, each its own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkpi.llm.common import materialize


def _either(word: str) -> str:
    """ASCII letters of ``word`` in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _keyed(*names: str) -> str:
    return "(" + "|".join(map(_either, names)) + r""")["']?\x20*[:=]\x20*["']?"""


# Kinds in the order in which spans at one position are listed.
ASSIGN = _keyed("password", "passwd", "secret", "token", "api_?key") + "([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
ACCOUNT = _keyed("user_?name", "user", "login", "account", "client_?id", "access_?key_?id") + "([A-Za-z0-9@+/_.-]{3,})"
MIXED = "[A-Za-z0-9+/_=-]{32,}"
ENDPOINT = r"""(?:https?|ftp|ssh|postgres|postgresql|mysql|mongodb|redis|amqp|jdbc:[a-z0-9]+)://[^\x00-\x20"'<>]+"""
KINDS = ["assign", "access", "hex", "account", "mixed", "endpoint"]
PATTERNS = dict(zip(KINDS, [ASSIGN, ACCESS, HEX, ACCOUNT, MIXED, ENDPOINT]))
BASE = KINDS[:3]
SECRETS = ["assign", "hex", "mixed"]
PLACEHOLDER = "[SECRET]"
# A part of any kind contains one of these; texts without are not looked at further.
HINT = "|".join([_keyed("password", "passwd", "secret", "token", "api_?key"), "AKIA", "[0-9a-f]{24}", MIXED, "://",
                 _keyed("user_?name", "user", "login", "account", "client_?id", "access_?key_?id")])


def row_key(id_col: Column, text: Column) -> Column:
    """Identifies a row by id and text."""
    return F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(":"), text))


def _found(text: Column, kind: str) -> Column:
    """Array of (rank, number, gap, width, keep): every match of a kind with the code
    points before it since the last match."""
    pattern = PATTERNS[kind]
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind in ("assign", "account") else hits

    def part(hit: Column, i: Column) -> Column:
        v = F.get(value, i)
        if kind == "assign":
            keep = F.length(v) >= 6
        elif kind == "mixed":
            keep = v.rlike("[a-z]") & v.rlike("[A-Z]") & v.rlike("[0-9]")
        else:
            keep = F.lit(True)
        return F.struct(F.lit(KINDS.index(kind)).alias("rank"), i.alias("number"),
                        F.length(F.get(gaps, i)).alias("gap"), F.length(hit).alias("width"), keep.alias("keep"))

    none = F.array().cast("array<struct<rank:int,number:int,gap:int,width:int,keep:boolean>>")
    return F.when(text.rlike(pattern), F.transform(hits, part)).otherwise(none)


def parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, rank, start, stop) of every part, weak candidates included; positions in code
    points, stop exclusive."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    hinted = docs.select(row_key(F.col(id_col), text).alias("key"), text.alias("text")).where(F.col("text").rlike(HINT))
    every = F.concat(*[_found(F.col("text"), k) for k in KINDS])
    rows = hinted.select("key", F.explode(every).alias("p")).select("key", "p.*")
    rows = rows.dropDuplicates(["key", "rank", "number"])  # repeated rows
    past = Window.partitionBy("key", "rank").orderBy("number")
    stop = F.sum(F.col("gap") + F.col("width")).over(past)
    return rows.select("key", "rank", stop.alias("stop"), (stop - F.col("width")).alias("start"), "keep") \
        .where("keep").select("key", "rank", "start", "stop")


def links(found: DataFrame, reach: int = 200) -> DataFrame:
    """(key, secret_rank, secret_start, secret_stop, rank, start, stop): every secret with
    every identifier or endpoint of its scope, parts that overlap (one text read two ways)
    left out.  ``found`` is what ``parts`` returns."""
    width = max(2 * reach, 1)
    ranks = [KINDS.index(k) for k in SECRETS]

    def bins(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(F.floor(low / width), F.floor(high / width)))

    s = found.where(F.col("rank").isin(ranks)).select(
        "key", F.col("rank").alias("secret_rank"), F.col("start").alias("secret_start"), F.col("stop").alias("secret_stop"),
        bins(F.col("start") - reach, F.col("stop") + reach).alias("bin"))
    c = found.where(~F.col("rank").isin(ranks)).select("key", "rank", "start", "stop", bins(F.col("start"), F.col("stop")).alias("bin"))
    gap = F.greatest(F.col("start") - F.col("secret_stop"), F.col("secret_start") - F.col("stop"))
    # a pair meets in several bins but counts in the first that both cover
    first = F.greatest(F.floor((F.col("secret_start") - reach) / width), F.floor(F.col("start") / width))
    return s.join(c, ["key", "bin"]).where((gap >= 0) & (gap <= reach) & (F.col("bin") == first)).drop("bin")


def spans(docs: DataFrame, reach: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, kind, rank, start, stop) of every reported span: all base spans, and the weak
    candidates that a link joins to a complementary part.  ``key`` is ``row_key``."""
    found = materialize(parts(docs, id_col, text_col))
    linked = links(found, reach)
    weak = linked.select("key", "rank", "start", "stop").unionByName(
        linked.select("key", F.col("secret_rank").alias("rank"), F.col("secret_start").alias("start"),
                      F.col("secret_stop").alias("stop"))).where(F.col("rank") >= len(BASE)).distinct()
    # a mixed token that a base span already covers adds nothing
    base = found.where(F.col("rank") < len(BASE))
    covered = base.select("key", F.col("start").alias("b0"), F.col("stop").alias("b1"),
                          F.explode(F.sequence(F.floor(F.col("start") / 400), F.floor(F.col("stop") / 400))).alias("bin"))
    w = weak.withColumn("bin", F.floor(F.col("start") / 400))
    weak = w.join(covered, (w.key == covered.key) & (w.bin == covered.bin) & (F.col("b0") <= F.col("start"))
                  & (F.col("b1") >= F.col("stop")), "left_anti").drop("bin")
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("rank") + 1)
    return base.unionByName(weak).select("key", kind.alias("kind"), "rank", "start", "stop")


def _listed(items: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(items), lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["rank"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def scan(docs: DataFrame, reach: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: (id, n_assign, n_access, n_hex, n_weak, base, spans); base and
    spans list kind:start:stop by start, then kind, comma-joined ('' where none)."""
    item = F.struct("start", "rank", "stop")
    per = spans(docs, reach, id_col, text_col).groupBy("key").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in BASE],
        F.count(F.when(F.col("rank") >= len(BASE), 1)).alias("n_weak"),
        _listed(F.collect_list(F.when(F.col("rank") < len(BASE), item))).alias("base"),
        _listed(F.collect_list(item)).alias("spans"))
    per = materialize(per.withColumnRenamed("key", "__key"))
    rows = docs.select(id_col, row_key(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).alias("__row"))
    counts = [F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in [*BASE, "weak"]]
    return rows.join(per, F.col("__row") == F.col("__key"), "left").select(
        id_col, *counts, *[F.coalesce(c, F.lit("")).alias(c) for c in ("base", "spans")])


def redact(docs: DataFrame, reach: int = 200, id_col: str = "doc_id", text_col: str = "text",
           length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every reported span replaced by a placeholder and ``length_col`` (where
    there is one) set to the new length; rows without secrets stay as they are.  Columns
    travel in a struct, so that their names clash with nothing."""
    by_start = Window.partitionBy("key").orderBy("start", "rank", "stop")
    earlier = F.max("stop").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    apart = spans(docs, reach, id_col, text_col).select(
        "key", F.greatest("start", F.coalesce(earlier, F.lit(0))).alias("start"), "stop").where("start < stop")
    cuts = materialize(apart.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("cuts")))
    given = F.col("doc")[text_col]
    text = F.coalesce(given, F.lit(""))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
                       row_key(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).alias("row"))
    rows = rows.join(cuts, F.col("row") == F.col("key"), "left")

    def before(cut: Column, i: Column) -> Column:
        since = F.when(i > 0, F.get(F.col("cuts"), i - 1)["stop"]).otherwise(0)
        return F.concat(F.substring(text, since.cast("int") + 1, (cut["start"] - since).cast("int")), F.lit(PLACEHOLDER))

    end = F.element_at("cuts", -1)["stop"].cast("int")
    clean = F.concat(F.array_join(F.transform("cuts", before), ""), F.substring(text, end + 1, F.length(text)))
    rows = rows.select("doc", "cuts", F.when(F.col("cuts").isNull(), given).otherwise(clean).alias("clean"))
    cols = {c: F.col("doc")[c] for c in docs.columns}
    cols[text_col] = F.col("clean")
    if length_col in cols:
        cols[length_col] = F.when(F.col("cuts").isNull(), cols[length_col]).otherwise(
            F.length("clean").cast(docs.schema[length_col].dataType))
    return rows.select(*[v.alias(c) for c, v in cols.items()])
