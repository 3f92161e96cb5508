"""License scans: canonical digest lookup.

A text is brought to a canonical form: lines of copyright notices go (not lines of a licence
that happen to begin with the word), case, punctuation and line ends go, equivalent spellings
become one.  The SHA-256 of the whole canonical text is looked up
among the digests of known licence texts by a hash join; so is every single line, among
the digests of known one-line notices ("Released under the MIT License.") and of lines of
standard headers.  Of a copyright line that goes on with a notice, the notice is looked up.
Nothing else is searched inside a text: a digest either is a known one or not.

The known digests come from fixed texts, from stored digests of longer ones and from a rule
(phrases times names): a table of a few hundred rows that never grows with the corpus, hence
broadcast.  A caller may add digests of further texts.  Only lines that
match are shuffled.  NULL and empty texts have the empty canonical text and match nothing;
rows that repeat id and text share one result, each its own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starkpi.llm.common import materialize
from starkpi.llm.license_texts import DIGESTS, HEADERS, NAMES, PHRASES, SPELLINGS, TEXTS, TITLES

NOT_WORD = r"[^\p{L}\p{N}]+"
_START = r"^[^\p{L}\p{N}©]*"
# a copyright notice: the word or sign with a year, a placeholder, (c) or "by", or the rights alone
NOTICE_LINE = (_START + r"(?:©|\([Cc]\)\s*(?:[Cc][Oo][Pp][Yy][Rr][Ii][Gg][Hh][Tt]|\d{4})"
               r"|[Cc][Oo][Pp][Yy][Rr][Ii][Gg][Hh][Tt]\s*(?:\([Cc]\)|©|&copy;|[:,]?\s*(?:\d{4}|[\[<{])|\s[Bb][Yy]\s)"
               r"|(?i:all rights reserved)[^\p{L}\p{N}]*$)")
# or with a name, unless the word after it belongs to a licence's own text
NAMED_LINE = _START + r"Copyright\s+\p{Lu}"
OWN_WORDS = _START + r"Copyright\s+(?:Licen[cs]e|Notice|Holder|Owner|Law|Act|Statement|Interest|Right|Treat|And|Or)"
_LOOSE = _START + r"(copyright\b|\(c\)|©|all rights reserved)"
_OPENERS = "|".join(["this source code form is subject to", *(p.lower() for p in PHRASES)])
# a copyright line that goes on with a notice, which is the second group
COPYRIGHT_AND_NOTICE = rf"(?i){_LOOSE}.*?[^\p{{L}}\p{{N}}](({_OPENERS})[^\p{{L}}\p{{N}}].*?)([^\p{{L}}\p{{N}}]+all rights reserved[^\p{{L}}\p{{N}}]*)?$"
# spellings of several words, which a line's end may part
_ACROSS = {other: usual for other, usual in SPELLINGS.items() if " " in other}


def is_notice(line: Column) -> Column:
    """Whether a line is a copyright notice and no part of a licence's own text."""
    return line.rlike(NOTICE_LINE) | (line.rlike(NAMED_LINE) & ~line.rlike(OWN_WORDS))


def canonical_line(line: Column) -> Column:
    """Lower case, words only, one space between, one spelling; '' for copyright lines."""
    low = F.lower(line)
    # every word has a blank of its own on either side, so that neighbours are replaced alike
    words = F.concat(F.lit(" "), F.regexp_replace(low, NOT_WORD, "  "), F.lit(" "))
    for other, usual in SPELLINGS.items():
        words = F.replace(words, F.lit(f" {other.replace(' ', '  ')} "), F.lit(f" {usual.replace(' ', '  ')} "))
    return F.when(is_notice(line), F.lit("")).otherwise(F.trim(F.replace(words, F.lit("  "), F.lit(" "))))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), r"\r?\n|\r", -1)


def canonical_lines(text: Column) -> Column:
    return F.filter(F.transform(_lines(text), canonical_line), lambda x: x != "")


def after_copyright(text: Column) -> Column:
    """The canonical notices that follow a copyright on its line."""
    both = F.filter(_lines(text), lambda x: x.rlike(COPYRIGHT_AND_NOTICE))
    return F.transform(both, lambda x: canonical_line(F.regexp_extract(x, COPYRIGHT_AND_NOTICE, 2)))


def canonical(lines: Column) -> Column:
    """The canonical text, the same however its lines are wrapped."""
    out = F.concat(F.lit(" "), F.array_join(lines, " "), F.lit(" "))
    for other, usual in _ACROSS.items():
        out = F.replace(out, F.lit(f" {other} "), F.lit(f" {usual} "))
    return F.trim(out)


def known(spark: SparkSession) -> DataFrame:
    """(digest, license, kind, width): kind is text or notice."""
    rows = [(name, "text", f"{title}\n{text}") for name, text in TEXTS.items() for title in ("", *TITLES[name])]
    rows += [(name, "notice", f"{phrase} {the}{alias}") for name, aliases in NAMES.items() for alias in aliases
             for phrase in PHRASES for the in ("", "the ")]
    rows += [(name, "notice", line) for name, lines in HEADERS.items() for line in lines]
    table = spark.createDataFrame(rows, "license string, kind string, text string")
    whole = canonical(canonical_lines(F.col("text")))
    stored = spark.createDataFrame([(d, name, 0) for name, digests in DIGESTS.items() for d in digests],
                                   "digest string, license string, width int")
    table = table.select("license", "kind", whole.alias("c"))
    table = table.select(F.sha2("c", 256).alias("digest"), "kind", "license", F.length("c").alias("width"))
    table = table.unionByName(stored.withColumn("kind", F.lit("text")))
    return table.groupBy("digest", "kind").agg(F.min("license").alias("license"), F.max("width").alias("width"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: DataFrame | None = None) -> DataFrame:
    """Per row of ``docs``: (id, digest, license, n_notices, notices).  digest is that of the
    whole canonical text, license the known licence it is (else NULL), n_notices counts
    the lines that are known notices, notices lists their licences, distinct, by name,
    comma-joined ('' where none).  ``texts``: (digest, license) of further licence texts by the
    SHA-256 of their canonical form; a text known here keeps its name."""
    spark = docs.sparkSession
    table = materialize(known(spark))
    widest = table.where("kind = 'notice'").agg(F.max("width")).first()[0]
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), F.coalesce(F.col(text_col), F.lit(""))))
    rows = docs.select(F.col(id_col), key.alias("__row"), canonical_lines(F.col(text_col)).alias("__lines"),
                       after_copyright(F.col(text_col)).alias("__after"))
    # lines longer than every known notice have no digest to look up
    notices = rows.select("__row", F.posexplode(F.filter(F.concat("__lines", "__after"), lambda x: F.length(x) <= widest)).alias("__at", "__line"))
    one = table.where("kind = 'notice'").select("digest", "license")
    hits = notices.join(F.broadcast(one), F.sha2("__line", 256) == F.col("digest")).dropDuplicates(["__row", "__at"])
    per = materialize(hits.groupBy(F.col("__row").alias("__key")).agg(
        F.count(F.lit(1)).alias("n_notices"), F.array_join(F.array_sort(F.collect_set("license")), ",").alias("notices")))
    full = table.where("kind = 'text'").select(F.col("digest").alias("__digest"), "license")
    if texts is not None:
        more = texts.groupBy(F.col("digest").alias("__digest")).agg(F.min("license").alias("license"))
        full = full.unionByName(more.join(full.select("__digest"), "__digest", "left_anti"))
    out = rows.select(F.col(id_col), "__row", F.sha2(canonical(F.col("__lines")), 256).alias("digest"))
    out = out.join(F.broadcast(full) if texts is None else full, F.col("digest") == F.col("__digest"), "left")
    return out.join(per, F.col("__row") == F.col("__key"), "left").select(
        id_col, "digest", "license", F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
        F.coalesce("notices", F.lit("")).alias("notices"))
