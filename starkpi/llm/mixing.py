"""Mixing sources to target weights.

Words per source are aggregated once; every source gets a target by filling up water: the
budget is shared by weight, no target passes ``max_repeat`` times its source, and what is
cut off is reshared by weight among the rest until none is above.  A source's repetition
rate is target / size.  Each document is taken floor(rate) times, plus one more time when
its hash-seeded uniform draw falls below the rate's fraction.  Draws depend on the seed and
the document's id alone (the text where the id is NULL), so reruns and recomputed tasks
agree, whatever the partitioning; rows that repeat an id share its draw.

NULL and empty texts have size 0 and are taken like others (they add no words), NULL is a
source of its own, and sources without words get target and rate 0.  An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkpi.llm.common import WORD, materialize

# A plan has one row per source.  Up to this many (some MB) it is broadcast; a longer one
# is joined by shuffle, where AQE splits a source that holds much of the corpus.
BROADCAST_SOURCES = 50_000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def cycled_weights(sources: DataFrame, weights: list[float], source_col: str = "source") -> DataFrame:
    """(source, weight): ``weights`` dealt round to the sources by code point, NULL last.
    One row per source stands in the window, however many documents there are."""
    by_name = Window.orderBy(F.col(source_col).asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    return sources.select(source_col).distinct().select(
        source_col, F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int")).alias("weight"))


def plan(sizes: DataFrame, weights: DataFrame, budget: float = 1.5, max_repeat: float = 2.0,
         source_col: str = "source") -> DataFrame:
    """(source, source_size, weight, target, rate) per source.

    ``sizes``: (source, source_size), one row per source; ``weights``: (source, weight > 0);
    a source without a weight gets target 0.  ``budget`` is the share of all words to take.
    The windows run over one row per source."""
    s = sizes.join(weights.withColumnRenamed(source_col, "__s"), F.col(source_col).eqNullSafe(F.col("__s")), "left")
    s = s.select(source_col, "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight"),
                 (F.lit(float(max_repeat)) * F.col("source_size")).alias("cap"),
                 (F.lit(float(budget)) * F.sum("source_size").over(Window.partitionBy())).alias("total"))
    # sources in the order in which a rising water level reaches their cap
    full_at = F.col("cap") / F.col("weight")
    s = s.withColumn("full_at", F.when(F.col("weight") > 0, full_at))
    rising = Window.orderBy("full_at", F.col(source_col).asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    weighted = s.where("weight > 0").withColumn("level", (F.col("total") - before) / after)
    # the level is right at the first source that it leaves below its cap
    level = F.min(F.when(F.col("full_at") >= F.col("level"), F.struct("full_at", "level"))).over(Window.partitionBy())
    weighted = weighted.withColumn("water", level["level"])
    # where no level leaves any below, all are full
    target = F.when(F.col("water").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("water") * F.col("weight")))
    cols = [source_col, "source_size", "weight"]
    out = weighted.select(*cols, target.alias("target")).unionByName(
        s.where("weight <= 0").select(*cols, F.lit(0.0).alias("target")))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(max_repeat))))
    return out.withColumn("rate", F.coalesce(rate, F.lit(0.0)))


def draw(id_col: Column, text: Column, seed: int) -> Column:
    """A uniform number in [0, 1) from 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), text, F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


_ADDED = {"__size", "__copies", "__source_size", "__target", "__rate", "__own_source", "__source", "__draw"}


def decide(docs: DataFrame, weights: list[float] | DataFrame, budget: float = 1.5, max_repeat: float = 2.0,
           seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: __size, __copies and the source's source_size, target
    and rate beside the columns ``keep`` (all by default).

    ``weights``: a list, dealt round to the sources by code point, or (source, weight)."""
    sized = docs.select(F.col(source_col), word_count(F.col(text_col)).alias("__n"))
    sizes = materialize(sized.groupBy(source_col).agg(F.sum("__n").alias("source_size")))
    if isinstance(weights, list):
        weights = cycled_weights(sizes, weights, source_col)
    per_source = materialize(plan(sizes, weights, budget, max_repeat, source_col).select(
        F.col(source_col).alias("__source"), F.col("source_size").alias("__source_size"),
        F.col("target").alias("__target"), F.col("rate").alias("__rate")))
    if per_source.count() <= BROADCAST_SOURCES:
        per_source = F.broadcast(per_source)
    names = docs.columns if keep is None else keep
    if clash := _ADDED & {c.lower() for c in names}:
        raise ValueError(f"decide adds columns of these names, keep others: {sorted(clash)}")
    fraction = F.col("__rate") - F.floor("__rate")
    own = docs.select(*[F.col(f"`{c}`") for c in names],
                      F.col(source_col).alias("__own_source"),
                      draw(F.col(id_col), F.col(text_col), seed).alias("__draw"),
                      word_count(F.col(text_col)).alias("__size"))
    out = own.join(per_source, F.col("__own_source").eqNullSafe(F.col("__source")))
    return out.withColumn("__copies", (F.floor("__rate") + F.when(F.col("__draw") < fraction, 1).otherwise(0)).cast("int")) \
        .drop("__own_source", "__source", "__draw")


def mix(docs: DataFrame, weights: list[float] | DataFrame, budget: float = 1.5, max_repeat: float = 2.0,
        seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as many times as it is taken.  Columns
    travel in a struct, so that their names clash with nothing."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"),
                       F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    if isinstance(weights, DataFrame):
        weights = weights.withColumnRenamed(source_col, "source")
    taken = decide(rows, weights, budget, max_repeat, seed, "id", "text", "source", keep=["doc"])
    return taken.where("__copies > 0").select(F.explode(F.array_repeat("doc", F.col("__copies"))).alias("doc")).select("doc.*")
