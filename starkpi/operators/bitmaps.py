"""Exact distinct counts that roll up (A3).

A distinct count per month cannot be summed to a year's.  A bitmap of the numbers that a
month holds can: bitmaps of months are or-ed to those of years, and their bits counted.
Numbers fall into chunks of 32,768 bits (4 KB), and a group keeps a bitmap for each chunk it
touches, so that neither a group's size nor the range of numbers is bounded, and chunks of
one group are made and merged by different tasks.

Integer ids are numbers as they are.  Other ids are numbered once, by ``number_ids``: ids of
one task get consecutive numbers, which fills chunks well, and later ids get numbers of a
generation of their own, so that bitmaps made earlier stay right."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CHUNK, _BITS = "__chunk", "__bits"


def id_bitmaps(rows: DataFrame, number: str | Column, groups: list[str]) -> DataFrame:
    """(groups, __chunk, __bits): the numbers that each group holds; NULL is no number.  The
    numbers travel to their chunk's task, not bitmaps of them: those that a task makes of
    scattered numbers hold a bit or two in 4 KB."""
    n = F.col(number) if isinstance(number, str) else number
    found = rows.select(*groups, n.cast("long").alias("__n")).where("__n IS NOT NULL")
    return found.withColumn(_CHUNK, F.bitmap_bucket_number("__n")).repartition(*groups, _CHUNK).groupBy(
        *groups, _CHUNK).agg(F.bitmap_construct_agg(F.bitmap_bit_position("__n")).alias(_BITS))


def roll_up(bitmaps: DataFrame, groups: list[str]) -> DataFrame:
    """Bitmaps of coarser ``groups``, columns of ``bitmaps``."""
    return bitmaps.groupBy(*groups, _CHUNK).agg(F.bitmap_or_agg(_BITS).alias(_BITS))


def distinct_counts(bitmaps: DataFrame, groups: list[str], name: str) -> DataFrame:
    """(groups, ``name``): how many different numbers each group holds."""
    return roll_up(bitmaps, groups).groupBy(*groups).agg(F.sum(F.bitmap_count(_BITS)).alias(name))


def number_ids(ids: DataFrame, id_col: str, known: DataFrame | None = None, generation: int = 0) -> DataFrame:
    """(``id_col``, number) of the ids that ``known``, what earlier generations gave, lacks.
    To be written before it is used: numbers follow the tasks that give them."""
    new = ids.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    if known is not None:
        new = new.join(known.select(id_col), id_col, "left_anti")
    return new.withColumn("number", F.lit(generation << 48) + F.monotonically_increasing_id())
