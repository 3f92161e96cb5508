"""Helpers shared by the operators: checkpoints and connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starkpi.session import checkpoint_root

# Words are runs of anything but ASCII white space, as in every contract.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver found it: its source goes
    to the executors once per application, as with ``--py-files``."""
    context = spark.sparkContext
    if getattr(context, "_starkpi_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="starkpi-"), "starkpi.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    context._starkpi_shipped = True


def map_arrow(df: DataFrame, function, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and cut its lineage, so that a lost
    executor costs a reread of shared files and expensive input is not computed twice."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``links`` (a, b) as (node, root), root being the
    component's smallest node; nodes that occur in no link are absent.

    Alternating large-star / small-star rounds, all of them joins and partial
    aggregates: every neighbour of a node is re-hung onto the node's smallest
    neighbour until nothing changes.  A hub's links stand on the streamed side of a
    join that AQE can split, and only one row per node stands on the other.  Each
    round is checkpointed; the driver sees two numbers per round.  NULL ends and
    self links are ignored."""
    u, v = F.col(a), F.col(b)
    e = links.where(u.isNotNull() & v.isNotNull() & (u != v)).select(
        F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()
    e = materialize(e)
    state = _digest(e)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("k")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            # a node that has only smaller neighbours keeps its link to the smallest
            least.where("m < k").select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct()
        large = materialize(large)
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = large.join(low, F.col("u") == F.col("k")).where("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct()
        e = materialize(small)
        before, state = state, _digest(e)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _digest(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def smallest_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Within a task: the smallest point connected to each of n points by links a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(new, step := new[new]):
            new = step
        if np.array_equal(new, root):
            break
        root = new[root]
        keep = root[a] != root[b]
        a, b = a[keep], b[keep]
    return root
