"""An index of the keys that a table of appended files holds.

Keys lie in buckets of their hash, one folder each, sorted by the hash and with a Parquet
Bloom filter on it.  A lookup reads the buckets that its own keys fall into; few keys are
pushed down as well, so that row groups without them are skipped.  Buckets hold a bounded
number of keys: when the average passes ``keys_per_bucket``, the index is dealt anew into a
folder with four times as many buckets, which a manifest publishes in one commit.  A lookup
thus reads the same amount however large the table is, and every key is dealt anew a constant
number of times on average.

The index follows the table's files: ``catch_up`` adds the keys of files it does not cover
yet, and notes them.  Nothing is lost or doubled if a run dies between append, keys and note:
the table alone says what it holds, and keys that are added twice are found as one.  NULL
keys are equal, as in the batch cleaning."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starkpi.sources import snapshots

_HASH, _BUCKET = "__key_hash", "__key_bucket"


def _read(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


class KeyIndex:
    def __init__(self, spark: SparkSession, table: str, path: str, key: list[str],
                 keys_per_bucket: int = 1 << 20, most_pushed: int = 500):
        self.spark, self.table, self.path, self.key = spark, table, path, key
        self.keys_per_bucket, self.most_pushed = keys_per_bucket, most_pushed

    # ---- layout -----------------------------------------------------------------

    def _state(self) -> tuple[str | None, int]:
        """(folder, buckets) of the published index."""
        now = snapshots.current(self.spark, self.path)
        return (os.path.join(self.path, now.folder), now.info["buckets"]) if now else (None, 1)

    def _with_bucket(self, rows: DataFrame, buckets: int) -> DataFrame:
        own = F.xxhash64(*[F.col(k) for k in self.key])
        return rows.withColumn(_HASH, own).withColumn(_BUCKET, F.pmod(own, F.lit(buckets)).cast("int"))

    def _write(self, keys: DataFrame, folder: str, buckets: int) -> None:
        dealt = self._with_bucket(keys.select(*self.key), buckets)
        (dealt.repartition(_BUCKET).sortWithinPartitions(_BUCKET, _HASH).write.mode("append")
         .option(f"parquet.bloom.filter.enabled#{_HASH}", "true")
         .option(f"parquet.bloom.filter.expected.ndv#{_HASH}", str(self.keys_per_bucket))
         .option("parquet.bloom.filter.max.bytes", str(2 << 20))
         .partitionBy(_BUCKET).parquet(os.path.join(folder, "keys")))

    def _note(self, files: list[str], folder: str, n_keys: int) -> None:
        """Which files of the table the keys are from, and how many keys that were."""
        rows = [(f, n_keys if i == 0 else 0) for i, f in enumerate(files)]
        self.spark.createDataFrame(rows, "file string, n long").coalesce(1).write.mode("append").parquet(os.path.join(folder, "files"))

    # ---- use --------------------------------------------------------------------

    def catch_up(self) -> int:
        """Add the keys of the table's files that are not covered yet; the number of files."""
        table = _read(self.spark, self.table)
        if table is None:
            return 0
        folder, buckets = self._state()
        covered = {} if folder is None else {
            r.file: r.n for r in _read(self.spark, os.path.join(folder, "files")).collect()}
        new = [f for f in table.inputFiles() if f not in covered]
        if not new:
            return 0
        keys = self.spark.read.schema(table.schema).option("basePath", self.table).parquet(*new).select(*self.key)
        n_keys = keys.count()
        total = sum(covered.values()) + n_keys
        grown = buckets
        while total > grown * self.keys_per_bucket:
            grown *= 4
        if folder is not None and grown == buckets:
            self._write(keys, folder, buckets)
            self._note(new, folder, n_keys)
            return len(new)
        if folder is not None:
            keys = keys.unionByName(self.spark.read.parquet(os.path.join(folder, "keys")).select(*self.key))
        version, name = snapshots.new_folder(self.spark, self.path)
        folder = os.path.join(self.path, name)
        self._write(keys.dropDuplicates(), folder, grown)
        self._note([*new, *covered], folder, total)
        snapshots.publish(self.spark, self.path, version, name, buckets=grown)
        return len(new)

    def candidates(self, rows: DataFrame) -> DataFrame | None:
        """The indexed keys among which those of ``rows`` are, if they are held at all; None
        while the index is empty.  ``rows`` is read twice."""
        folder, buckets = self._state()
        if folder is None:
            return None
        asked = self._with_bucket(rows.select(*self.key), buckets)
        touched = [r[0] for r in asked.select(_BUCKET).distinct().collect()]  # the number of buckets at most
        held = self.spark.read.parquet(os.path.join(folder, "keys")).where(F.col(_BUCKET).isin(touched))
        few = asked.select(_HASH).distinct().limit(self.most_pushed + 1).collect()
        if len(few) <= self.most_pushed:
            held = held.where(F.col(_HASH).isin([r[0] for r in few]))
        return held.select(*self.key, _HASH)

    def unseen(self, rows: DataFrame, asked: DataFrame | None = None) -> DataFrame:
        """``rows`` whose keys no covered file of the table holds; ``asked`` has all their keys
        and is cheaper to read than ``rows``."""
        held = self.candidates(rows if asked is None else asked)
        if held is None:
            return rows
        held = held.select(*[F.col(c).alias(f"__held_{c}") for c in held.columns])
        own = F.xxhash64(*[F.col(k) for k in self.key])
        same: list[Column] = [rows[k].eqNullSafe(held[f"__held_{k}"]) for k in self.key]
        return rows.join(held, reduce(lambda a, b: a & b, same, own == held[f"__held_{_HASH}"]), "left_anti")
