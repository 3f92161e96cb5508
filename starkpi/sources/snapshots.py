"""Versioned folders that become visible in one commit.

A writer fills a folder of its own below a root and then publishes its name: one JSON row,
appended as one file, which exists whole or not at all.  Readers ask for the newest published
folder.  A writer that dies before publishing leaves a folder nobody looks at; a reader that
has resolved a folder goes on reading it, whatever is published meanwhile.  Of two writers at
once both complete, and the one with the higher number (or, with equal numbers, the greater
folder name) is read."""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

_MANIFEST = "_versions"
_ROW = "version long, folder string, info map<string, long>, state string"


def current(spark: SparkSession, root: str) -> Row | None:
    """(version, folder, info, state) published last below ``root``, or None."""
    try:
        return spark.read.schema(_ROW).json(os.path.join(root, _MANIFEST)).orderBy(
            F.col("version").desc(), F.col("folder").desc()).first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def new_folder(spark: SparkSession, root: str) -> tuple[int, str]:
    """(version, name) of a fresh folder below ``root``, to be written and then published."""
    now = current(spark, root)
    version = now.version + 1 if now else 1
    return version, f"v{version:08d}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, root: str, version: int, folder: str, state: str | None = None, **info: int) -> None:
    """Make ``folder`` what readers of ``root`` see; ``state`` is text of the writer's own."""
    spark.createDataFrame([(version, folder, info, state)], _ROW).coalesce(1).write.mode("append").json(os.path.join(root, _MANIFEST))


def resolve(spark: SparkSession, root: str) -> str:
    """The folder to read: the newest published one, or ``root`` itself where none is."""
    now = current(spark, root)
    return os.path.join(root, now.folder) if now else root
