"""Releases of several tables at once.

Tables are staged in folders of their own; a release is one row of the manifest that names the folder of every
table, and that row's file appears as a whole or not at all. Readers pin a release and read all its tables
from it, whatever is published meanwhile. A release that fails before its row is written leaves the old one.
One publisher at a time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ROW = "version long, tables map<string, string>"


def _newest(spark: SparkSession, root: str, version: int | None = None):
    try:
        manifest = spark.read.schema(_ROW).parquet(f"{root}/manifest")
    except AnalysisException:
        return None
    rows = manifest if version is None else manifest.where(F.col("version") == version)
    return rows.orderBy(F.desc("version")).first()


def pinned(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, dict[str, str]]:
    """Number and table folders of the newest release, or of the one named; 0 and none before the first."""
    row = _newest(spark, root, version)
    return (row.version, dict(row.tables)) if row else (0, {})


def read(spark: SparkSession, release: tuple[int, dict[str, str]], name: str) -> DataFrame:
    return spark.read.parquet(release[1][name])


def publish(spark: SparkSession, root: str, feeds: dict[str, DataFrame]) -> int:
    """Stage ``feeds`` and flip to a release that has them and, unchanged, the old one's other tables."""
    version, tables = pinned(spark, root)
    for name, feed in feeds.items():
        path = f"{root}/{name}/{version + 1}-{uuid.uuid4().hex}"
        feed.write.parquet(path)
        tables[name] = path
    spark.createDataFrame([(version + 1, tables)], _ROW).coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return version + 1


def upserted(old: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with the rows of ``new`` in the place of those of equal keys."""
    return new if old is None else old.join(new.select(*keys), keys, "left_anti").unionByName(new)
