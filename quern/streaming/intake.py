"""Structured Streaming: intake, dedupe, rates, sessions, upserts and late rows.

Every function returns a streaming DataFrame or starts a query with ``availableNow``, so the same code
drains a backlog once or follows a live source. State is keyed and bounded by its watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType


def follow(spark: SparkSession, path: str, schema: StructType, files_at_once: int = 100) -> DataFrame:
    """New Parquet files of a folder, or the one file that ``path`` names, where it lies."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once)
    folder, _, name = path.rstrip("/").rpartition("/")
    files = spark.read.schema(schema).parquet(path).inputFiles()
    if any(f.rstrip("/").endswith(f"/{name}") for f in files):
        return stream.option("pathGlobFilter", name).parquet(folder)
    return stream.parquet(path)


def drain(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Write what has arrived, exactly once, and stop."""
    df.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def drain_to(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """``each(batch, id)`` for what has arrived; a batch may come again after a failure, so ``each`` must be idempotent."""
    df.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def deduped(df: DataFrame, stamp: str, keys: list[str], delay: str = "1 day") -> DataFrame:
    """The first of each key within the delay."""
    return df.withWatermark(stamp, delay).dropDuplicatesWithinWatermark(keys)


def throughput(df: DataFrame, stamp: str, keys: list[str], width: str = "30 minutes", slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Events and summed value in each window."""
    window = F.window(stamp, width, slide) if slide else F.window(stamp, width)
    out = df.withWatermark(stamp, delay).groupBy(window.alias("w"), *keys).agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), *keys, "events", "total")


def sessions(df: DataFrame, stamp: str, keys: list[str], gap: str = "900 seconds", delay: str = "1 hour") -> DataFrame:
    """Spells of activity: a gap of silence ends one."""
    out = df.withWatermark(stamp, delay).groupBy(F.session_window(stamp, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("events"))
    return out.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *keys, "events")


def claims_into(documents: DataFrame, target: str, checkpoint: str, claims: Callable[[DataFrame], DataFrame]) -> None:
    """Drain a stream of whole documents into claims, exactly once.

    Each batch is a run; its claims go to a folder of their own, which a batch that comes again after a failure
    writes anew. A document delivered again is claimed again under the later run, see :func:`current_claims`.
    """

    def write(batch: DataFrame, run: int) -> None:
        kept = batch.persist()
        try:
            claims(kept).withColumn("run", F.lit(run).cast("long")).write.mode("overwrite").parquet(f"{target}/claims/run={run}")
            kept.select("doc_id").distinct().write.mode("overwrite").parquet(f"{target}/documents/run={run}")
        finally:
            kept.unpersist()

    drain_to(documents, write, checkpoint)


def current_claims(spark: SparkSession, target: str) -> DataFrame:
    """The claims of each document's newest run, also where that found none."""
    newest = spark.read.parquet(f"{target}/documents").groupBy("doc_id").agg(F.max("run").alias("run"))
    return spark.read.parquet(f"{target}/claims").join(newest, ["doc_id", "run"], "left_semi")


def upsert_into(rows: DataFrame, target: str, checkpoint: str, keys: list[str], order: list[str], buckets: int = 64) -> None:
    """Drain a stream into a table that keeps the newest row (by ``order``) of each key, a null key being one.

    The table is dealt by a hash of the key to buckets; a batch writes the buckets it touches, whole, under its own number, and
    readers take each bucket's newest. A batch that comes again after a failure writes the same folder anew.
    """
    schema = rows.schema

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).persist()
        try:
            touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets``
            old = upserted(spark, target, schema, number).where(F.col("bucket").isin(touched)) if touched else None
            both = fresh if old is None else old.unionByName(fresh)
            best = F.max_by(F.struct(*schema.names), F.struct(*order)).alias("r")
            both.groupBy("bucket", *keys).agg(best).select("bucket", "r.*").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/batch={number}")
        finally:
            fresh.unpersist()

    drain_to(rows, write, checkpoint)


def upserted(spark: SparkSession, target: str, schema: StructType, before: int | None = None) -> DataFrame:
    """Rows of the table that :func:`upsert_into` keeps, with their bucket; those before a batch if one is named."""
    from pyspark.errors import AnalysisException

    try:
        every = spark.read.schema(StructType([*schema.fields, StructField("batch", LongType()), StructField("bucket", IntegerType())])).parquet(target)
    except AnalysisException:  # no batch yet
        return spark.createDataFrame([], StructType([*schema.fields, StructField("bucket", IntegerType())]))
    every = every if before is None else every.where(F.col("batch") < before)
    newest = every.groupBy("bucket").agg(F.max("batch").alias("batch"))
    return every.join(newest, ["bucket", "batch"], "left_semi").select(*schema.names, "bucket")


def split_late(batch: DataFrame, stamp: str, horizon) -> tuple[DataFrame, DataFrame]:
    """Rows on time, and rows older than the horizon, which go to a side table instead of being dropped."""
    late = F.col(stamp) < F.lit(horizon)
    return batch.where(~late), batch.where(late)


def latest_by_key(batch: DataFrame, keys: list[str], stamp: str, tie: str) -> DataFrame:
    from ..operators.resolve import newest

    return newest(batch, keys, stamp, tie)
