"""Dedupe, latest-per-key, versions, upserts and status transitions. Every order is total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_of(df: DataFrame, keys: list[str], *order: Column, n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key; Spark prunes to n a partition before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def newest(df: DataFrame, keys: list[str], stamp: str, tie: str) -> DataFrame:
    return first_of(df, keys, F.desc(stamp), F.desc(tie))


def latest_point(df: DataFrame, keys: list[str]) -> DataFrame:
    """Latest period, then largest confidence, then first seen."""
    return first_of(df, keys, F.desc("sort_key"), F.desc("confidence"), F.asc("observation_id"))


def active(claims: DataFrame, run_id: int | None = None) -> DataFrame:
    out = claims.where("superseded_by_run_id is null")
    return out.where(F.col("run_id") == run_id) if run_id is not None else out


def not_quarantined(claims: DataFrame, quarantine: DataFrame, keep_resolved: bool = False) -> DataFrame:
    """Claims outside quarantine; ``keep_resolved`` lets resolved rows back in."""
    held = quarantine.where("not resolved") if keep_resolved else quarantine
    return claims.join(held.select("claim_id"), "claim_id", "left_anti")


def resolve_quarantine(quarantine: DataFrame, claims: DataFrame) -> DataFrame:
    """Rows whose claim has been superseded become resolved."""
    gone = claims.where("superseded_by_run_id is not null").select("claim_id", F.lit(True).alias("__gone"))
    joined = quarantine.join(gone, "claim_id", "left")
    return joined.withColumn("resolved", F.col("resolved") | F.coalesce("__gone", F.lit(False))).drop("__gone")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    return child.join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def insert_new(batch: DataFrame, known: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of the batch with ``is_new``: the first of its hash in the batch and not in ``known``."""
    seen = known.select(key).distinct().withColumn("__known", F.lit(True))
    first = F.row_number().over(Window.partitionBy(key).orderBy(order)) == 1
    return batch.join(seen, key, "left").withColumn("is_new", first & F.col("__known").isNull()).drop("__known")


def upsert(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``changes`` replace those of ``base`` with their key; the rest is appended."""
    return base.join(changes.select(*keys).distinct(), keys, "left_anti").unionByName(changes.select(*base.columns))


def upsert_point(points: Column, point: Column, key: str = "sort_key") -> Column:
    """An array of structs with ``point`` in place of that of its key, in key order."""
    return F.array_sort(F.concat(F.filter(points, lambda p: p[key] != point[key]), F.array(point)))


def replace_prefix(base: DataFrame, batch: DataFrame, id_column: str, prefix: str) -> DataFrame:
    return base.where(~F.col(id_column).startswith(prefix)).unionByName(batch)


def supersede(claims: DataFrame, decisions: DataFrame) -> DataFrame:
    """decisions (document_id, new_run): active claims of the document's other runs are superseded by the new run."""
    joined = claims.join(decisions, "document_id", "left")
    replaced = F.col("superseded_by_run_id").isNull() & F.col("new_run").isNotNull() & (F.col("run_id") != F.col("new_run"))
    return joined.withColumn("superseded_by_run_id", F.when(replaced, F.col("new_run")).otherwise(F.col("superseded_by_run_id"))).drop("new_run")


def refresh_decisions(candidates: DataFrame) -> DataFrame:
    """candidates (document_id, gate, extracted, verified, new_count, old_count) with ``promote`` and ``reason``."""
    reason = (
        F.when(F.col("gate") == "fail", "gate failed").when(~F.col("extracted"), "extraction failed").when(~F.col("verified"), "verification failed")
        .when((F.col("new_count") == 0) & (F.col("old_count") > 0), "nothing would replace something").otherwise("promoted")
    )
    return candidates.withColumn("reason", reason).withColumn("promote", reason == "promoted")


# Where an interrupted state goes back to.
RESTART = {"downloading": "pending", "parsing": "downloaded", "extracting": "parsed"}


def restarted(documents: DataFrame) -> DataFrame:
    back = F.create_map(*[F.lit(x) for pair in RESTART.items() for x in pair])
    return documents.withColumn("status", F.coalesce(back[F.col("status")], F.col("status")))


def reset_failed(documents: DataFrame, outputs: DataFrame) -> DataFrame:
    """Failed documents start over where their output exists: parsed with one, pending without."""
    found = outputs.select("file_hash").distinct().withColumn("__has", F.lit(True))
    joined = documents.join(found, "file_hash", "left")
    return joined.withColumn("status", F.when(F.col("status") == "failed", F.when(F.col("__has"), "parsed").otherwise("pending")).otherwise(F.col("status"))).drop("__has")


def rewrite(df: DataFrame, column: str, new: Column) -> DataFrame:
    """Rows whose text changes: before and after."""
    return df.withColumn("before", F.col(column)).withColumn("after", new).where("before != after")


def runs(claims: DataFrame) -> DataFrame:
    """Run bookkeeping: claims, documents, first and last claim of each run."""
    return claims.groupBy("run_id").agg(F.count(F.lit(1)).alias("claims"), F.count_distinct("document_id").alias("documents"), F.min("created_at").alias("first_claim"), F.max("created_at").alias("last_claim"))


def canonical_by_hash(documents: DataFrame) -> DataFrame:
    """Alias documents with the newest document of the same content."""
    best = documents.groupBy("file_hash").agg(F.max("doc_id").alias("canonical_id"))
    return documents.join(best, "file_hash").where("doc_id != canonical_id").select("doc_id", "file_hash", "canonical_id")


def aliases(rows: DataFrame, content: str, key: str) -> DataFrame:
    """alias, canonical: every row whose content an earlier one (the smallest ``key``) has already."""
    named = rows.where(F.col(content).isNotNull())
    first = named.groupBy(content).agg(F.min(key).alias("canonical"))
    return named.join(first, content).where(F.col(key) != F.col("canonical")).select(F.col(key).alias("alias"), "canonical")


def appended(events: DataFrame, new: DataFrame) -> DataFrame:
    """``events`` and the new rows after them; columns that these lack are null."""
    return events.unionByName(new, allowMissingColumns=True).select(*events.columns)


def listed(holders: DataFrame, items: DataFrame, ids: str, item: str, name: str) -> DataFrame:
    """``holders`` with the items that their array ``ids`` names, in its order, as array ``name``; ids without an item are left out.

    items: ``item`` (the id) and ``name``. holders need a column ``key``.
    """
    asked = holders.select("key", F.posexplode(ids).alias("__at", item))
    found = asked.join(items.select(item, name), item).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("__at", name))).alias("__found"))
    none = F.expr("cast(array() as array<string>)")
    return holders.join(found, "key", "left").withColumn(name, F.coalesce(F.transform("__found", lambda x: x[name].cast("string")), none)).drop("__found")
