"""Sharding over fixed virtual slots.

Every record hashes (doc_id and CRC-32 of the text) into one of ``n_slots`` virtual slots, bytes are summed
for each slot, and a stored, versioned slot-to-shard map (one row per slot and version) says where a slot
lives. Version 1 deals the slots out in turn, before anything is known of the data. Rebalancing reads the
latest version, edits it - slots move from shards over their fair share to those under it - and appends the
edited map as the next version; records are never rehashed. Rows are placed by the version that is read back.

Only the slot totals (``n_slots`` rows, a constant) reach the driver; records are read in place
and only ``(doc_id, size, crc32)`` crosses the network, never the text.

The law is ``bytes``: equal texts under different doc_ids may lie in different shards, else a group of copies
with a third of all bytes could not be spread evenly.

Defined results: a null text has size 1 and the CRC-32 of the empty string; a null doc_id hashes
by its text alone; repeated rows share a slot and each get their own place; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import shared_dir, store, table

N_SLOTS = 4096
N_SHARDS = 8
#: Rebalancing takes slots only from shards this much over their fair share.
TOLERANCE = 0.01
MAP_SCHEMA = "version int, vslot int, shard int, bytes long"


def sized(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return rows.withColumn("vslot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(n_slots)).cast("int"))


def slot_bytes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))


def first_map(n_slots: int, n_shards: int) -> dict[int, int]:
    """Slots dealt out in turn."""
    return {slot: slot % n_shards for slot in range(n_slots)}


def rebalanced(shard_of: dict[int, int], totals: dict[int, int], n_shards: int, tolerance: float = TOLERANCE) -> dict[int, int]:
    """The map edited for ``n_shards``: shards over their fair share hand slots to those under it.

    Slots of shards that no longer exist move too. All other slots stay where they are, so adding a
    shard moves rows only into it (as long as the old shards were balanced).
    """
    out = dict(shard_of)
    load = dict.fromkeys(range(n_shards), 0)
    homeless = []
    for slot, shard in out.items():
        if shard in load:
            load[shard] += totals.get(slot, 0)
        else:
            homeless.append(slot)
    fair = sum(totals.values()) / n_shards
    for slot in sorted(homeless, key=lambda s: (-totals.get(s, 0), s)):
        out[slot] = min(load, key=lambda s: (load[s], s))
        load[out[slot]] += totals.get(slot, 0)
    donors = {h for h, n in load.items() if n > fair * (1 + tolerance)}
    for slot in sorted((s for s, h in out.items() if h in donors), key=lambda s: (-totals.get(s, 0), s)):
        size, at, to = totals.get(slot, 0), out[slot], min(load, key=lambda s: (load[s], s))
        if size and load[at] - size >= fair and load[to] + size <= fair:
            out[slot] = to
            load[at] -= size
            load[to] += size
    return out


def put_map(spark: SparkSession, path: str, shard_of: dict[int, int], totals: dict[int, int], version: int) -> None:
    """Append one version of the map to the table at ``path``, with the bytes each slot held when it was made."""
    rows = [(version, s, h, totals.get(s, 0)) for s, h in sorted(shard_of.items())]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the stored map, the latest if none is named."""
    versions = spark.read.schema(MAP_SCHEMA).parquet(path)
    return versions.where(F.col("version") == (version or versions.agg(F.max("version")).first()[0]))


def rebalance(spark: SparkSession, path: str, totals: dict[int, int], n_shards: int, tolerance: float = TOLERANCE) -> int:
    """Edit the latest map at ``path`` for the slots' present bytes and append it; its version."""
    latest = read_map(spark, path).collect()
    version = latest[0].version + 1
    put_map(spark, path, rebalanced({r.vslot: r.shard for r in latest}, totals, n_shards, tolerance), totals, version)
    return version


def place(rows: DataFrame, current: DataFrame, counts: DataFrame) -> DataFrame:
    """Shard of every row and its place in the shard, from 0 without gaps.

    A row's place is the number of rows in earlier virtual slots of its shard plus its rank within its
    own slot, so no task ever holds a whole shard. The two small tables have one row for each slot.
    """
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1))
    offsets = current.join(F.broadcast(counts.select("vslot", "n")), "vslot").withColumn("offset", F.coalesce(before, F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size"))
    return rows.withColumn("rank", rank).join(F.broadcast(offsets.select("vslot", "shard", "offset", "version")), "vslot").withColumn("slot", F.col("offset") + F.col("rank") - 1)


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, n_slots: int = N_SLOTS, map_path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (place in the shard), vslot, map_version.

    ``map_path`` names a stored map to carry on from; without it a new one begins at version 1.
    """
    spark = docs.sparkSession
    rows = store(sized(docs, n_slots), "sized")
    counts = {r.vslot: (r.bytes, r.n) for r in slot_bytes(rows).collect()}  # n_slots rows at most
    totals = {s: b for s, (b, _) in counts.items()}
    if map_path is None:
        map_path = f"{shared_dir(spark).rstrip('/')}/quern-slot-map-{uuid.uuid4().hex}"
        put_map(spark, map_path, first_map(n_slots, n_shards), {}, 1)
    version = rebalance(spark, map_path, totals, n_shards, 0.0)
    per_slot = spark.createDataFrame([(s, n) for s, (_, n) in counts.items()], "vslot int, n long")
    placed = place(rows, read_map(spark, map_path, version), per_slot)
    return placed.select("doc_id", "size", "text_crc32", "shard", "slot", "vslot", F.col("version").alias("map_version"))


def op7_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "vslot", "map_version")


QUERIES = {"op7_virtual_slots": op7_virtual_slots}
ORACLE: dict[str, str] = {}
