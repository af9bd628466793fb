"""Slot maps are stored, edited and applied: placements against brute force, versions against the edits they stand for."""

import uuid
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from quern.llm import sharding
from quern.llm._common import shared_dir

from .test_operators import EDGES, SCHEMA


def test_placement_equals_brute_force(spark):
    docs = spark.createDataFrame(EDGES + EDGES[:5] + [(k, f"text {k} " * (k % 50), "en", "a") for k in range(100, 600)], SCHEMA)
    path = f"{shared_dir(spark)}/map-{uuid.uuid4().hex}"
    sharding.put_map(spark, path, sharding.first_map(64, 8), {}, 1)
    got = sharding.shard_documents(docs, 8, 64, path).collect()
    home = {r.vslot: r.shard for r in sharding.read_map(spark, path).collect()}
    slots = {(r.doc_id, r.text_crc32): r.vslot for r in sharding.sized(docs, 64).collect()}
    rows = [(r.doc_id, zlib.crc32((r.text or "").encode()), len((r.text or "").encode()) + 1) for r in docs.collect()]
    wanted, count = Counter(), defaultdict(int)
    for doc, crc, size in sorted(rows, key=lambda r: (slots[r[0], r[1]], r[0] is not None, r[0] or 0, r[1], r[2])):
        shard = home[slots[doc, crc]]
        wanted[doc, crc, size, shard, count[shard]] += 1
        count[shard] += 1
    assert Counter((r.doc_id, r.text_crc32, r["size"], r.shard, r.slot) for r in got) == wanted
    assert {r.map_version for r in got} == {2}


def test_versions_keep_their_history_and_move_only_what_they_must(spark):
    path = f"{shared_dir(spark)}/map-{uuid.uuid4().hex}"
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 97).cast("int")).alias("text"))
    sharding.put_map(spark, path, sharding.first_map(512, 4), {}, 1)
    two = {r.doc_id: r for r in sharding.shard_documents(docs, 4, 512, path).collect()}
    three = {r.doc_id: r for r in sharding.shard_documents(docs, 5, 512, path).collect()}
    maps = {v: {r.vslot: r.shard for r in sharding.read_map(spark, path, v).collect()} for v in (1, 2, 3)}
    assert maps[1] == sharding.first_map(512, 4) and sharding.read_map(spark, path).first().version == 3
    assert all(two[d].shard == maps[2][two[d].vslot] and three[d].shard == maps[3][three[d].vslot] for d in two)
    moved = [d for d in two if two[d].shard != three[d].shard]
    assert moved and {three[d].shard for d in moved} == {4} and len(moved) < 0.3 * len(two)
    for placed in (two, three):
        load = Counter()
        for r in placed.values():
            load[r.shard] += r["size"]
        assert max(load.values()) - min(load.values()) < 0.02 * sum(load.values()) / len(load)
