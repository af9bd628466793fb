"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

Every source is cut into about PER_SOURCE blocks of equally many words (of one word, where it has fewer), in
the order of a hash of its documents. A source asks for target / block slots; cumulated, the sources' wishes
divide a line on which the slots are the whole numbers. Slot ``i`` comes at time ``t``, the van der Corput
point of ``i`` (its binary digits reversed, for a power of two of slots), so at any time every source has had
its share; the slots of a source are ranked by time, and rank ``r`` takes block ``r mod n_blocks``. A document's
``taken`` words are those of its text that lie in taken blocks, once for each time a block is taken.

The points up to a power of two are all whole numbers, so a source's number of slots is the number of whole numbers
on its stretch: less than one from its wish, for a source of any size. ``mix`` makes the slots by ``schedule``, counts
how often each block comes up in it (``taken_blocks``) and looks up the blocks in which a document begins and ends.

Hot sources: the place of a document in its source is the sum of earlier hash-prefix buckets plus a
running sum within its own bucket, and blocks are looked up by source and number, so no task holds a
whole source. The hash covers doc_id and text, so rows without a doc_id, or sharing one, are spread too; only rows alike in both meet. Tables with a row for each source or bucket are small: buckets grow
with the square root of the documents. A source has fewer than
2 * PER_SOURCE blocks and 4 * PER_SOURCE slots.

Defined results: null text has size 0 and takes 0; a null source comes last; sources without words
have target 0; repeated rows count each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import store, table, word_count

#: The mix takes this share of all words, and no source (or document) more than CAP times its own.
SHARE, CAP, WEIGHTS = 1.5, 2, (3, 1, 2)
#: Blocks that a source is cut into: the schedule's resolution. A slot is counted in UNIT parts.
PER_SOURCE, UNIT = 4096, 1024
#: Targets of up to so many sources are broadcast.
FEW_SOURCES = 10_000


def before(over: list[str], order: list[str]):
    return Window.partitionBy(*over).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def source_targets(sizes: DataFrame, share: float = SHARE, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, skey, source_size, weight, target: weights' shares of the mix, each at most cap x size.

    Sources fill up in the order of cap / weight; those before the first whose cap holds its share are
    capped, the rest share what is left by weight, which is what resharing again and again ends in.
    """
    by_source = sizes.groupBy("skey").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("skey.isnull"), F.col("skey.name"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long")
    w = by_source.withColumn("weight", weight).withColumn("cap", F.lit(cap).cast("long") * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("skey.isnull"), F.col("skey.name"))
    upto, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = w.withColumn("capped", F.coalesce(F.sum("cap").over(upto), F.lit(0))).withColumn("light", F.coalesce(F.sum("weight").over(upto), F.lit(0))).withColumn("total", F.sum("source_size").over(all_rows)).withColumn("weights", F.sum("weight").over(all_rows))
    level = (F.lit(float(share)) * F.col("total") - F.col("capped")) / (F.col("weights") - F.col("light"))
    w = w.withColumn("level", F.when(F.col("cap") > level * F.col("weight"), level))
    w = w.withColumn("level", F.max("level").over(all_rows))
    return w.select("skey", "source_size", "weight", "total", F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double"))).alias("target"))


def stretches(targets: DataFrame, cap: int = CAP, per_source: int = PER_SOURCE) -> DataFrame:
    """``targets`` with block (its words), n_blocks, first and slots: the source's slots are the whole numbers from first on."""
    order = Window.orderBy(F.col("skey.isnull"), F.col("skey.name"))
    t = targets.withColumn("block", F.greatest(F.expr(f"source_size div {per_source}"), F.lit(1)).cast("long"))
    t = t.withColumn("n_blocks", F.greatest(F.ceil(F.col("source_size") / F.col("block")), F.lit(1))).withColumn("wish", F.round(F.col("target") / F.col("block") * UNIT).cast("long"))
    t = t.withColumn("from", F.coalesce(F.sum("wish").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    t = t.withColumn("first", F.expr(f"(`from` + {UNIT - 1}) div {UNIT}")).withColumn("slots", F.expr(f"(`from` + wish + {UNIT - 1}) div {UNIT}") - F.col("first"))
    return t.withColumn("slots", F.least("slots", cap * F.col("n_blocks"))).drop("from", "wish")


def schedule(stretched: DataFrame) -> DataFrame:
    """time, skey, rank, block: every slot of :func:`stretches`, ordered by ``time``; block is the number of the block it takes."""
    last = stretched.agg(F.coalesce(F.max(F.col("first") + F.col("slots")), F.lit(0))).first()[0]
    bits = max(1, int(max(1, last - 1)).bit_length())
    slots = stretched.where("slots > 0").repartition("skey").select("skey", "n_blocks", F.explode(F.sequence("first", F.col("first") + F.col("slots") - 1)).alias("slot"))
    slots = slots.withColumn("time", F.conv(F.reverse(F.lpad(F.bin("slot"), bits, "0")), 2, 10).cast("long"))
    ranked = slots.withColumn("rank", F.row_number().over(Window.partitionBy("skey").orderBy("time")) - 1)
    return ranked.select("time", "skey", "rank", (F.col("rank") % F.col("n_blocks")).alias("block"))


def taken_blocks(stretched: DataFrame) -> DataFrame:
    """skey, at, times, earlier: for every block ``at`` of :func:`stretches`, how often :func:`schedule` takes it, and the blocks before it together."""
    none = stretched.repartition("skey").select("skey", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("at"), F.lit(0).cast("long").alias("times"))
    took = schedule(stretched).select("skey", F.col("block").alias("at"), F.lit(1).cast("long").alias("times"))
    times = none.unionByName(took).groupBy("skey", "at").agg(F.sum("times").alias("times"))
    return times.withColumn("earlier", F.coalesce(F.sum("times").over(before(["skey"], ["at"])), F.lit(0)))


def mix(docs: DataFrame, share: float = SHARE, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS, per_source: int = PER_SOURCE) -> DataFrame:
    """doc_id, size, source, source_size, target, taken for every row of ``docs`` (doc_id, text, source)."""
    key = F.struct(F.col("source").isNull().alias("isnull"), F.coalesce("source", F.lit("")).alias("name"))
    mark = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce("text", F.lit("")))))
    sizes = store(docs.select("doc_id", key.alias("skey"), word_count(F.col("text")).alias("size"), mark.alias("h")), "mix-sizes")
    return mix_sized(sizes, share, cap, weights, per_source)


def mix_sized(sizes: DataFrame, share: float, cap: int, weights: tuple[int, ...], per_source: int) -> DataFrame:
    """:func:`mix` of rows (doc_id, skey, size, h): ``h`` is the hash in whose order a source's documents lie."""
    targets = store(source_targets(sizes, share, cap, weights).coalesce(1), "mix-targets")
    # documents in hash order: the first hex digits of the hash are the bucket
    digits = min(8, max(1, round(math.log(max(1, sizes.count()), 16) / 2)))
    rows = sizes.withColumn("bucket", F.substring("h", 1, digits))
    sums = rows.groupBy("skey", "bucket").agg(F.sum("size").alias("n"))
    sums = sums.withColumn("first", F.coalesce(F.sum("n").over(before(["skey"], ["bucket"])), F.lit(0))).drop("n")
    within = F.coalesce(F.sum("size").over(before(["skey", "bucket"], ["h", "doc_id", "size"])), F.lit(0))
    # doc_id and size settle equal hashes; rows alike in both are the same row to the mix
    rows = rows.withColumn("within", within).join(sums, ["skey", "bucket"]).withColumn("lo", F.col("first") + F.col("within"))
    stretched = stretches(targets, cap, per_source)
    blocks = store(taken_blocks(stretched), "mix-blocks")
    dealt = stretched.select("skey", "source_size", "target", "block")
    # a hot source isn't dealt to one task for its own row of targets
    dealt = F.broadcast(dealt) if targets.count() <= FEW_SOURCES else dealt
    rows = rows.join(dealt, "skey").withColumn("hi", F.col("lo") + F.col("size"))
    # rows without words take nothing: they get numbers that no block has, spread by their hash
    for end, word in (("first", "lo"), ("last", "hi - 1")):
        rows = rows.withColumn(f"{end}_at", F.expr(f"if(size > 0, ({word}) div block, -1 - crc32(h))"))
        ends = blocks.select("skey", F.col("at").alias(f"{end}_at"), F.col("times").alias(f"{end}_times"), F.col("earlier").alias(f"{end}_earlier"))
        rows = rows.join(ends.hint("merge"), ["skey", f"{end}_at"], "left")

    def upto(end: str, word: str):
        """Words taken of the source's words before ``word``."""
        return F.col(f"{end}_earlier") * F.col("block") + (F.col(word) - F.col(f"{end}_at") * F.col("block")) * F.col(f"{end}_times")

    taken = F.when(F.col("size") > 0, upto("last", "hi") - upto("first", "lo")).otherwise(0).cast("long")
    return rows.select("doc_id", "size", F.when(~F.col("skey.isnull"), F.col("skey.name")).alias("source"), "source_size", "target", taken.alias("taken"))


def repeated(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: a document stays as many times as round(taken / size), which can be 0.

    Rows alike in doc_id, source and size share their sum of repeats, dealt out evenly.
    """
    keys = ["doc_id", "source", "size"]
    sized = docs.withColumn("__size", word_count(F.col("text")))
    times = mix(docs.select("doc_id", "text", "source")).groupBy(*keys).agg((F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).alias("__share"))
    times = times.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__n"), F.round("__share").cast("int").alias("__times"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source")) & (F.col("__size") == F.col("__n"))
    return sized.join(times, same).where("__times > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), "__times"))).select(*docs.columns)


def op10_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken", "source")


QUERIES = {"op10_source_schedule": op10_source_schedule}
ORACLE = {
    "op10_source_schedule": f"""
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(concat(coalesce(doc_id::VARCHAR, ''), ':', md5(coalesce(text, '')))) AS h FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
w AS (SELECT *, ([{", ".join(map(str, WEIGHTS))}])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}]::BIGINT AS weight,
        {CAP} * source_size AS cap FROM src),
o AS (SELECT *, coalesce(sum(cap) OVER f, 0) AS capped, coalesce(sum(weight) OVER f, 0) AS light, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
      FROM w WINDOW f AS (ORDER BY cap / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, ({SHARE}::DOUBLE * total::DOUBLE - capped::DOUBLE) / (weights - light)::DOUBLE AS level FROM o),
m AS (SELECT max(level) FILTER (WHERE cap > level * weight) AS level FROM l),
targets AS (SELECT source, source_size, least(cap::DOUBLE, coalesce(m.level * weight, cap::DOUBLE)) AS target FROM l, m),
b AS (SELECT *, greatest(1, source_size // {PER_SOURCE})::BIGINT AS block FROM targets),
wished AS (SELECT *, greatest(ceil(source_size / block::DOUBLE)::BIGINT, 1) AS n_blocks, round(target / block * {UNIT})::BIGINT AS wish FROM b),
line AS (SELECT *, coalesce(sum(wish) OVER (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lo FROM wished),
bits AS (SELECT greatest(1, ceil(log2(greatest(2, ceil(sum(wish) / {UNIT}::DOUBLE))))::INTEGER) AS n FROM wished),
points AS (SELECT i, (SELECT sum(((i >> k) & 1) << (n - 1 - k)) FROM range(62) b(k) WHERE k < n) AS t FROM (SELECT unnest(range((SELECT ceil(sum(wish) / {UNIT}::DOUBLE)::BIGINT FROM wished))) AS i), bits),
ranked AS (SELECT source, n_blocks, row_number() OVER (PARTITION BY source ORDER BY t) - 1 AS rank FROM points JOIN line ON i * {UNIT} >= lo AND i * {UNIT} < lo + wish),
blocks AS (SELECT source, rank % n_blocks AS blk, count(*) AS times FROM ranked WHERE rank < {CAP} * n_blocks GROUP BY ALL),
placed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lo FROM sizes),
spans AS (SELECT p.*, block, unnest(range(p.lo // block, (p.lo + greatest(size, 1) - 1) // block + 1)) AS blk FROM placed p JOIN b ON p.source IS NOT DISTINCT FROM b.source)
SELECT s.doc_id, s.size, t.source_size, t.target, sum((least(s.lo + s.size, (s.blk + 1) * block) - greatest(s.lo, s.blk * block)) * coalesce(times, 0))::BIGINT AS taken, s.source
FROM spans s LEFT JOIN blocks k ON s.source IS NOT DISTINCT FROM k.source AND s.blk = k.blk JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
GROUP BY s.doc_id, s.size, t.source_size, t.target, s.source, s.lo
"""
}
