"""I-Match document fingerprints with randomised lexicons, in DataFrame functions only.

Terms are runs of letters and digits, lower-cased and named by a 64-bit hash. The lexicon holds the terms
whose inverse document frequency lies in BAND, counted over all documents. A document's lexicon terms are
sorted; each randomised lexicon keeps a random part of them (1/8 down to 1/512, RATES x REPEATS lexicons)
and hashes what it kept; one more keeps all of them, so that a short text of which the others keep nothing
still has a fingerprint of its own. Unlike one hash of everything, some of the sparser lexicons survive an
edit, so the share of equal hashes grades likeness.

Size of the lexicon: a term in BAND is in at least e**-BAND[1] of the documents, so there are at most
(distinct terms per document) * e**BAND[1] of them however large the corpus is. A scalar subquery hands them
to every task as BUCKETS sorted arrays.

A text is fingerprinted where it is read and crosses the network once, keyed by doc_id and a hash of the
text; its neighbour gets its finished fingerprint and as many code points of its beginning as it needs. Who
follows whom is found from keys and lengths alone: they are range-partitioned in descending order, and each
partition's first row goes to the partition before.

Defined results: null text is empty; a document without lexicon terms is fingerprinted by all its terms,
one without terms by the empty set; null doc_ids come last in descending order; rows with equal doc_id
follow in the order of a hash of their texts; one document alone is its own neighbour; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import store, table

#: Natural logarithms of N / df: terms in 3 % down to 0.1 % of the documents.
BAND = (3.5, 6.9)
RATES, REPEATS = range(3, 10), 3
#: Arrays that the lexicon is dealt into by the last bits of its terms (a power of two).
BUCKETS = 1 << 14
KEY = ["z", "i", "h"]


def term_ids(text: Column) -> Column:
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def lexicon(texts: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """One row: ``buckets``, BUCKETS arrays of terms."""
    df = texts.select(F.explode(term_ids(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = texts.agg(F.count(F.lit(1)).alias("n")).scalar()
    kept = df.where(F.log(n / F.col("df")).between(*band)).groupBy(F.col("term").bitwiseAND(BUCKETS - 1).alias("bucket")).agg(F.array_sort(F.collect_list("term")).alias("terms"))
    every = texts.sparkSession.range(0, BUCKETS, 1, 8).withColumnRenamed("id", "bucket").join(kept, "bucket", "left")
    dealt = every.agg(F.array_sort(F.collect_list(F.struct("bucket", F.coalesce("terms", F.expr("cast(array() as array<bigint>)")).alias("terms")))).alias("dealt"))
    return dealt.select(F.transform("dealt", lambda d: d.terms).alias("buckets"))


def prints(ids: str) -> Column:
    """One hash (int; null where nothing is kept) for each lexicon, from the column ``ids`` of term ids; ``lex`` holds the lexicon."""
    inside = f"transform(array(filter({ids}, t -> array_contains(lex[int(t & {BUCKETS - 1})], t))), k -> array_sort(if(size(k) = 0, {ids}, k)))[0]"
    drawn = f"transform({inside}, t -> struct(t, xxhash64(t, 0) as h0, xxhash64(t, 1) as h1, xxhash64(t, 2) as h2))"
    hashes = []
    for rep in range(REPEATS):
        low = 0
        for rate in RATES:
            mask = ((1 << rate) - 1) << low
            low += rate
            hashes.append(f"transform(filter(d, x -> x.h{rep} & {mask}L = 0), x -> x.t)")
    hashes.append("transform(d, x -> x.t)")  # keeps everything: empty for texts without terms only
    kept = f"transform(array({drawn}), d -> array({', '.join(hashes)}))[0]"
    return F.expr(f"transform({kept}, k -> if(size(k) = 0, cast(null as int), cast(shiftright(xxhash64(k), 32) as int)))")


def following(texts: DataFrame) -> DataFrame:
    """z, i, h, n_chars, copies of each distinct row of ``texts`` (z, i, h, text), and next: the key (z, i, h) of the one that follows it."""
    rows = texts.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies"), F.max(F.length("text")).cast("long").alias("n_chars"))
    rows = store(rows.repartitionByRange("z", F.desc("i"), "h").withColumn("part", F.spark_partition_id()), "order")
    firsts = rows.groupBy("part").agg(F.min_by(F.struct(*KEY), F.struct("z", F.bitwise_not("i"), "h")).alias("first"))
    parts = Window.orderBy("part")  # a row for each partition
    everywhere = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select("part", F.coalesce(F.lead("first").over(parts), F.first("first").over(everywhere)).alias("after"))
    lead = F.lead(F.struct(*KEY)).over(Window.partitionBy("part").orderBy("z", F.desc("i"), "h"))
    return rows.withColumn("next", lead).join(F.broadcast(after), "part").withColumn("next", F.coalesce("next", "after")).drop("part", "after")


def fingerprints(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, and the prints text_fp, edited_fp and next_fp."""
    texts = docs.select(F.col("doc_id").isNull().alias("z"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("i"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("h", F.xxhash64("text"))
    words = store(lexicon(texts, band), "lexicon").scalar()
    order = store(following(texts), "following")
    own = texts.withColumn("lex", words).withColumn("ids", term_ids(F.col("text"))).withColumn("text_fp", prints("ids")).select(*KEY, "text", "text_fp")
    own = own.repartition(*KEY).withColumn("copy", F.row_number().over(Window.partitionBy(*KEY).orderBy("text")))
    # what a document's predecessor needs of it; both reads of ``own`` share one exchange
    asked = order.select(*[F.col(f"next.{c}").alias(c) for c in KEY], F.struct(*KEY).alias("for"), F.floor(F.col("n_chars") / 3).cast("int").alias("third"))
    sent = own.join(asked.hint("merge"), KEY).where(F.least("copy", F.lit(2)) == 1)
    sent = sent.select(*[F.col(f"for.{c}").alias(c) for c in KEY], F.expr("left(text, third)").alias("head"), F.col("text_fp").alias("next_fp"))
    rows = own.join(sent.hint("merge"), KEY).join(order.select(*KEY, "copies", "n_chars").hint("merge"), KEY)
    third = "int(floor(n_chars / 3))"
    # all but the last of several rows alike are followed by the same text
    rows = rows.withColumn("edited", F.expr(f"concat(left(text, int(n_chars) - {third}), if(copy < copies, left(text, {third}), head))"))
    rows = rows.withColumn("next_fp", F.when(F.col("copy") < F.col("copies"), F.col("text_fp")).otherwise(F.col("next_fp")))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256)).withColumn("edited_ids", term_ids(F.col("edited"))).withColumn("lex", words).withColumn("edited_fp", prints("edited_ids"))
    return rows.select(F.when(~F.col("z"), F.col("i")).alias("doc_id"), "n_chars", "edited_sha256", "text_fp", "edited_fp", "next_fp")


def likeness(a: str, b: str) -> Column:
    """Share of the lexicons that keep something of either text on which both hash alike; equal fingerprints are 1."""
    same = f"aggregate(zip_with({a}, {b}, (x, y) -> int(coalesce(x = y, false))), 0, (s, v) -> s + v)"
    either = f"aggregate(zip_with({a}, {b}, (x, y) -> int(x is not null or y is not null)), 0, (s, v) -> s + v)"
    return F.expr(f"if({either} = 0, 1.0D, {same} / {either})")


def shown(name: str) -> Column:
    return F.array_join(F.transform(name, lambda x: F.lower(F.lpad(F.right(F.hex(x.cast("long")), F.lit(8)), 8, "0"))), ".", "-")


def op4_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", shown("text_fp").alias("fingerprint"), shown("edited_fp").alias("edited_fingerprint"),
        likeness("text_fp", "edited_fp").alias("near_edited"), likeness("text_fp", "next_fp").alias("near_next"),
    )


QUERIES = {"op4_imatch": op4_imatch}
ORACLE: dict[str, str] = {}
