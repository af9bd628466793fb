"""Evidence tables derived from the driver's star schema, as DataFrames and as the SQL an oracle needs.

Every view is lazy and column-pruned by Catalyst; dimension joins stay plain equi-joins, so Spark
broadcasts a side only where its own size statistics allow it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Document states, in life-cycle order.
STATUSES = ("pending", "downloading", "downloaded", "parsing", "parsed", "extracting", "extracted", "synced", "failed")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation an order: metric, region, subgroup, period, value, confidence."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(nation, customer.c_nationkey == nation.n_nationkey)
    year, quarter = F.year("o_orderdate"), F.quarter("o_orderdate")
    return joined.select(
        F.col("o_orderkey").alias("observation_id"), F.col("o_custkey").alias("document_id"), F.col("n_name").alias("region"),
        F.col("o_orderpriority").alias("metric"), F.col("c_mktsegment").alias("subgroup"), F.col("o_orderstatus").alias("unit"),
        year.alias("year"), quarter.alias("quarter"), F.month("o_orderdate").alias("month"),
        F.concat(year.cast("string"), F.lit(" Q"), quarter.cast("string")).alias("period_label"), (year * 100 + quarter * 3).alias("sort_key"),
        (year + (quarter - 1) / 4.0).alias("decimal_year"), F.col("o_totalprice").alias("value"), F.col("c_acctbal").alias("confidence"),
    )


OBS = """obs AS (SELECT o_orderkey AS observation_id, o_custkey AS document_id, n_name AS region, o_orderpriority AS metric,
  c_mktsegment AS subgroup, o_orderstatus AS unit, year(o_orderdate)::INTEGER AS year, quarter(o_orderdate)::INTEGER AS quarter,
  month(o_orderdate)::INTEGER AS month, concat(year(o_orderdate), ' Q', quarter(o_orderdate)) AS period_label,
  (year(o_orderdate) * 100 + quarter(o_orderdate) * 3)::INTEGER AS sort_key,
  year(o_orderdate) + (quarter(o_orderdate) - 1) / 4.0::DOUBLE AS decimal_year, o_totalprice AS value, c_acctbal AS confidence
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned claims: id, document, run, category, confidence, superseding run, creation time."""
    o = table(spark, sf_dir, "orders")
    run = F.year("o_orderdate")
    return o.select(
        F.col("o_orderkey").alias("claim_id"), F.col("o_custkey").alias("document_id"), run.alias("run_id"), F.col("o_orderpriority").alias("category"),
        ((F.col("o_orderkey") % 100) / 100.0).alias("confidence"), F.when(F.col("o_orderstatus") == "F", run + 1).alias("superseded_by_run_id"),
        F.col("o_orderdate").alias("created_at"), F.col("o_totalprice").alias("value"),
    )


CLAIMS = """claims AS (SELECT o_orderkey AS claim_id, o_custkey AS document_id, year(o_orderdate)::INTEGER AS run_id, o_orderpriority AS category,
  (o_orderkey % 100) / 100.0::DOUBLE AS confidence, CASE WHEN o_orderstatus = 'F' THEN year(o_orderdate)::INTEGER + 1 END AS superseded_by_run_id,
  o_orderdate AS created_at, o_totalprice AS value FROM orders)"""


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = claims(spark, sf_dir).where("claim_id % 17 = 0")
    return c.select("claim_id", "document_id", "run_id", (F.col("claim_id") % 34 == 0).alias("resolved"))


QUARANTINE = "quarantine AS (SELECT claim_id, document_id, run_id, claim_id % 34 = 0 AS resolved FROM claims WHERE claim_id % 17 = 0)"


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document registry: id, hash of the text, path, state, page count, source, language."""
    d = table(spark, sf_dir, "documents")
    status = F.element_at(F.array(*map(F.lit, STATUSES)), (F.pmod("doc_id", F.lit(len(STATUSES))) + 1).cast("int"))
    path = F.concat(F.lit("/"), F.col("source"), F.lit("/HIV_STI_"), (F.pmod("doc_id", F.lit(20)) + 2005).cast("string"), F.lit("_"), F.col("doc_id").cast("string"), F.lit(".pdf"))
    return d.select("doc_id", F.md5("text").alias("file_hash"), path.alias("local_path"), status.alias("status"), "source", "lang", "n_chars", "text")


REGISTRY = f"""registry AS (SELECT doc_id, md5(text) AS file_hash, concat('/', source, '/HIV_STI_', (doc_id % 20 + 2005)::VARCHAR, '_', doc_id::VARCHAR, '.pdf') AS local_path,
  ([{", ".join(f"'{s}'" for s in STATUSES)}])[doc_id % {len(STATUSES)} + 1] AS status, source, lang, n_chars, text FROM documents)"""


def official(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Official yearly averages by metric: an estimate independent of the observations."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    joined = li.join(o, li.l_orderkey == o.o_orderkey)
    return joined.groupBy(F.col("o_orderpriority").alias("metric"), F.year("l_shipdate").alias("year")).agg(F.avg("l_extendedprice").alias("value"))


OFFICIAL = """official AS (SELECT o_orderpriority AS metric, year(l_shipdate)::INTEGER AS year, avg(l_extendedprice) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"""


def draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simulated paths: one value for each draw, stage and time."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").alias("draw"), F.col("event_type").alias("stage"), F.dayofmonth("ts").alias("time")).agg(F.max("value").alias("value"))


DRAWS = """draws AS (SELECT user_id AS draw, event_type AS stage, day(ts)::INTEGER AS time, max(value) AS value FROM events GROUP BY ALL)"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-blank trimmed lines of documents with their line number."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).select("doc_id", "line_no", F.trim("line").alias("line")).where("line != ''")


LINES = """lines AS (SELECT doc_id, (i - 1)::INTEGER AS line_no, trim(l[i]) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), unnest(range(1, len(l) + 1)) r(i)
  WHERE trim(l[i]) <> '')"""
