"""Numbers of each customer (n, m, k: counts; p, q: shares) and texts that say them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import views

NUMS = """nums AS (SELECT o_custkey AS claim_id, count(*) * 37 + 100 AS n, max(o_orderkey) % 9000 + 11 AS m, min(o_orderkey) % 700 + 10 AS k,
  count(*) % 90 + 5 AS p, max(o_orderkey) % 41 + 1 AS q FROM orders GROUP BY 1)"""


def nums(spark: SparkSession, d: str) -> DataFrame:
    o = views.table(spark, d, "orders")
    n, high, low = F.count(F.lit(1)), F.max("o_orderkey"), F.min("o_orderkey")
    return o.groupBy(F.col("o_custkey").alias("claim_id")).agg((n * 37 + 100).alias("n"), (high % 9000 + 11).alias("m"), (low % 700 + 10).alias("k"), (n % 90 + 5).alias("p"), (high % 41 + 1).alias("q"))


def said(form: str) -> Column:
    """The form with its ``{number}``s put in; counts with thousands separators."""
    parts = re.split(r"\{(\w)\}", form)
    return F.concat(*[F.lit(x) if k % 2 == 0 else F.format_number(x, 0) if x in "nmk" else F.col(x).cast("string") for k, x in enumerate(parts)])


def claims(spark: SparkSession, d: str, form: str) -> DataFrame:
    return nums(spark, d).select("claim_id", said(form).alias("claim_text"))
