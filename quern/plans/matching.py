"""Markers looked for in every text, and what review and policy work makes of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import markers
from ..sources import views
from .registry import query


@query("SELECT doc_id, count(*) AS n, min(item_id) AS least, max(item_id) AS greatest FROM documents JOIN (SELECT min(item_id) AS item_id, left(text, 40) AS marker FROM benchmark GROUP BY 2) ON contains(text, marker) GROUP BY 1")
def j18_marker_texts(spark, d):
    """Every document that holds the beginning of a passage, and how many do."""
    passages = views.table(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.left("text", F.lit(40)).alias("marker"))
    found = markers.contained(views.table(spark, d, "documents").select("doc_id", "text"), "text", passages)
    return found.where(F.size("found") > 0).select("doc_id", F.size("found").cast("long").alias("n"), F.array_min("found").alias("least"), F.array_max("found").alias("greatest"))


@query(
    "SELECT page_id, word FROM (SELECT DISTINCT lower(unnest(string_split(p_name, ' '))) AS word FROM part) JOIN pages ON contains(lower(html), word) WHERE word <> ''",
)
def j18_part_words(spark, d):
    """Words of part names in pages: thousands of pairs, each text read once."""
    words = views.table(spark, d, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("word")).where("word != ''").distinct()
    numbered = words.select(F.xxhash64("word").alias("id"), F.col("word").alias("marker"))
    found = markers.contained(views.table(spark, d, "pages").select("page_id", F.lower("html").alias("html")), "html", numbered)
    return found.select("page_id", F.explode("found").alias("id")).join(numbered, "id").select("page_id", F.col("marker").alias("word"))
