"""Queries over the boards' merges, picks, counts and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import boards
from ..sources import views
from ..sources.views import CLAIMS, OBS, QUARANTINE, REGISTRY
from .registry import query

RES = "res AS (SELECT region, metric, round(sum(value) / 1e6 - 40, 4) AS residual FROM obs GROUP BY ALL)"
LEAK = "leak AS (SELECT region, count(*) FILTER (WHERE unit = 'F') AS lost FROM obs GROUP BY ALL)"
TOP = "top AS (SELECT * FROM res QUALIFY row_number() OVER (PARTITION BY region ORDER BY abs(residual) DESC, metric) = 1)"


def _residuals(spark, d):
    return views.observations(spark, d).groupBy("region", "metric").agg(F.round(F.sum("value") / 1e6 - 40, 4).alias("residual"))


@query("SELECT region, metric, residual FROM top", OBS, RES, TOP)
def w16_largest_residual(spark, d):
    return boards.largest_absolute(_residuals(spark, d), "region", "residual", "metric")


@query("SELECT region, lost, metric, residual FROM leak JOIN top USING (region)", OBS, RES, TOP, LEAK)
def j12_leakage_and_residual(spark, d):
    lost = views.observations(spark, d).groupBy("region").agg(F.count_if(F.col("unit") == "F").alias("lost"))
    return lost.join(boards.largest_absolute(_residuals(spark, d), "region", "residual", "metric"), "region")


_S, _E = "s AS (SELECT year, count(*)::DOUBLE AS value, 1 AS stamp FROM obs WHERE year <> 1996 GROUP BY 1)", "e AS (SELECT year, count(*) FILTER (WHERE quarter > 1)::DOUBLE AS value, (year % 3)::INTEGER AS stamp FROM obs GROUP BY 1)"


@query("SELECT year, CASE WHEN t THEN ev ELSE sv END AS value, CASE WHEN t THEN 'extracted' ELSE 'structured' END AS origin FROM (SELECT year, s.value AS sv, e.value AS ev, coalesce(s.value IS NULL OR (e.value IS NOT NULL AND abs(e.value - s.value) > 2.5 AND e.stamp > s.stamp), FALSE) AS t FROM s FULL JOIN e USING (year))", OBS, _S, _E)
def j14_precedence_merge(spark, d):
    o = views.observations(spark, d)
    s = o.where("year != 1996").groupBy("year").agg(F.count(F.lit(1)).cast("double").alias("value"), F.lit(1).alias("stamp"))
    e = o.groupBy("year").agg(F.count_if(F.col("quarter") > 1).cast("double").alias("value")).withColumn("stamp", F.col("year") % 3)
    return boards.merged(s, e, "year")


@query("SELECT metric, year, prev, n AS cur, is_last FROM (SELECT *, lag(n) OVER w AS prev, lead(n) OVER w IS NULL AS is_last FROM (SELECT metric, year, count(*) AS n FROM obs GROUP BY ALL) WINDOW w AS (PARTITION BY metric ORDER BY year)) WHERE prev IS NOT NULL", OBS)
def w12_steps(spark, d):
    return boards.steps(views.observations(spark, d).groupBy("metric", "year").agg(F.count(F.lit(1)).alias("n")), ["metric"], "year", "n")


@query("SELECT role, region FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY place) AS k FROM (SELECT 0 AS place, 'closest' AS role, arg_min(region, (abs(n - 600), region)) AS region FROM r UNION ALL SELECT 1, 'widest', arg_min(region, (-abs(n - 600), region)) FROM r UNION ALL SELECT 2, 'highest', arg_min(region, (-n, region)) FROM r)) WHERE k = 1", OBS, "r AS (SELECT region, count(*) AS n FROM obs GROUP BY 1)")
def w22_role_picks(spark, d):
    rows = views.observations(spark, d).groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    gap = F.abs(F.col("n") - 600)
    return boards.role_picks(rows, "region", [("closest", [gap, F.col("region")]), ("widest", [-gap, F.col("region")]), ("highest", [-F.col("n"), F.col("region")])])


@query("SELECT 'claims' AS kind, count(*) AS n FROM claims UNION ALL SELECT 'observations', count(*) FROM obs UNION ALL SELECT 'quarantine', count(*) FROM quarantine", OBS, CLAIMS, QUARANTINE)
def a22_export_counts(spark, d):
    return boards.counted(claims=views.claims(spark, d), observations=views.observations(spark, d), quarantine=views.quarantine(spark, d))


@query("SELECT count(*) AS claims, count(DISTINCT document_id) AS documents, count(DISTINCT nullif(subgroup, 'BUILDING')) AS diseases FROM obs", OBS)
def a7_kpis(spark, d):
    o = views.observations(spark, d)
    return o.agg(F.count(F.lit(1)).alias("claims"), F.count_distinct("document_id").alias("documents"), F.count_distinct(F.nullif("subgroup", F.lit("BUILDING"))).alias("diseases"))


@query("SELECT claim_id, category, row_number() OVER (ORDER BY category = '1-URGENT' DESC, run_id DESC, confidence DESC, claim_id) AS place FROM claims QUALIFY place <= 80", CLAIMS)
def r8_claim_order(spark, d):
    """The first page of results: chart-ready first, then year and confidence, newest first."""
    order = (F.desc(F.col("category") == "1-URGENT"), F.desc("run_id"), F.desc("confidence"), F.asc("claim_id"))
    page = views.claims(spark, d).orderBy(*order).limit(80)
    return boards.ranked(page, *order).select("claim_id", "category", F.col("place").cast("long").alias("place"))


@query("SELECT doc_id, status FROM registry WHERE doc_id % 7 <> 0 UNION ALL SELECT doc_id, 'synced' FROM registry WHERE doc_id % 7 = 0", REGISTRY)
def v12_replaced_items(spark, d):
    items = views.registry(spark, d).select("doc_id", "status")
    return boards.replaced(items, items.where("doc_id % 7 = 0").withColumn("status", F.lit("synced")), "doc_id")


@query("SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'id' ELSE 'suffix' END AS how FROM registry WHERE doc_id % 11 = 0 OR local_path LIKE '%7.pdf'", REGISTRY)
def u6_targets(spark, d):
    r = views.registry(spark, d)
    return boards.targets(r.where("doc_id % 11 = 0").select("doc_id"), r.where(F.col("local_path").endswith("7.pdf")).select("doc_id"), "doc_id")


@query("SELECT count(*) AS scanned, count(*) FILTER (WHERE status = 'synced') AS skipped, count(*) FILTER (WHERE status <> 'synced' AND n_chars >= 500) AS written, count(*) FILTER (WHERE status <> 'synced' AND n_chars < 500) AS missing FROM registry", REGISTRY)
def a20_backfill(spark, d):
    return boards.backfill(views.registry(spark, d), F.col("status") == "synced", F.col("n_chars") >= 500)
