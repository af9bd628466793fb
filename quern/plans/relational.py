"""Queries of the relational families: filters, joins, aggregates, windows, set operations, upserts, search."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import numbers, text
from ..operators import resolve, search, series
from ..operators.classify import activity
from ..sources import views
from ..sources.views import CLAIMS, OBS, OFFICIAL, QUARANTINE, REGISTRY, STATUSES
from .registry import query

# --- filters and projections


@query("SELECT doc_id, local_path FROM registry WHERE contains(lower(local_path), '/src1/') OR contains(lower(local_path), '/src2/')", REGISTRY)
def f1_folder_scope(spark, d):
    path = F.lower(F.translate("local_path", "\\", "/"))
    return views.registry(spark, d).where(F.contains(path, F.lit("/src1/")) | F.contains(path, F.lit("/src2/"))).select("doc_id", "local_path")


@query("SELECT doc_id, status FROM registry WHERE status IN ('parsing', 'extracting', 'downloading')", REGISTRY)
def f2_status_set(spark, d):
    return views.registry(spark, d).where(F.col("status").isin("parsing", "extracting", "downloading")).select("doc_id", "status")


@query("SELECT claim_id, document_id FROM claims WHERE superseded_by_run_id IS NULL AND run_id = 1998", CLAIMS)
def f3_active_of_run(spark, d):
    return resolve.active(views.claims(spark, d), 1998).select("claim_id", "document_id")


@query("SELECT claim_id, confidence FROM claims WHERE confidence >= 0.8", CLAIMS)
def f4_confident(spark, d):
    return views.claims(spark, d).where("confidence >= 0.8").select("claim_id", "confidence")


@query("SELECT observation_id, region FROM obs WHERE upper(trim(region)) IN (SELECT n_name FROM nation WHERE n_regionkey = 2)", OBS)
def f5_valid_region(spark, d):
    valid = views.table(spark, d, "nation").where("n_regionkey = 2").select(F.col("n_name").alias("__r"))
    obs = views.observations(spark, d)
    return obs.join(valid, F.upper(F.trim("region")) == F.col("__r"), "left_semi").select("observation_id", "region")


@query("SELECT observation_id, value FROM obs WHERE metric IN ('1-URGENT', '2-HIGH') AND subgroup = 'BUILDING' AND unit = 'O' AND year >= 1998", OBS)
def f6_headline(spark, d):
    return views.observations(spark, d).where("metric in ('1-URGENT', '2-HIGH') and subgroup = 'BUILDING' and unit = 'O' and year >= 1998").select("observation_id", "value")


@query("SELECT observation_id, value, CASE WHEN value BETWEEN 1900 AND 2030 THEN 'year-like' WHEN value BETWEEN 100 AND 5000 THEN 'small' ELSE 'plausible' END AS band FROM obs WHERE value > 1000", OBS)
def f7_plausible(spark, d):
    band = F.when(F.col("value").between(1900, 2030), "year-like").when(F.col("value").between(100, 5000), "small").otherwise("plausible")
    return views.observations(spark, d).where("value > 1000").select("observation_id", "value", band.alias("band"))


@query("SELECT observation_id FROM obs WHERE region = 'NATION_3'", OBS)
def f8_optional_exact(spark, d):
    return views.observations(spark, d).where(search.optional_equal("region", "NATION_3") & search.optional_equal("metric", "all")).select("observation_id")


@query("SELECT doc_id, lower((quality = 1)::VARCHAR) IN ('true', '1') AS good FROM labels")
def f9_truthy(spark, d):
    return views.table(spark, d, "labels").select("doc_id", search.truthy(F.col("quality") == 1).alias("good"))


@query("SELECT event_id, (regexp_extract(props, '[0-9]+'))::BIGINT AS k FROM events WHERE regexp_extract(props, '[0-9]+') <> ''")
def f10_try_cast(spark, d):
    e = views.table(spark, d, "events")
    return e.select("event_id", numbers.matched(F.col("props"), "[0-9]+").try_cast("long").alias("k")).where("k is not null")


@query("SELECT doc_id, length(trim(text)) AS n, CASE WHEN length(trim(text)) < 50 THEN 'insufficient' WHEN length(trim(text)) < 200 OR contains(text, 'All rights reserved') THEN 'junk' ELSE 'text' END AS verdict FROM documents")
def f11_junk_text(spark, d):
    n = F.length(F.trim("text"))
    verdict = F.when(n < 50, "insufficient").when((n < 200) | F.contains("text", F.lit("All rights reserved")), "junk").otherwise("text")
    return views.table(spark, d, "documents").select("doc_id", n.cast("long").alias("n"), verdict.alias("verdict"))


@query("SELECT doc_id, local_path FROM registry WHERE status = 'failed' ORDER BY doc_id DESC LIMIT 20", REGISTRY)
def f12_failed_sample(spark, d):
    return views.registry(spark, d).where("status = 'failed'").select("doc_id", "local_path").orderBy(F.desc("doc_id")).limit(20)


@query("SELECT doc_id, local_path FROM registry WHERE ends_with(local_path, '_7.pdf') ORDER BY doc_id DESC LIMIT 1", REGISTRY)
def f13_by_suffix(spark, d):
    return views.registry(spark, d).where(F.col("local_path").endswith("_7.pdf")).select("doc_id", "local_path").orderBy(F.desc("doc_id")).limit(1)


@query("SELECT claim_id, document_id, coalesce(superseded_by_run_id, 0) AS superseded, round(value, 0)::BIGINT AS shown FROM claims", CLAIMS)
def p1_result_projection(spark, d):
    return views.claims(spark, d).select("claim_id", "document_id", F.coalesce("superseded_by_run_id", F.lit(0)).alias("superseded"), F.round("value", 0).cast("long").alias("shown"))


@query("SELECT doc_id, string_split(local_path, '/')[-1] AS name, regexp_replace(string_split(local_path, '/')[-1], '\\.[^.]*$', '') AS stem, string_split(local_path, '/')[-2] AS folder FROM registry", REGISTRY)
def p2_path_parts(spark, d):
    p = F.col("local_path")
    return views.registry(spark, d).select("doc_id", text.file_name(p).alias("name"), text.stem(p).alias("stem"), text.folder(p).alias("folder"))


@query("SELECT doc_id, CASE WHEN contains(source, '1') THEN 'first' WHEN contains(source, '2') THEN 'second' ELSE 'other' END AS category FROM documents")
def p4_category(spark, d):
    category = F.when(F.contains("source", F.lit("1")), "first").when(F.contains("source", F.lit("2")), "second").otherwise("other")
    return views.table(spark, d, "documents").select("doc_id", category.alias("category"))


@query("SELECT region, round(avg(confidence), 2) AS mean_gap, rank() OVER (ORDER BY round(avg(confidence), 2) DESC, region) AS place FROM obs GROUP BY region", OBS)
def p5_ranked_rows(spark, d):
    g = views.observations(spark, d).groupBy("region").agg(F.round(F.avg("confidence"), 2).alias("mean_gap"))
    return g.withColumn("place", F.rank().over(Window.orderBy(F.desc("mean_gap"), "region")).cast("long"))


@query("SELECT c.claim_id, c.category FROM claims c WHERE superseded_by_run_id IS NULL AND confidence >= 0.8 AND claim_id NOT IN (SELECT claim_id FROM quarantine)", CLAIMS, QUARANTINE)
def p6_export(spark, d):
    c = views.claims(spark, d)
    return resolve.not_quarantined(resolve.active(c).where("confidence >= 0.8"), views.quarantine(spark, d)).select("claim_id", "category")


# --- joins


@query("SELECT claim_id, category, c_name FROM claims JOIN customer ON document_id = c_custkey", CLAIMS)
def j1_claims_documents(spark, d):
    return views.claims(spark, d).join(views.table(spark, d, "customer").select(F.col("c_custkey").alias("document_id"), "c_name"), "document_id").select("claim_id", "category", "c_name")


@query("SELECT claim_id FROM claims WHERE claim_id NOT IN (SELECT claim_id FROM quarantine WHERE NOT resolved)", CLAIMS, QUARANTINE)
def j2_outside_quarantine(spark, d):
    return resolve.not_quarantined(views.claims(spark, d), views.quarantine(spark, d), keep_resolved=True).select("claim_id")


@query("SELECT q.claim_id, q.document_id, q.run_id, q.resolved OR c.superseded_by_run_id IS NOT NULL AS resolved FROM quarantine q JOIN claims c USING (claim_id)", CLAIMS, QUARANTINE)
def j3_resolve_quarantine(spark, d):
    return resolve.resolve_quarantine(views.quarantine(spark, d), views.claims(spark, d)).select("claim_id", "document_id", "run_id", "resolved")


@query("SELECT doc_id, file_hash, canonical_id FROM registry JOIN (SELECT file_hash, max(doc_id) AS canonical_id FROM registry GROUP BY 1) USING (file_hash) WHERE doc_id <> canonical_id", REGISTRY)
def j4_canonical_alias(spark, d):
    return resolve.canonical_by_hash(views.registry(spark, d).select("doc_id", "file_hash"))


@query("SELECT doc_id, source, first_id FROM registry LEFT JOIN (SELECT source, min(doc_id) AS first_id FROM registry GROUP BY 1) USING (source)", REGISTRY)
def j5_first_of_source(spark, d):
    r = views.registry(spark, d).select("doc_id", "source")
    return r.join(r.groupBy("source").agg(F.min("doc_id").alias("first_id")), "source", "left").select("doc_id", "source", "first_id")


@query("SELECT DISTINCT sort_key FROM obs WHERE metric = '1-URGENT' INTERSECT SELECT DISTINCT sort_key FROM obs WHERE metric = '5-LOW'", OBS)
def j7_shared_periods(spark, d):
    o = views.observations(spark, d)
    return o.where("metric = '1-URGENT'").select("sort_key").intersect(o.where("metric = '5-LOW'").select("sort_key"))


@query("SELECT n.region, coalesce(o.total, 0) AS total FROM (SELECT n_name AS region FROM nation) n LEFT JOIN (SELECT region, count(*) AS total FROM obs WHERE metric = '1-URGENT' AND value > 400000 GROUP BY 1) o USING (region)", OBS)
def j8_left_defaults(spark, d):
    o = views.observations(spark, d).where("metric = '1-URGENT' and value > 400000").groupBy("region").agg(F.count(F.lit(1)).alias("total"))
    n = views.table(spark, d, "nation").select(F.col("n_name").alias("region"))
    return n.join(o, "region", "left").select("region", F.coalesce("total", F.lit(0)).alias("total"))


@query("SELECT period_label, a.n AS urgent, b.n AS low FROM (SELECT period_label, count(*) AS n FROM obs WHERE metric = '1-URGENT' AND year < 1998 GROUP BY 1) a FULL JOIN (SELECT period_label, count(*) AS n FROM obs WHERE metric = '5-LOW' AND year > 1996 GROUP BY 1) b USING (period_label)", OBS)
def j9_full_outer_periods(spark, d):
    o = views.observations(spark, d)
    a = o.where("metric = '1-URGENT' and year < 1998").groupBy("period_label").agg(F.count(F.lit(1)).alias("urgent"))
    b = o.where("metric = '5-LOW' and year > 1996").groupBy("period_label").agg(F.count(F.lit(1)).alias("low"))
    return a.join(b, "period_label", "full_outer")


@query("SELECT year, region, max(value) FILTER (WHERE metric = '1-URGENT') AS a, max(value) FILTER (WHERE metric = '2-HIGH') AS b, max(value) FILTER (WHERE metric = '3-MEDIUM') AS c FROM obs GROUP BY ALL HAVING a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL", OBS)
def j11_stage_star(spark, d):
    from ..operators.regional import pivoted

    m = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
    wide = pivoted(views.observations(spark, d), ["year", "region"], m, "max").na.drop(subset=m)
    return wide.select("year", "region", *[F.col(f"`{x}`").alias(n) for x, n in zip(m, "abc", strict=True)])


@query("SELECT region, year, o.total, l.total AS last_total FROM (SELECT region, year, count(*) AS total FROM obs GROUP BY ALL) o LEFT JOIN (SELECT region, year, count(*) AS total FROM obs WHERE year = 2000 GROUP BY ALL) l USING (region, year)", OBS)
def j13_left_of_year(spark, d):
    per = views.observations(spark, d).groupBy("region", "year").agg(F.count(F.lit(1)).alias("total"))
    return per.join(per.where("year = 2000").withColumnRenamed("total", "last_total"), ["region", "year"], "left")


@query("SELECT doc_id, quality IS NOT NULL AS has_output FROM documents LEFT JOIN labels USING (doc_id)")
def j15_output_exists(spark, d):
    l = views.table(spark, d, "labels").select("doc_id", F.lit(True).alias("x"))
    return views.table(spark, d, "documents").select("doc_id").join(l, "doc_id", "left").select("doc_id", F.col("x").isNotNull().alias("has_output"))


@query("SELECT a.doc_id, b.doc_id AS match_id FROM registry a JOIN registry b ON regexp_replace(string_split(a.local_path, '/')[-1], '\\.pdf$', '') = regexp_replace(string_split(b.local_path, '/')[-1], '\\.pdf$', '')", REGISTRY)
def j16_stem_match(spark, d):
    r = views.registry(spark, d).select("doc_id", text.stem(F.col("local_path")).alias("stem"))
    return r.join(r.withColumnRenamed("doc_id", "match_id"), "stem").select("doc_id", "match_id")


@query("SELECT observation_id, r_name AS display FROM obs JOIN nation ON region = n_name JOIN region ON n_regionkey = r_regionkey", OBS)
def j19_display_names(spark, d):
    names = views.table(spark, d, "nation").join(views.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("region"), F.col("r_name").alias("display"))
    return views.observations(spark, d).join(names, "region").select("observation_id", "display")


@query("SELECT o_orderkey AS claim_id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')")
def j20_orphans(spark, d):
    some = views.table(spark, d, "customer").where("c_mktsegment != 'BUILDING'")
    return resolve.orphans(views.claims(spark, d), some, "document_id", "c_custkey").select("claim_id")


@query(
    "SELECT y.year, s.metric, coalesce(v.value, -1) AS value, CASE WHEN v.value IS NULL THEN 'missing' ELSE 'observed' END AS status FROM (SELECT unnest(range(1994, 2003))::INTEGER AS year) y, (SELECT DISTINCT metric FROM obs) s "
    "LEFT JOIN (SELECT year, metric, count(*)::DOUBLE AS value FROM obs GROUP BY ALL) v ON v.year = y.year AND v.metric = s.metric", OBS,
)
def j21_year_grid(spark, d):
    o = views.observations(spark, d)
    grid = o.select("metric").distinct().withColumn("year", F.explode(F.sequence(F.lit(1994), F.lit(2002))))
    v = o.groupBy("year", "metric").agg(F.count(F.lit(1)).cast("double").alias("value"))
    return grid.join(v, ["year", "metric"], "left").select("year", "metric", F.coalesce("value", F.lit(-1.0)).alias("value"), F.when(F.col("value").isNull(), "missing").otherwise("observed").alias("status"))


# --- aggregates


@query("SELECT status, count(*) AS n FROM registry WHERE contains(local_path, '/src1') GROUP BY 1", REGISTRY)
def a1_status_counts(spark, d):
    return views.registry(spark, d).where(F.contains("local_path", F.lit("/src1"))).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS claims, count(*) FILTER (WHERE superseded_by_run_id IS NULL) AS active, count(DISTINCT document_id) AS documents, count(DISTINCT category) AS categories FROM claims", CLAIMS)
def a2_totals(spark, d):
    return views.claims(spark, d).agg(F.count(F.lit(1)).alias("claims"), F.count_if(F.col("superseded_by_run_id").isNull()).alias("active"), F.count_distinct("document_id").alias("documents"), F.count_distinct("category").alias("categories"))


@query("SELECT document_id, count(*) AS n FROM claims WHERE superseded_by_run_id IS NULL GROUP BY 1", CLAIMS)
def a3_active_per_document(spark, d):
    return resolve.active(views.claims(spark, d)).groupBy("document_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT run_id AS year, count(*) AS n FROM claims GROUP BY 1 ORDER BY 1", CLAIMS)
def a4_claims_per_year(spark, d):
    return views.claims(spark, d).groupBy(F.col("run_id").alias("year")).agg(F.count(F.lit(1)).alias("n")).orderBy("year")


@query("SELECT document_id, count(*) AS n FROM claims GROUP BY 1 ORDER BY n DESC, document_id LIMIT 10", CLAIMS)
def a6_top_documents(spark, d):
    return views.claims(spark, d).groupBy("document_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "document_id").limit(10)


@query(
    "SELECT metric, region, subgroup, count(*) AS n, CASE WHEN GROUPING(metric) = 0 THEN 'metric' WHEN GROUPING(region) = 0 THEN 'region' ELSE 'subgroup' END AS facet FROM obs GROUP BY GROUPING SETS ((metric), (region), (subgroup))", OBS,
)
def a8_review_summary(spark, d):
    views.observations(spark, d).select("metric", "region", "subgroup").createOrReplaceTempView("quern_obs")
    return spark.sql("SELECT metric, region, subgroup, count(*) AS n, CASE WHEN grouping(metric) = 0 THEN 'metric' WHEN grouping(region) = 0 THEN 'region' ELSE 'subgroup' END AS facet FROM quern_obs GROUP BY GROUPING SETS ((metric), (region), (subgroup))")


@query("SELECT year, region, round(sum(value) FILTER (WHERE metric = '1-URGENT'), 2) AS urgent, round(sum(value) FILTER (WHERE metric = '5-LOW'), 2) AS low FROM obs GROUP BY ALL", OBS)
def a10_pivot(spark, d):
    from ..operators.regional import pivoted

    wide = pivoted(views.observations(spark, d).where("metric in ('1-URGENT', '5-LOW')"), ["year", "region"], ["1-URGENT", "5-LOW"])
    every = views.observations(spark, d).select("year", "region").distinct()
    return every.join(wide, ["year", "region"], "left").select("year", "region", F.round("`1-URGENT`", 2).alias("urgent"), F.round("`5-LOW`", 2).alias("low"))


@query("SELECT year, round(sum(value) FILTER (WHERE unit = 'F') / sum(value) * 100, 1) AS f_share, round(sum(value) FILTER (WHERE unit = 'O') / sum(value) * 100, 1) AS o_share FROM obs GROUP BY 1", OBS)
def a11_ratio_block(spark, d):
    s = views.observations(spark, d).groupBy("year").agg(*[F.sum(F.when(F.col("unit") == u, F.col("value"))).alias(u) for u in "FO"], F.sum("value").alias("t"))
    return s.select("year", numbers.percent(F.col("F"), F.col("t")).alias("f_share"), numbers.percent(F.col("O"), F.col("t")).alias("o_share"))


@query("SELECT period_label, document_id, metric, round(sum(value), 2) AS total, count(*) AS n FROM obs GROUP BY ALL", OBS)
def a12_sum_per_file(spark, d):
    return views.observations(spark, d).groupBy("period_label", "document_id", "metric").agg(F.round(F.sum("value"), 2).alias("total"), F.count(F.lit(1)).alias("n"))


@query("SELECT region, round(median(value), 4) AS median FROM obs GROUP BY 1", OBS)
def a16_median(spark, d):
    return views.observations(spark, d).groupBy("region").agg(F.round(F.median("value"), 4).alias("median"))


@query("SELECT year, round(sum(value), 2) AS total FROM obs GROUP BY 1", OBS)
def a17_annual_sum(spark, d):
    return views.observations(spark, d).groupBy("year").agg(F.round(F.sum("value"), 2).alias("total"))


@query("SELECT region, round(coalesce(sum(value) FILTER (WHERE metric = '1-URGENT'), 0), 2) AS alive, round(coalesce(sum(value) FILTER (WHERE metric IN ('4-NOT SPECIFIED', '5-LOW')), 0), 2) AS burden FROM obs GROUP BY 1", OBS)
def a18_leakage(spark, d):
    from ..operators.regional import leakage

    return leakage(views.observations(spark, d), "1-URGENT", "4-NOT SPECIFIED", "5-LOW").select("region", F.round("alive", 2).alias("alive"), F.round("burden", 2).alias("burden"))


@query("SELECT facet, item, count(*) AS n FROM (UNPIVOT (SELECT metric, region, subgroup, unit, year::VARCHAR AS year FROM obs) ON metric, region, subgroup, unit, year INTO NAME facet VALUE item) GROUP BY ALL", OBS)
def a21_facets(spark, d):
    return search.facets(views.observations(spark, d), ["metric", "region", "subgroup", "unit", "year"])


@query("SELECT metric, arg_min(period_label, sort_key) AS first_period, arg_max(period_label, sort_key) AS last_period, count(DISTINCT sort_key) AS n_points FROM obs GROUP BY 1", OBS)
def a29_coverage(spark, d):
    points = views.observations(spark, d).select("metric", "sort_key", "period_label").distinct()
    return series.coverage(points, ["metric"])


@query("SELECT source, arg_min(lang, doc_id) AS first_lang, min(doc_id) AS first_id FROM documents GROUP BY 1")
def a28_first_seen(spark, d):
    return views.table(spark, d, "documents").groupBy("source").agg(F.min_by("lang", "doc_id").alias("first_lang"), F.min("doc_id").alias("first_id"))


@query("SELECT metric, min(year) AS first_year, max(year) AS last_year FROM obs GROUP BY 1", OBS)
def a31_bounds(spark, d):
    return views.observations(spark, d).groupBy("metric").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"))


@query(f"SELECT s.status, s.place::INTEGER AS place, count(r.doc_id) AS n FROM (SELECT unnest([{', '.join(repr(s) for s in STATUSES)}, 'archived']) AS status, unnest(range({len(STATUSES) + 1})) AS place) s LEFT JOIN registry r USING (status) GROUP BY ALL", REGISTRY)
def a32_zero_filled_status(spark, d):
    dim = spark.createDataFrame([(s, k) for k, s in enumerate((*STATUSES, "archived"))], "status string, place int")
    n = views.registry(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return dim.join(n, "status", "left").select("status", "place", F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT year, round(avg(n), 2) AS monthly_mean FROM (SELECT year, month, count(*) AS n FROM obs GROUP BY ALL) GROUP BY 1", OBS)
def a33_monthly_mean(spark, d):
    return views.observations(spark, d).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n")).groupBy("year").agg(F.round(F.avg("n"), 2).alias("monthly_mean"))


# --- windows, ranks, sorts


@query("SELECT claim_id, document_id, category FROM claims QUALIFY row_number() OVER (PARTITION BY document_id, category ORDER BY created_at DESC, claim_id DESC) = 1", CLAIMS)
def w1_first_wins(spark, d):
    return resolve.newest(views.claims(spark, d), ["document_id", "category"], "created_at", "claim_id").select("claim_id", "document_id", "category")


@query("SELECT year, region, metric, observation_id, value FROM obs QUALIFY row_number() OVER (PARTITION BY year, region, metric ORDER BY sort_key DESC, confidence DESC, observation_id) = 1", OBS)
def w2_latest_per_key(spark, d):
    return resolve.latest_point(views.observations(spark, d), ["year", "region", "metric"]).select("year", "region", "metric", "observation_id", "value")


@query("SELECT metric, year, max(sort_key) AS sort_key, round(arg_max(value, sort_key), 2) AS value FROM (SELECT metric, year, sort_key, round(avg(value), 2) AS value FROM obs GROUP BY ALL) GROUP BY ALL", OBS)
def w3_annual_latest(spark, d):
    p = views.observations(spark, d).groupBy("metric", "year", "sort_key").agg(F.round(F.avg("value"), 2).alias("value"))
    return series.annual_latest(p, ["metric"]).select("metric", "year", "sort_key", "value")


@query("SELECT observation_id, metric, sort_key FROM obs QUALIFY sort_key = max(sort_key) OVER (PARTITION BY metric)", OBS)
def w4_latest_period(spark, d):
    from ..operators.regional import latest_rows

    return latest_rows(views.observations(spark, d), ["metric"]).select("observation_id", "metric", "sort_key")


@query("SELECT period_label, metric, observation_id, value FROM obs QUALIFY row_number() OVER (PARTITION BY period_label, metric ORDER BY CASE WHEN unit = 'O' THEN 0 ELSE 1 END, value DESC, observation_id) = 1", OBS)
def w5_candidate_pick(spark, d):
    order = (F.when(F.col("unit") == "O", 0).otherwise(1).asc(), F.desc("value"), F.asc("observation_id"))
    return resolve.first_of(views.observations(spark, d), ["period_label", "metric"], *order).select("period_label", "metric", "observation_id", "value")


@query("SELECT period_label, document_id, n FROM (SELECT period_label, document_id, count(*) AS n, max(value) AS top FROM obs GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY period_label ORDER BY n DESC, top DESC, document_id) = 1", OBS)
def w6_file_per_period(spark, d):
    g = views.observations(spark, d).groupBy("period_label", "document_id").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))
    return resolve.first_of(g, ["period_label"], F.desc("n"), F.desc("top"), F.asc("document_id")).select("period_label", "document_id", "n")


@query(
    "SELECT panel, metric, region, n_points FROM (SELECT metric, region, count(DISTINCT sort_key) AS n_points, max(sort_key) AS last_key FROM obs GROUP BY ALL) JOIN (VALUES ('burden', '1-URGENT', 0), ('burden', '2-HIGH', 1), ('care', '5-LOW', 0)) s(panel, metric, metric_rank) USING (metric) "
    "QUALIFY row_number() OVER (PARTITION BY panel ORDER BY metric_rank, n_points DESC, last_key DESC, metric, region) = 1", OBS,
)
def w7_preferred_series(spark, d):
    s = views.observations(spark, d).groupBy("metric", "region").agg(F.count_distinct("sort_key").alias("n_points"), F.max("sort_key").alias("last_key"))
    spec = spark.createDataFrame([("burden", "1-URGENT", 0), ("burden", "2-HIGH", 1), ("care", "5-LOW", 0)], "panel string, metric string, metric_rank int")
    return series.preferred(s, spec, ["metric", "region"]).select("panel", "metric", "region", "n_points")


@query("SELECT metric, sort_key, value, round(value - lag(value) OVER (PARTITION BY metric ORDER BY sort_key), 6) AS delta FROM (SELECT metric, sort_key, round(avg(value), 6) AS value FROM obs GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY metric ORDER BY sort_key DESC) = 1", OBS)
def w8_latest_delta(spark, d):
    p = series.period_means(views.observations(spark, d), ["metric"], 6)
    return series.latest_delta(p, ["metric"], 6).select("metric", "sort_key", "value", "delta")


@query("SELECT metric, region, round(arg_max(value, sort_key) - arg_min(value, sort_key), 6) AS change FROM (SELECT metric, region, sort_key, round(avg(value), 8) AS value FROM obs GROUP BY ALL) GROUP BY ALL HAVING abs(change) >= 1", OBS)
def w9_start_to_end(spark, d):
    return series.change(series.period_means(views.observations(spark, d), ["metric", "region"], 8), ["metric", "region"], digits=6).select("metric", "region", "change")


@query("SELECT p_partkey, rank() OVER (PARTITION BY p_brand ORDER BY p_size) + (count(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2.0::DOUBLE AS avg_rank FROM part")
def w10_average_rank(spark, d):
    return views.table(spark, d, "part").select("p_partkey", series.average_rank("p_size", ["p_brand"]).alias("avg_rank"))


@query("SELECT region, sort_key, n - lag(n) OVER (PARTITION BY region ORDER BY sort_key) AS diff FROM (SELECT region, sort_key, count(*) AS n FROM obs GROUP BY ALL)", OBS)
def w11_first_difference(spark, d):
    g = views.observations(spark, d).groupBy("region", "sort_key").agg(F.count(F.lit(1)).alias("n"))
    return g.select("region", "sort_key", (F.col("n") - F.lag("n").over(Window.partitionBy("region").orderBy("sort_key"))).alias("diff"))


@query(
    "SELECT region, min(sort_key) AS first_key, max(sort_key) AS coverage_end, min(v) AS value FROM (SELECT *, sum(m) OVER (PARTITION BY region ORDER BY sort_key) AS island FROM "
    "(SELECT *, CASE WHEN v <> lag(v) OVER (PARTITION BY region ORDER BY sort_key) THEN 1 ELSE 0 END AS m FROM (SELECT region, sort_key, (count(*) // 10)::DOUBLE AS v FROM obs GROUP BY ALL))) GROUP BY region, island", OBS,
)
def w13_plateaus(spark, d):
    g = views.observations(spark, d).groupBy("region", "sort_key").agg(F.floor(F.count(F.lit(1)) / 10).cast("double").alias("value"))
    return series.plateaus(g, ["region"]).drop("island")


@query(
    "SELECT g.region, g.year, v.n FROM (SELECT region, unnest(range(min(year), max(year) + 1))::INTEGER AS year FROM obs WHERE value > 490000 GROUP BY region) g LEFT JOIN (SELECT region, year, count(*) AS n FROM obs WHERE value > 490000 GROUP BY ALL) v USING (region, year)", OBS,
)
def w14_year_grid(spark, d):
    p = views.observations(spark, d).where("value > 490000").groupBy("region", "year").agg(F.count(F.lit(1)).alias("n"))
    return series.year_grid(p, ["region"]).select("region", "year", "n")


@query("SELECT region, metric, year, round(v - lag(v) OVER (PARTITION BY region, metric ORDER BY year), 6) AS delta FROM (SELECT region, metric, year, round(avg(value), 8) AS v FROM obs GROUP BY ALL)", OBS)
def w15_year_delta(spark, d):
    g = views.observations(spark, d).groupBy("region", "metric", "year").agg(F.round(F.avg("value"), 8).alias("v"))
    return g.select("region", "metric", "year", F.round(F.col("v") - F.lag("v").over(Window.partitionBy("region", "metric").orderBy("year")), 6).alias("delta"))


@query("SELECT year, n, n - lag(n) OVER (ORDER BY year) AS change FROM (SELECT run_id AS year, count(*) AS n FROM claims GROUP BY 1)", CLAIMS)
def w18_volume_change(spark, d):
    g = views.claims(spark, d).groupBy(F.col("run_id").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("change", F.col("n") - F.lag("n").over(Window.orderBy("year")))


@query(
    "SELECT event_id, round(CASE WHEN s > t0 THEN (p - p0) / ((s - t0) / 60.0::DOUBLE) END, 4) AS rate FROM (SELECT event_id, s, p, min(s) OVER w AS t0, min(p) OVER w AS p0 FROM "
    "(SELECT event_id, user_id, floor(epoch(ts))::BIGINT AS s, event_id::DOUBLE AS p FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY s RANGE BETWEEN 1800 PRECEDING AND CURRENT ROW)) QUALIFY count(*) OVER (PARTITION BY event_id) = 1",
)
def w19_rolling_rate(spark, d):
    e = views.table(spark, d, "events").select("event_id", "user_id", F.unix_timestamp("ts").alias("ts_s"), F.col("event_id").cast("double").alias("progress"))
    return series.rolling_rate(e, ["user_id"], 1800).select("event_id", "rate")


@query("SELECT user_id, arg_max(event_id, event_id) AS baseline FROM events WHERE event_type = 'signup' GROUP BY 1")
def w21_baseline(spark, d):
    return views.table(spark, d, "events").where("event_type = 'signup'").groupBy("user_id").agg(F.max_by("event_id", "event_id").alias("baseline"))


@query("SELECT document_id, claim_id FROM claims QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY created_at, claim_id) <= 8", CLAIMS)
def r1_top_per_group(spark, d):
    return resolve.first_of(views.claims(spark, d), ["document_id"], F.asc("created_at"), F.asc("claim_id"), n=8).select("document_id", "claim_id")


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY abs(c_acctbal) DESC, c_custkey LIMIT 8")
def r2_top_absolute(spark, d):
    from ..operators.regional import top_absolute

    return top_absolute(views.table(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 8, "c_custkey")


@query("SELECT doc_id, status FROM registry WHERE status IN ('parsing', 'extracting') ORDER BY CASE status WHEN 'extracting' THEN 0 ELSE 1 END, n_chars DESC, doc_id DESC LIMIT 25", REGISTRY)
def r5_work_queue(spark, d):
    r = views.registry(spark, d).where(F.col("status").isin("parsing", "extracting"))
    return r.orderBy(F.when(F.col("status") == "extracting", 0).otherwise(1), F.desc("n_chars"), F.desc("doc_id")).limit(25).select("doc_id", "status")


@query("SELECT metric, region, count(DISTINCT sort_key) AS n_points FROM obs GROUP BY ALL ORDER BY n_points DESC, metric, region LIMIT 20", OBS)
def r6_trend_order(spark, d):
    g = views.observations(spark, d).groupBy("metric", "region").agg(F.count_distinct("sort_key").alias("n_points"))
    return g.orderBy(F.desc("n_points"), "metric", "region").limit(20)


# --- sets, upserts, versions, search


@query("SELECT year FROM obs WHERE metric IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW') GROUP BY 1 HAVING count(DISTINCT metric) = 5", OBS)
def u2_common_years(spark, d):
    return views.observations(spark, d).groupBy("year").agg(F.count_distinct("metric").alias("n")).where("n = 5").select("year")


@query("SELECT DISTINCT year FROM (SELECT year FROM obs WHERE metric = '1-URGENT' UNION SELECT year FROM official)", OBS, OFFICIAL)
def u3_union_years(spark, d):
    return views.observations(spark, d).where("metric = '1-URGENT'").select("year").union(views.official(spark, d).select("year")).distinct()


@query("SELECT id, value FROM (SELECT concat(year, ':', observation_id) AS id, value FROM obs) WHERE NOT starts_with(id, '1996') UNION ALL SELECT concat('1996:new:', metric), count(*)::DOUBLE FROM obs GROUP BY metric", OBS)
def u4_replace_batch(spark, d):
    o = views.observations(spark, d)
    base = o.select(F.concat_ws(":", F.col("year").cast("string"), F.col("observation_id").cast("string")).alias("id"), "value")
    batch = o.groupBy("metric").agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.concat(F.lit("1996:new:"), "metric").alias("id"), "value")
    return resolve.replace_prefix(base, batch, "id", "1996")


@query("SELECT DISTINCT source, lang FROM documents WHERE source IN ('src1', 'src2', 'src3')")
def u5_distinct_sources(spark, d):
    return views.table(spark, d, "documents").where(F.col("source").isin("src1", "src2", "src3")).select("source", "lang").distinct()


@query("SELECT doc_id, file_hash, row_number() OVER (PARTITION BY file_hash ORDER BY doc_id) = 1 AND file_hash NOT IN (SELECT file_hash FROM registry WHERE doc_id % 5 = 0) AS is_new FROM registry WHERE doc_id % 5 <> 0", REGISTRY)
def v1_insert_if_new(spark, d):
    r = views.registry(spark, d).select("doc_id", "file_hash")
    return resolve.insert_new(r.where("doc_id % 5 != 0"), r.where("doc_id % 5 = 0"), "file_hash", "doc_id")


@query("SELECT metric, year, round(coalesce(c.v, o.v), 2) AS value FROM (SELECT metric, year, avg(value) AS v FROM obs GROUP BY ALL) o FULL JOIN (SELECT metric, year, value AS v FROM official WHERE year >= 2000) c USING (metric, year)", OBS, OFFICIAL)
def v2_upsert(spark, d):
    base = views.observations(spark, d).groupBy("metric", "year").agg(F.avg("value").alias("value"))
    out = resolve.upsert(base, views.official(spark, d).where("year >= 2000"), ["metric", "year"])
    return out.select("metric", "year", F.round("value", 2).alias("value"))


@query("SELECT claim_id, CASE WHEN superseded_by_run_id IS NULL AND run_id <> n THEN n ELSE superseded_by_run_id END AS superseded_by_run_id FROM claims JOIN (SELECT document_id, max(run_id) AS n FROM claims GROUP BY 1) USING (document_id)", CLAIMS)
def v4_supersede(spark, d):
    c = views.claims(spark, d)
    newest = c.groupBy("document_id").agg(F.max("run_id").alias("new_run"))
    return resolve.supersede(c, newest).select("claim_id", "superseded_by_run_id")


@query(
    "SELECT document_id, CASE WHEN document_id % 7 = 0 THEN 'gate failed' WHEN document_id % 11 = 0 THEN 'extraction failed' WHEN document_id % 13 = 0 THEN 'verification failed' WHEN new_count = 0 AND old_count > 0 THEN 'nothing would replace something' ELSE 'promoted' END AS reason "
    "FROM (SELECT document_id, count(*) FILTER (WHERE run_id = 2000) AS new_count, count(*) FILTER (WHERE run_id < 2000) AS old_count FROM claims GROUP BY 1)", CLAIMS,
)
def v5_refresh_decision(spark, d):
    c = views.claims(spark, d).groupBy("document_id").agg(F.count_if(F.col("run_id") == 2000).alias("new_count"), F.count_if(F.col("run_id") < 2000).alias("old_count"))
    c = c.withColumn("gate", F.when(F.col("document_id") % 7 == 0, "fail").otherwise("pass")).withColumn("extracted", F.col("document_id") % 11 != 0).withColumn("verified", F.col("document_id") % 13 != 0)
    return resolve.refresh_decisions(c).select("document_id", "reason")


@query("SELECT doc_id, CASE status WHEN 'downloading' THEN 'pending' WHEN 'parsing' THEN 'downloaded' WHEN 'extracting' THEN 'parsed' ELSE status END AS status FROM registry", REGISTRY)
def v6_restart(spark, d):
    return resolve.restarted(views.registry(spark, d)).select("doc_id", "status")


@query("SELECT doc_id, CASE WHEN status = 'failed' THEN CASE WHEN file_hash IN (SELECT file_hash FROM registry WHERE doc_id % 2 = 0) THEN 'parsed' ELSE 'pending' END ELSE status END AS status FROM registry", REGISTRY)
def v7_reset_failed(spark, d):
    r = views.registry(spark, d)
    return resolve.reset_failed(r.select("doc_id", "file_hash", "status"), r.where("doc_id % 2 = 0")).select("doc_id", "status")


@query("SELECT run_id, count(*) AS claims, count(DISTINCT document_id) AS documents, min(created_at) AS first_claim, max(created_at) AS last_claim FROM claims GROUP BY 1", CLAIMS)
def v10_runs(spark, d):
    return resolve.runs(views.claims(spark, d))


@query("SELECT doc_id, source, lang FROM documents WHERE lang = 'en' AND contains(lower(regexp_replace(concat_ws(' ', text, source), '[ \\t\\n\\r\\f\\v]+', ' ', 'g')), 'the and') ORDER BY doc_id LIMIT 80")
def z1_search(spark, d):
    docs = views.table(spark, d, "documents")
    return search.search(docs, {"lang": "en", "source": "all"}, ["text", "source"], "The and", [F.asc("doc_id")]).select("doc_id", "source", "lang")


@query("SELECT term, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS term FROM documents) WHERE term <> '' GROUP BY ALL")
def z3_postings(spark, d):
    """Every term of every document with its occurrences there."""
    return search.postings(views.table(spark, d, "documents"), "doc_id", ["text"]).select("term", "doc_id", "tf")


@query("SELECT term, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS term FROM documents) WHERE term <> '' GROUP BY ALL")
def z3_all_postings(spark, d):
    """Postings of the whole table."""
    return search.postings(views.table(spark, d, "documents"), "doc_id", ["text"]).select("term", "doc_id", "tf")


@query("SELECT doc_id, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS term FROM documents) WHERE term IN ('the', 'and', 'with') GROUP BY 1 HAVING count(DISTINCT term) = 3")
def z3_term_search(spark, d):
    index = search.postings(views.table(spark, d, "documents"), "doc_id", ["text"])
    return search.term_search(index, "doc_id", ["the", "and", "with"]).select("doc_id", "tf")


@query("SELECT doc_id, CASE WHEN n_chars IS NULL THEN 'unknown' WHEN n_chars >= 900 THEN 'possible stall' WHEN n_chars >= 240 THEN 'slow' ELSE 'active' END AS state FROM documents")
def c21_activity(spark, d):
    return views.table(spark, d, "documents").select("doc_id", activity(F.col("n_chars")).alias("state"))
