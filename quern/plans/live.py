"""Streams that extract and watch, observed checkpoints and releases of several feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import draws, extract, tables
from ..sources import releases, views
from ..sources.views import OBS
from ..streaming import intake, stalls
from .registry import query
from .texts import _scratch


def normalized_claims(documents: DataFrame) -> DataFrame:
    """Claims of whole documents (doc_id, text, source), normalised: doc_id, line_no and the columns of the normaliser."""
    path = F.concat(F.lit("/"), F.coalesce("source", F.lit("")), F.lit("/HIV_STI_"), (F.pmod("doc_id", F.lit(20)) + 2005).cast("string"), F.lit("_"), F.col("doc_id").cast("string"), F.lit(".pdf"))
    found = extract.claims(documents).join(documents.select("doc_id", path.alias("local_path")), "doc_id")
    raw = found.withColumn("claim_id", F.concat_ws(":", "doc_id", "strategy_rank", "line_no")).withColumn("page_index", F.lit(0))
    part = lambda k: F.split("claim_id", ":")[k]
    return tables.normalized(raw).withColumns({"doc_id": part(0).cast("long"), "line_no": part(2).cast("int")})


@query()
def y3_stream_claims(spark, d):
    """Claims of the documents as they arrive, each once; a test holds them to the batch."""
    path, at = f"{d}/documents.parquet", _scratch(spark)
    stream = intake.follow(spark, path, spark.read.parquet(path).schema, 8)
    intake.claims_into(stream, f"{at}/out", f"{at}/log", normalized_claims)
    return intake.current_claims(spark, f"{at}/out").select("doc_id", "line_no", "category", "metric_type", "region", "year", "document_type", F.md5("claim_text").alias("digest"))


@query(
    "SELECT user_id, flag, ts AS last_event FROM (SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS later FROM (SELECT DISTINCT user_id, ts FROM events)), (SELECT max(ts) - INTERVAL 1 HOUR AS seen FROM events), (VALUES (240, 'slow'), (900, 'stalled')) f(s, flag) "
    "WHERE coalesce(later, seen) >= ts + s * INTERVAL 1 SECOND"
)
def y5_live_stalls(spark, d):
    """Every silence of 240 and 900 seconds: told by later events, and by timers where none came before the watermark."""
    path, at = f"{d}/events.parquet", _scratch(spark)
    schema = views.table(spark, d, "events").schema
    stream = intake.follow(stalls.with_timers(spark), path, schema).withColumn("ts", F.col("ts").cast("timestamp"))
    intake.drain(stalls.stall_flags(stream, "ts", "user_id"), f"{at}/out", f"{at}/log")
    return spark.read.schema("user_id long, flag string, last_event timestamp").parquet(f"{at}/out").withColumn("last_event", F.col("last_event").cast("timestamp_ntz"))


YEARLY = "yearly AS (SELECT region, metric, year, floor(avg(value))::BIGINT AS value FROM obs GROUP BY ALL), ends AS (SELECT max(year) AS last FROM obs)"


def _yearly(spark, d) -> DataFrame:
    return views.observations(spark, d).groupBy("region", "metric", "year").agg(F.floor(F.avg("value")).cast("long").alias("value"))


@query(
    """SELECT region, metric, string_agg(coalesce(seen, value)::VARCHAR, ',' ORDER BY year) AS vals,
      coalesce(string_agg(year::VARCHAR, ',' ORDER BY year) FILTER (WHERE year >= last - 2 AND (NOT has OR year > last - 1)), '') AS forecast_years,
      coalesce(string_agg(year::VARCHAR, ',' ORDER BY year) FILTER (WHERE year <= last - 3 OR has AND year = last - 1), '') AS observed_years
      FROM (SELECT *, count(seen) OVER (PARTITION BY region, metric) > 0 AS has FROM (SELECT y.*, last, CASE WHEN region < 'NATION_2' AND year = last - 1 THEN value + 7 END AS seen FROM yearly y, ends)) GROUP BY 1, 2""",
    OBS,
    YEARLY,
)
def v11_observed_checkpoint(spark, d):
    """The year before the last is observed in regions before NATION_2: it replaces the paths' value and the forecasts up to it."""
    yearly = _yearly(spark, d)
    last = yearly.agg(F.max("year").alias("last"))
    rows = yearly.join(last, F.lit(True))
    point = F.struct("year", "value")
    paths = rows.groupBy("region", "metric").agg(
        F.array_sort(F.collect_list(point)).alias("p"), F.array_sort(F.collect_list(F.when(F.col("year") >= F.col("last") - 2, point))).alias("forecast"), F.array_sort(F.collect_list(F.when(F.col("year") <= F.col("last") - 3, F.col("year")))).alias("observed_years")
    )
    paths = paths.select("region", "metric", F.col("p.year").alias("years"), F.col("p.value").alias("values"), "forecast", "observed_years")
    observed = rows.where("region < 'NATION_2' and year = last - 1").select("region", "metric", "year", (F.col("value") + 7).alias("value"))
    joined = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    out = draws.with_checkpoint(paths, observed, ["region", "metric"])
    return out.select("region", "metric", joined("values").alias("vals"), joined("forecast.year").alias("forecast_years"), joined("observed_years").alias("observed_years"))


def feeds(yearly: DataFrame, year) -> dict[str, DataFrame]:
    """What a release of one year brings to each feed; yearly: region, metric, year, value."""
    now = yearly.where(F.col("year") == year)
    national = now.groupBy("metric", "year").agg(F.sum("value").alias("value"))
    burden = now.groupBy("region", "year").agg(F.sum("value").alias("value"))
    ladder = now.groupBy("region").agg(F.max("value").alias("value"))
    mean = now.groupBy("metric").agg(F.floor(F.avg("value")).alias("mean"))
    residuals = now.join(mean, "metric").select("region", "metric", (F.col("value") - F.col("mean")).alias("value"))
    anomalies = residuals.orderBy(F.desc(F.abs("value")), "region", "metric").limit(8)
    return {"national": national, "burden": burden, "ladder": ladder, "anomalies": anomalies}


#: Feeds that keep earlier years, with their keys; the others are a release's own.
KEPT = {"national": ["metric", "year"], "burden": ["region", "year"]}


def release(spark, root: str, new: dict[str, DataFrame]) -> int:
    """Publish what a release brings: restated and added in feeds that are kept, in place of the others."""
    old = releases.pinned(spark, root)
    merged = {n: releases.upserted(releases.read(spark, old, n) if n in old[1] else None, df, KEPT[n]) if n in KEPT else df for n, df in new.items()}
    return releases.publish(spark, root, merged)


@query(
    """SELECT 'national' AS feed, metric AS name, year, sum(value)::BIGINT AS value FROM yearly, ends WHERE year >= last - 2 GROUP BY ALL
      UNION ALL SELECT 'burden', region, year, sum(value)::BIGINT FROM yearly, ends WHERE year >= last - 2 GROUP BY ALL
      UNION ALL SELECT 'ladder', region, NULL, max(value)::BIGINT FROM yearly, ends WHERE year = last GROUP BY ALL
      UNION ALL (SELECT 'anomalies', concat(region, ':', metric), NULL, value FROM (SELECT y.region, y.metric, (y.value - floor(avg(y.value) OVER (PARTITION BY y.metric)))::BIGINT AS value FROM yearly y, ends WHERE year = last) ORDER BY abs(value) DESC, region, metric LIMIT 8)""",
    OBS,
    YEARLY,
)
def b15_release_update(spark, d):
    """Three yearly releases of four feeds, each flipped at once; the feeds as the last release has them."""
    root, yearly = _scratch(spark), _yearly(spark, d).persist()
    try:
        last = yearly.agg(F.max("year")).first()[0] or 0
        for year in range(last - 2, last + 1):
            release(spark, root, feeds(yearly, year))
    finally:
        yearly.unpersist()
    now = releases.pinned(spark, root)
    names = {"national": F.col("metric"), "burden": F.col("region"), "ladder": F.col("region"), "anomalies": F.concat_ws(":", "region", "metric")}
    parts = [releases.read(spark, now, f).select(F.lit(f).alias("feed"), n.alias("name"), (F.col("year") if f in KEPT else F.lit(None)).cast("int").alias("year"), F.col("value").cast("long").alias("value")) for f, n in names.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
