"""Summaries over a table of simulated paths (draw, stage, time, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bands(draws: DataFrame, keys: list[str]) -> DataFrame:
    """Exact 10 %, 50 % and 90 % points over draws."""
    out = draws.groupBy(*keys).agg(F.percentile("value", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("p"))
    return out.select(*keys, *[F.round(F.col("p")[k], 4).alias(n) for k, n in enumerate(("p10", "median", "p90"))])


def threshold_shares(draws: DataFrame, keys: list[str], thresholds: list[float]) -> DataFrame:
    """Share of draws at or above each threshold: one pass, one column a threshold, then long."""
    aggs = [F.avg((F.col("value") >= t).cast("double")).alias(str(t)) for t in thresholds]
    return draws.groupBy(*keys).agg(*aggs).unpivot(keys, [f"`{t}`" for t in thresholds], "threshold", "share")


def first_hits(draws: DataFrame, threshold: float) -> DataFrame:
    """First time each path reaches the threshold; null if never."""
    return draws.groupBy("draw", "stage").agg(F.min(F.when(F.col("value") >= threshold, F.col("time"))).alias("hit"))


def reached_by(hits: DataFrame) -> DataFrame:
    """Share of a stage's paths whose first hit is at or before each time."""
    total = hits.groupBy("stage").agg(F.count(F.lit(1)).alias("paths"))
    per_time = hits.where("hit is not null").groupBy("stage", F.col("hit").alias("time")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("stage").orderBy("time"))
    return per_time.withColumn("upto", upto).join(total, "stage").select("stage", "time", F.round(F.col("n") / F.col("paths"), 4).alias("hit_share"), F.round(F.col("upto") / F.col("paths"), 4).alias("reached_share"))


def bottlenecks(wide: DataFrame, keys: list[str], stages: list[str], targets: dict[str, float]) -> DataFrame:
    """Share of rows in which each stage falls short the most; ``all_met`` where none does. wide has a column a stage."""
    short = {s: F.greatest(F.lit(targets[s]) - F.coalesce(F.col(f"`{s}`"), F.lit(0.0)), F.lit(0.0)) for s in stages}
    most = F.greatest(*short.values())
    which = F.when(most <= 0, "all_met")
    for s in stages:
        which = which.when(short[s] == most, s)
    counted = wide.withColumn("stage", which).groupBy(*keys, "stage").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(*keys)), 4)).drop("n")


def persistence(points: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Slope of a value on the one before it, held within 0.15 and 0.92; 0.65 with fewer than two pairs."""
    before = F.lag("value").over(Window.partitionBy(*keys).orderBy(order))
    pairs = points.withColumn("before", before).where("before is not null")
    out = pairs.groupBy(*keys).agg((F.covar_pop("before", "value") / F.nullif(F.var_pop("before"), F.lit(0.0))).alias("slope"), F.count(F.lit(1)).alias("pairs"))
    held = F.least(F.lit(0.92), F.greatest(F.lit(0.15), F.col("slope")))
    return out.select(*keys, F.round(F.when((F.col("pairs") < 2) | F.col("slope").isNull(), 0.65).otherwise(held), 4).alias("persistence"), "pairs")


def risk(shortfalls: DataFrame, n: int = 10) -> DataFrame:
    """Watch list: mean shortfall + 0.35 x leakage rate. shortfalls (region, mean_shortfall, rate)."""
    return shortfalls.withColumn("risk", F.round(F.col("mean_shortfall") + 0.35 * F.col("rate"), 2)).orderBy(F.desc("risk"), "region").limit(n)


def with_checkpoint(paths: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """Paths after an observed year has come in: its value stands in every path array, and forecasts of it and earlier years go.

    paths: ``keys``, years and values (arrays side by side), forecast (array of year, value), observed_years (array).
    observed: ``keys``, year, value; several of a key are applied alike. Keys without an observation stay as they are.
    """
    seen = observed.where("year is not null and value is not null").groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("year", "value")))).alias("__seen"), F.max("year").alias("__last"))
    held = paths.join(seen, keys, "left")
    patched = F.zip_with("years", "values", lambda y, v: F.coalesce(F.try_element_at("__seen", y), v))
    later = F.filter("forecast", lambda f: F.col("__last").isNull() | (f["year"] > F.col("__last")))
    years = F.array_sort(F.array_union("observed_years", F.coalesce(F.map_keys("__seen"), F.slice("observed_years", 1, 0))))
    return held.withColumns({"values": patched, "forecast": later, "observed_years": years}).select(*paths.columns)
