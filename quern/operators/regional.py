"""Regional layers: pivots, snapshots, gaps, scorecards, scatters and outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .series import fit


def pivoted(obs: DataFrame, keys: list[str], metrics: list[str], how: str = "sum") -> DataFrame:
    """Metrics as columns; naming them spares Spark a pass over the data."""
    agg = {"sum": F.sum, "avg": F.avg, "max": F.max}[how]
    return obs.groupBy(*keys).pivot("metric", metrics).agg(agg("value"))


def latest_period(obs: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the latest period of each key."""
    last = F.max("sort_key").over(Window.partitionBy(*keys))
    return obs.withColumn("__last", last).where("sort_key = __last").drop("__last")


def latest_rows(obs: DataFrame, keys: list[str]) -> DataFrame:
    """As ``latest_period`` by a small aggregate and a join, for keys of few values: no rows of a hot key meet in one task."""
    last = obs.groupBy(*keys).agg(F.max("sort_key").alias("sort_key"))
    return obs.join(F.broadcast(last), [*keys, "sort_key"])


def region_means(obs: DataFrame, digits: int = 2) -> DataFrame:
    return obs.groupBy("metric", "region").agg(F.round(F.avg("value"), digits).alias("value"))


def gap_snapshot(obs: DataFrame, targets: dict[str, float], digits: int = 2) -> DataFrame:
    """metric, region, value, gap to target in the latest period of each metric."""
    target = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])
    return region_means(latest_rows(obs.where(F.col("metric").isin(*targets)), ["metric"]), digits).withColumn("gap", F.round(target[F.col("metric")] - F.col("value"), digits))


def snapshot_summary(snapshot: DataFrame, digits: int = 2) -> DataFrame:
    """Spread, median, leader and laggard of each metric; ties go to the first region by name."""
    best = F.min_by("region", F.struct(-F.col("value"), F.col("region")))
    worst = F.min_by("region", F.struct("value", "region"))
    return snapshot.groupBy("metric").agg(F.round(F.max("value") - F.min("value"), digits).alias("spread"), F.round(F.median("value"), digits).alias("median"), best.alias("leader"), worst.alias("laggard"), F.count(F.lit(1)).alias("regions"))


def scorecard(snapshot: DataFrame, digits: int = 2) -> DataFrame:
    """Mean gap of each region over its metrics."""
    return snapshot.groupBy("region").agg(F.round(F.avg("gap"), digits).alias("mean_gap"), F.count(F.lit(1)).alias("metric_count"))


def scorecard_maps(snapshot: DataFrame) -> DataFrame:
    """Also each metric's value and gap, as maps."""
    entry = lambda c: F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", c))))
    return snapshot.groupBy("region").agg(F.round(F.avg("gap"), 2).alias("mean_gap"), entry("value").alias("metric_values"), entry("gap").alias("metric_gaps"))


def ends(card: DataFrame, n: int = 5) -> DataFrame:
    """The n smallest and n largest mean gaps, with their side and rank."""
    best = card.orderBy("mean_gap", "region").limit(n).withColumn("side", F.lit("best"))
    worst = card.orderBy(F.desc("mean_gap"), "region").limit(n).withColumn("side", F.lit("largest_gap"))
    return best.unionByName(worst)


def scatter(obs: DataFrame, x_metric: str, y_metric: str, least: int = 3) -> DataFrame:
    """Regions' mean x and y of the latest period that at least ``least`` regions share."""
    means = obs.where(F.col("metric").isin(x_metric, y_metric)).groupBy("sort_key", "region").agg(F.avg(F.when(F.col("metric") == x_metric, F.col("value"))).alias("x"), F.avg(F.when(F.col("metric") == y_metric, F.col("value"))).alias("y")).where("x is not null and y is not null")
    last = means.groupBy("sort_key").count().where(F.col("count") >= least).agg(F.max("sort_key").alias("sort_key"))
    return means.join(F.broadcast(last), "sort_key")


def quadrants(points: DataFrame) -> DataFrame:
    """Points with quadrant against the medians, and residual from their fit."""
    medians = points.agg(F.median("x").alias("mx"), F.median("y").alias("my"))
    line = fit(points.withColumn("__all", F.lit(1)), ["__all"], "x", "y").select("slope", "intercept")
    side = F.concat(F.when(F.col("y") >= F.col("my"), "high y, ").otherwise("low y, "), F.when(F.col("x") >= F.col("mx"), "high x").otherwise("low x"))
    # both are a single row
    joined = points.join(F.broadcast(medians), F.lit(True)).join(F.broadcast(line), F.lit(True))
    return joined.select("region", "x", "y", side.alias("quadrant"), (F.col("y") - F.col("intercept") - F.col("slope") * F.col("x")).alias("residual"))


def yearly_layer(latest: DataFrame, stages: list[str], digits: int = 2) -> DataFrame:
    """(year, region) with all stages present, and the mean gap of the stages to the best region of the year."""
    wide = pivoted(latest, ["year", "region"], stages, "max").na.drop(subset=stages)
    top = Window.partitionBy("year")
    gaps = [F.max(f"`{s}`").over(top) - F.col(f"`{s}`") for s in stages]
    return wide.withColumn("mean_gap", F.round(sum(gaps[1:], gaps[0]) / len(stages), digits))


def leakage(obs: DataFrame, alive: str, lost: str, off: str) -> DataFrame:
    """Burden = lost + off, and its share of alive + burden, by region."""
    pick = lambda m: F.coalesce(F.sum(F.when(F.col("metric") == m, F.col("value"))), F.lit(0.0))
    out = obs.groupBy("region").agg(pick(alive).alias("alive"), (pick(lost) + pick(off)).alias("burden"))
    return out.withColumn("rate", F.try_divide(F.col("burden"), F.col("alive") + F.col("burden")) * 100)


def top_absolute(df: DataFrame, column: str, n: int, tie: str) -> DataFrame:
    """The n largest by absolute value, in signed order."""
    return df.orderBy(F.desc(F.abs(column)), tie).limit(n).orderBy(F.desc(column), tie)


def outlier_score(df: DataFrame, n: int = 3) -> DataFrame:
    """Top by |residual| + 3 * leakage / largest leakage; df has one row a region."""
    largest = df.agg(F.max("rate").alias("__top"))
    score = F.abs("residual") + 3 * F.try_divide(F.col("rate"), F.col("__top"))
    return df.join(F.broadcast(largest), F.lit(True)).withColumn("score", score).drop("__top").orderBy(F.desc("score"), "region").limit(n)
