"""Series: building, windows over periods, fits and forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .resolve import first_of


def period_means(obs: DataFrame, keys: list[str], digits: int = 4) -> DataFrame:
    """Mean of each period, rounded, with how many samples it has."""
    return obs.groupBy(*keys, "period_label", "sort_key", "decimal_year").agg(F.round(F.avg("value"), digits).alias("value"), F.count(F.lit(1)).alias("sample_count"))


def build(obs: DataFrame, keys: list[str], least: int = 2, digits: int = 4) -> DataFrame:
    """One row a series: its points in period order; at least ``least`` periods. An array holds a point a period."""
    point = F.struct("sort_key", "decimal_year", "period_label", "value", "sample_count")
    series = period_means(obs, keys, digits).groupBy(*keys).agg(F.array_sort(F.collect_list(point)).alias("points"))
    return series.withColumn("n_points", F.size("points").cast("long")).where(F.col("n_points") >= least)


def latest_delta(points: DataFrame, keys: list[str], digits: int = 2) -> DataFrame:
    """Latest point of each series and its change from the point before."""
    w = Window.partitionBy(*keys).orderBy("sort_key")
    return first_of(points.withColumn("previous", F.lag("value").over(w)).withColumn("delta", F.round(F.col("value") - F.col("previous"), digits)), keys, F.desc("sort_key"))


def coverage(points: DataFrame, keys: list[str]) -> DataFrame:
    return points.groupBy(*keys).agg(F.min_by("period_label", "sort_key").alias("first_period"), F.max_by("period_label", "sort_key").alias("last_period"), F.count(F.lit(1)).alias("n_points"))


def change(points: DataFrame, keys: list[str], least: float = 1.0, digits: int = 2) -> DataFrame:
    """Start-to-end change where it is at least ``least``."""
    ends = points.groupBy(*keys).agg(F.min_by("value", "sort_key").alias("start_value"), F.max_by("value", "sort_key").alias("end_value"))
    return ends.withColumn("change", F.round(F.col("end_value") - F.col("start_value"), digits)).where(F.abs("change") >= least)


def annual_latest(points: DataFrame, keys: list[str]) -> DataFrame:
    """The latest point of each year."""
    return points.groupBy(*keys, "year").agg(F.max_by("value", "sort_key").alias("value"), F.max("sort_key").alias("sort_key"))


def average_rank(column: str, keys: list[str]) -> Column:
    """Rank from 1; ties share the mean of their ranks."""
    alike = F.count(F.lit(1)).over(Window.partitionBy(*keys, column))
    return F.rank().over(Window.partitionBy(*keys).orderBy(column)) + (alike - 1) / 2.0


def plateaus(points: DataFrame, keys: list[str], tolerance: float = 1e-6) -> DataFrame:
    """Runs of equal values as one row: first period, end of coverage, value."""
    w = Window.partitionBy(*keys).orderBy("sort_key")
    moved = F.coalesce((F.abs(F.col("value") - F.lag("value").over(w)) > tolerance).cast("int"), F.lit(0))
    islands = points.withColumn("__moved", moved).withColumn("island", F.sum("__moved").over(w))
    return islands.groupBy(*keys, "island").agg(F.min("sort_key").alias("first_key"), F.max("sort_key").alias("coverage_end"), F.min_by("value", "sort_key").alias("value"))


def year_grid(points: DataFrame, keys: list[str]) -> DataFrame:
    """Every year between a series' first and last, null where nothing was observed."""
    span = points.groupBy(*keys).agg(F.min("year").alias("__a"), F.max("year").alias("__b"))
    grid = span.select(*keys, F.explode(F.sequence("__a", "__b")).alias("year"))
    return grid.join(points, [*keys, "year"], "left")


def fit(points: DataFrame, keys: list[str], x: str = "decimal_year", y: str = "value") -> DataFrame:
    """Least squares for each key; a series without spread in x is flat at its mean."""
    out = points.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"), F.avg(y).alias("mean"), F.count(F.lit(1)).alias("n_points"))
    flat = F.col("slope").isNull() | F.isnan("slope")
    return out.select(*keys, F.when(flat, 0.0).otherwise(F.col("slope")).alias("slope"), F.when(flat, F.col("mean")).otherwise(F.col("intercept")).alias("intercept"), F.when(flat | F.isnan("r2"), 0.0).otherwise(F.greatest(F.lit(0.0), F.coalesce("r2", F.lit(0.0)))).alias("r2"), "n_points")


def theil_sen(points: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Median of the slopes of all pairs of points of a series, and median intercept: points pair within their own (short) series."""
    a = points.select(*keys, F.col(x).alias("x1"), F.col(y).alias("y1"))
    b = points.select(*keys, F.col(x).alias("x2"), F.col(y).alias("y2"))
    slopes = a.join(b, keys).where("x2 > x1").groupBy(*keys).agg(F.median((F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1"))).alias("slope"))
    return points.join(slopes, keys).groupBy(*keys, "slope").agg(F.median(F.col(y) - F.col("slope") * F.col(x)).alias("intercept"))


def residuals(points: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    fits = fit(points, keys, x, y).select(*keys, "slope", "intercept")
    return points.join(fits, keys).withColumn("expected", F.col("intercept") + F.col("slope") * F.col(x)).withColumn("residual", F.col(y) - F.col("expected"))


def forecast(points: DataFrame, keys: list[str], target: float, deadline: float, horizon: float = 15.0, digits: int = 2, gap_digits: int = 2) -> DataFrame:
    """Gap, slope, date at which the fit meets the target, and what that says about the deadline."""
    last = points.groupBy(*keys).agg(F.max("decimal_year").alias("last_x"), F.max_by("value", "decimal_year").alias("last_value"))
    out = fit(points, keys).join(last, keys).withColumn("gap", F.lit(target) - F.col("last_value"))
    years = F.when((F.col("slope") > 0) & (F.col("gap") > 0), F.col("gap") / F.col("slope"))
    projected = F.when(F.col("gap") <= 0, F.col("last_x")).when(years <= horizon, F.col("last_x") + years)
    out = out.withColumn("projected", projected)
    return out.select(
        *keys, "n_points", F.round("gap", gap_digits).alias("gap"), F.round("slope", digits).alias("slope_per_year"), F.round("r2", 4).alias("r2"), F.round("projected", digits).alias("projected"),
        F.when(F.col("n_points") < 3, "insufficient_data").when(F.col("gap") <= 0, "met").when(F.col("slope") > 0, "rising").otherwise("not_rising").alias("trajectory"),
        F.when(F.col("projected").isNull(), "not_projected").when(F.col("projected") <= deadline, "on_time").otherwise("late").alias("deadline_status"),
        F.when(F.col("r2") >= 0.7, "strong").when(F.col("r2") >= 0.3, "moderate").otherwise("weak").alias("fit_quality"),
    )


def preferred(series: DataFrame, spec: DataFrame, keys: list[str], least_points: int = 2) -> DataFrame:
    """For each panel of spec (panel, metric, metric_rank) its best series: metric rank, then most points, then latest, then key order."""
    ranked = series.where(F.col("n_points") >= least_points).join(F.broadcast(spec), "metric")
    return first_of(ranked, ["panel"], F.asc("metric_rank"), F.desc("n_points"), F.desc("last_key"), *[F.asc(k) for k in keys])


def rolling_rate(events: DataFrame, keys: list[str], seconds: int) -> DataFrame:
    """Progress a minute over the window that ends at each row: earliest against latest sample in it (progress never falls)."""
    w = Window.partitionBy(*keys).orderBy("ts_s").rangeBetween(-seconds, 0)
    out = events.withColumn("t0", F.min("ts_s").over(w)).withColumn("p0", F.min("progress").over(w))
    return out.withColumn("rate", F.when(F.col("ts_s") > F.col("t0"), F.round((F.col("progress") - F.col("p0")) / ((F.col("ts_s") - F.col("t0")) / 60.0), 4)))


def spearman(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    ranked = df.withColumn("__x", average_rank(x, keys)).withColumn("__y", average_rank(y, keys))
    return ranked.groupBy(*keys).agg(F.corr("__x", "__y").alias("rho"), F.count(F.lit(1)).alias("n"))


def first_source(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Points of several sources, the first that has a key speaks; ``source`` is its place in the list."""
    every = parts[0].withColumn("source", F.lit(0))
    for k, part in enumerate(parts[1:], 1):
        every = every.unionByName(part.select(*parts[0].columns).withColumn("source", F.lit(k)))
    others = [c for c in parts[0].columns if c not in keys]
    best = every.where("value is not null").groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct("source", *others)).alias("__b"), F.min("source").alias("source"))
    return best.select(*keys, *[F.col(f"__b.{c}").alias(c) for c in others], "source")


def plausible_merge(structured: DataFrame, extracted: DataFrame, keys: list[str], low: float, high: float) -> DataFrame:
    """Yearly points (year, sort_key, value), extracted ones let in year by year where they are plausible.

    A year without a point takes one within 0.8 to 1.35 times the year before's, or within low to high where that has none; a point
    gives way to a later one within 0.8 to 1.25 times its own. A series' years fit into one row.
    """
    point = F.struct("sort_key", "value")
    rows = lambda df, name: df.where("value is not null").groupBy(*keys, "year").agg(F.max_by(point, F.struct("sort_key", "value")).alias("p")).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("year", "p"))).alias(name))
    both = rows(structured, "__s").join(rows(extracted, "__e"), keys, "full")
    none = lambda c: F.coalesce(c, F.slice(F.coalesce("__s", "__e"), 1, 0))

    def step(known, e):
        now, before = F.try_element_at(known, e["year"]), F.try_element_at(known, e["year"] - 1)
        value = e["p"]["value"]
        new = F.when(before.isNull(), value.between(low, high)).otherwise(value.between(before["value"] * 0.8, before["value"] * 1.35))
        later = value.between(now["value"] * 0.8, now["value"] * 1.25) & (e["p"]["sort_key"] > now["sort_key"])
        taken = F.when(now.isNull(), new).otherwise(later)
        return F.when(taken, F.map_concat(F.map_filter(known, lambda y, _: y != e["year"]), F.map_from_arrays(F.array(e["year"]), F.array(e["p"])))).otherwise(known)

    merged = F.aggregate(none(F.col("__e")), F.map_from_entries(none(F.col("__s"))), step)
    return both.select(*keys, F.explode(merged).alias("year", "p")).select(*keys, "year", "p.sort_key", "p.value")


def coverage_report(points: DataFrame, keys: list[str]) -> DataFrame:
    """first and last year, number of points and the latest value, written with thousands, of each series."""
    out = points.where("value is not null").groupBy(*keys).agg(F.min("year").alias("first"), F.max("year").alias("last"), F.count(F.lit(1)).alias("points"), F.max_by("value", "year").alias("latest"))
    return out.select(*keys, F.concat_ws("-", "first", "last").alias("coverage"), "points", F.format_number("latest", 0).alias("latest"))
