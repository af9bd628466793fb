"""Merges, picks, counts and orders of the boards: DataFrame -> DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numbers


def largest_absolute(df: DataFrame, key: str, column: str, tie: str) -> DataFrame:
    """The row of each key whose ``column`` lies farthest from 0; ties go to the smaller ``tie``."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(F.abs(column)), tie))
    return df.withColumn("__place", place).where("__place = 1").drop("__place")


def merged(structured: DataFrame, extracted: DataFrame, key: str, differs: float = 2.5) -> DataFrame:
    """``key``, value, origin: the structured value unless it is absent, or the extracted one differs by more than ``differs`` and is newer."""
    s, e = structured.select(key, F.col("value").alias("sv"), F.col("stamp").alias("ss")), extracted.select(key, F.col("value").alias("ev"), F.col("stamp").alias("es"))
    takes = F.col("sv").isNull() | (F.col("ev").isNotNull() & (F.abs(F.col("ev") - F.col("sv")) > differs) & (F.col("es") > F.col("ss")))
    both = s.join(e, key, "full_outer").withColumn("takes", F.coalesce(takes, F.lit(False)))
    return both.select(key, F.when(F.col("takes"), F.col("ev")).otherwise(F.col("sv")).alias("value"), F.when(F.col("takes"), "extracted").otherwise("structured").alias("origin"))


def steps(points: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Consecutive pairs of a series: previous and current value, and whether it is the last step."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = points.withColumn("prev", F.lag(value).over(w)).withColumn("is_last", F.lead(value).over(w).isNull())
    return rows.where("prev is not null").select(*keys, order, "prev", F.col(value).alias("cur"), "is_last")


def role_picks(rows: DataFrame, key: str, roles: list[tuple[str, list[Column]]]) -> DataFrame:
    """The best key for each role in order; a key that has an earlier role keeps that one only."""
    spark_rows = rows.agg(*[F.min_by(key, F.struct(*order)).alias(role) for role, order in roles])  # one row
    picks = spark_rows.select(F.posexplode(F.array(*[F.struct(F.lit(role).alias("role"), F.col(role).alias(key)) for role, _ in roles])).alias("place", "pick")).select("place", "pick.*")
    return picks.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy("place"))).where("n = 1").select("role", key)


def counted(**tables: DataFrame) -> DataFrame:
    """kind, n: the number of rows of each table."""
    out = None
    for kind, df in tables.items():
        one = df.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with its place in an order that several tasks can share only as a sort: meant for result pages."""
    return df.withColumn("place", F.row_number().over(Window.orderBy(*order)))


def replaced(items: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """``items`` with those of ``changed`` in the place of their namesakes."""
    return items.join(changed.select(key), key, "left_anti").unionByName(changed.select(*items.columns))


def targets(listed: DataFrame, by_suffix: DataFrame, key: str) -> DataFrame:
    """Rows listed by id and rows found by a suffix, each once; how says the first way."""
    both = listed.withColumn("how", F.lit("id")).unionByName(by_suffix.withColumn("how", F.lit("suffix")))
    return both.groupBy(key).agg(F.min("how").alias("how"))


def backfill(documents: DataFrame, has_output: Column, has_text: Column) -> DataFrame:
    """scanned, skipped (already there), written and missing counts."""
    return documents.agg(F.count(F.lit(1)).alias("scanned"), F.count_if(has_output).alias("skipped"), F.count_if(~has_output & has_text).alias("written"), F.count_if(~has_output & ~has_text).alias("missing"))


def year_end(rows: DataFrame) -> DataFrame:
    """Rows of each year's newest file that has any; rows: filename, year, month and what its table says. A file without readable rows has none here."""
    newest = rows.groupBy("year").agg(F.max(F.struct("month", "filename")).alias("__m"))
    return rows.join(newest, "year").where((F.col("month") == F.col("__m.month")) & (F.col("filename") == F.col("__m.filename"))).drop("__m")


def leakage_by_year(observed: DataFrame, backfill: DataFrame) -> DataFrame:
    """year, region, alive, ltfu, not_on_treatment (0 where unknown), missing_not_on_treatment, proxy, burden and place.

    observed: year, region, metric, value, sort_key, confidence: the latest of a year speaks, then the surest. backfill (year, region,
    metric, value) fills what isn't observed; not_on_treatment filled so is a proxy.
    """
    best = observed.groupBy("year", "region", "metric").agg(F.max_by("value", F.struct("sort_key", "confidence", "value")).alias("value")).withColumn("filled", F.lit(False))
    more = backfill.join(best.select("year", "region", "metric"), ["year", "region", "metric"], "left_anti").select("year", "region", "metric", "value", F.lit(True).alias("filled"))
    every = best.unionByName(more).where("value is not null")
    of = lambda m, c: F.max(F.when(F.col("metric") == m, F.col(c)))
    out = every.groupBy("year", "region").agg(*[of(m, "value").alias(m) for m in ("alive", "ltfu", "not_on_treatment")], F.coalesce(of("not_on_treatment", "filled"), F.lit(False)).alias("proxy"))
    out = out.withColumn("missing_not_on_treatment", F.col("not_on_treatment").isNull()).fillna(0.0, ["alive", "ltfu", "not_on_treatment"]).withColumn("burden", F.col("ltfu") + F.col("not_on_treatment"))
    return out.withColumn("place", F.row_number().over(Window.partitionBy("year").orderBy(F.desc("burden"), "region")))


def active_work(work: DataFrame, stages: list[str], n: int = 100) -> DataFrame:
    """The first ``n`` of the work in one of ``stages``, numbered by the stage's place, then who claimed first, then id."""
    order = [F.array_position(F.array(*map(F.lit, stages)), F.col("status")), F.asc_nulls_first("claimed_at"), F.asc("id")]
    first = work.where(F.col("status").isin(stages)).orderBy(*order).limit(n)
    return first.withColumn("place", F.row_number().over(Window.orderBy(*order)))  # n rows at most


def by_shortfall(rows: DataFrame, keys: list[str], stages: list[str], target: float = 95.0) -> DataFrame:
    """Regions of each of ``keys`` numbered: those with every stage observed first, then by their total shortfall, the smallest first."""
    short = sum(F.greatest(F.lit(target) - F.coalesce(F.col(s), F.lit(0.0)), F.lit(0.0)) for s in stages)
    whole = F.forall(F.array(*[F.col(s).isNotNull() for s in stages]), lambda x: x)
    out = rows.withColumn("shortfall", F.round(short, 2)).withColumn("complete", whole)
    return out.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("complete"), "shortfall", "region")))


def progress(work: DataFrame) -> DataFrame:
    """percent and eta_seconds of work (done, total, rolling and average rates a minute): the rolling rate, where it is known."""
    rate = F.coalesce(F.when(F.col("rolling") > 0, F.col("rolling")), F.when(F.col("average") > 0, F.col("average")))
    left = F.when((F.col("total") > 0) & (F.col("done") < F.col("total")), (F.col("total") - F.col("done")) / rate * 60)
    return work.withColumn("percent", F.when(F.col("total") > 0, numbers.rounded(F.col("done") / F.col("total") * 100, 1))).withColumn("rate", rate).withColumn("eta_seconds", numbers.rounded(left, 1))
