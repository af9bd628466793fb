"""Sinks: CSV, JSON lines, one-row feeds, manifests and small Markdown reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_csv_union(parts: list[DataFrame], path: str) -> None:
    """Columns of all parts in the order they first come; missing ones are empty."""
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    write_csv(out, path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def feed(**parts: DataFrame) -> DataFrame:
    """One row of JSON with an array for each (small) part, and a stamp."""
    frames = [df.agg(F.collect_list(F.struct(*df.columns)).alias(name)) for name, df in parts.items()]
    out = frames[0]
    for more in frames[1:]:
        out = out.join(F.broadcast(more), F.lit(True))
    return out.select(F.to_json(F.struct(*parts, F.current_timestamp().alias("generated_at"))).alias("value"))


def write_feed(path: str, **parts: DataFrame) -> None:
    feed(**parts).coalesce(1).write.mode("overwrite").text(path)


def manifest(spark: SparkSession, written: dict[str, DataFrame], required: set[str]) -> DataFrame:
    """name, rows of what was written; a missing required name raises."""
    missing = required - written.keys()
    if missing:
        raise ValueError(f"missing exports: {', '.join(sorted(missing))}")
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).withColumn("name", F.lit(name)) for name, df in sorted(written.items())]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out.select("name", "rows")


def markdown(df: DataFrame, formats: dict[str, str] | None = None) -> DataFrame:
    """Lines of a Markdown table; nulls are blank. For reports of a few rows."""
    cells = [F.coalesce(F.format_string((formats or {}).get(c, "%s"), F.col(c)) if c in (formats or {}) else F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("value"))


def stamps(claims: DataFrame, quarantine: DataFrame, generated_at: str) -> DataFrame:
    """One row that an export carries: when it was made, how many claims it has, and how many of them are in quarantine."""
    counted = claims.agg(F.count(F.lit(1)).alias("total_claims"), F.count_if(F.col("superseded_by_run_id").isNull()).alias("active_claims"))
    held = quarantine.agg(F.count_if(~F.coalesce(F.col("resolved"), F.lit(False))).alias("quarantined"))
    return counted.join(held, F.lit(True)).select(F.lit(generated_at).alias("generated_at"), "total_claims", "active_claims", "quarantined")
