"""Readers for landed files: CSV, JSON lines, JSON documents, binary and whole-text files, HTML link tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All columns as the schema says; a missing or empty path gives an empty table; a byte-order mark is dropped."""
    parsed = spark.createDataFrame([], schema).schema
    try:
        df = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")
    except AnalysisException:
        return spark.createDataFrame([], parsed)
    df = df.withColumnsRenamed({c: c.lstrip("﻿").strip() for c in df.columns})
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in parsed.fields])


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Blank and broken lines are skipped."""
    rows = spark.read.text(path).where(F.trim("value") != "")
    parsed = rows.select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r"))
    return parsed.where("r is not null").select("r.*")


def read_json_document(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One row for each whole-file JSON document; a missing path gives an empty table."""
    try:
        return spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("r")).where("r is not null").select("r.*")
    except AnalysisException:
        return spark.createDataFrame([], schema)


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Recursive file listing with content hashes; content is read by the tasks and dropped there."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length", "modificationTime", F.sha2("content", 256).alias("file_hash"))


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """One text a file; names that begin with ``_`` or end in ``.markitdown.md`` are left out."""
    texts = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))
    return texts.where(~F.col("name").startswith("_") & ~F.col("name").endswith(".markitdown.md"))


def anchors(html: Column) -> Column:
    """Array of (href, label) of the anchors of a page."""
    pattern = r'(?s)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
    pairs = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("label"))
    return F.transform(pairs, lambda p: F.struct(p["href"].alias("href"), strip_markup(p["label"]).alias("label")))


def strip_markup(text: Column) -> Column:
    """Tags out, the common entities decoded."""
    out = F.regexp_replace(text, "<[^>]*>", "")
    for entity, char in (("&#8211;", "-"), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(out)


def links(pages: DataFrame) -> DataFrame:
    """page_id, href, label: one row an anchor."""
    return pages.select("page_id", F.inline(anchors(F.col("html"))))


def new_links(found: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct links not known yet."""
    return found.select("href").distinct().join(known.select("href"), "href", "left_anti")


def sub_pages(pages: DataFrame, prefix: str) -> DataFrame:
    return links(pages).where(F.col("href").startswith(prefix)).select("href").distinct()


def json_map_rows(df: DataFrame, column: str) -> DataFrame:
    """key, value rows of a JSON object column."""
    return df.select("*", F.explode(F.from_json(column, "map<string,string>")).alias("key", "item")).drop(column)


def wide_to_long(df: DataFrame, ids: list[str], columns: list[str], name: str = "metric", value: str = "value") -> DataFrame:
    """Unpivot; null cells give no row."""
    return df.unpivot(ids, columns, name, value).where(F.col(value).isNotNull())


def payload_rows(df: DataFrame, column: str, item: str) -> DataFrame:
    """Rows of a JSON array payload whose value is not null."""
    return df.select(F.inline(F.from_json(column, f"array<struct<{item}>>"))).where("value is not null")


def official_series(rows: DataFrame, indicators: list[str], since: int = 2010, area: str | None = None, subgroup: str | None = None) -> DataFrame:
    """Official long rows (indicator, year, value; area, subgroup where given): the indicators asked for, from a year on, of one area and subgroup, without nulls."""
    kept = rows.where(F.col("indicator").isin(indicators) & (F.col("year") >= since) & F.col("value").isNotNull())
    kept = kept if area is None else kept.where(F.col("area") == area)
    return kept if subgroup is None else kept.where(F.col("subgroup") == subgroup)
