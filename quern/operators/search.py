"""Faceted search, term postings and facet counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse


def optional_equal(column: str, wanted: str | None) -> Column:
    """No argument, or ``all``, matches everything."""
    return F.lit(True) if wanted in (None, "", "all") else F.col(column).cast("string") == wanted


def truthy(value: Column) -> Column:
    return F.lower(value.cast("string")).isin("true", "1")


def limit_of(asked: int | None, default: int = 80, most: int = 200) -> int:
    return max(1, min(most, asked or default))


def search(df: DataFrame, exact: dict[str, str | None], text_columns: list[str], query: str = "", order: list[Column] | None = None, limit: int | None = None) -> DataFrame:
    """Exact filters and a case-blind substring over the joined text columns, best first, at most the clamped limit."""
    out = df
    for column, wanted in exact.items():
        out = out.where(optional_equal(column, wanted))
    if query:
        out = out.where(F.contains(F.lower(collapse(F.concat_ws(" ", *text_columns))), F.lit(query.lower())))
    return out.orderBy(*(order or [])).limit(limit_of(limit)) if order else out


def postings(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """term, key, field, tf of every lower-cased word."""
    one = [df.select(key, F.lit(f).alias("field"), F.explode(F.split(F.lower(F.col(f)), r"[^a-z0-9]+")).alias("term")) for f in fields]
    rows = one[0]
    for more in one[1:]:
        rows = rows.unionByName(more)
    return rows.where("term != ''").groupBy("term", key, "field").agg(F.count(F.lit(1)).alias("tf"))


def term_search(index: DataFrame, key: str, terms: list[str], every: bool = True) -> DataFrame:
    """Rows with all (or any) of the terms, most occurrences first in ``tf``."""
    hits = index.where(F.col("term").isin(terms)).groupBy(key).agg(F.count_distinct("term").alias("terms"), F.sum("tf").alias("tf"))
    return hits.where(F.col("terms") >= (len(set(terms)) if every else 1))


def facets(df: DataFrame, columns: list[str]) -> DataFrame:
    """facet, item, n of several columns in one pass; blanks are dropped."""
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("item")) for c in columns])
    return df.select(F.inline(pairs)).where("item is not null and item != ''").groupBy("facet", "item").agg(F.count(F.lit(1)).alias("n"))


def bundle(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row of JSON: totals and facets."""
    f = facets(df, columns).groupBy("facet").agg(F.array_sort(F.collect_list(F.struct("item", "n"))).alias("values"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    packed = f.agg(F.array_sort(F.collect_list(F.struct("facet", "values"))).alias("facets"))
    return total.join(F.broadcast(packed), F.lit(True)).select(F.to_json(F.struct("total", "facets")).alias("payload"))
