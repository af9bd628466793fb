"""Verification, contracts, samples, reconciliations and gates."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import percent
from ..functions.text import alnum_key, collapse


def verbatim(pairs: DataFrame, source: str, snippet: str) -> DataFrame:
    """``exact``: the snippet stands in the source; ``loose``: only its letters and digits do."""
    return pairs.withColumn("exact", F.contains(collapse(F.col(source)), collapse(F.col(snippet)))).withColumn("loose", F.contains(alnum_key(F.col(source)), alnum_key(F.col(snippet))))


def suffix_automaton(text: str) -> tuple[list[dict[str, int]], list[int], list[int]]:
    """States of all substrings of a text, at most two a character: where a character leads, the state of the longest shorter suffix, and the longest length."""
    steps, link, size, last = [{}], [-1], [0], 0
    for c in text:
        now, at = len(steps), last
        steps.append({})
        link.append(0)
        size.append(size[last] + 1)
        while at >= 0 and c not in steps[at]:
            steps[at][c] = now
            at = link[at]
        if at >= 0:
            to = steps[at][c]
            if size[at] + 1 != size[to]:  # longer substrings end there too: split
                steps.append(dict(steps[to]))
                link.append(link[to])
                size.append(size[at] + 1)
                copy = len(steps) - 1
                link[to] = copy
                while at >= 0 and steps[at].get(c) == to:
                    steps[at][c] = copy
                    at = link[at]
                to = copy
            link[now] = to
        last = now
    return steps, link, size


def longest_common(a: str, b: str, automaton: tuple | None = None) -> int:
    """Length of the longest common substring: one pass over ``a`` through the substrings of ``b``."""
    steps, link, size = automaton or suffix_automaton(b)
    at = length = best = 0
    for c in a:
        while at and c not in steps[at]:
            at = link[at]
            length = size[at]
        if c in steps[at]:
            at, length = steps[at][c], length + 1
            best = max(best, length)
    return best


def fuzzy_share(source: Column, snippet: Column) -> Column:
    """Longest common substring as a share of the snippet; meant for the rows an exact test misses."""

    @F.pandas_udf("double")
    def share(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            made = {y: suffix_automaton(y) for y in set(b) if y}  # a snippet's once a batch
            yield pd.Series([longest_common(x or "", y, made[y]) / len(y) if y else 0.0 for x, y in zip(a, b, strict=True)])

    return share(source, snippet)


def contract(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows with the names of the rules they break, in order."""
    return df.withColumn("failures", F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items()]), lambda x: x.isNotNull()))


def spot_check(claims: DataFrame, rate: float = 0.05) -> DataFrame:
    """Per document max(1, floor(n * rate)) claims, chosen by a hash of their id."""
    doc = Window.partitionBy("document_id")
    ranked = claims.withColumn("n", F.count(F.lit(1)).over(doc)).withColumn("r", F.row_number().over(doc.orderBy(F.md5(F.col("claim_id").cast("string")), "claim_id")))
    return ranked.where(F.col("r") <= F.greatest(F.lit(1), F.floor(F.col("n") * rate))).drop("r")


def compare_official(official: DataFrame, local_points: DataFrame, keys: list[str]) -> DataFrame:
    """Official value of a year against the latest local period of that year, with the signed difference."""
    local = local_points.groupBy(*keys, "year").agg(F.max_by("value", "sort_key").alias("local_value"), F.max("sort_key").alias("local_key"))
    return official.withColumnRenamed("value", "official_value").join(local, [*keys, "year"]).withColumn("difference", F.round(F.col("local_value") - F.col("official_value"), 2))


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], relative: float = 0.005) -> DataFrame:
    """Full outer comparison of two sums: missing on either side, or apart by more than ``relative``."""
    both = left.withColumnRenamed("value", "left_value").join(right.withColumnRenamed("value", "right_value"), keys, "full_outer")
    apart = F.abs(F.col("left_value") - F.col("right_value")) > relative * F.abs("right_value")
    issue = F.when(F.col("left_value").isNull(), "left missing").when(F.col("right_value").isNull(), "right missing").when(apart, "mismatch")
    return both.withColumn("issue", issue).where("issue is not null")


def implausible(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where((F.col(column) < low) | (F.col(column) > high))


def admitted(documents: DataFrame, gates: DataFrame) -> DataFrame:
    """Documents whose gate is not ``fail``."""
    return documents.join(gates.where("gate != 'fail'").select("doc_id"), "doc_id", "left_semi")


def page_features(documents: DataFrame, text: str = "text") -> DataFrame:
    """Shape of each text: characters, words, digits, upper-case share, pipes, lines."""
    t = F.col(text)
    return documents.select(
        "doc_id", F.length(t).cast("long").alias("chars"), F.regexp_count(t, F.lit(r"[^ \t\n\r]+")).cast("long").alias("words"), F.regexp_count(t, F.lit("[0-9]")).cast("long").alias("digits"),
        F.regexp_count(t, F.lit("[A-Z]")).cast("long").alias("upper"), F.regexp_count(t, F.lit("[A-Za-z]")).cast("long").alias("letters"), F.regexp_count(t, F.lit(r"\|")).cast("long").alias("pipes"), F.size(F.split(t, "\n")).cast("long").alias("n_lines"),
    )


def gate(features: DataFrame) -> DataFrame:
    """pass, warn or fail with the issues found."""
    issues = F.filter(
        F.array(
            F.when(F.col("chars") < 200, "short text"), F.when(F.col("words") < 20, "few words"),
            F.when(F.col("letters") > 0, F.when(F.col("upper") / F.col("letters") > 0.6, "mostly upper case")), F.when(F.col("letters") < F.col("chars") * 0.5, "few letters"),
        ),
        lambda x: x.isNotNull(),
    )
    out = features.withColumn("issues", F.array_join(issues, "; ")).withColumn("n_issues", F.size(issues).cast("long"))
    return out.withColumn("gate", F.when(F.col("n_issues") == 0, "pass").when((F.col("n_issues") >= 2) | (F.col("chars") < 50), "fail").otherwise("warn"))


def coverage_share(done: Column, total: Column) -> Column:
    return percent(done, total)


def audit_summary(compared: DataFrame, tolerance: float = 0.1) -> DataFrame:
    """One row of counts over comparisons (metric, year, value, local): how many, how many differ by more than the tolerance, of how many indicators and years."""
    differs = F.abs(F.col("value") - F.col("local")) > tolerance * F.col("value")
    return compared.agg(F.count(F.lit(1)).alias("compared"), F.count_if(differs).alias("differing"), F.countDistinct("metric").alias("indicators"), F.min("year").alias("first"), F.max("year").alias("last"))
