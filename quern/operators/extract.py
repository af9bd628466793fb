"""Claims from text: table rows, quantitative lines, narrative sentences, with verbatim snippets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import chunks
from .resolve import first_of

MARKERS = ("cases", "diagnosed", "deaths", "tests", "treatment", "%", "percent", "reported")


def row_label(claim_text: Column) -> Column:
    return F.nullif(F.regexp_extract(claim_text, r":\s*(.+?)\s+has values\s", 1), F.lit(""))


def leading(rows: DataFrame, most: int | None) -> DataFrame:
    return rows if most is None else first_of(rows, ["doc_id"], F.asc("line_no"), n=most)


def table_rows(lines: DataFrame, most: int | None = None, least_cells: int = 4) -> DataFrame:
    """Pipe rows with at least ``least_cells`` cells and two values in a row become claims; all, or the first ``most`` of a document."""
    rows = lines.withColumn("cells", chunks.cells(F.col("line")))
    is_row = F.col("line").contains("|")
    rows = chunks.carried_context(rows.withColumn("is_row", is_row), ["doc_id"], "line_no", ~F.col("is_row"), "line").where("is_row")
    rows = rows.withColumn("values", chunks.value_run(F.col("line"))).where((F.size("cells") >= least_cells) & (F.size("values") >= 2))
    label = F.get("cells", 0)
    text = F.concat_ws("", F.coalesce("context", F.lit("Table")), F.lit(": "), label, F.lit(" has values "), F.array_join("values", ", "), F.lit("."))
    out = rows.select("doc_id", "line_no", text.alias("claim_text"), F.array_join("values", " | ").alias("value"), F.col("line").alias("snippet"), F.lit("Structured Table Row").alias("category"), F.lit(0.95).alias("confidence"))
    return leading(out, most)


def quantitative_lines(lines: DataFrame, most: int | None = None, low: int = 35, high: int = 420) -> DataFrame:
    """Lines of fit length with at least two numbers; all, or the first ``most`` of a document."""
    n = F.regexp_count("line", F.lit(r"\d[\d,]*(?:\.\d+)?"))
    kept = lines.where(F.length("line").between(low, high) & (n >= 2) & ~F.col("line").contains("|"))
    out = kept.select("doc_id", "line_no", F.col("line").alias("claim_text"), F.lit(None).cast("string").alias("value"), F.col("line").alias("snippet"), F.lit("Quantitative Narrative").alias("category"), F.lit(0.93).alias("confidence"))
    return leading(out, most)


def narrative_sentences(documents: DataFrame, most: int | None = None, markers: tuple[str, ...] = MARKERS) -> DataFrame:
    """Sentences of 50 to 500 characters with two numbers and a marker, without addresses; all, or the first ``most`` of a document."""
    s = chunks.sentences(documents)
    n = F.regexp_count("sentence", F.lit(r"\d[\d,]*(?:\.\d+)?"))
    kept = s.where(F.length("sentence").between(50, 500) & (n >= 2) & F.lower("sentence").rlike("|".join(markers)) & ~F.col("sentence").rlike(r"https?://|@"))
    out = kept.select("doc_id", F.col("sentence_no").alias("line_no"), F.col("sentence").alias("claim_text"), F.lit(None).cast("string").alias("value"), F.col("sentence").alias("snippet"), F.lit("Narrative Statistic").alias("category"), F.lit(0.92).alias("confidence"))
    return leading(out, most)


def claims(documents: DataFrame) -> DataFrame:
    """All three strategies, and of claims alike in text and snippet the first."""
    lines = chunks.lines(documents)
    rank = {"table": table_rows(lines), "line": quantitative_lines(lines), "sentence": narrative_sentences(documents)}
    parts = [df.withColumn("strategy_rank", F.lit(k)) for k, df in enumerate(rank.values())]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    keyed = every.withColumn("__key", F.md5(F.concat_ws("\n", F.lower("claim_text"), F.lower("snippet"))))
    return first_of(keyed, ["doc_id", "__key"], F.asc("strategy_rank"), F.asc("line_no")).drop("__key")


def located(pairs: DataFrame, text: str = "text", snippet: str = "snippet", margin: int = 80) -> DataFrame:
    """start, stop and window of the snippet in its text: exact place, else that of its collapsed form."""
    collapsed = F.regexp_replace(F.col(text), r"\s+", " ")
    exact, loose = F.position(F.col(snippet), F.col(text)), F.position(F.regexp_replace(F.col(snippet), r"\s+", " "), collapsed)
    at = F.when(exact > 0, exact).otherwise(loose)
    source = F.when(exact > 0, F.col(text)).otherwise(collapsed)
    start = F.greatest(at - margin, F.lit(1))
    out = pairs.withColumn("start", at - 1).withColumn("stop", at - 1 + F.length(snippet))
    return out.withColumn("window", F.when(at > 0, source.substr(start, at - start + F.length(snippet) + margin)))


def coerced(payloads: DataFrame, column: str, item: str = "claim_text string, value string, snippet string, confidence double") -> DataFrame:
    """Findings of model outputs: a JSON array, or an object with ``findings`` or ``points``, or the first object inside other text."""
    array, wrapped = f"array<struct<{item}>>", f"struct<findings: array<struct<{item}>>, points: array<struct<{item}>>>"
    inner = F.regexp_extract(column, r"(?s)(\{.*\})", 1)
    tried = [F.when(F.ltrim(column).startswith("["), F.from_json(column, array)), F.from_json(column, wrapped)["findings"], F.from_json(column, wrapped)["points"], F.from_json(inner, wrapped)["findings"], F.from_json(inner, wrapped)["points"]]
    return payloads.withColumn("findings", F.coalesce(*[F.when(F.size(t) > 0, t) for t in tried])).select("*", F.inline("findings")).drop("findings", column)


def best_per_period(rows: DataFrame) -> DataFrame:
    """Largest value of each (series, period)."""
    return rows.groupBy("series", "period_label").agg(F.max("value").alias("value"), F.max_by("doc_id", F.struct("value", "doc_id")).alias("doc_id"))


def indicator(text: Column, patterns: list[str], low: float, high: float) -> Column:
    """First pattern whose number is plausible."""
    found = [F.replace(F.nullif(F.regexp_extract(text, p, 1), F.lit("")), F.lit(","), F.lit("")).try_cast("double") for p in patterns]
    return F.coalesce(*[F.when(v.between(low, high), v) for v in found])
