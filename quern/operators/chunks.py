"""Pages, chunks, lines, sentences, cells and line windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pages(documents: DataFrame) -> DataFrame:
    """doc_id, page_no, page_text: cut before each ``## [Page n]`` line; text before the first is page 0."""
    parts = F.split("text", r"(?m)(?=^## \[Page \d+\])")
    out = documents.select("doc_id", F.posexplode(parts).alias("place", "page_text")).where(F.trim("page_text") != "")
    return out.withColumn("page_no", F.coalesce(F.nullif(F.regexp_extract("page_text", r"^## \[Page (\d+)\]", 1), F.lit("")).cast("int"), F.lit(0)))


def packed(text: Column, chunk_chars: int = 8000, max_chunks: int | None = None) -> Column:
    """Lines packed greedily into chunks of at most ``chunk_chars`` (a longer line is a chunk of its own): all, or the first ``max_chunks``."""
    start = F.struct(F.expr("cast(array() as array<string>)").alias("done"), F.lit("").alias("open"))
    def step(a, line):
        joined = F.when(a["open"] == "", line).otherwise(F.concat(a["open"], F.lit("\n"), line))
        full = (a["open"] != "") & (F.length(joined) > chunk_chars)
        return F.struct(F.when(full, F.concat(a["done"], F.array(a["open"]))).otherwise(a["done"]).alias("done"), F.when(full, line).otherwise(joined).alias("open"))
    chunks = F.aggregate(F.split(text, "\n"), start, step, lambda a: F.concat(a["done"], F.array(a["open"])))
    filled = F.filter(chunks, lambda c: F.trim(c) != "")
    return filled if max_chunks is None else F.slice(filled, 1, max_chunks)


def chunks(documents: DataFrame, chunk_chars: int = 8000, max_chunks: int | None = None) -> DataFrame:
    return documents.select("doc_id", F.posexplode(packed(F.col("text"), chunk_chars, max_chunks)).alias("chunk_no", "chunk"))


def lines(documents: DataFrame) -> DataFrame:
    """doc_id, line_no, line: trimmed, blanks dropped, numbers kept."""
    return documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).select("doc_id", "line_no", F.trim("line").alias("line")).where("line != ''")


def artifact(line: Column) -> Column:
    """Page numbers, captions and short headings."""
    low = F.lower(line)
    return low.rlike(r"^\d+$|^page \d+( of \d+)?$|^(figure|table) \d+[.:]?") | ((F.length(line) <= 60) & ~line.rlike(r"[.!?:;,]$") & line.rlike(r"^[A-Z][A-Z0-9 &/-]+$"))


def sentences(documents: DataFrame) -> DataFrame:
    parts = F.split("text", r"(?<=[.!?])\s+(?=[A-Z0-9<(])")
    return documents.select("doc_id", F.posexplode(parts).alias("sentence_no", "sentence")).where(F.trim("sentence") != "")


def cells(line: Column) -> Column:
    return F.filter(F.transform(F.split(line, r"\|"), lambda c: F.trim(c)), lambda c: c != "")


def value_like(cell: Column) -> Column:
    return cell.rlike(r"^[<>]?\d[\d,]*(\.\d+)?%?$")


def value_run(line: Column) -> Column:
    """The contiguous run of value cells that begins at the first one."""
    start = F.struct(F.lit(0).alias("state"), F.expr("cast(array() as array<string>)").alias("run"))
    def step(a, c):
        v = value_like(c)
        state = F.when(a["state"] == 2, 2).when(v, 1).when(a["state"] == 1, 2).otherwise(0)
        return F.struct(state.alias("state"), F.when(v & (a["state"] < 2), F.concat(a["run"], F.array(c))).otherwise(a["run"]).alias("run"))
    return F.aggregate(cells(line), start, step, lambda a: a["run"])


def carried_context(rows: DataFrame, keys: list[str], order: str, is_context: Column, value: str) -> DataFrame:
    """``context``: the last context line at or before each row."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("context", F.last(F.when(is_context, F.col(value)), ignorenulls=True).over(w))


def ahead(rows: DataFrame, keys: list[str], order: str, value: str, n: int) -> DataFrame:
    """``window``: the values of this row and the next n - 1, joined."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(0, n - 1)
    return rows.withColumn("window", F.concat_ws(" ", F.collect_list(value).over(w)))


def numbers_ahead(rows: DataFrame, keys: list[str], order: str, line: str, n: int) -> DataFrame:
    """``numbers``: number tokens of this line and the next n - 1."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(0, n - 1)
    tokens = F.regexp_extract_all(line, F.lit(r"\d[\d,]*(?:\.\d+)?"), F.lit(0))
    return rows.withColumn("__t", tokens).withColumn("numbers", F.flatten(F.collect_list("__t").over(w))).drop("__t")


def islands(rows: DataFrame, keys: list[str], order: str, starts: Column) -> DataFrame:
    """``island``: how many starting rows there are up to each row; rows before the first are island 0."""
    return rows.withColumn("island", F.sum(starts.cast("int")).over(Window.partitionBy(*keys).orderBy(order)))


def wrapped_lines(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Lines joined to the line before while that ends without punctuation and this begins in lower case (a hyphen joins without a space)."""
    before = F.lag("line").over(Window.partitionBy(*keys).orderBy(order))
    continues = before.isNotNull() & ~before.rlike(r"[.!?:;]$") & F.col("line").rlike(r"^[a-z]")
    marked = islands(rows, keys, order, ~continues)
    parts = F.array_sort(F.collect_list(F.struct(F.col(order), F.col("line"))))
    out = marked.groupBy(*keys, "island").agg(F.min(order).alias(order), parts.alias("__p"))
    text = F.array_join(F.transform("__p", lambda p: p["line"]), "\n")
    return out.withColumn("line", F.regexp_replace(F.regexp_replace(text, r"-\n", ""), r"\n", " ")).drop("__p", "island")


def labelled_blocks(rows: DataFrame, keys: list[str], order: str, is_label: Column, is_value: Column, most: int | None = None, least: int = 5) -> DataFrame:
    """label, values: a label line and the value lines after it, all or the first ``most``, kept with at least ``least``."""
    marked = islands(rows.withColumn("__l", is_label).withColumn("__v", is_value), keys, order, F.col("__l")).where("island > 0")
    values = F.array_sort(F.collect_list(F.when(F.col("__v"), F.struct(F.col(order), F.col("line")))))
    out = marked.groupBy(*keys, "island").agg(F.min_by("line", order).alias("label"), F.transform(values if most is None else F.slice(values, 1, most), lambda v: v["line"]).alias("values"))
    return out.where(F.size("values") >= least)


def suspicious_tokens(documents: DataFrame, fragments: list[str]) -> DataFrame:
    """Long words that hold at least two known fragments: token and how often."""
    words = documents.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[a-z/&+-]{12,}"), F.lit(0))).alias("token"))
    held = F.size(F.filter(F.array(*map(F.lit, fragments)), lambda f: F.contains(F.col("token"), f)))
    return words.where(held >= 2).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def positioned_rows(words: DataFrame, keys: list[str], row_gap: float = 3.0, cell_gap: float = 20.0) -> DataFrame:
    """Table rows from positioned words (x0, x1, y0, word): a row ends where y jumps, a cell where x does."""
    down = Window.partitionBy(*keys).orderBy("y0", "x0")
    jumped = F.coalesce((F.col("y0") - F.lag("y0").over(down) > row_gap).cast("int"), F.lit(0))
    rows = words.withColumn("__j", jumped).withColumn("row_no", F.sum("__j").over(down))
    across = Window.partitionBy(*keys, "row_no").orderBy("x0")
    lead_in = F.when(F.col("x0") - F.lag("x1").over(across) > cell_gap, " | ").when(F.lag("x1").over(across).isNotNull(), " ").otherwise("")
    parts = rows.withColumn("__w", F.concat(lead_in, F.col("word")))
    ordered = F.array_sort(F.collect_list(F.struct("x0", "__w")))
    return parts.groupBy(*keys, "row_no").agg(F.array_join(F.transform(ordered, lambda p: p["__w"]), "").alias("row_text"))


def month_tokens(text: Column) -> Column:
    """Names of months in a text, in its order, in lower case."""
    from ..functions.numbers import MONTHS

    return F.regexp_extract_all(F.lower(text), F.lit(rf"\b({'|'.join(MONTHS)})\b"), F.lit(1))
