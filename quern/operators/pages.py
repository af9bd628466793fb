"""Pages of parsed documents: their flags, their quality, and whether a page is a table read in the wrong order.

Everything is an expression over the page's own line array: one pass, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What block tags say of a page.
TAGS = {"ocr": "OCR Text Content", "native": "Native Text Content", "positioned_table": "Position-Aware Table Layout", "vision": "AI Visual & Tabular Insights", "table_deferred": "Table Parsing Deferred", "blank": "Blank Page", "vision_failure": "Vision Failure", "ocr_failure": "OCR Failure"}
# Limits of the scrambled-table rules.
MIN_LINES, PIPE_LINES, NUMERIC_TOKENS, ALPHA_TOKENS, SHORT_CELLS, DENSE_LINES, SOME_PIPES = 8, 0.55, 0.58, 0.24, 0.62, 0.72, 0.35
_NUMBER, _WORD = r"\b\d[\d,]*(?:\.\d+)?\b", r"\b[A-Za-z]{3,}\b"


def lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def content(text: Column) -> Column:
    """Lines of a page without block tags and its own heading."""
    return F.filter(lines(text), lambda x: ~x.startswith("#### [") & ~x.rlike(r"^## \[Page \d+\]$"))


def cleaned(text: Column) -> Column:
    """A chunk's text without page headings, block tags and the source header."""
    out = F.regexp_replace(text, r"(?m)^(?:## \[Page \d+\]|#### \[[^\]]+\])\s*$", "")
    return F.regexp_replace(out, r"(?s)--- SOURCE INFO ---.*?------------------", "")


def flags(pages: DataFrame) -> DataFrame:
    """``pages`` (page_text) with a flag for each block tag, n_lines of content, and empty: no content though not called blank."""
    tagged = {f"is_{k}": F.contains("page_text", F.lit(f"#### [{tag}]")) for k, tag in TAGS.items()}
    out = pages.withColumns(tagged).withColumn("n_lines", F.size(content(F.col("page_text"))))
    return out.withColumn("is_empty", (F.col("n_lines") == 0) & ~F.col("is_blank"))


def line_features(rows: Column) -> Column:
    """Counts over an array of lines: n, pipes, dense (mostly numbers), short (cells of few letters), numbers and words in all."""

    def add(a, line):
        numbers, words = F.regexp_count(line, F.lit(_NUMBER)), F.regexp_count(line, F.lit(_WORD))
        cells = F.filter(F.transform(F.split(line, r"\|"), lambda c: F.trim(c)), lambda c: c != "")
        short = F.size(F.filter(cells, lambda c: F.length(F.regexp_replace(c, "[^A-Za-z]", "")) <= 2))
        pipe = F.contains(line, F.lit("|"))
        counted = {"n": F.lit(1), "pipes": pipe.cast("int"), "dense": (numbers >= F.greatest(F.lit(3), words + 2)).cast("int"), "short": (pipe & (F.size(cells) >= 3) & (short >= SHORT_CELLS * F.size(cells))).cast("int"), "numbers": numbers, "words": words}
        return F.struct(*[(a[k] + v).alias(k) for k, v in counted.items()])

    return F.aggregate(rows, F.struct(*[F.lit(0).alias(k) for k in ("n", "pipes", "dense", "short", "numbers", "words")]), add)


def scrambled(features: Column) -> Column:
    """A table whose cells were read out of order, by any of three groups of ratios; never under MIN_LINES lines."""
    per_line = lambda k: features[k] / F.greatest(features["n"], F.lit(1))
    tokens = F.greatest(features["numbers"] + features["words"], F.lit(1))
    few_words = features["words"] / tokens <= ALPHA_TOKENS
    piped = (per_line("pipes") >= PIPE_LINES) & (features["numbers"] / tokens >= NUMERIC_TOKENS) & few_words
    dense = (per_line("dense") >= DENSE_LINES) & few_words
    short = (per_line("pipes") >= SOME_PIPES) & (per_line("short") >= SHORT_CELLS)
    return (features["n"] >= MIN_LINES) & (piped | dense | short)
