"""Periods: years, quarters and months from texts, labels, and their order on a time axis."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import MONTHS, let, matched

# Month names and their three-letter forms.
MONTH_NUMBERS = {m: k for k, m in enumerate(MONTHS, 1)} | {m[:3]: k for k, m in enumerate(MONTHS, 1)}
_QUARTERS = {months: f"Q{q}" for q in range(1, 5) for months in (f"{q * 3 - 2},{q * 3 - 1},{q * 3}", f"{q * 3 - 2},{q * 3}")}


def year(*texts: Column) -> Column:
    """First 19xx or 20xx that touches no other digit; earlier texts win."""
    return F.coalesce(*[matched(t, r"(?<!\d)(20\d{2}|19\d{2})(?!\d)", 1).try_cast("int") for t in texts])


def month_numbers(text: Column) -> Column:
    """Months named in a text, in order, with repeats."""
    lookup = F.create_map(*[F.lit(x) for pair in MONTH_NUMBERS.items() for x in pair])
    words = F.regexp_extract_all(F.lower(F.translate(text, "_-", "  ")), F.lit("[a-z]+"), F.lit(0))
    return F.filter(F.transform(words, lambda w: lookup[w]), lambda m: m.isNotNull())


def month(*texts: Column) -> Column:
    """The month of the first text that names exactly one."""
    return F.coalesce(*[let(month_numbers(t), lambda found: F.when(F.size(found) == 1, F.get(found, 0))) for t in texts])


def quarter(*texts: Column) -> Column:
    """``Qn``, or the quarter whose three months (or whose first and last) a text names."""
    quarters = F.create_map(*[F.lit(x) for pair in _QUARTERS.items() for x in pair])
    # three months in any order, two in the text's
    ranges = lambda found: quarters[F.array_join(F.when(F.size(found) == 3, F.array_sort(found)).otherwise(found).cast("array<string>"), ",")]
    of = lambda t: F.coalesce(F.concat(F.lit("Q"), matched(t, r"(?i)(?<![A-Za-z0-9])Q([1-4])(?!\d)", 1)), let(F.array_distinct(month_numbers(t)), ranges))
    return F.coalesce(*[let(t, of) for t in texts])


def granularity(year_: Column, quarter_: Column, month_: Column) -> Column:
    return F.when(quarter_.isNotNull(), "quarter").when(month_.isNotNull(), "month").when(year_.isNotNull(), "year").otherwise("unknown")


def label(year_: Column, quarter_: Column, month_: Column) -> Column:
    def of(p):
        y = p["y"].cast("string")
        return F.when(p["q"].isNotNull(), F.concat_ws(" ", y, p["q"])).when(p["y"].isNotNull() & p["m"].isNotNull(), F.format_string("%d-%02d", p["y"], p["m"])).otherwise(F.coalesce(y, F.lit("")))

    return let(F.struct(year_.alias("y"), quarter_.alias("q"), month_.alias("m")), of)


def sort_key(label_: Column) -> Column:
    """year * 100 + last month of the label's period; a label's last year counts."""

    def of(x):
        y = let(F.regexp_extract_all(x, F.lit(r"(?:19|20)\d{2}"), F.lit(0)), lambda years: F.get(years, F.size(years) - 1)).try_cast("int")
        q, m = matched(x, r"Q([1-4])", 1).try_cast("int"), matched(x, r"\d{4}-(\d{2})$", 1).try_cast("int")
        return y * 100 + F.coalesce(q * 3, m, F.lit(12))

    return let(label_, of)


def decimal_year(label_: Column) -> Column:
    def of(x, key):
        y, m = F.floor(key / 100), key % 100
        return y + F.when(x.rlike("Q[1-4]"), (m / 3 - 1) / 4).when(x.rlike(r"\d{4}-\d{2}$"), (m - 1) / 12).otherwise(F.lit(0.0))

    return let(label_, lambda x: let(sort_key(x), lambda key: of(x, key)))


def from_decimal_year(x: Column, granularity_: Column) -> Column:
    y = F.floor(x).cast("int")
    q = F.least(F.lit(4), F.greatest(F.lit(1), F.floor((x - y) * 4 + 1e-6) + 1)).cast("int")
    m = F.least(F.lit(12), F.greatest(F.lit(1), F.floor((x - y) * 12 + 1e-6) + 1)).cast("int")
    return F.when(granularity_ == "quarter", F.format_string("%d Q%d", y, q)).when(granularity_ == "month", F.format_string("%d-%02d", y, m)).otherwise(y.cast("string"))


def deadline(year_: Column, granularity_: Column) -> Column:
    """The end of a year on the axis of decimal years."""
    return year_ + F.when(granularity_ == "quarter", 0.75).when(granularity_ == "month", 11 / 12).otherwise(0.0)


def cumulative_label(start: int, label_: Column) -> Column:
    return F.concat(F.lit(f"{start}-"), label_)


def age_label(seconds: Column) -> Column:
    h, m = F.floor(seconds / 3600), F.floor(seconds % 3600 / 60)
    return F.when(h > 0, F.format_string("%dh %dm", h, m)).otherwise(F.format_string("%dm", m))


def scopes(cells: Column) -> Column:
    """Cells of a quick-facts row with their scopes, by how many there are: (scope, cell)."""
    ladder = F.when(F.size(cells) == 2, F.array(F.lit("month"), F.lit("cumulative"))).when(F.size(cells) == 3, F.array(F.lit("month"), F.lit("year_to_date"), F.lit("cumulative"))).otherwise(
        F.array(F.lit("month"), F.lit("year_to_date"), F.lit("recent_window"), F.lit("cumulative"))
    )
    return F.when(F.size(cells) >= 2, F.arrays_zip(ladder.alias("scope"), F.slice(cells, 1, 4).alias("cell")))
