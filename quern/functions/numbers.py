"""Number parsing and small arithmetic: Column -> Column. No input raises; what is no number is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number words, month names.
NUMBER_WORDS = dict(zip("one two three four five six seven eight nine ten".split(), range(1, 11), strict=True))
MONTHS = "january february march april may june july august september october november december".split()


def matched(text: Column, pattern: str, group: int = 0) -> Column:
    """First match or null."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def let(value: Column, use) -> Column:
    """``use(x)`` with ``value`` computed once."""
    return F.transform(F.array(value), lambda x: use(x))[0]


def first_number(text: Column) -> Column:
    return F.replace(matched(text, r"\d[\d,]*(?:\.\d+)?"), F.lit(","), F.lit("")).try_cast("double")


def clean_token(text: Column) -> Column:
    """A token that is one number: ``<`` or ``>`` before it, ``%`` or a footnote letter after it are allowed."""
    token = F.regexp_replace(F.trim(text), r"([0-9])[A-Za-z]$", "$1")
    return F.when(token.rlike(r"^[<>]?\d[\d,]*(?:\.\d+)?%?$"), first_number(token))


def integer(text: Column) -> Column:
    words = F.create_map(*[F.lit(x) for pair in NUMBER_WORDS.items() for x in pair])
    return F.coalesce(words[F.lower(F.trim(text))].cast("long"), F.nullif(F.regexp_replace(text, "[^0-9]", ""), F.lit("")).try_cast("long"))


def decimal(text: Column) -> Column:
    return matched(F.regexp_replace(text, "[,%]", ""), r"\d+(?:\.\d+)?").try_cast("double")


def signed(text: Column) -> Column:
    return F.nullif(F.regexp_replace(text, "[^0-9.-]", ""), F.lit("")).try_cast("double")


def nullable(text: Column) -> Column:
    """Null tokens are the empty string and ``...``."""
    return F.when(~F.trim(text).isin("", "..."), F.replace(F.trim(text), F.lit(","), F.lit(""))).try_cast("double")


def dash_is_zero(text: Column) -> Column:
    return F.when(F.trim(text).isin("-", "--", "–"), F.lit(0).cast("long")).otherwise(integer(text))


def unit(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.contains("%") | low.contains("percent"), "percent").when(low.contains("death"), "deaths").when(low.contains("test"), "tests").otherwise("count")


def is_reference(text: Column, number: Column) -> Column:
    """A year beside a month name (or the words year, quarter), or the number of a cited order, is no value."""
    low, whole = F.lower(text), number == F.floor(number)
    dated = number.between(1900, 2030) & low.rlike("|".join([*MONTHS, "year", "quarter"]))
    n = number.cast("long").cast("string")
    cited = F.lit(False)
    for lead in ("ra ", "ao ", "dm ", "dc ", "administrative order no. "):
        cited = cited | F.contains(low, F.concat(F.lit(lead), n))
    return F.coalesce(whole & (dated | cited), F.lit(False))


def rounded(x: Column, digits: int = 0) -> Column:
    """Rounded as SQL engines do, by the product with a power of ten, halves away from zero; Spark's own ``round`` takes the shortest decimal that a double prints as."""
    return F.round(x * 10.0**digits) / 10.0**digits


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Rounded share in percent; null where either is null or 0."""
    return F.round(F.try_divide(F.nullif(part, F.lit(0)), F.nullif(whole, F.lit(0))) * 100, digits)


def gap(target: float, value: Column, digits: int = 2) -> Column:
    return F.round(F.lit(target) - value, digits)


def logit(pct: Column) -> Column:
    p = F.greatest(F.lit(0.001), F.least(F.lit(0.999), pct / 100))
    return F.ln(p / (1 - p))


def inverse_logit(x: Column) -> Column:
    return 100 / (1 + F.exp(-x))


def count_of(total: Column, pct: Column) -> Column:
    return F.round(total * pct / 100).cast("long")


def percent_bounds(low: Column, high: Column, step: int = 5) -> Column:
    """(low, high, ticks) widened to multiples of ``step`` within 0 and 100."""
    a, b = F.greatest(F.lit(0), F.floor(low / step) * step), F.least(F.lit(100), F.ceil(high / step) * step)
    return F.struct(a.alias("low"), b.alias("high"), F.sequence(a, b, F.lit(step).cast("long")).alias("ticks"))


def number_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\d[\d,]*(?:\.\d+)?"))


def percent_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\d+(?:\.\d+)?%"))


def upper_ratio(text: Column) -> Column:
    return F.try_divide(F.regexp_count(text, F.lit("[A-Z]")), F.regexp_count(text, F.lit("[A-Za-z]")))


def leakage_rate(alive: Column, lost: Column) -> Column:
    return F.try_divide(lost, alive + lost) * 100
