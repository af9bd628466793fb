"""Text cleaning: Column -> Column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Single characters that become others, and ligatures.
PUNCTUATION = {" ": " ", "•": "-", "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "−": "-", "（": "(", "）": ")", "，": ",", "：": ":", "；": ";"}
LIGATURES = {"ﬁ": "fi", "ﬂ": "fl"}
# Glued phrases of scanned bulletins and their repair.
PHRASES = (
    ("issuedon", "issued on"), ("directedthe", "directed the"), ("Numberof", "Number of"), ("numberof", "number of"), ("HIVcaseinthe", "HIV case in the"),
    ("HIVcasesreportedto", "HIV cases reported to"), ("reportedcasessince", "reported cases since"), ("therehavebeen", "there have been"), ("Amongthe", "Among the"),
    ("Amongthem", "Among them"), ("Ofthe", "Of the"), ("Philippinesin", "Philippines in"), ("reportedin", "reported in"), ("withinformation", "with information"),
    ("thisregard", "this regard"), ("capacitybuilding", "capacity building"), ("primarycare", "primary care"), ("healthcare", "health care"), ("serviceproviders", "service providers"),
    ("communitybased", "community-based"), ("antiretroviraltherapy", "antiretroviral therapy"), ("performedby", "performed by"), ("inthe", "in the"), ("therewere", "there were"),
    ("reportedto", "reported to"), ("casesreported", "cases reported"), ("timeof", "time of"), ("permonth", "per month"), ("Inthe", "In the"), ("ARTRegistry", "ART Registry"),
    ("diagnosedfrom", "diagnosed from"), ("casesbymodeof", "cases by mode of"), ("HIVpositive", "HIV-positive"), ("HIVnegative", "HIV-negative"), ("HIVrelated", "HIV-related"),
)
# Spacing rules of claim texts, in order.
SPACING = (
    (r"(?<=[A-Za-z])&(?=[A-Za-z])", " & "), (r"(?<=[a-z])(?=[A-Z][a-z])", " "), (r"(?<=[a-z])(?=[A-Z]{2,}\b)", " "), (r"(?<=[A-Za-z])(?=\d{4}\b)", " "),
    (r"(?<=\d)(?=[a-z]{3,}\b)", " "), (r"(?i)\b(\d+)\s+(st|nd|rd|th)\b", "$1$2"), (r"(?<![\d,])(\d{1,3}),\s+(\d{3}\b)", "$1,$2"), (r"(?<=,)(?=[A-Za-z])", " "),
    (r"(?<=[;:])(?=[A-Za-z0-9])", " "), (r"(?<=[a-z0-9])\.(?=[A-Z])", ". "), (r"(?<=\))(?=[A-Za-z0-9])", " "), (r"\bNo\.(?=\d)", "No. "), (r"percent(?=\()", "percent "),
    (r"\bof(?=\d)", "of "), (r"\bto(?=\d)", "to "), (r"\bbeen(?=\d)", "been "), (r"\baged(?=\d)", "aged "),
)


def fold(text: Column, rules) -> Column:
    """Ordered (pattern, replacement) rules as one nested expression."""
    return reduce(lambda c, rule: F.regexp_replace(c, *rule), rules, text)


def plain_punctuation(text: Column) -> Column:
    out = F.translate(text, "".join(PUNCTUATION), "".join(PUNCTUATION.values()))
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), LIGATURES.items(), out)


def repair_phrases(text: Column) -> Column:
    return fold(text, [(rf"\b{glued}\b", apart) for glued, apart in PHRASES])


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def claim_text(text: Column) -> Column:
    """Plain punctuation, phrase repair and spacing, without edge punctuation; null is empty."""
    cleaned = fold(repair_phrases(collapse(plain_punctuation(F.coalesce(text, F.lit(""))))), SPACING)
    return F.regexp_replace(F.regexp_replace(collapse(cleaned), r"^[ ,;:]+", ""), r"[ ,;:]+$", "")


def clean_lines(text: Column) -> Column:
    """Each line cleaned, blank lines dropped."""
    cleaned = F.transform(F.split(text, "\n"), lambda line: collapse(repair_phrases(plain_punctuation(line))))
    return F.array_join(F.filter(cleaned, lambda line: line != ""), "\n")


def clean_scan(text: Column) -> Column:
    """For scanned text also: letters and digits apart, space after punctuation, at most two line breaks in a row."""
    apart = fold(text, ((r"(?<=[a-z])(?=\d)", " "), (r"(?<=\d)(?=[a-z]{2,})", " "), (r"(?<=[a-z,;])(?=[A-Z])", " "), (r"\b(in|of|from)(January|February|March|April|May|June|July|August|September|October|November|December)\b", "$1 $2"), (r"\bRegion(?=[IVX0-9])", "Region ")))
    return F.regexp_replace(clean_lines(apart), r"\n{3,}", "\n\n")


def evidence(*parts: Column) -> Column:
    """Non-blank parts joined, white space collapsed."""
    return collapse(F.concat_ws(" ", *[F.when(F.trim(p) != "", p) for p in parts]))


def alnum_key(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, "[^a-zA-Z0-9]", ""))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def folder(path: Column) -> Column:
    return F.get(F.split(path, "/"), F.size(F.split(path, "/")) - 2)


def safe_file_name(label: Column, category: Column) -> Column:
    word = F.regexp_replace(F.regexp_replace(label, r"[^\w\s-]", ""), r"\s+", "_")
    return F.concat(category, F.lit("_"), word, F.lit(".pdf"))


def after_starter(sentence: Column, starters: list[str]) -> Column:
    """The sentence from its earliest starter on, or all of it."""
    at = F.array_min(F.filter(F.array(*[F.locate(s, sentence) for s in starters]), lambda p: p > 0))
    return F.when(at.isNull(), sentence).otherwise(sentence.substr(at, F.length(sentence)))


def table_context(line: Column, markers: list[str]) -> Column:
    """Pipe parts up to the first that holds a narrative marker."""
    parts = F.transform(F.split(line, r"\|"), lambda p: F.trim(p))
    told = lambda p: F.lower(p).rlike("|".join(markers))
    kept = F.aggregate(parts, F.struct(F.lit(False).alias("stop"), F.expr("cast(array() as array<string>)").alias("out")), lambda a, p: F.struct((a["stop"] | told(p)).alias("stop"), F.when(a["stop"] | told(p), a["out"]).otherwise(F.concat(a["out"], F.array(p))).alias("out")), lambda a: a["out"])
    return F.array_join(kept, " | ")


def source_header(url: Column, folder_: Column, name: Column, text: Column) -> Column:
    return F.concat(F.lit("--- SOURCE INFO ---\nURL: "), url, F.lit("\nFolder: "), folder_, F.lit("\nFile: "), name, F.lit("\n\n"), text)


def residual_label(stage: Column, residual: Column) -> Column:
    return F.format_string("%s is %s than expected", stage, F.when(residual >= 0, "higher").otherwise("lower"))
