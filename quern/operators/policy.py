"""Policy tags: type, reference, issuer and title of a claim, and where each was found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import evidence

# How policies are cited in texts and in file names, in order; a type without a number cites none.
_ID = r"([0-9]{4}[-–][0-9A-Za-z]+)"
CITED = (
    ("department_memorandum", rf"Department Memorandum No\.?\s*{_ID}"), ("administrative_order", rf"Administrative Order No\.?\s*{_ID}"), ("department_circular", rf"Department Circular No\.?\s*{_ID}"), ("memorandum", rf"Memorandum No\.?\s*{_ID}"),
    ("department_memorandum", rf"\bDM\s*{_ID}\b"), ("administrative_order", rf"\bAO\s*{_ID}\b"), ("department_circular", rf"\bDC\s*{_ID}\b"), ("republic_act", r"\bRA\s*([0-9]{4,5})\b"), ("guideline", r"Guidelines?()"),
)
NAMED = (
    ("administrative_order", r"(?:^|_)ao(?:_?no)?_?(\d{4})_(\d{4})"), ("department_circular", r"(?:^|_)dc_?(\d{4})_(\d{4})"), ("department_memorandum", r"(?:^|_)dm_?(\d{4})_(\d{4})"), ("republic_act", r"(?:^|_)ra_?(\d{4,5})()"),
)
TITLE_ENDS = r"(?:\bRegion Name\b|\bOTHER FACILITIES\b|\bTREATMENT HUBS\b|\bDOH Certified\b|$)"


def _first(text: Column, rules: tuple[tuple[str, str], ...], value) -> tuple[Column, Column]:
    """Type and value of the first rule that matches."""
    kind, number = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, pattern in reversed(rules):
        holds = text.rlike(f"(?i){pattern}")
        kind, number = F.when(holds, name).otherwise(kind), F.when(holds, value(f"(?i){pattern}")).otherwise(number)
    return kind, number


def _named(text: Column) -> Column:
    return F.nullif(F.regexp_replace(text, r"^[ \-:;,.]+|[ \-:;,.]+$", ""), F.lit(""))


def tags(claims: DataFrame) -> DataFrame:
    """``claims`` (claim_text, snippet, filename, document_type) with policy_type, _reference, _issuer and _title, each with
    ``_from`` (text, file or null), and ``structured``: two slots or more are filled.

    A slot is filled from the text, and only where that leaves it empty from the file's name.
    """
    text = evidence(F.col("claim_text"), F.col("snippet"))
    stem = F.regexp_replace(F.element_at(F.split(F.coalesce("filename", F.lit("")), "/"), -1), r"\.[^.]*$", "")
    compact = F.regexp_replace(F.lower(stem), "[^a-z0-9]+", "_")
    blank = F.lit("")
    said_type, said_ref = _first(text, CITED, lambda p: F.nullif(F.replace(F.regexp_extract(text, p, 1), F.lit("–"), F.lit("-")), blank))
    file_type, file_ref = _first(compact, NAMED, lambda p: F.concat_ws("-", F.regexp_extract(compact, p, 1), F.nullif(F.regexp_extract(compact, p, 2), blank)))
    incomplete = said_type.isNull() | said_ref.isNull()
    policy = F.col("document_type") == "guideline_policy"
    after_number = F.regexp_extract(text, rf"(?i)No\.?\s*[0-9]{{4}}[-–][0-9A-Za-z]+:\s*(.{{12,220}}?)(?={TITLE_ENDS})", 1)
    of_guideline = F.when(said_type == "guideline", F.regexp_extract(text, r"(?i)((?:national |clinical )?guidelines?.{0,180})", 1))
    cleaned = F.regexp_replace(F.regexp_replace(stem, "[_-]+", " "), r"(?i)\b(?:ao|dc|dm)\s*\d{4}\s*\d{4}\b|\bno\b\.?\s*\d{4}\s*\d{4}\b", "")
    slots = {
        "type": (said_type, F.when(incomplete, file_type)), "reference": (said_ref, F.when(incomplete, file_ref)),
        "issuer": (F.when(F.lower(text).contains("department of health") | text.rlike(r"\bDOH\b"), "DOH"), F.when(policy, "DOH")),
        "title": (F.coalesce(_named(after_number), _named(of_guideline)), F.when(policy, F.nullif(F.trim(F.regexp_replace(cleaned, r"\s+", " ")), blank))),
    }
    out = claims.withColumns({f"__{k}_{s}": v for k, both in slots.items() for s, v in zip(("text", "file"), both, strict=True)})
    filled = {f"policy_{k}": F.coalesce(f"__{k}_text", f"__{k}_file") for k in slots}
    where = {f"policy_{k}_from": F.when(F.col(f"__{k}_text").isNotNull(), "text").when(F.col(f"__{k}_file").isNotNull(), "file") for k in slots}
    out = out.withColumns(filled | where).drop(*[f"__{k}_{s}" for k in slots for s in ("text", "file")])
    return out.withColumn("structured", sum(F.col(f"policy_{k}").isNotNull().cast("int") for k in slots) >= 2)
