"""Table rows that a page's layout broke into lines, and claims built from them.

A row's parts are only told apart by what came before them (a "7" is a region or a value), so a document's
lines run through a small machine, in one pass inside its task; nothing is shuffled and a document's rows leave as they are found.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import clean_token
from ..functions.text import claim_text

# Sections and headings of annex tables, words of narratives, region codes, starts of rows, headings of the region table.
SECTIONS = {"care cascade by age group": "AGE GROUP", "age group": "AGE GROUP", "care cascade by key population": "KEY POPULATION", "key population": "KEY POPULATION", "care cascade by region": "REGION"}
HEADINGS = {"ESTIMATED", "PLHIV", "DIAGNOSED", "1st 95)", "ON ART", "2nd 95", "VL TESTED", "VL TESTING", "COVERAGE (VL", "Tested/On ART)", "VL", "SUPPRESSED", "SUPPRESSION", "AMONG", "TESTED", "3rd 95", "(VL", "(VL Tested/", "(VL Tested/ On", "Suppressed", "Suppressed/", "/ On ART)", "On ART)", "ART)", "Dx = Diagnosed", "- Annex", "KEY", "POPULATION"}
NARRATIVE = (" as of ", "were ", "these", "among", "individuals", "treatment", "follow-up", "reported", "migrating")
CONTEXT = ("age group", "mode of transmission", "treatment outcome", "viral load", "care cascade", "region of", "sex assigned at birth", "current age", "percent increase", "number of")
REGION = r"(?:[0-9]{1,2}[A-Z]?|NCR|NIR|CAR|CARAGA|BARMM)"
STARTS = {"AGE GROUP": ("CHILDREN", "ADOLESCENTS", "YOUTH", "ADULTS"), "KEY POPULATION": ("MALES", "PERSONS", "OTHER MALES", "OTHER FEMALES")}
TITLE = "Viral Load Status among PLHIV on ART per region"
STREAM_SKIP = {"Region of", "Treatment", "Facility", TITLE, "Alive on ART", "Tested for VL", "VL", "Suppressed", "%", "Tested", "for VL"}
STREAM_ENDS = re.compile(r"## \[Page |\d+\.\s|Table |TREATMENT|Note:")
#: Fewest and most values of an annex row; from so many on, a line that begins a row ends the one before.
LEAST, MOST, FULL = 5, 10, 8


def table_value(line: Column) -> Column:
    """A line that can be a table's value: it has a digit, no word of narratives, and isn't long text."""
    low = F.lower(F.trim(line))
    words = F.lit(False)
    for w in NARRATIVE:
        words = words | F.contains(low, F.lit(w))
    return low.rlike("[0-9]") & ~words & ~((F.length(low) > 24) & (F.regexp_count(low, F.lit(r"\p{L}")) > 6))


def table_context(line: Column) -> Column:
    low = F.lower(F.trim(line))
    keyed = F.lit(False)
    for w in CONTEXT:
        keyed = keyed | F.contains(low, F.lit(w))
    return F.trim(line).rlike("^(?:Table|Figure) ") | (~F.contains(line, F.lit("|")) & keyed)


def parenthetical(line: Column) -> Column:
    """A short note in brackets that belongs to a label, and isn't a region's code."""
    return F.trim(line).rlike(r"^\([^)]{1,40}\)$") & ~F.trim(line).rlike(rf"^\({REGION}\)$")


def row_start(line: Column, section: str) -> Column:
    return F.upper(F.trim(line)).rlike("^(?:" + "|".join(STARTS[section]) + ")")


def _is_value(line: str) -> bool:
    low = line.lower()
    return any(c.isdigit() for c in line) and not any(w in low for w in NARRATIVE) and not (len(line) > 24 and sum(c.isalpha() for c in line) > 6)


def _begins(line: str, section: str) -> bool:
    return bool(re.fullmatch(REGION, line)) if section == "REGION" else line.upper().startswith(STARTS[section])


def annex_rows(text: str) -> Iterator[tuple[str, str, list[str], str, int]]:
    """(section, label, values, snippet, first line) of every row of a document's annex tables, in order."""
    lines = [(no, raw.strip()) for no, raw in enumerate(text.split("\n")) if raw.strip()]
    if "Care Cascade by" not in text and not any(line == "REGION" for _, line in lines):
        return
    section, label, values, held, start = "", [], [], [], 0

    def row():
        return (section.title(), " ".join(label), list(values), "\n".join(held), start)

    for k, (no, line) in enumerate(lines):
        head = SECTIONS.get(line.lower()) or ("REGION" if line == "REGION" else None)
        if line == "KEY" and k + 1 < len(lines) and lines[k + 1][1] == "POPULATION":
            head = "KEY POPULATION"
        note = line in HEADINGS or line.startswith("Note:") or line.lower().startswith("footnote:")
        begins = bool(section) and _begins(line, section)
        if label and not head and not note and not values and re.fullmatch(r"\([^)]{1,40}\)", line) and not re.fullmatch(REGION, line.strip("()")) and not (section == "REGION" and re.fullmatch(REGION, label[0])):
            label.append(line)
            held.append(line)
            continue
        if label and not head and not note and _is_value(line) and not (begins and len(values) >= FULL):
            values.append(line)
            held.append(line)
            if len(values) < MOST:
                continue
            yield row()
            label, values = [], []
            continue
        # the line doesn't go on with the values: what is open ends here, unless a label goes on
        if label and (values or head or note or begins or (section == "REGION" and re.fullmatch(REGION, label[0]))):
            if len(values) >= LEAST:
                yield row()
            label, values = [], []
        if head:
            section = head
        elif section and not note and (not _is_value(line) or (section == "REGION" and begins)):
            if not label:
                held, start = [], no
            label.append(line)
            held.append(line)
    if label and len(values) >= LEAST:
        yield row()


def _code(label: str) -> str | None:
    """Code of a region's label: a code, or a region's number, Roman or not."""
    plain = re.sub(r"\s+", " ", label).strip()
    if re.fullmatch(REGION, plain):
        return plain
    named = {"NCR": r"national capital region|\bncr\b", "CAR": r"cordillera administrative region|\bcar\b", "CARAGA": r"\bcaraga\b|region xiii\b", "BARMM": r"bangsamoro autonomous region|\bbarmm\b", "NIR": r"negros island region|\bnir\b"}
    for code, pattern in named.items():
        if re.search(pattern, plain.lower()):
            return code
    m = re.fullmatch(r"region\s*([ivx]+|\d{1,2})(?:\s*-?\s*([ab]))?", plain.lower())
    roman = dict(zip("i ii iii iv v vi vii viii ix x xi xii xiii".split(), map(str, range(1, 14)), strict=True))
    return f"{roman.get(m[1], m[1])}{(m[2] or '').upper()}" if m else None


def region_stream(text: str) -> Iterator[tuple[str, list[float]]]:
    """(region, five numbers) of the region table after its title: a region's cell, then numbers up to the fifth; another region before that begins anew."""
    lines, inside = text.split("\n"), False
    region, numbers = None, []
    for line in lines:
        if not inside:
            inside = TITLE in line
            continue
        if STREAM_ENDS.match(line.strip()):
            return
        for cell in filter(None, (c.strip() for c in line.split("|"))):
            if cell in STREAM_SKIP or cell.startswith("(n="):
                continue
            number = re.fullmatch(r"[<>]?(\d[\d,]*(?:\.\d+)?)%?", cell)
            if region and number:
                numbers.append(float(number[1].replace(",", "")))
                if len(numbers) == 5:
                    yield region, numbers
                    region, numbers = None, []
            elif code := _code(cell):
                region, numbers = code, []
            elif region and numbers:
                region, numbers = None, []


def by_document(documents: DataFrame, machine: Callable[[str], Iterator[tuple]], columns: str) -> DataFrame:
    """doc_id, place and what ``machine`` finds in each text (null: nothing), as ``columns``."""
    names = [c.strip().split(" ")[0] for c in re.split(r",(?![^<]*>)", columns)]

    def run(batches):
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                out = [(doc_id, k, *row) for k, row in enumerate(machine(text or ""))]
                if out:
                    yield pd.DataFrame(out, columns=["doc_id", "place", *names], dtype=object)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").where("text is not null").mapInPandas(run, f"doc_id {kind}, place int, {columns}")


def annexes(documents: DataFrame, most: int | None = None) -> DataFrame:
    """doc_id, place, section, label, values, snippet, line_no: all annex rows of each document, or the first ``most``."""
    out = by_document(documents, annex_rows, "section string, label string, values array<string>, snippet string, line_no int")
    return out if most is None else out.where(F.col("place") < most)


def region_rows(documents: DataFrame) -> DataFrame:
    """doc_id, place, region and the numbers on_art, vl_tested, vl_tested_pct, vl_suppressed, vl_suppression_among_tested."""
    out = by_document(documents, region_stream, "region string, numbers array<double>")
    names = ("on_art", "vl_tested", "vl_tested_pct", "vl_suppressed", "vl_suppression_among_tested")
    return out.select("doc_id", "place", "region", *[F.get("numbers", k).alias(n) for k, n in enumerate(names)])


def annex_claims(rows: DataFrame) -> DataFrame:
    """Annex rows as claims before their check: doc_id, line_no, category, claim_text, value, snippet, confidence."""
    said = F.concat(F.lit("Care Cascade "), "section", F.lit(": "), "label", F.lit(" has values "), F.array_join("values", ", "), F.lit("."))
    return rows.select("doc_id", "line_no", F.concat(F.lit("Care Cascade "), "section").alias("category"), said.alias("claim_text"), F.array_join("values", " | ").alias("value"), "snippet", F.lit(0.95).alias("confidence"))


def built(claims: DataFrame, least_claim: int = 15, least_snippet: int = 50, most_snippet: int = 500) -> DataFrame:
    """Claims under their contract: text cleaned, snippet trimmed and cut, ``rejected`` tells why a claim isn't one (null: it is)."""
    out = claims.withColumn("claim_text", F.trim(claim_text(F.coalesce("claim_text", F.lit(""))))).withColumn("snippet", F.regexp_replace(F.coalesce("snippet", F.lit("")), r"^\s+|\s+$", ""))
    short = F.when(F.length("claim_text") < least_claim, "claim too short").when(F.length("snippet") < least_snippet, "snippet too short")
    bad = F.when(~F.col("confidence").between(0, 1) | F.col("confidence").isNull(), "confidence out of range")
    return out.withColumn("rejected", F.coalesce(short, bad)).withColumn("snippet", F.left("snippet", F.lit(most_snippet)))


def total(values: Column) -> Column:
    """Sum of the cells' numbers."""
    return F.aggregate(F.transform(values, clean_token), F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
