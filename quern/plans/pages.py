"""Annex rows, region tables, pages, policy tags and year-end tables of documents whose numbers come from the orders of each customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import blocks, boards, chunks, classify, pages, policy
from ..sources import views
from ..sources.views import OBS
from . import bulletins
from .registry import query
from .views_numbers import NUMS, nums, said

FORMATTED = "f AS (SELECT claim_id, n, m, k, p, q, format('{:,}', n) AS sn, format('{:,}', m) AS sm, format('{:,}', k) AS sk, concat(p, '%') AS sp, concat(q, '%') AS sq FROM nums)"


def _documents(spark, d, form):
    return nums(spark, d).select(F.col("claim_id").alias("doc_id"), "n", "m", "k", "p", "q", said(form).alias("text"))


ANNEX = """Annex
Care Cascade by Age Group
ESTIMATED
PLHIV
DIAGNOSED
Children
(0-9 years)
{n}
{m}
{p}%
{k}
{q}%
{n}
{m}
{k}
{q}%
YOUTH
{k}
{p}%
{m}
{n}
{q}%
Care Cascade by Region
7
{n}
{m}
{p}%
{k}
{q}%
NCR
{k}
{k}
{k}
{k}
{k}
Note: as reported
KEY
POPULATION
Males having sex
with males
{m}
{m}
{m}
{m}
{m}
{m}
Persons
{p}%
{q}%
Note: end"""
#: section, label, first line, values
_ROWS = [("Age Group", "Children (0-9 years)", 5, "nmpkqnmkq"), ("Age Group", "YOUTH", 16, "kpmnq"), ("Region", "7", 23, "nmpkq"), ("Region", "NCR", 29, "kkkkk"), ("Key Population", "Males having sex with males", 38, "mmmmmm")]


@query(" UNION ALL ".join(f"SELECT claim_id AS doc_id, {place} AS place, '{s}' AS section, '{label}' AS label, {len(v)} AS n_values, ({' + '.join(v)})::DOUBLE AS total, {at} AS line_no FROM nums" for place, (s, label, at, v) in enumerate(_ROWS)), NUMS)
def x4_annex_rows(spark, d):
    """Rows of three sections, labels over several lines, a row too short to count."""
    rows = blocks.annexes(_documents(spark, d, ANNEX))
    return rows.select("doc_id", "place", "section", "label", F.size("values").alias("n_values"), blocks.total(F.col("values")).alias("total"), "line_no")


_SNIPPETS = {"Children (0-9 years)": "Children\n(0-9 years)", "Males having sex with males": "Males having sex\nwith males"}


def _snippet(label, values):
    return " || chr(10) || ".join([*(f"'{part}'" for part in _SNIPPETS.get(label, label).split("\n")), *(f"s{v}" for v in values)])


@query(" UNION ALL ".join(f"SELECT claim_id AS doc_id, 'Care Cascade {s}' AS category, md5({_snippet(label, v)}) AS digest, CASE WHEN length({_snippet(label, v)}) < 50 THEN 'snippet too short' END AS rejected FROM f" for s, label, _, v in _ROWS), NUMS, FORMATTED)
def x7_built_claims(spark, d):
    """Annex claims under their contract: those with too little evidence are told apart, not lost."""
    made = blocks.built(blocks.annex_claims(blocks.annexes(_documents(spark, d, ANNEX))))
    return made.select("doc_id", "category", F.md5("snippet").alias("digest"), "rejected")


STREAM = """Before the table NCR | 1 | 2 | 3 | 4 | 5
Viral Load Status among PLHIV on ART per region
Region of | Treatment | (n={n})
NCR | {n} | {m} | {p}% | {k} | {q}%
Region IV-A
{m} | {k} | {q}%
{n} | {p}%
CAR | {n} | {m}
Region XI | {k} | {k} | {p}% | {k} | {p}%
BARMM | {n} | none | {m} | {k} | {n} | {m}
Note: as reported
CARAGA | 1 | 2 | 3 | 4 | 5"""


@query("SELECT region, count(*) AS n_rows, sum(a)::DOUBLE AS on_art, sum(t)::DOUBLE AS vl_tested, sum(s)::DOUBLE AS vl_suppressed FROM (SELECT 'NCR' AS region, n AS a, m AS t, k AS s FROM nums UNION ALL SELECT '4A', m, k, n FROM nums UNION ALL SELECT '11', k, k, k FROM nums) GROUP BY 1", NUMS)
def g12_region_stream(spark, d):
    """A region's cell and exactly five numbers, over cells and lines; anything between begins anew."""
    rows = blocks.region_rows(_documents(spark, d, STREAM))
    return rows.groupBy("region").agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(c).alias(c) for c in ("on_art", "vl_tested", "vl_suppressed")])


LINES = ["{n} as of May", "Table 3. Cases", "these were reported", "{p}%", "(10-19 y/o)", "(4A)", "Children under {q}", "Number of {k} cases", "plain words here", "a | viral load | {n}", "the longest of lines with {n} in it"]
_PREDICATES = {"value": (3, 4, 5, 6, 7, 9), "context": (1, 7), "bracket": (4,), "age": (6,)}


@query(" UNION ALL ".join(f"SELECT claim_id, {k} AS line_no, " + ", ".join(f"{k in _PREDICATES[c] or c == 'value' and k == 1} AS is_{c}" for c in _PREDICATES) + " FROM nums" for k in range(len(LINES))), NUMS)
def c15_line_predicates(spark, d):
    rows = nums(spark, d).select("claim_id", F.posexplode(F.array(*map(said, LINES))).alias("line_no", "line"))
    line = F.col("line")
    return rows.select("claim_id", "line_no", (blocks.table_value(line)).alias("is_value"), blocks.table_context(line).alias("is_context"), blocks.parenthetical(line).alias("is_bracket"), blocks.row_start(line, "AGE GROUP").alias("is_age"))


def _paged(spark, d):
    """Three pages a customer: a mix of prose and numeric rows, one whose tag goes by the customer, and a short one; text before the first heading is page 0."""
    prose, row = F.lit("these words stand here today once"), said("{n} | {m} | {k}")
    many = F.pmod("claim_id", F.lit(11)).cast("int")
    mixed = F.array_join(F.concat(F.array_repeat(prose, many), F.array_repeat(row, 10 - many)), "\n")
    tag = F.element_at(F.array(*[F.lit(f"#### [{t}]") for t in pages.TAGS.values()]), (F.pmod("claim_id", F.lit(len(pages.TAGS))) + 1).cast("int"))
    body = F.when(F.pmod("claim_id", F.lit(3)) == 0, prose).otherwise("")
    text = F.concat(F.lit("Source\n## [Page 1]\n#### [OCR Text Content]\n"), mixed, F.lit("\n## [Page 2]\n"), tag, F.lit("\n\n"), body, F.lit("\n## [Page 3]\n"), F.array_join(F.array_repeat(row, 7), "\n"))
    return chunks.pages(nums(spark, d).select(F.col("claim_id").alias("doc_id"), text.alias("text")))


_FLAGS = ", ".join(f"page_no = 2 AND claim_id % {len(pages.TAGS)} = {k}{' OR page_no = 1' if name == 'ocr' else ''} AS is_{name}" for k, name in enumerate(pages.TAGS))
_BLANK = list(pages.TAGS).index("blank")


@query(f"SELECT claim_id AS doc_id, page_no, {_FLAGS}, lines AS n_lines, lines = 0 AND NOT (page_no = 2 AND claim_id % {len(pages.TAGS)} = {_BLANK}) AS is_empty FROM (SELECT claim_id, page_no, CASE page_no WHEN 0 THEN 1 WHEN 1 THEN 10 WHEN 2 THEN (claim_id % 3 = 0)::INTEGER ELSE 7 END AS lines FROM nums, range(4) r(page_no))", NUMS)
def c16_page_flags(spark, d):
    """Pages cut at their headings, and what their block tags say."""
    return pages.flags(_paged(spark, d)).select("doc_id", F.col("page_no").cast("long").alias("page_no"), *[f"is_{k}" for k in pages.TAGS], "n_lines", "is_empty")


@query(
    "SELECT claim_id AS doc_id, page_no, page_no = 1 AND ((rows / 10 >= 0.55 AND numbers / greatest(tokens, 1) >= 0.58 AND words / greatest(tokens, 1) <= 0.24) OR (rows / 10 >= 0.72 AND words / greatest(tokens, 1) <= 0.24) OR (rows / 10 >= 0.35 AND rows / 10 >= 0.62)) AS scrambled "
    "FROM (SELECT *, numbers + words AS tokens FROM (SELECT claim_id, page_no, greatest(10 - claim_id % 11, 0)::DOUBLE AS rows, (claim_id % 11 * 6)::DOUBLE AS words, greatest(10 - claim_id % 11, 0)::DOUBLE * 3 AS numbers FROM nums, range(4) r(page_no)))",
    NUMS,
)
def c13_scrambled_pages(spark, d):
    rows = _paged(spark, d)
    return rows.select("doc_id", F.col("page_no").cast("long").alias("page_no"), pages.scrambled(pages.line_features(pages.content(F.col("page_text")))).alias("scrambled"))


@query("SELECT claim_id AS doc_id, page_no, md5(CASE page_no WHEN 1 THEN 'x' ELSE 'y' END) AS digest FROM nums, range(1, 3) r(page_no)", NUMS)
def t11_chunk_text(spark, d):
    """Page headings, block tags and the source header go; what is left is one letter a page."""
    text = F.concat(F.lit("## [Page 1]\n--- SOURCE INFO ---\nURL: "), F.col("claim_id").cast("string"), F.lit("\n------------------\n#### [OCR Text Content]\nx\n## [Page 2]\n#### [Native Text Content] \ny"))
    rows = chunks.pages(nums(spark, d).select(F.col("claim_id").alias("doc_id"), text.alias("text")))
    return rows.select("doc_id", F.col("page_no").cast("long").alias("page_no"), F.md5(F.regexp_replace(pages.cleaned(F.col("page_text")), r"^\s+|\s+$", "")).alias("digest"))


POLICIES = [
    ("DOH Department Memorandum No. 2020-0{q}: Guidelines on the delivery of testing services", "x.pdf", "surveillance_report", ("department_memorandum", "2020-0{q}", "DOH", "Guidelines on the delivery of testing services"), "text text text text"),
    ("It was repealed by RA 85{q2}.", "policy.pdf", "guideline_policy", ("republic_act", "85{q2}", "DOH", "policy"), "text text file file"),
    ("No number in this text.", "a/AO_No_2019-00{q2}_update.pdf", "guideline_policy", ("administrative_order", "2019-00{q2}", "DOH", None), "file file file file"),
    ("National guidelines for care, issued by the Department of Health", "a.pdf", "other", ("guideline", None, "DOH", "National guidelines for care, issued by the Department of Health"), "text - text text"),
    ("plain words", "plain.pdf", "other", (None, None, None, None), "- - - -"),
    ("Guidelines of the program", "DC_2021-00{q2}.pdf", "other", ("guideline", "2021-00{q2}", None, "Guidelines of the program"), "text file - text"),
]
_SLOTS = ("type", "reference", "issuer", "title")


def _policy_sql() -> str:
    """{q} is a number as it is, {q2} the same in two digits."""
    value = lambda v: "NULL::VARCHAR" if v is None else "concat(" + ", ".join(f"'{x}'" if k % 2 == 0 else "lpad(q::VARCHAR, 2, '0')" if x == "q2" else "q::VARCHAR" for k, x in enumerate(v.replace("}", "{").split("{"))) + ")"
    rows = []
    for k, (_, _, _, slots, found) in enumerate(POLICIES):
        cells = [f"{value(v)} AS policy_{s}" for s, v in zip(_SLOTS, slots, strict=True) if s != "title"]
        cells += [f"{'NULL::VARCHAR' if w == '-' else repr(w)} AS policy_{s}_from" for s, w in zip(_SLOTS, found.split(), strict=True)]
        cells.append(f"{sum(w != '-' for w in found.split()) >= 2} AS structured")
        title = "'AO update'" if k == 2 else value(slots[3])
        rows.append(f"SELECT claim_id, {', '.join(cells)}, {title} AS policy_title FROM nums WHERE claim_id % {len(POLICIES)} = {k}")
    return " UNION ALL ".join(rows)


@query(_policy_sql(), NUMS)
def c6_policy_tags(spark, d):
    """Slots filled from the text, else from the file's name, and where each was found."""
    made = nums(spark, d).withColumn("q2", F.lpad(F.col("q").cast("string"), 2, "0"))
    put = lambda v: F.concat(*[F.lit(x) if k % 2 == 0 else F.col(x).cast("string") for k, x in enumerate(v.replace("}", "{").split("{"))])
    pick = lambda c: F.element_at(F.array(*[put(p[c]) for p in POLICIES]), (F.pmod("claim_id", F.lit(len(POLICIES))) + 1).cast("int"))
    claims = made.select("claim_id", pick(0).alias("claim_text"), F.lit(None).cast("string").alias("snippet"), pick(1).alias("filename"), pick(2).alias("document_type"))
    return policy.tags(claims).select("claim_id", *[f"policy_{s}" for s in _SLOTS], *[f"policy_{s}_from" for s in _SLOTS], "structured")


YEARENDS = """ends AS (SELECT year, quarter, ascii(right(region, 1)) % 5 + 1 AS code, count(*) AS a, count(*) FILTER (WHERE unit = 'F') AS b, count(*) FILTER (WHERE unit = 'O') AS c FROM obs GROUP BY ALL),
kept AS (SELECT * FROM ends WHERE NOT (quarter = 4 AND year % 2 = 0)),
last AS (SELECT e.* FROM kept e JOIN (SELECT year, max(quarter) AS quarter FROM kept GROUP BY 1) USING (year, quarter))"""


def _year_end(spark, d):
    """A file for each quarter with the region table; the fourth quarter's of even years can't be read."""
    o = views.observations(spark, d)
    code = (F.ascii(F.right("region", F.lit(1))) % 5 + 1).cast("string")
    cells = o.groupBy("year", "quarter", code.alias("code")).agg(F.count(F.lit(1)).alias("a"), F.count_if(F.col("unit") == "F").alias("b"), F.count_if(F.col("unit") == "O").alias("c"))
    line = F.concat_ws(" | ", "code", "a", "b", F.lit("5%"), "c", F.lit("7%"))
    title = F.when((F.col("quarter") == 4) & (F.col("year") % 2 == 0), "Unreadable").otherwise(blocks.TITLE)
    files = cells.groupBy("year", "quarter").agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("lines"))
    name = F.concat(F.col("year").cast("string"), F.lit("_Q"), F.col("quarter").cast("string"), F.lit(".md"))
    rows = blocks.region_rows(files.select(name.alias("doc_id"), F.concat(title, F.lit("\n"), "lines").alias("text")))
    part = lambda k: F.regexp_extract("doc_id", r"^(\d+)_Q(\d)", k).cast("int")
    return boards.year_end(rows.select(F.col("doc_id").alias("filename"), part(1).alias("year"), (part(2) * 3).alias("month"), "region", "on_art", "vl_tested", "vl_suppressed"))


@query("SELECT year, concat(year, '_Q', quarter, '.md') AS filename, code::VARCHAR AS region, a::DOUBLE AS on_art, b::DOUBLE AS vl_tested, c::DOUBLE AS vl_suppressed FROM last", OBS, YEARENDS)
def x13_year_end_tables(spark, d):
    """The newest file of each year that can be read."""
    return _year_end(spark, d).drop("month")


LEAKAGE = """seen AS (SELECT year, (ascii(right(region, 1)) % 5 + 1)::VARCHAR AS region, CASE metric WHEN '1-URGENT' THEN 'alive' WHEN '2-HIGH' THEN 'ltfu' ELSE 'not_on_treatment' END AS metric, floor(value) AS value, sort_key, confidence FROM obs
  WHERE metric IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND NOT (metric = '3-MEDIUM' AND year % 2 = 0) AND NOT (metric = '2-HIGH' AND ascii(right(region, 1)) % 5 = 1)),
best AS (SELECT year, region, metric, arg_max(value, (sort_key, confidence, value)) AS value, FALSE AS filled FROM seen GROUP BY 1, 2, 3),
more AS (SELECT year, code::VARCHAR AS region, metric, value, TRUE AS filled FROM (SELECT year, code, unnest(['alive', 'ltfu', 'not_on_treatment']) AS metric, unnest([a, b, c])::DOUBLE AS value FROM last WHERE year % 4 <> 0)),
every AS (SELECT * FROM best UNION ALL SELECT * FROM more WHERE NOT EXISTS (SELECT 1 FROM best b WHERE b.year = more.year AND b.region = more.region AND b.metric = more.metric)),
wide AS (SELECT year, region, max(value) FILTER (WHERE metric = 'alive') AS alive, max(value) FILTER (WHERE metric = 'ltfu') AS ltfu, max(value) FILTER (WHERE metric = 'not_on_treatment') AS n, coalesce(bool_or(filled) FILTER (WHERE metric = 'not_on_treatment'), FALSE) AS proxy FROM every GROUP BY 1, 2)"""


@query("SELECT year, region, coalesce(alive, 0)::DOUBLE AS alive, coalesce(ltfu, 0)::DOUBLE AS ltfu, coalesce(n, 0)::DOUBLE AS not_on_treatment, proxy, n IS NULL AS missing_not_on_treatment, (coalesce(ltfu, 0) + coalesce(n, 0))::DOUBLE AS burden, row_number() OVER (PARTITION BY year ORDER BY coalesce(ltfu, 0) + coalesce(n, 0) DESC, region)::INTEGER AS place FROM wide", OBS, YEARENDS, LEAKAGE)
def b12_leakage_by_year(spark, d):
    """Observed leakage, years that lack a metric filled from the year-end table (every fourth year has none), gaps flagged."""
    o = views.observations(spark, d).where("metric in ('1-URGENT', '2-HIGH', '3-MEDIUM') and not (metric = '3-MEDIUM' and year % 2 = 0) and not (metric = '2-HIGH' and ascii(right(region, 1)) % 5 = 1)")
    metric = F.when(F.col("metric") == "1-URGENT", "alive").when(F.col("metric") == "2-HIGH", "ltfu").otherwise("not_on_treatment")
    seen = o.select("year", (F.ascii(F.right("region", F.lit(1))) % 5 + 1).cast("string").alias("region"), metric.alias("metric"), F.floor("value").cast("double").alias("value"), "sort_key", "confidence")
    ends = _year_end(spark, d).where("year % 4 != 0").select("year", "region", F.col("on_art").alias("alive"), F.col("vl_tested").alias("ltfu"), F.col("vl_suppressed").alias("not_on_treatment"))
    return boards.leakage_by_year(seen, ends.unpivot(["year", "region"], ["alive", "ltfu", "not_on_treatment"], "metric", "value"))


# --- review families and work queues

_REASONS = list(classify.REVIEW_FAMILIES)
_TEXTS = [form for form, _ in bulletins._ALL] + ["Quick facts: Male has values 1.", "Mode of transmission: Bisexual has values 2.", "Region of: NCR has values 3.", "Health workers shall undergo a test.", "See AO 2020-1.", "| 1 | 2 | 3 |", "nothing of note"]


def _families_sql() -> str:
    quoted = lambda w: "'" + w.replace("'", "''") + "'"
    part = lambda ws: "(" + " OR ".join(f"contains(low, {quoted(w)})" for w in ws) + ")"
    cases = [f"WHEN review_reason = '{reason}' AND {' AND '.join(map(part, parts))} THEN '{name}'" for reason, rules in classify.REVIEW_FAMILIES.items() for name, *parts in rules]
    cases.append("WHEN review_reason = 'structured_table_mapping_needed' AND (len(regexp_extract_all(low, '\\|')) >= 3 OR len(regexp_extract_all(low, '\\b[0-9]{4}\\b')) >= 4 OR regexp_matches(low, '(?:[0-9]+[ ,]+){6,}')) THEN 'ocr_scrambled_table'")
    back = " ".join(f"WHEN review_reason = '{r}' THEN '{f}'" for r, f in classify.FALLBACK_FAMILIES.items())
    forms = ", ".join(quoted(t) for t in _TEXTS)
    return (
        f"SELECT coalesce(family, CASE {back} END) AS template_family, CASE WHEN family IS NULL THEN 'fallback' ELSE 'deterministic' END AS family_source, count(*) AS n FROM (SELECT review_reason, CASE {' '.join(cases)} END AS family FROM "
        f"(SELECT ([{', '.join(quoted(r) for r in _REASONS)}])[claim_id % {len(_REASONS)} + 1] AS review_reason, lower(([{forms}])[claim_id % {len(_TEXTS)} + 1]) AS low FROM nums)) GROUP BY ALL"
    )


@query(_families_sql(), NUMS)
def a9_family_counts(spark, d):
    """Families of review items by all markers of their reason, and how many each source gave."""
    text = F.element_at(F.array(*map(F.lit, _TEXTS)), (F.pmod("claim_id", F.lit(len(_TEXTS))) + 1).cast("int"))
    reason = F.element_at(F.array(*map(F.lit, _REASONS)), (F.pmod("claim_id", F.lit(len(_REASONS))) + 1).cast("int"))
    return classify.family_counts(classify.families(nums(spark, d).select(reason.alias("review_reason"), text.alias("text"))))


@query("SELECT doc_id AS id, status, row_number() OVER (ORDER BY CASE status WHEN 'parsing' THEN 1 WHEN 'extracting' THEN 2 ELSE 3 END, n_chars, doc_id)::INTEGER AS place FROM registry WHERE status IN ('parsing', 'extracting', 'downloading') QUALIFY place <= 100", views.REGISTRY)
def r7_active_work(spark, d):
    work = views.registry(spark, d).select(F.col("doc_id").alias("id"), "status", F.col("n_chars").alias("claimed_at"))
    return boards.active_work(work, ["parsing", "extracting", "downloading"]).select("id", "status", "place")


@query(
    "SELECT year, region, complete, shortfall, row_number() OVER (PARTITION BY year ORDER BY complete DESC, shortfall, region)::INTEGER AS place FROM (SELECT year, region, a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL AS complete, round(greatest(95 - coalesce(a, 0), 0) + greatest(95 - coalesce(b, 0), 0) + greatest(95 - coalesce(c, 0), 0), 2)::DOUBLE AS shortfall "
    "FROM (SELECT year, region, max(value % 97)::INTEGER FILTER (WHERE metric = '1-URGENT')::DOUBLE AS a, max((value % 89)::INTEGER) FILTER (WHERE metric = '2-HIGH')::DOUBLE AS b, max((value % 83)::INTEGER) FILTER (WHERE metric = '5-LOW')::DOUBLE AS c FROM (SELECT year, region, metric, floor(value)::BIGINT AS value FROM obs) GROUP BY 1, 2))".replace("max(value % 97)::INTEGER FILTER", "max((value % 97)::INTEGER) FILTER"),
    OBS,
)
def r9_by_shortfall(spark, d):
    o = views.observations(spark, d).withColumn("v", F.floor("value"))
    of = lambda m, k: F.max(F.when(F.col("metric") == m, F.col("v") % k)).cast("double")
    wide = o.groupBy("year", "region").agg(of("1-URGENT", 97).alias("diagnosis"), of("2-HIGH", 89).alias("treatment"), of("5-LOW", 83).alias("suppression"))
    return boards.by_shortfall(wide, ["year"], ["diagnosis", "treatment", "suppression"]).select("year", "region", "complete", "shortfall", "place")


@query("SELECT claim_id, round(k / m::DOUBLE * 100, 1) AS percent, CASE WHEN claim_id % 3 = 0 THEN q::DOUBLE WHEN claim_id % 3 = 1 THEN p::DOUBLE END AS rate, CASE WHEN k < m AND claim_id % 3 < 2 THEN round((m - k) / (CASE WHEN claim_id % 3 = 0 THEN q ELSE p END)::DOUBLE * 60, 1) END AS eta_seconds FROM nums", NUMS)
def w20_progress(spark, d):
    """Remaining work over the rolling rate, else over the average one, else unknown."""
    third = F.pmod("claim_id", F.lit(3))
    work = nums(spark, d).select("claim_id", F.col("k").alias("done"), F.col("m").alias("total"), F.when(third == 0, F.col("q").cast("double")).alias("rolling"), F.when(third < 2, F.col("p").cast("double")).otherwise(F.lit(0.0)).alias("average"))
    return boards.progress(work).select("claim_id", "percent", "rate", "eta_seconds")
