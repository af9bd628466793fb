"""Operators over input whose rows differ in kind, so that the operator and not the query decides."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers
from ..operators import chunks, classify, quality, resolve, series
from ..sources import readers, sinks, views
from ..sources.views import CLAIMS, OBS, OFFICIAL, QUARANTINE, REGISTRY
from .pages import _TEXTS
from .registry import query
from .views_numbers import NUMS, nums, said

#: token, and what each parser makes of it: clean, whole, decimal, signed, nullable, dash, unit.
TOKENS = [
    ("{n}", "n", "n", "n", "n", "n", "n", "count"), ("<{k}", "k", "k", "k", "k", None, "k", "count"), ("{p}.5%", "p + 0.5", "p * 10 + 5", "p + 0.5", "p + 0.5", None, "p * 10 + 5", "percent"), ("{k}a", "k", "k", "k", "k", None, "k", "count"),
    ("-", None, None, None, None, None, "0", "count"), ("...", None, None, None, None, None, None, "count"), ("three", None, "3", None, None, None, "3", "count"), ("-{q}.25", None, "q * 100 + 25", "q + 0.25", "-(q + 0.25)", "-(q + 0.25)", "q * 100 + 25", "count"),
    ("{k} deaths", None, "k", "k", "k", None, "k", "deaths"), ("{k} tests done", None, "k", "k", "k", None, "k", "tests"), ("", None, None, None, None, None, None, "count"),
]
_PARSED = ("clean", "whole", "decimal", "signed", "nullable", "dash")


@query(" UNION ALL ".join(f"SELECT claim_id, {at} AS place, " + ", ".join(f"({v or 'NULL'})::{'BIGINT' if c in ('whole', 'dash') else 'DOUBLE'} AS {c}" for c, v in zip(_PARSED, row[1:7], strict=True)) + f", '{row[7]}' AS unit FROM nums" for at, row in enumerate(TOKENS)), NUMS)
def m_parsers(spark, d):
    """Every parser over every kind of token."""
    token = F.col("token")
    rows = nums(spark, d).select("claim_id", F.posexplode(F.array(*[said(t[0]) if t[0] else F.lit("") for t in TOKENS])).alias("place", "token"))
    parsers = dict(zip(_PARSED, (numbers.clean_token, numbers.integer, numbers.decimal, numbers.signed, numbers.nullable, numbers.dash_is_zero), strict=True))
    return rows.select("claim_id", "place", *[f(token).alias(c) for c, f in parsers.items()], numbers.unit(token).alias("unit"))


@query(
    "SELECT claim_id, CASE claim_id % 4 WHEN 0 THEN 1990 + claim_id % 30 WHEN 1 THEN 1990 + claim_id % 30 WHEN 2 THEN 5000 + n ELSE k END::DOUBLE AS first_number, claim_id % 4 = 0 AS reference FROM nums", NUMS,
)
def m9_reference_numbers(spark, d):
    """A year beside a month is a reference; the same number alone, larger ones, and small ones are not."""
    year = (1990 + F.col("claim_id") % 30).cast("string")
    texts = [F.concat(F.lit("As of May "), year, F.lit(" there were more")), F.concat(year, F.lit(" people were told")), F.concat(F.lit("In May, "), (5000 + F.col("n")).cast("string"), F.lit(" came")), F.concat(F.lit("In May, "), F.col("k").cast("string"), F.lit(" came"))]
    text = F.element_at(F.array(*texts), (F.col("claim_id") % 4 + 1).cast("int"))
    number = numbers.first_number(text)
    return nums(spark, d).select("claim_id", number.alias("first_number"), numbers.is_reference(text, number).alias("reference"))


REGIONS = [("National Capital Region (NCR)", "NCR"), ("ncr", "NCR"), ("Region IV-A", "4A"), ("Region 4-B", "4B"), ("region xiii", "CARAGA"), ("CARAGA", "CARAGA"), ("Cordillera Administrative Region", "CAR"), ("BARMM", "BARMM"), ("Region IX", "9"), ("nowhere", None), ("Region 12", "12"), ("Region X", "10"), ("", None)]


@query(f"SELECT claim_id, ([{', '.join('NULL' if c is None else repr(c) for _, c in REGIONS)}])[claim_id % {len(REGIONS)} + 1] AS code FROM nums", NUMS)
def c5_region_labels(spark, d):
    label = F.element_at(F.array(*[F.lit(x) for x, _ in REGIONS]), (F.col("claim_id") % len(REGIONS) + 1).cast("int"))
    return nums(spark, d).select("claim_id", classify.region_code(label).alias("code"))


_FILES = ["HIV_STI_2019_May.pdf", "AO_2015_0017.pdf", "situational_report_3.pdf", "other.pdf"]
_CATEGORIES = ["Narrative Statistic", "Care Cascade Region", "Treatment Outcome", "general"]


def _first_sql(text: str, rules: dict[str, str], default: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({text}, '(?i){p}') THEN '{n}'" for n, p in rules.items()) + f" ELSE '{default}' END"


def _classified_sql() -> str:
    quoted = lambda xs: ", ".join("'" + x.replace("'", "''") + "'" for x in xs)
    low = "lower(concat(name, chr(10), category, chr(10), said))"
    hints = lambda ws: "(" + " OR ".join(f"contains({low}, '{w}')" for w in ws) + ")"
    kind = f"CASE WHEN starts_with(category, 'Care Cascade') THEN 'care_cascade_report' WHEN {hints(classify.POLICY_HINTS)} THEN 'guideline_policy' WHEN {hints(classify.SITUATION_HINTS)} THEN 'situational_report' WHEN {hints(classify.SURVEILLANCE_HINTS)} THEN 'surveillance_report' ELSE 'other' END"
    metric = f"CASE WHEN starts_with(category, 'Care Cascade') THEN 'care_cascade' WHEN category = 'Treatment Outcome' THEN 'treatment_outcome' ELSE {_first_sql('concat(said, chr(10), category)', classify.METRICS, 'general')} END"
    return (
        f"SELECT claim_id, {metric} AS metric_type, {_first_sql('said', classify.PLACES, 'Unknown')} AS region, {kind} AS document_type FROM (SELECT claim_id, ([{quoted(_TEXTS)}])[claim_id % {len(_TEXTS)} + 1] AS said, "
        f"([{quoted(_FILES)}])[claim_id % {len(_FILES)} + 1] AS name, ([{quoted(_CATEGORIES)}])[claim_id // 4 % {len(_CATEGORIES)} + 1] AS category FROM nums)"
    )


@query(_classified_sql(), NUMS)
def c_classified_claims(spark, d):
    """Metric type, region and document type of claims of every wording under several names and categories."""
    pick = lambda xs, k: F.element_at(F.array(*map(F.lit, xs)), (k % len(xs) + 1).cast("int"))
    claim = F.col("claim_id")
    rows = nums(spark, d).select("claim_id", pick(_TEXTS, claim).alias("said"), pick(_FILES, claim).alias("name"), pick(_CATEGORIES, F.floor(claim / 4)).alias("category"))
    text, name, category = (F.col(c) for c in ("said", "name", "category"))
    return rows.select("claim_id", classify.metric_type(category, text).alias("metric_type"), classify.region(F.lit(""), text).alias("region"), classify.document_type(name, category, text).alias("document_type"))


@query(
    "SELECT page_id, md5(trim(replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]*>', '', 'g'), '&#8211;', '-'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'))) AS digest FROM pages"
)
def t12_plain_pages(spark, d):
    return views.table(spark, d, "pages").select("page_id", F.md5(readers.strip_markup(F.col("html"))).alias("digest"))


@query("SELECT doc_id AS alias, canonical FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY file_hash) AS canonical FROM registry WHERE file_hash IS NOT NULL) WHERE doc_id <> canonical", REGISTRY)
def k8_aliases(spark, d):
    """Documents whose text an earlier one has, and which."""
    return resolve.aliases(views.registry(spark, d), "file_hash", "doc_id")


_KEY = ["document_id", "metric", "unit", "region", "subgroup", "period_label", "year", "quarter"]


@query(f"SELECT observation_id FROM obs QUALIFY row_number() OVER (PARTITION BY {', '.join(_KEY)} ORDER BY observation_id) = 1", OBS)
def w1_first_of_key(spark, d):
    """Of observations alike in all eight columns the first stays."""
    return resolve.first_of(views.observations(spark, d), _KEY, F.asc("observation_id")).select("observation_id")


@query("SELECT claim_id, document_id, run_id, resolved FROM quarantine UNION ALL SELECT claim_id, document_id, run_id, NULL FROM claims WHERE confidence < 0.05", CLAIMS, QUARANTINE)
def v9_quarantine_append(spark, d):
    """Claims that fail are appended; that they are open is a null."""
    failed = views.claims(spark, d).where("confidence < 0.05").select("claim_id", "document_id", "run_id")
    return resolve.appended(views.quarantine(spark, d), failed)


@query("SELECT l_orderkey AS key, string_agg(p_name, ' | ' ORDER BY l_linenumber, l_partkey) AS listed FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_partkey % 7 <> 0 GROUP BY 1")
def j17_listed_items(spark, d):
    """Each order's parts by name, in the order of its lines; parts that aren't known are left out."""
    lines = views.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("ids"))
    parts = views.table(spark, d, "part").where("p_partkey % 7 != 0").select("p_partkey", "p_name")
    return resolve.listed(lines, parts, "ids", "p_partkey", "p_name").where(F.size("p_name") > 0).select("key", F.array_join("p_name", " | ").alias("listed"))


@query("SELECT metric, year, coalesce(o.value, l.value) AS value, CASE WHEN o.value IS NULL THEN 1 ELSE 0 END AS source FROM (SELECT metric, year, floor(value) AS value FROM official WHERE year <= 1995) o FULL JOIN (SELECT metric, year, floor(avg(value)) AS value FROM obs GROUP BY 1, 2) l USING (metric, year)", OBS, OFFICIAL)
def b9_historical_series(spark, d):
    """Official values up to 1995, local ones for the years they lack."""
    official = views.official(spark, d).where("year <= 1995").select("metric", "year", F.floor("value").cast("double").alias("value"))
    local = views.observations(spark, d).groupBy("metric", "year").agg(F.floor(F.avg("value")).cast("double").alias("value"))
    return series.first_source([official, local], ["metric", "year"])


@query()
def b10_plausible_series(spark, d):
    """Yearly sums of odd years, and those of all years let in where they are plausible; held to brute force."""
    o = views.observations(spark, d)
    structured = o.where("year % 2 = 1").groupBy("metric", "year").agg(F.count(F.lit(1)).cast("double").alias("value")).withColumn("sort_key", F.col("year") * 100 + 6)
    extracted = o.groupBy("metric", "year").agg((F.count(F.lit(1)) + F.max("month")).cast("double").alias("value")).withColumn("sort_key", F.col("year") * 100 + 12)
    return series.plausible_merge(structured, extracted, ["metric"], 10, 1_000_000)


@query("SELECT metric, concat(min(year), '-', max(year)) AS coverage, count(*) AS points, format('{:,}', arg_max(value, year)) AS latest FROM (SELECT metric, year, floor(avg(value))::BIGINT AS value FROM obs GROUP BY 1, 2) GROUP BY 1", OBS)
def q8_coverage_report(spark, d):
    points = views.observations(spark, d).groupBy("metric", "year").agg(F.floor(F.avg("value")).cast("long").alias("value"))
    return series.coverage_report(points, ["metric"])


@query("SELECT indicator, year, value FROM (SELECT metric AS indicator, year, floor(value)::BIGINT AS value FROM official) WHERE indicator IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND year >= 1994", OFFICIAL)
def s13_official_series(spark, d):
    rows = views.official(spark, d).select(F.col("metric").alias("indicator"), "year", F.floor("value").cast("long").alias("value"))
    return readers.official_series(rows, ["1-URGENT", "2-HIGH", "3-MEDIUM"], 1994)


@query("SELECT indicator, area, year, value FROM (SELECT metric AS indicator, region AS area, subgroup, year, count(*) AS value FROM obs GROUP BY ALL) WHERE indicator IN ('1-URGENT', '5-LOW') AND year >= 1993 AND area = 'NATION_7' AND subgroup = 'BUILDING'", OBS)
def s12_one_area(spark, d):
    """One area and one subgroup of a long table."""
    rows = views.observations(spark, d).groupBy(F.col("metric").alias("indicator"), F.col("region").alias("area"), "subgroup", "year").agg(F.count(F.lit(1)).alias("value"))
    return readers.official_series(rows, ["1-URGENT", "5-LOW"], 1993, "NATION_7", "BUILDING").drop("subgroup")


@query("SELECT '2024-01-01' AS generated_at, (SELECT count(*) FROM claims) AS total_claims, (SELECT count(*) FROM claims WHERE superseded_by_run_id IS NULL) AS active_claims, (SELECT count(*) FROM quarantine WHERE NOT resolved) AS quarantined", CLAIMS, QUARANTINE)
def k6_stamps(spark, d):
    return sinks.stamps(views.claims(spark, d), views.quarantine(spark, d), "2024-01-01")


_MONTH_LIST = "[" + ", ".join(f"'{m}'" for m in numbers.MONTHS) + "]"


@query(f"SELECT observation_id, concat(({_MONTH_LIST})[month], ',', ({_MONTH_LIST})[quarter * 3]) AS months FROM obs", OBS)
def g15_month_tokens(spark, d):
    """Names of months in a text, whatever stands between; longer words that hold one are none."""
    names = F.array(*[F.lit(m.title()) for m in numbers.MONTHS])
    text = F.concat(F.lit("Maybe as of "), F.element_at(names, F.col("month")), F.lit(" 12, marching to "), F.element_at(names, F.col("quarter") * 3), F.lit("; decembers"))
    return views.observations(spark, d).select("observation_id", F.array_join(chunks.month_tokens(text), ",").alias("months"))


@query("SELECT count(*) AS compared, count(*) FILTER (WHERE abs(o.value - l.value) > 0.1 * o.value) AS differing, count(DISTINCT metric) AS indicators, min(year) AS first, max(year) AS last FROM official o JOIN (SELECT metric, year, avg(value) AS value FROM obs GROUP BY 1, 2) l USING (metric, year)", OBS, OFFICIAL)
def q9_audit_summary(spark, d):
    """How many comparisons an audit made, how many differ, and over what."""
    local = views.observations(spark, d).groupBy("metric", "year").agg(F.avg("value").alias("local"))
    return quality.audit_summary(views.official(spark, d).join(local, ["metric", "year"]), 0.1)
