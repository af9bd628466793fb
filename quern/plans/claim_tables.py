"""Claims to observations: table rows whose cells are numbers of each customer's orders, read back and compared with those numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tables
from .registry import query
from .views_numbers import NUMS, nums, said

_COLUMNS = {"filename": "hiv_sti_2024_q2.pdf", "page_index": 0, "category": "Structured Table Row", "row_label": "", "snippet": "", "region": "Unknown", "document_type": "surveillance_report", "year": 2024, "metric_type": "general", "period_granularity": "quarter", "period_label": "2024 Q2"}


def _claims(spark, d, value, text="Table: x has values 1.", **columns):
    made = {**_COLUMNS, **columns}
    return nums(spark, d).select("claim_id", said(value).alias("raw_value"), said(text).alias("claim_text"), *[F.lit(v).alias(k) for k, v in made.items()])


def _rows(*rows, source="nums"):
    """metric, region, subgroup, scope, number."""
    return " UNION ALL ".join(f"SELECT claim_id, '{m}' AS metric, '{r}' AS region, '{g}' AS subgroup, '{s}' AS scope, ({x})::DOUBLE AS value FROM {source}" for m, r, g, s, x in rows)


def _out(df):
    return df.select("claim_id", "metric", "region", "subgroup", "scope", "value")


VL = ("{n} | {m} | {p}% | {k} | {q}%", [("alive_on_art_count", "4A", "", "snapshot", "n"), ("viral_load_tested_count", "4A", "", "snapshot", "m"), ("viral_load_tested_pct", "4A", "", "snapshot", "p"), ("viral_load_suppressed_count", "4A", "", "snapshot", "k"), ("viral_load_suppressed_pct", "4A", "", "snapshot", "q")])


@query(_rows(*VL[1]), NUMS)
def o4_viral_load_rows(spark, d):
    return _out(tables.observations(_claims(spark, d, VL[0], row_label="Region IV-A")))


OUT = [("alive_on_art_count", "n"), ("lost_to_follow_up_count", "k"), ("dead_count", "q"), ("migrated_overseas_count", "k"), ("refused_art_count", "q"), ("ever_enrolled_art_count", "m"), ("lost_to_follow_up_pct", "p"), ("not_on_treatment_count", "greatest(m - n, 0)")]


@query(_rows(*[(m, "NCR", "", "snapshot", x) for m, x in OUT]), NUMS)
def o5_outcome_rows(spark, d):
    return _out(tables.observations(_claims(spark, d, "{n} | {k} | {q} | {k} | {q} | {m} | {p}%", "Treatment Outcome: NCR has values 1.", row_label="NCR", period_granularity="year")))


@query(_rows(*[({"dead_count": "lost_to_follow_up_count", "lost_to_follow_up_count": "dead_count"}.get(m, m), "CAR", "", "snapshot", x) for m, x in OUT]), NUMS)
def o5_outcome_rows_dead_first(spark, d):
    return _out(tables.observations(_claims(spark, d, "{n} | {k} | {q} | {k} | {q} | {m} | {p}%", "Treatment Outcome: CAR has values 1.", row_label="Unreadable", region="CAR", period_granularity="year", filename="HIV_STI_2025_Q4.pdf")))


@query(_rows(("alive_on_art_count", "CARAGA", "", "snapshot", "n"), ("lost_to_follow_up_count", "CARAGA", "", "snapshot", "k"), ("migrated_overseas_count", "CARAGA", "", "snapshot", "q")), NUMS)
def o6_partial_outcomes(spark, d):
    """The region is a cell of the row."""
    return _out(tables.observations(_claims(spark, d, "CARAGA | {n} | {k} | {q}", filename=tables.RESIDENCE_FILE, page_index=3)))


@query(_rows(("new_cases_count", "6", "", "snapshot", "n"), ("new_cases_pct", "6", "", "snapshot", "p"), *[(f"reported_cases_{w}", "NCR", "", s, x) for s, c in (("year_to_date", "m"), ("recent_window", "k"), ("cumulative", "n")) for w, x in (("count", c), ("pct", "q"))]), NUMS)
def o7_two_panels(spark, d):
    """One row holds two regions; the first panel's count was scanned into its label."""
    made = _claims(spark, d, "{p}% | NCR | {m} {q}% | {k} {q}% | {n} {q}%", "Region Number of %: 6 has values 1.", filename=tables.RESIDENCE_FILE, page_index=1)
    return _out(tables.observations(made.join(nums(spark, d).select("claim_id", said("6 {n}").alias("label")), "claim_id").withColumn("row_label", F.col("label")).drop("label")))


@query(_rows(*[("sexual_contact_cases_" + w, "Unknown", "", s, x) for s, c, p in (("month", "n", "p"), ("cumulative", "m", "q")) for w, x in (("count", c), ("pct", p))]), NUMS)
def o9_transmission_rows(spark, d):
    return _out(tables.observations(_claims(spark, d, "", "Mode of HIV Transmission: Sexual Contact has values {n}, {p}%, {m}, {q}%.", row_label="Sexual Contact")))


@query(_rows(("male_male_sex_cases_count", "Unknown", "", "month", "n"), ("male_male_sex_cases_count", "Unknown", "", "cumulative", "m"), ("male_male_sex_cases_pct", "Unknown", "", "cumulative", "q")), NUMS)
def o9_transmission_rows_without_month_share(spark, d):
    return _out(tables.observations(_claims(spark, d, "", "Types of Sexual Transmission: Homosexual contact has values {n}, {m}, {q}%.", row_label="Homosexual contact")))


_CASCADE = [("estimated_plhiv", "n"), ("diagnosed_plhiv", "m"), ("diagnosis_coverage", "p"), ("on_art", "k"), ("art_coverage", "q"), ("vl_tested", "n"), ("vl_testing_coverage", "p"), ("vl_suppressed", "k"), ("vl_suppression_among_tested", "q"), ("suppression_among_on_art", "p")]
_TEN, _NINE = "{n} | {m} | {p}% | {k} | {q}% | {n} | {p}% | {k} | {q}% | {p}%", "{n} | {m} | {p}% | {k} | {q}% | {n} | {k} | {q}% | {p}%"


@query(_rows(*[(m, "7", "", "", x) for m, x in _CASCADE]), NUMS)
def o2_cascade_by_region(spark, d):
    return _out(tables.observations(_claims(spark, d, _TEN, category="Care Cascade Region", row_label="7")))


@query(_rows(*[(m, "Unknown", "15-24", "", x) for m, x in _CASCADE if m != "vl_testing_coverage"]), NUMS)
def o2_cascade_by_age(spark, d):
    return _out(tables.observations(_claims(spark, d, _NINE, category="Care Cascade Age Group", row_label="15-24")))


_MIXED = (
    (0, dict(value=VL[0], row_label="Region IV-A"), VL[1]), (1, dict(value="{k} | {m} | {n}", row_label="Male", period_granularity="month"), [("reported_cases", "Unknown", "male", s, x) for s, x in (("month", "k"), ("year_to_date", "m"), ("cumulative", "n"))]),
    (2, dict(value=_TEN, category="Care Cascade Region", row_label="7"), [(m, "7", "", "", x) for m, x in _CASCADE]),
    (3, dict(value="{n} | {m} | {p}%", text="Percent increase between December 2020 and 2025: Male has values 1.", row_label="20-24"), [("cases_2020", "Unknown", "20-24", "", "n"), ("cases_2025", "Unknown", "20-24", "", "m"), ("percent_increase", "Unknown", "20-24", "", "p")]),
    (4, dict(value="", text="Since 2011, a total of {n} diagnosed women were reported pregnant at the time of diagnosis.", category="Narrative Statistic"), [("pregnant_women_reported_count", "Philippines", "pregnant_women", "cumulative", "n")]),
)


@query(" UNION ALL ".join(_rows(*rows, source=f"(SELECT * FROM nums WHERE claim_id % 5 = {k})") for k, _, rows in _MIXED), NUMS)
def o1_dispatch(spark, d):
    """Claims of all kinds in one table, each read by the first mapper that can."""
    made = [_claims(spark, d, **how).where(F.col("claim_id") % len(_MIXED) == k) for k, how, _ in _MIXED]
    every = made[0]
    for m in made[1:]:
        every = every.unionByName(m)
    return _out(tables.observations(every))


@query("SELECT claim_id, 'HIV_STI_2019_May.pdf' AS filename, 2019::INTEGER AS year, 5::INTEGER AS month, 'month' AS period_granularity, '2019-05' AS period_label, 'HIV' AS primary_disease, 'deaths' AS metric_type, 'NCR' AS region, 'surveillance_report' AS document_type, n::DOUBLE AS numeric_value, 'deaths' AS numeric_unit FROM nums", NUMS)
def o39_normalized_claims(spark, d):
    raw = nums(spark, d).select("claim_id", F.lit("/a/HIV_STI_2019_May.pdf").alias("local_path"), F.lit(0).alias("page_index"), F.lit("general").alias("category"), said("In May, {n} HIV deaths were recorded in NCR.").alias("claim_text"), said("{n} deaths").alias("value"), F.lit("").alias("snippet"), F.lit(0.9).alias("confidence"))
    return tables.normalized(raw).select("claim_id", "filename", "year", "month", "period_granularity", "period_label", "primary_disease", "metric_type", "region", "document_type", "numeric_value", "numeric_unit")


@query("SELECT claim_id, CASE WHEN claim_id % 3 <> 0 THEN n::DOUBLE END AS value, CASE WHEN claim_id % 3 <> 0 THEN 'percent' END AS unit FROM nums", NUMS)
def o37_scalar_values(spark, d):
    """No number for categories that hold several."""
    number, unit = tables.scalar(F.col("v"), F.lit("text without numbers"), F.when(F.col("claim_id") % 3 == 0, "Treatment Outcome").otherwise("general"))
    return nums(spark, d).select("claim_id", said("{n} percent").alias("v")).select("claim_id", number.alias("value"), unit.alias("unit"))


@query("SELECT claim_id, metric, value::DOUBLE AS value FROM (UNPIVOT (SELECT claim_id, n AS estimated, m AS ever_enrolled, k AS alive, greatest(m - k, 0) AS not_on_treatment FROM nums) ON COLUMNS(* EXCLUDE claim_id) INTO NAME metric VALUE value)", NUMS)
def o41_dimension_rows(spark, d):
    wide = nums(spark, d).select("claim_id", F.col("n").alias("estimated"), F.col("m").alias("ever_enrolled"), F.col("k").alias("alive"))
    return tables.cascade_rows(wide, ["claim_id"], ["estimated", "ever_enrolled", "alive"], "ever_enrolled", "alive")


@query("SELECT claim_id, TRUE AS share, FALSE AS count, claim_id % 2 = 0 AS pairs FROM nums", NUMS)
def m17_token_predicates(spark, d):
    token, last = said("{p}%"), F.when(F.col("claim_id") % 2 == 0, said("{q}%")).otherwise(said("{q}"))
    return nums(spark, d).select("claim_id", tables.is_percent(token).alias("share"), tables.is_count(token).alias("count"), tables.three_pairs(F.array(said("{n}"), token, said("{m}"), token, said("{k}"), last)).alias("pairs"))


@query("SELECT claim_id, round(CASE WHEN claim_id % 2 = 0 THEN m ELSE n / (p / 100.0::DOUBLE) END, 4) AS estimate FROM nums", NUMS)
def m18_backed_out(spark, d):
    return nums(spark, d).select("claim_id", F.round(tables.backed_out(F.when(F.col("claim_id") % 2 == 0, F.col("m")).cast("double"), F.col("n"), F.col("p")), 4).alias("estimate"))


@query("SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'pregnant_women' WHEN 1 THEN 'tgw' ELSE '' END AS cohort, ['pregnant_women', 'tgw', 'migrant_workers', 'age_10_19', ''][o_orderkey % 5 + 1] AS subgroup, ['reported_deaths', 'new_cases', 'reported_cases', 'new_cases', 'reported_cases'][o_orderkey % 5 + 1] AS base FROM orders")
def c7_c8_subgroups(spark, d):
    forms = ["Among pregnant women 4 reported deaths", "Newly diagnosed transgender women", "Most OFWs were cases", "Adolescents 10-19 newly reported", "Nothing else"]
    o = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.element_at(F.array(*map(F.lit, forms)), (F.col("o_orderkey") % 5 + 1).cast("int")).alias("t"))
    return o.select("o_orderkey", tables.cohort_subgroup(F.col("t")).alias("cohort"), tables.narrative_subgroup(F.col("t")).alias("subgroup"), tables.metric_base(F.lit("general"), F.col("t")).alias("base"))


@query("SELECT claim_id, CASE claim_id % 3 WHEN 0 THEN '4A' WHEN 1 THEN 'NCR' END AS region, '11' AS named, n AS embedded, concat_ws(',', 'BARMM', k, q::VARCHAR || '%') AS tokens, '7' AS before FROM (SELECT *, n::VARCHAR AS ns FROM nums)", NUMS)
def c22_g17_g18_row_regions(spark, d):
    label, claimed = F.when(F.col("claim_id") % 3 == 0, "Region IV-A").otherwise("total"), F.when(F.col("claim_id") % 3 == 1, "NCR").otherwise("Unknown")
    named, embedded = tables.label_and_count(F.concat(F.lit("11 "), F.col("n").cast("string")))
    rows = nums(spark, d)
    return rows.select(
        "claim_id", tables.row_region(label, claimed).alias("region"), named.alias("named"), embedded.cast("long").alias("embedded"),
        F.array_join(tables.cell_tokens(F.concat(F.lit("Bangsamoro Autonomous Region in Muslim Mindanao (BARMM) | "), F.col("k").cast("string"), F.lit(" of "), F.col("q").cast("string"), F.lit("%"))), ",").alias("tokens"),
        tables.before_value(F.concat(F.lit("x | 7 | "), F.col("n").cast("string"), F.lit(" | 9")), F.col("n").cast("string")).alias("before"),
    )
