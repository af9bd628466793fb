"""Narrative mappers over claims whose wording is a form of their topic and whose numbers come from the orders of each customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bulletins, mappers, tables
from . import views_numbers as numbers_
from .registry import query

#: mapper, wording with numbers, and what it says: metric, subgroup, scope, number.
FORMS = {
    "o11_cohort_cascade": ("cohort_pregnant", "Among pregnant women, {n} ({p}%) were currently alive. Of these, {m} ({q}%) were initiated on ART. Only {k} ({p}%) were retained on ART.", [("alive_count", "pregnant_women", "", "n"), ("alive_pct", "pregnant_women", "", "p"), ("initiated_on_art_count", "pregnant_women", "", "m"), ("initiated_on_art_pct", "pregnant_women", "", "q"), ("retained_on_art_count", "pregnant_women", "", "k"), ("retained_on_art_pct", "pregnant_women", "", "p")]),
    "o11_cohort_cascade_tgw": ("cohort_tgw", "For TGW only {k} ({p}%) underwent viral load testing, of whom {m} ({q}%) were virally suppressed.", [("viral_load_tested_count", "tgw", "", "k"), ("viral_load_tested_pct", "tgw", "", "p"), ("viral_load_suppressed_count", "tgw", "", "m"), ("viral_load_suppressed_pct", "tgw", "", "q")]),
    "o12_national_headline": ("national_art_headline", "Further, {n} ({p}%) PLHIV are currently on life saving Anti-retroviral Therapy or ART, of which, {m} ({q}%) PLHIV have been tested for viral load.", [("plhiv_on_art_count", "", "", "n"), ("plhiv_on_art_pct", "", "", "p"), ("viral_load_tested_count", "", "", "m"), ("viral_load_tested_pct", "", "", "q")]),
    "o13_art_snapshot": ("historical_art", "A total of {n} people living with HIV (PLHIV) were presently on ART as of May 2017.", [("plhiv_on_art_count", "", "", "n")]),
    "o15_month_compared": ("monthly_new_cases_compared", "In May 2019, there were {n} newly diagnosed HIV cases. This was {p}% lower compared to the same period last year (n= {m} in 2018).", [("new_cases_count", "", "month", "n"), ("new_cases_yoy_change_pct", "", "month", "-p"), ("new_cases_prior_year_same_month_count", "", "month", "m")]),
    "o17_cumulative_deaths": ("cumulative_deaths", "A total of {n} deaths were reported from January 1984 to May 2019.", [("reported_deaths_count", "", "cumulative", "n")]),
    "o18_transmission_summary": ("transmission_summary", "Of these, {p}% ({n}) were infected through sexual contact, {q}% ({k}) through sharing of infected needles.", [("sexual_contact_cases_count", "", "", "n"), ("sexual_contact_cases_pct", "", "", "p"), ("needle_transmission_count", "", "", "k"), ("needle_transmission_pct", "", "", "q")]),
    "o21_migrant_workers": ("migrant_workers_split", "There were {n} OFWs since 1984, comprising {q}% of all cases. {m} ({p}%) were males and {k} ({q}%) were females.", [("reported_cases_count", "migrant_workers", "cumulative", "n"), ("reported_cases_pct", "migrant_workers", "cumulative", "q"), ("reported_cases_count", "migrant_workers_male", "cumulative", "m"), ("reported_cases_pct", "migrant_workers_male", "cumulative", "p"), ("reported_cases_count", "migrant_workers_female", "cumulative", "k"), ("reported_cases_pct", "migrant_workers_female", "cumulative", "q")]),
    "o22_program_viral_load": ("program_viral_load", "In total, a total of {m} individuals were eligible for viral load testing. Of these eligible individuals, {n} ({p}%) underwent viral load testing, while {k} ({q}%) were not virally suppressed.", [("viral_load_eligible_count", "", "", "m"), ("viral_load_tested_count", "", "", "n"), ("viral_load_tested_pct", "", "", "p"), ("viral_load_not_suppressed_count", "", "", "k"), ("viral_load_not_suppressed_pct", "", "", "q")]),
    "o23_compact_quarterly": ("compact_quarterly", "There were {n} newly reported cases who identified as transgender women; {k} ({p}%) were 15 - 24 years old, {m} ({q}%) were 25 - 34 years old. Another {m} cases ({p}%) have an unknown mode of transmission.", [("new_cases_count", "tgw", "", "n"), ("new_cases_count", "tgw_15_24", "", "k"), ("new_cases_pct", "tgw_15_24", "", "p"), ("new_cases_count", "tgw_25_34", "", "m"), ("new_cases_pct", "tgw_25_34", "", "q"), ("unknown_mot_count", "", "cumulative", "m"), ("unknown_mot_pct", "", "cumulative", "p")]),
    "o24_viral_load_summary": ("viral_load_summary", "So far {n} ({p}%) PLHIV have been tested for viral load. Among those tested for VL, {m} ({q}%) are virally suppressed.", [("viral_load_tested_count", "", "", "n"), ("viral_load_tested_pct", "", "", "p"), ("viral_load_suppressed_count", "", "", "m"), ("viral_load_suppressed_pct", "", "", "q")]),
    "o25_transactional_sex": ("transactional_sex", "In May, {n} ({p}%) of the newly diagnosed engaged in transactional sex.", [("new_cases_count", "transactional_sex", "", "n"), ("new_cases_pct", "transactional_sex", "", "p")]),
    "o26_regimens": ("art_regimens", "Most, {n} ({p}%) were on a first-line regimen, {m} ({q}%) were on a second-line regimen and {k} ({q}%) were on salvage therapy.", [("first_line_regimen_count", "", "", "n"), ("first_line_regimen_pct", "", "", "p"), ("second_line_regimen_count", "", "", "m"), ("second_line_regimen_pct", "", "", "q"), ("salvage_regimen_count", "", "", "k"), ("salvage_regimen_pct", "", "", "q")]),
    "o27_pregnant_reported": ("pregnant_reported", "Since 2011, a total of {n} diagnosed women were reported pregnant at the time of diagnosis.", [("pregnant_women_reported_count", "pregnant_women", "cumulative", "n")]),
    "o29_national_transmission": ("national_transmission", "Of the {m} reported cases, {n} ({p}%) were acquired through sexual contact.", [("sexual_contact_cases_count", "", "", "n"), ("sexual_contact_cases_pct", "", "", "p")]),
    "o30_art_losses": ("art_losses", "This includes {n} individuals who were lost to follow-up, {k} who refused to continue ART, and three who reported migrating overseas.", [("lost_to_follow_up_count", "", "", "n"), ("refused_art_count", "", "", "k"), ("migrated_overseas_count", "", "", "3")]),
    "o31_art_status": ("art_current_status", "Among the {m} people living with HIV ever enrolled, a total of {n} individuals in care were alive on ART. As of May, {k} individuals ({q}%) who were previously on ART were no longer receiving treatment. In all {p}% of the PLHIV on ART are concentrated in the Greater Manila Area.", [("ever_enrolled_art_count", "", "", "m"), ("alive_on_art_count", "", "", "n"), ("not_on_treatment_count", "", "", "k"), ("not_on_treatment_pct", "", "", "q"), ("gmm_art_share_pct", "", "", "p")]),
    "o32_advanced_disease": ("advanced_disease", "Among the total reported cases, {n} ({p}%) were diagnosed with Advanced HIV disease; data were unavailable for the remaining {m} ({q}%) cases.", [("advanced_hiv_disease_count", "", "", "n"), ("advanced_hiv_disease_pct", "", "", "p"), ("missing_immunologic_clinical_data_count", "", "", "m"), ("missing_immunologic_clinical_data_pct", "", "", "q")]),
    "o33_quarter_modes": ("quarter_new_cases_by_mode", "In the first quarter of 2024, {n} ({p}%) newly reported cases had acquired HIV through sexual contact: {m} through male-male sex, {k} male - male / female.", [("new_cases_sexual_contact_count", "", "", "n"), ("new_cases_sexual_contact_pct", "", "", "p"), ("new_cases_male_male_sex_count", "", "", "m"), ("new_cases_male_male_female_sex_count", "", "", "k")]),
    "o34_epidemic_history": ("epidemic_history", "Since then, there have been {n} confirmed HIV cases reported to the HARP. {p}% ({m}) of those diagnosed were male, {q}% ({k}) were female.", [("reported_cases_count", "", "cumulative", "n"), ("reported_cases_count", "male", "cumulative", "m"), ("reported_cases_pct", "male", "cumulative", "p"), ("reported_cases_count", "female", "cumulative", "k"), ("reported_cases_pct", "female", "cumulative", "q")]),
}


def _said(name: str, oracle_rows: list[tuple[str, str, str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT claim_id, '{m}' AS metric, '{g}' AS subgroup, '{s}' AS scope, ({x})::DOUBLE AS value FROM nums" for m, g, s, x in oracle_rows)


def _claims(spark, d, form):
    return numbers_.claims(spark, d, form).withColumn("page_index", F.lit(0)).withColumn("snippet", F.lit(""))


def _topic(name):
    return tuple(m for m in bulletins.BULLETINS if m.name == name)


def _observed(spark, d, mapper, form):
    return mappers.narrative(_claims(spark, d, form), _topic(mapper)).select("claim_id", "metric", "unit", "subgroup", "scope", "value")


def _register(name, mapper, form, rows):
    def run(spark, d):
        return _observed(spark, d, mapper, form).drop("unit")

    run.__name__ = name
    query(_said(name, rows), numbers_.NUMS)(run)


for _name, (_mapper, _form, _rows) in FORMS.items():
    _register(_name, _mapper, _form, _rows)


@query(_said("o16", [("reported_deaths_count", "", "month", "n"), ("reported_deaths_count", "male", "month", "m"), ("reported_deaths_pct", "male", "month", "p"), ("reported_deaths_count", "female", "month", "k")]) + " UNION ALL SELECT claim_id, 'reported_deaths_pct', 'female', 'month', round(k / n::DOUBLE * 100, 1) FROM nums WHERE k <= n", numbers_.NUMS)
def o16_monthly_deaths(spark, d):
    """Female deaths come without a share; it follows from the total."""
    return _observed(spark, d, "monthly_deaths", "In May 2019, there were {n} reported deaths due to any cause. Of these {p}% ({m}) were male while {k} were female.").drop("unit")


@query(_said("o14", [("diagnosed_plhiv_pct", "", "", "p"), ("plhiv_on_art_count", "", "", "m")]) + " UNION ALL SELECT claim_id, 'diagnosed_plhiv_count', '', '', n::DOUBLE FROM nums WHERE n >= m AND NOT (claim_id % 2 = 0 AND p >= 50 AND n < 50000)", numbers_.NUMS)
def o14_diagnosed(spark, d):
    """Counts of diagnosed below those on treatment, or in late years small ones beside large shares, are misread."""
    made = _claims(spark, d, "Of the estimated PLHIV, {n} ({p}%) PLHIV have been diagnosed. Further, {m} PLHIV are currently on life-saving ART.").withColumn("year", F.when(F.col("claim_id") % 2 == 0, 2024).otherwise(2016))
    return mappers.narrative(made, _topic("national_diagnosed")).select("claim_id", "metric", "subgroup", "scope", "value")


@query(_said("o28", [("tgw_diagnosed_count", "tgw", "", "m"), ("sexual_contact_cases_pct", "tgw", "", "p"), ("needle_transmission_count", "tgw", "", "2"), ("missing_mot_count", "tgw", "", "k"), ("missing_mot_pct", "tgw", "", "q")]) + " UNION ALL SELECT claim_id, 'sexual_contact_cases_count', 'tgw', '', n::DOUBLE FROM nums WHERE n <= m AND NOT (p >= 80 AND n * 2 < m)", numbers_.NUMS)
def o28_tgw_transmission(spark, d):
    return _observed(spark, d, "tgw_transmission", "Of the {m} TGW diagnosed, {n} ({p}%) acquired HIV through sexual contact, two through sharing of infected needles, and {k} ({q}%) had no data on MOT.").drop("unit")


_MODE_SHARES = " UNION ALL ".join(f"SELECT claim_id, '{mode}_pct', '', '', round({x} / n::DOUBLE * 100, 1) FROM nums WHERE {x} <= n" for mode, x in (("male_male_sex_cases", "m"), ("male_male_female_sex_cases", "k")))


@query(_said("o35", [("sexual_contact_cases_count", "", "", "n"), ("sexual_contact_cases_pct", "", "", "p"), ("male_male_sex_cases_count", "", "", "m"), ("male_male_female_sex_cases_count", "", "", "k")]) + " UNION ALL " + _MODE_SHARES, numbers_.NUMS)
def o35_transmission_breakdown(spark, d):
    """Modes without a share get theirs of all sexual contacts."""
    return _observed(spark, d, "transmission_breakdown", "In all {p}% ({n}) acquired HIV through sexual contact: homosexual ({m}), bisexual ({k}).").drop("unit")


#: Further wordings, near misses and contradictions: what they say, and what must come of it: metric, region, subgroup, scope, number.
_P = "Philippines"
MORE = [
    ("All of the newly reported TGW (n={n}) in this quarter were alive.", [("alive_count", _P, "tgw", "", "n"), ("alive_pct", _P, "tgw", "", "100")]),
    ("Among reported pregnant women, with {p}% ({m}) virally suppressed.", [("viral_load_suppressed_count", _P, "pregnant_women", "", "m"), ("viral_load_suppressed_pct", _P, "pregnant_women", "", "p")]),
    ("The others were through blood transfusion ({k}), needle prick injury ({q}) and mother-to-child transmission ({p}).", [("blood_transmission_count", _P, "", "", "k"), ("needle_prick_injury_transmission_count", _P, "", "", "q"), ("mother_to_child_transmission_count", _P, "", "", "p")]),
    ("From January 1984 to May 2019, {p}% ({n}) were infected through sexual contact and blood transfusion ({k}).", [("sexual_contact_cases_count", _P, "", "cumulative", "n"), ("sexual_contact_cases_pct", _P, "", "cumulative", "p")]),
    ("There were {n} OFWs since 1984, comprising 7% of all cases.", [("reported_cases_count", _P, "migrant_workers", "cumulative", "n"), ("reported_cases_pct", _P, "migrant_workers", "cumulative", "7")]),
    ("In May, {n} OFWs were reported; {p}% were male and {q}% were female.", [("reported_cases_count", _P, "migrant_workers", "", "n"), *((f"reported_cases_{w}", _P, f"migrant_workers_{g}", "", x) for g, v in (("male", "p"), ("female", "q")) for w, x in (("pct", v), ("count", f"round(n * {v} / 100.0)")))]),
    ("There were 300 (60%) PLHIV who died.", []),
    ("So far {n} ({p}%) PLHIV have been tested for viral load.", [("viral_load_tested_count", _P, "", "", "n"), ("viral_load_tested_pct", _P, "", "", "p")]),
    ("The regions with the most number of newly diagnosed cases were: NCR with {n} ({p}%) cases, Region IV-A with {m} ({q}%), and CAR ({q}%, {k}).", [(f"new_cases_{w}", r, "", "", x) for r, c, s in (("NCR", "n", "p"), ("4A", "m", "q"), ("CAR", "k", "q")) for w, x in (("count", c), ("pct", s))]),
    ("Since 1984, the top five regions were Region XI with {n} cases and BARMM with {m} cases.", [("reported_cases_count", "11", "", "cumulative", "n"), ("reported_cases_count", "BARMM", "", "cumulative", "m")]),
    ("By age group, {n} ({p}%) were 15-24 years old, ({m} or {q}%) belonged to the 25-34 year age group, and {k} cases were children less than 10 years old.", [("reported_cases_count", _P, "age_15_24", "", "n"), ("reported_cases_pct", _P, "age_15_24", "", "p"), ("reported_cases_count", _P, "age_25_34", "", "m"), ("reported_cases_pct", _P, "age_25_34", "", "q"), ("reported_cases_count", _P, "age_lt_10", "", "k")]),
    ("Newly reported: {n} ({p}%) adolescents aged 10-19 years old, {m} ({q}%) were aged 50 years and older, and {k} ({q}%) were aged < 15 years old.", [(f"new_cases_{w}", _P, g, "", x) for g, c, s in (("age_10_19", "n", "p"), ("age_50_plus", "m", "q"), ("age_lt_15", "k", "q")) for w, x in (("count", c), ("pct", s))]),
    ("Of the 50 TGW diagnosed, 70 (90%) acquired HIV through sexual contact.", [("tgw_diagnosed_count", _P, "tgw", "", "50"), ("sexual_contact_cases_pct", _P, "tgw", "", "90")]),
    ("In May 2019, there were {n} reported deaths. Since 2011, a total of {m} diagnosed women were reported pregnant at the time of diagnosis.", [("reported_deaths_count", _P, "", "month", "n"), ("pregnant_women_reported_count", _P, "pregnant_women", "cumulative", "m")]),
    ("Most ({p}%) of the cases were infected through sexual contact; male-male sex was common ({n} or {q}%) and {m} had sex with both males and females.", [("sexual_contact_cases_pct", _P, "", "", "p"), ("male_male_sex_cases_count", _P, "", "", "n"), ("male_male_sex_cases_pct", _P, "", "", "q"), ("male_male_female_sex_cases_count", _P, "", "", "m")]),
]

_ALL = [(form, [(m, _P, g, s, x) for m, g, s, x in rows]) for _, form, rows in FORMS.values()] + MORE
_KINDS = ("surveillance_report", "situational_report", "guideline_policy")


def _told(k: int, rows) -> list[str]:
    return [f"SELECT claim_id, '{m}' AS metric, '{r}' AS region, '{g}' AS subgroup, '{s}' AS scope, ({x})::DOUBLE AS value FROM nums WHERE claim_id % {len(_ALL)} = {k} AND claim_id // {len(_ALL)} % 3 < 2" for m, r, g, s, x in rows]


@query(" UNION ALL ".join(x for k, (_, rows) in enumerate(_ALL) for x in _told(k, rows)), numbers_.NUMS)
def o10_narrative(spark, d):
    """Claims of every wording in one table through the whole dispatcher; those of guidelines say nothing."""
    n = numbers_.nums(spark, d)
    text = F.element_at(F.array(*[numbers_.said(form) for form, _ in _ALL]), (F.col("claim_id") % len(_ALL) + 1).cast("int"))
    kind = F.element_at(F.array(*map(F.lit, _KINDS)), (F.floor(F.col("claim_id") / len(_ALL)) % 3 + 1).cast("int"))
    made = n.select("claim_id", text.alias("claim_text"), kind.alias("document_type"), *[F.lit(v).alias(c) for c, v in (("filename", "hiv_sti_2024_q2.pdf"), ("page_index", 0), ("category", "Narrative Statistic"), ("row_label", ""), ("raw_value", ""), ("snippet", ""), ("region", "Unknown"), ("year", 2016), ("metric_type", "general"), ("period_granularity", "quarter"), ("period_label", "2024 Q2"))])
    return tables.observations(made).select("claim_id", "metric", "region", "subgroup", "scope", "value")
