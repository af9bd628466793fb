"""Narrative topics of surveillance bulletins, in the order that settles which one speaks for a claim.

Rules say how bulletins word a count and a share (see :mod:`mappers`); what follows from several numbers
together - shares from counts, counts that contradict their total - is a step of the topic on its rows.
"""

from __future__ import annotations

from .mappers import Mapper, Rule, counts_of, drop_if, shares_of, value_of

# How a number, a number or number word, and a share are written.
_N, _W, _P = r"(\d[\d,]*)", r"([A-Za-z]+|\d[\d,]*)", r"(<?\d+(?:\.\d+)?)%"
_NP, _PN = rf"{_N}\s*\({_P}[^)]*\)", rf"{_P}\s*\({_N}\)"
#: A stretch inside a sentence.
_GAP = r"[^.]*?"
_NEEDLES, _MOTHER = r"sharing of (?:infected )?needles", r"mother[ -]to[ -]child transmission"


def _rule(metric: str, *patterns: str | tuple, count: int = 1, share: int = 0, subgroup: str = "", scope: str = "", minus: bool = False) -> Rule:
    return Rule(metric, tuple((f"(?i){p[0]}", *p[1:]) if isinstance(p, tuple) else f"(?i){p}" for p in patterns), count, share, subgroup, scope, minus=minus)


def _cohort(name: str, markers: tuple[str, ...], group: str) -> Mapper:
    of = lambda metric, *patterns: _rule(metric, *patterns, share=2, subgroup=group)
    return Mapper(name, markers, (
        of("alive", (rf"\ball {_GAP}\(n=\s*{_N}\){_GAP} were alive", 1, "100"), rf"{_NP}\s*were (?:currently )?alive"), of("initiated_on_art", rf"of these,\s*{_NP}\s*were initiated {_GAP}ART"), of("retained_on_art", rf"only\s*{_NP}{_GAP}were retained on ART"),
        of("viral_load_tested", rf"only\s*{_NP}\s*(?:underwent|were tested for)\s+viral load"),
        of("viral_load_suppressed", rf"(?:whom|with)\s*{_NP}\s*(?:were )?(?:virally|viral load) suppress", (rf"with\s*{_PN}\s*(?:were )?(?:virally|viral load) suppress", 2, 1)),
    ))


_OFW = (" ofw", "ofws", "overseas filipino workers", "worked overseas", "migrant workers")
_AGES = {
    "age_lt_10": r"children[^.;\d]*10 years", "age_10_19": r"adolescents?[^.;\d]*10-19", "age_lt_15": r"(?:<|less than|under)\s*15", "age_15_24": "15-24", "age_25_34": "25-34", "age_35_49": "35-49",
    "age_50_plus": r"50 years[^.;\d]*(?:above|older)",
}


def _age(group: str, words: str) -> Rule:
    near = r"[^.;\d]{0,40}?"
    return _rule("{base}", rf"\({_N}\s*or\s*{_P}\){near}{words}", rf"{_NP}{near}{words}", (rf"{_N}\s+(?:cases|were|belong|children|adolescents|youth|aged){near}{words}", 1, 0), share=2, subgroup=group, scope="{since}")


_OR = rf"\({_N}\s*or\s*{_P}\)"
# How bulletins name the modes: metric, in brackets, in short, at length.
_MODES = (
    ("male_male_sex_cases", "homosexual", r"(?:reported transmission through male to male|male-male) sex", "male to male sex"),
    ("male_male_female_sex_cases", "bisexual", r"(?:had )?sex with both males?\s*(?:and|&)\s*females?", "males who have sex with both males and females"),
    ("male_female_sex_cases", "heterosexual", r"(?:through male to female|male-female) sex", "male to female sex"),
)


def _either(words: str) -> tuple[tuple, ...]:
    """A mode with its count and share in brackets after it, or before it."""
    return (rf"{words}\s*\({_P}\s*,\s*{_N}\)", 2, 1), (rf"{_PN}\s*through {words}", 2, 1), (rf"{words}\s*\({_W}\)", 1, 0), (rf"{words}\s*{_OR}", 1, 2)


#: Topics, their markers (lower case) and wordings.
_TOPICS = (
    _cohort("cohort_pregnant", ("pregnant women", "reported pregnant"), "pregnant_women"),
    _cohort("cohort_tgw", ("tgw", "transgender women"), "tgw"),
    Mapper("national_art_headline", ("plhiv are currently on life", "diagnosed plhiv on treatment", "treatment coverage", "plhiv have been tested", "plhiv on art"), (
        _rule("plhiv_on_art", rf"{_NP}\s*PLHIV are currently on {_GAP}ART", share=2),
        _rule("plhiv_on_art", rf"since 2002,\s*a total of\s*{_N}\s*PLHIV{_GAP}alive on ART"),
        _rule("viral_load_tested", rf"of which,?\s*{_NP}\s*PLHIV have been tested for viral load", share=2),
        _rule("suppression_among_on_art", rf"only\s*{_P}\s*were virally suppressed among plhiv on art", count=0, share=1),
    ), True),
    Mapper("historical_art", ("presently on art", "presently on anti-retroviral therapy", "presently on antiretroviral therapy"), (
        _rule("plhiv_on_art", rf"a total of\s*{_N}\*?\s*(?:people living with hiv\s*\(plhiv\)\s*)?were\s*presently\s*on\s*art", rf"there (?:are|were)\s*{_N}\*?\s*(?:people living with hiv\s*\(plhiv\)\s*)?presently on\s*(?:anti[- ]?retroviral therapy|art)"),
    )),
    Mapper("national_diagnosed", ("estimated plhiv", "plhiv have been diagnosed"), (_rule("diagnosed_plhiv", rf"{_NP}\s*(?:cases|PLHIV)\s*have been diagnosed", share=2), _rule("plhiv_on_art", rf"Further,?\s*{_N}\s*PLHIV are currently on {_GAP}ART")), after=(
        drop_if("diagnosed_plhiv_count", lambda a: f"{value_of(a, 'diagnosed_plhiv_count')} < {value_of(a, 'plhiv_on_art_count')} or (year >= 2020 and {value_of(a, 'diagnosed_plhiv_pct')} >= 50 and {value_of(a, 'diagnosed_plhiv_count')} < 50000)"),
    )),
    Mapper("monthly_new_cases_compared", ("newly diagnosed hiv cases", "new hiv"), (
        _rule("new_cases", rf"(?:In|For the month of)\s+[A-Z][a-z]+\s+\d{{4}},\s+there (?:were|was)\s*{_N}\s*(?:newly diagnosed HIV cases|new HIV)", scope="month"),
        _rule("new_cases_yoy_change", rf"This was\s*{_P}\s*higher\s*compared to the same period last year", count=0, share=1, scope="month"),
        _rule("new_cases_yoy_change", rf"This was\s*{_P}\s*lower\s*compared to the same period last year", count=0, share=1, scope="month", minus=True),
        _rule("new_cases_prior_year_same_month", rf"compared to the same period last year\s*\(n=\s*{_N}", scope="month"),
    )),
    Mapper("monthly_deaths", ("reported deaths",), (
        _rule("reported_deaths", rf"(?:For the month of|In)\s+[A-Z][a-z]+\s+\d{{4}},\s+there (?:were|was)\s*{_N}\*?\s*reported deaths", scope="month"),
        _rule("reported_deaths", rf"{_PN}\s*were male", count=2, share=1, subgroup="male", scope="month"), _rule("reported_deaths", rf"were male while\s*{_N}\s*were female", subgroup="female", scope="month"),
    ), after=(shares_of("reported_deaths", ("reported_deaths",), ("male", "female")),)),
    Mapper("cumulative_deaths", ("deaths were reported from january 1984",), (_rule("reported_deaths", rf"a total of\s*{_N}\s*deaths were reported from January 1984 to", scope="cumulative"),)),
    Mapper("transmission_summary", ("sexual contact", "sharing of needles", "blood transfusion", "mother-to-child"), (
        _rule("sexual_contact_cases", rf"{_PN}\s*were (?:infected|acquired hiv) through sexual contact", count=2, share=1, scope="{since}"), _rule("needle_transmission", rf"{_PN}\s*through {_NEEDLES}", count=2, share=1, scope="{since}"),
        _rule("blood_transmission", rf"{_PN}\s*through blood", count=2, share=1, scope="{since}"), _rule("mother_to_child_transmission", rf"{_PN}\s*through {_MOTHER}", count=2, share=1, scope="{since}"),
    ), fallback=tuple(_rule(m, rf"{words}\s*\({_N}\)", scope="{since}") for m, words in (("blood_transmission", "blood transfusion"), ("needle_prick_injury_transmission", "needle prick injury"), ("mother_to_child_transmission", _MOTHER)))),
    Mapper("migrant_workers_split", _OFW, (
        _rule(
            "{cases}", rf"cases,\s*{_NP}\s*were\s*hiv[- ]positive\s+ofws", rf"{_N}\s*(?:hiv[- ]positive\s+)?ofws?\s+since\s+1984,\s*comprising\s*{_P}", rf"{_N}\)?\s*ofws were reported{_GAP}comprising\s*{_P}", rf"{_N}\)?\s*filipinos who worked overseas{_GAP}comprised\s*{_P}",
            rf"since\s+1984,\s*(?:a total of\s*)?{_NP}\s*(?:of diagnosed cases have been )?migrant workers", (rf"{_N}\s*(?:hiv[- ]positive\s+)?ofws?\s+since\s+1984", 1, 0), (rf"{_N}\)?\s*ofws were reported", 1, 0), (rf"{_N}\)?\s*filipinos who worked overseas{_GAP}were newly reported", 1, 0),
            (rf"since\s+1984,\s*a total of\s*{_N}\s*migrant workers", 1, 0), share=2, subgroup="migrant_workers", scope="{since}",
        ),
        *(_rule("{cases}", rf"{_NP}\s*were {sex}s?", (rf"{_P}\s*were {sex}s?", 0, 1), share=2, subgroup=f"migrant_workers_{sex}", scope="{since}") for sex in ("male", "female")),
    ), after=(counts_of("migrant_workers", ("migrant_workers_male", "migrant_workers_female")),)),
    Mapper("program_viral_load", ("eligible for viral load testing",), (
        _rule("viral_load_eligible", rf"a total of\s*{_N}\s*individuals{_GAP}eligible for viral load testing"), _rule("viral_load_tested", rf"Of these eligible individuals,?\s*{_N}{_GAP}\({_P}\)\s*(?:PLHIV )?(?:underwent|were tested for)\s+viral load", share=2),
        _rule("viral_load_not_suppressed", rf"while\s*{_NP}\s*were not virally suppressed", share=2),
    )),
    Mapper("compact_quarterly", ("15 - 24 years old", "pregnant at the time of diagnosis", "engaged in transactional sex", "unknown mode of transmission", "needlestick injuries", "reported sharing of infected needles"), (
        _rule("new_cases", rf"there were\s*{_N}\s*newly reported cases who identified as transgender women", subgroup="tgw"), _rule("new_cases", rf"{_W}\s*\({_P}\)\s*were\s*15\s*-\s*24\s*years old", share=2, subgroup="tgw_15_24"),
        _rule("new_cases", rf"{_W}\s*\({_P}\)\s*were\s*25\s*-\s*34\s*years old", share=2, subgroup="tgw_25_34"), _rule("new_cases", rf"{_W}\s*\({_P}\)\s*were\s*35\s*-\s*49\s*years old", share=2, subgroup="tgw_35_49"),
        _rule("new_cases", rf"{_W}\s*\({_P}\)\s*were\s*50\s*years and older", share=2, subgroup="tgw_50_plus"),
        _rule("pregnant_women_reported", rf"there were\s*{_N}\s*hiv[- ]positive women{_GAP}pregnant at the time of diagnosis", subgroup="pregnant_women"),
        _rule("pregnant_women_reported_yoy_change", rf"this was an?\s*{_P}\s*increase compared to the same reporting period last year", count=0, share=1, subgroup="pregnant_women"),
        _rule("reported_cases", rf"engaged in transactional sex[^(]*\(n=\s*{_N}\)", subgroup="transactional_sex", scope="recent_window"), _rule("needle_transmission", rf"{_NP}\s*reported sharing of infected needles", share=2),
        _rule("unknown_mot", rf"{_N}\s*cases\s*\({_P}\)\s*have an unknown mode of transmission", share=2, scope="cumulative"), _rule("blood_and_needlestick_transmission", rf"reported in\s*{_N}\s*cases\s*\({_P}\)", share=2, scope="cumulative"),
    )),
    Mapper("viral_load_summary", ("virally suppressed", "tested for viral load"), (
        _rule("viral_load_tested", rf"{_NP}\s*PLHIV have been tested for viral load", share=2), _rule("viral_load_tested", rf"(?<!\d )\({_P}\)\s*PLHIV have been tested for viral load", count=0, share=1),
        _rule("viral_load_suppressed", rf"Among those tested for VL,?\s*{_NP}\s*(?:are|were)\s*virally suppressed", share=2),
    ), True),
    Mapper("transactional_sex", ("engaged in transactional sex",), (_rule("new_cases", rf"{_NP}\s*of the newly diagnosed engaged in transactional sex", share=2, subgroup="transactional_sex"),)),
    Mapper("art_regimens", ("first-line regimen",), tuple(_rule(m, rf"{_NP}\s*were on (?:a )?{w}", share=2) for m, w in (("first_line_regimen", "first-line regimen"), ("second_line_regimen", "second-line regimen"), ("salvage_regimen", "salvage therapy")))),
    Mapper("pregnant_reported", ("reported pregnant at the time of diagnosis",), (_rule("pregnant_women_reported", rf"total of\s*{_N}\s*diagnosed women were reported pregnant at the time of diagnosis", subgroup="pregnant_women", scope="cumulative"),)),
    Mapper("tgw_transmission", ("tgw diagnosed",), (
        _rule("tgw_diagnosed", rf"Of the\s*{_N}\s*TGW diagnosed", subgroup="tgw"), _rule("sexual_contact_cases", rf"{_NP}\s*acquired HIV through sexual contact", share=2, subgroup="tgw"),
        _rule("needle_transmission", rf"{_W}\s*(?:\([^)]*\)\s*)?through sharing of infected needles", subgroup="tgw"), _rule("mother_to_child_transmission", rf"{_W}\s*(?:cases? )?through\s*{_MOTHER}", subgroup="tgw"),
        _rule("missing_mot", rf"{_NP}\s*had no data on MOT", share=2, subgroup="tgw"),
    ), also=("acquired hiv through sexual contact",), after=(
        drop_if("sexual_contact_cases_count", lambda a: f"r.value > {value_of(a, 'tgw_diagnosed_count', 'tgw')} or ({value_of(a, 'sexual_contact_cases_pct', 'tgw')} >= 80 and r.value * 2 < {value_of(a, 'tgw_diagnosed_count', 'tgw')})"),
    )),
    Mapper("national_transmission", ("acquired through sexual contact",), (_rule("sexual_contact_cases", rf"reported cases,?\s*{_NP}\s*were acquired through sexual contact", share=2),)),
    Mapper("art_losses", ("lost to follow-up",), (
        _rule("lost_to_follow_up", rf"includes\s*{_N}\s*individuals who were lost to follow-up"), _rule("refused_art", rf"{_W}\s*who refused to continue ART"), _rule("migrated_overseas", rf"{_W}\s*who reported migrat(?:ing|ed) overseas"),
    )),
    Mapper("art_current_status", ("alive on art", "no longer receiving treatment", "concentrated in the greater manila area"), (
        _rule("ever_enrolled_art", rf"Among the\s*{_N}\s*people living with HIV"), _rule("alive_on_art", rf"a total of\s*{_N}\s*individuals {_GAP}were alive on ART"),
        _rule("not_on_treatment", rf"{_N}\s*individuals?\s*\({_P}\)\s*who were previously on ART were no longer receiving treatment", share=2), _rule("gmm_art_share", rf"{_P}\s*of the PLHIV on ART are concentrated in the Greater Manila Area", count=0, share=1),
    )),
    Mapper("advanced_disease", ("advanced hiv disease", "unavailable for the remaining"), (
        _rule("advanced_hiv_disease", rf"Among the total reported cases,?\s*{_NP}\s*were diagnosed with Advanced HIV disease", share=2), _rule("missing_immunologic_clinical_data", rf"unavailable for the remaining\s*{_NP}\s*cases", share=2),
    )),
    Mapper("quarter_new_cases_by_mode", ("newly reported cases had acquired hiv through sexual contact",), (
        _rule("new_cases_sexual_contact", rf"{_NP}\s*newly reported cases had acquired HIV through sexual contact", share=2), _rule("new_cases_male_male_sex", rf"{_N}\s*through male-male sex"),
        _rule("new_cases_male_male_female_sex", rf"{_N}\s*male\s*-\s*male\s*/\s*female"), _rule("new_cases_male_female_sex", rf"{_N}\s*male\s*-\s*female sex"),
    )),
    Mapper("epidemic_history", ("since then, there have been", "from january 1984 to", "of those diagnosed were male"), (
        _rule("reported_cases", rf"since then, there have been\s*{_N}\s*(?:confirmed\s*)?hiv cases reported to the harp", rf"from january 1984 to[^,.]*,\s*there (?:has been|were)\s*{_N}\s*(?:confirmed\s*)?hiv", scope="cumulative"),
        _rule("reported_cases", rf"{_PN}\s*of those diagnosed were male", count=2, share=1, subgroup="male", scope="cumulative"), _rule("reported_cases", rf"{_PN}\s*were female", count=2, share=1, subgroup="female", scope="cumulative"),
        _rule("reported_cases", rf"{_PN}\s*out of the total\s*\([\d,]+\)\s*diagnosed cases were among msm", count=2, share=1, subgroup="msm", scope="cumulative"),
    )),
    Mapper("transmission_breakdown", ("homosexual", "bisexual", "heterosexual", "male-male sex", "male to male sex", "male-female sex", "predominant mode of transmission"), (
        _rule("sexual_contact_cases", rf"{_PN}\s*(?:were infected|acquired the infection|acquired hiv) through\s*sexual contact", rf"predominant mode of transmission\s*\({_P}\s*,\s*{_N}\)", (rf"most\s*\({_P}\) of the cases were infected through sexual contact", 0, 1), (rf"sexual contact\s*{_OR}", 1, 2), count=2, share=1),
        *(_rule(metric, (rf"{_PN}\s*(?:were |reported )?(?:transmission )?through {long}", 2, 1), (rf"\b{short}(?: contact)?\s*\({_W}\)", 1, 0), (rf"{_W}\s*{near}", 1, 0), (rf"{near}[^.;\d]*{_OR}", 1, 2)) for metric, short, near, long in _MODES),
        _rule("needle_transmission", *_either(_NEEDLES)), _rule("mother_to_child_transmission", *_either(_MOTHER), (rf"{_W}\s*(?:were )?(?:acquired )?through\s*{_MOTHER}", 1, 0)),
    ), after=(shares_of("sexual_contact_cases", ("male_male_sex_cases", "male_male_female_sex_cases", "male_female_sex_cases", "needle_transmission", "mother_to_child_transmission")),)),
    Mapper("regional_mentions", ("top five regions", "most number of reported cases", "most number of newly diagnosed cases", "most number of newly reported cases", "were from the national capital region", "most number of overseas filipino workers")),
    Mapper("age_groups", ("age group", "years old", "youth aged 15-24", "children less than 10", "adolescents aged 10-19", "50 years old and above"), tuple(_age(group, words) for group, words in _AGES.items())),
)
#: Which topic speaks first.
_ORDER = """cohort_pregnant cohort_tgw historical_art national_diagnosed national_art_headline viral_load_summary program_viral_load compact_quarterly transactional_sex art_regimens pregnant_reported tgw_transmission
national_transmission art_losses art_current_status advanced_disease epidemic_history quarter_new_cases_by_mode transmission_breakdown regional_mentions age_groups migrant_workers_split monthly_new_cases_compared monthly_deaths cumulative_deaths transmission_summary""".split()
BULLETINS = tuple(sorted(_TOPICS, key=lambda m: _ORDER.index(m.name)))
