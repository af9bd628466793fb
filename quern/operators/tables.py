"""Table rows to observations by layouts: what the cells of a row are, in order, says what they mean.

Each token of a row is a count (c), a share (p) or a region (r); a row is a word of these letters, and a Layout
is a pattern of such words with the meaning of each place. All layouts of a family compile to one expression,
so a row is read once, in place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers, periods
from ..functions.numbers import let
from ..functions.text import evidence
from . import classify, extract, mappers
from .bulletins import BULLETINS

# Categories and how they are read, codes of regions, labels of transmission tables.
NARRATIVE = ("Quantitative Narrative", "Narrative Statistic", "general")
REPORTS = ("surveillance_report", "situational_report")
CODES = "NCR NIR CAR CARAGA BARMM ARMM".split()
TRANSMISSION = {
    "mother-to-child": "mother_to_child_transmission", "needle prick injury": "needle_prick_injury_transmission", "injecting drug use": "needle_transmission", "blood/blood products": "blood_transmission", "sexual contact": "sexual_contact_cases",
    "homosexual contact": "male_male_sex_cases", "bisexual contact": "bisexual_contact_cases", "heterosexual contact": "male_female_sex_cases", "heterosexual contact - female": "male_female_sex_cases",
}
RESIDENCE_FILE = "hiv_sti_2024_april_june.pdf"
DEAD_FIRST_FILE = "hiv_sti_2025_q4.pdf"
GROWTH_MARK = "Percent increase between December 2020"


@dataclass(frozen=True)
class Layout:
    """``kinds``: a pattern over letters c, p, r; ``cells``: (place, metric, unit, scope); ``region``: the place that names the region, -1 for the row's own."""

    kinds: str
    cells: tuple[tuple[int, str, str, str], ...]
    region: int = -1


def _in_order(*metrics: str, scope: str = "snapshot") -> tuple[tuple[int, str, str, str], ...]:
    return tuple((k, m, "percent" if m.endswith("_pct") else "count", scope) for k, m in enumerate(metrics))


def _pairs(first: int, metric: str, *scopes: str) -> tuple[tuple[int, str, str, str], ...]:
    return tuple((first + 2 * k + j, f"{metric}_{w}", u, s) for k, s in enumerate(scopes) for j, (w, u) in enumerate((("count", "count"), ("pct", "percent"))))


_WINDOWS = ("year_to_date", "recent_window", "cumulative")
VIRAL_LOAD = (Layout("(?=(c*p){2}c*$)[cp]{5}", _in_order("alive_on_art_count", "viral_load_tested_count", "viral_load_tested_pct", "viral_load_suppressed_count", "viral_load_suppressed_pct")),)
_LOSSES = ("migrated_overseas_count", "refused_art_count", "ever_enrolled_art_count", "lost_to_follow_up_pct")
OUTCOME = (Layout("(?=c*pc*$)[cp]{7}", _in_order("alive_on_art_count", "lost_to_follow_up_count", "dead_count", *_LOSSES)),)
OUTCOME_DEAD_FIRST = (Layout("(?=c*pc*$)[cp]{7}", _in_order("alive_on_art_count", "dead_count", "lost_to_follow_up_count", *_LOSSES)),)
_PARTIAL = ("alive_on_art_count", "lost_to_follow_up_count", "migrated_overseas_count", "refused_art_count")
PARTIAL = tuple(Layout(f"c{{{n}}}", _in_order(*_PARTIAL[:n])) for n in (2, 3, 4))
PARTIAL_NAMED = tuple(Layout(f"rc{{{n}}}", tuple((k + 1, m, "count", "snapshot") for k, m in enumerate(_PARTIAL[:n])), 0) for n in (2, 3, 4))
RESIDENCE = (Layout("cp", _pairs(0, "new_cases", "snapshot")), Layout("cpcpcp", _pairs(0, "reported_cases", *_WINDOWS)), Layout("cr(cp){3}.*", _pairs(2, "reported_cases", *_WINDOWS), 1))
#: The two panels of a row with two regions are read one after the other.
RESIDENCE_TWO = (Layout("cpr(cp){3}.*", _pairs(0, "new_cases", "snapshot")), Layout("cpr(cp){3}.*", _pairs(3, "reported_cases", *_WINDOWS), 2))
LEGACY = (Layout("cpcp.*", _pairs(0, "", "month", "cumulative")), Layout("ccp.*", ((0, "_count", "count", "month"), (1, "_count", "count", "cumulative"), (2, "_pct", "percent", "cumulative"))), Layout("cc.*", ((0, "_count", "count", "month"), (1, "_count", "count", "cumulative"))))

_ROW = "array<struct<metric: string, unit: string, region: string, subgroup: string, scope: string, value: double>>"


def is_percent(token: Column) -> Column:
    return F.trim(token).rlike(r"^[<>]?\d[\d,]*(?:\.\d+)?%$")


def is_count(token: Column) -> Column:
    return numbers.clean_token(token).isNotNull() & ~is_percent(token)


def three_pairs(tokens: Column) -> Column:
    """Six tokens, count and share by turns."""
    return F.coalesce((F.size(tokens) == 6) & F.forall(F.transform(tokens, lambda t, k: F.when(k % 2 == 0, is_count(t)).otherwise(is_percent(t))), lambda ok: ok), F.lit(False))


def code_of(label: Column) -> Column:
    """Code of a region label: a name, a code, or a number from 1 to 12 with A or B."""
    plain = F.upper(F.trim(F.regexp_replace(label, r"\s+", " ")))
    return F.coalesce(classify.region_code(label), F.when(plain.isin(CODES) | plain.rlike("^(?:[1-9]|1[0-2])[AB]?$"), plain))


def label_and_count(label: Column) -> tuple[Column, Column]:
    """Region code of a row label and the count that a scan left behind it, if any."""
    glued = r"(?i)^\s*(CARAGA|BARMM|NCR|CAR|NIR|[0-9]{1,2}[A-Z]?)\s+(\d[\d,]*)\s*$"
    both = label.rlike(glued)
    return F.when(both, code_of(F.regexp_extract(label, glued, 1))).otherwise(code_of(label)), F.when(both, F.regexp_extract(label, glued, 2))


def row_region(label: Column, claimed: Column) -> Column:
    """The label's code, else the claim's own region where it is known."""
    return F.coalesce(code_of(label), F.when(claimed != "Unknown", F.coalesce(code_of(claimed), claimed)))


def before_value(snippet: Column, token: Column) -> Column:
    """Region code that stands directly before a value in a snippet's cells."""
    cells = F.transform(F.split(snippet, r"\|"), lambda c: F.trim(c))
    at = F.array_position(cells, token).cast("int")
    return code_of(F.regexp_extract(F.get(cells, at - 2), r"(?:^|.*\s)(\S+)$", 1))


def cell_tokens(value: Column) -> Column:
    """Cells of a row: those that name a region as its code, the others as the numbers in them."""
    return F.flatten(F.transform(mappers.split_cells(value), lambda c: F.when(code_of(c).isNotNull() & ~c.rlike(r"^\d+$"), F.array(code_of(c))).otherwise(F.regexp_extract_all(c, F.lit(r"[<>]?\d[\d,]*(?:\.\d+)?%?"), F.lit(0)))))


def kinds(tokens: Column) -> Column:
    return F.array_join(F.transform(tokens, lambda t: F.when(is_percent(t), "p").when(is_count(t), "c").when(code_of(t).isNotNull(), "r").otherwise("x")), "")


def read_tokens(df: DataFrame, name: str, tokens: Column) -> DataFrame:
    """Columns ``name``_t (tokens), ``name``_w (their kinds as a word) and ``name``_n (their numbers), which the layouts look at many times."""
    df = df.withColumn(f"{name}_t", tokens)
    return df.withColumns({f"{name}_w": kinds(F.col(f"{name}_t")), f"{name}_n": F.transform(f"{name}_t", numbers.clean_token)})


def laid_out(layouts: tuple[Layout, ...], name: str, region: Column, every: bool = False, metric: Column | None = None) -> Column:
    """Rows of the first layout (or of all) whose pattern the kinds of the tokens ``name`` match, else an empty array; ``metric`` goes before the layouts' metrics."""
    none, found = F.expr(f"cast(array() as {_ROW})"), []
    for lay in layouts:
        named = lambda m: F.lit(m) if metric is None else F.concat(metric, F.lit(m))
        rows = lambda own, lay=lay: F.array(*[F.struct(named(m).alias("metric"), F.lit(u).alias("unit"), own.alias("region"), F.lit("").alias("subgroup"), F.lit(s).alias("scope"), F.get(f"{name}_n", k).alias("value")) for k, m, u, s in lay.cells])
        found.append(F.when(F.col(f"{name}_w").rlike(f"^(?:{lay.kinds})$"), let(code_of(F.get(f"{name}_t", lay.region)), rows) if lay.region >= 0 else rows(region)))
    return F.flatten(F.array(*[F.coalesce(f, none) for f in found])) if every else F.coalesce(*found, none)


def series(schema: list[str], values: Column, region: Column, subgroup: Column) -> Column:
    """Numbers zipped with the metrics of a schema, as many as there are."""
    names = F.array(*map(F.lit, schema))
    pairs = F.arrays_zip(F.slice(names, 1, F.least(F.size(values), F.lit(len(schema)))).alias("m"), F.slice(values, 1, len(schema)).alias("v"))
    unit = lambda m: F.when(m.rlike("coverage|pct|among|rate|percent"), "percent").otherwise("count")
    rows = F.transform(pairs, lambda p: F.struct(p["m"].alias("metric"), unit(p["m"]).alias("unit"), region.alias("region"), subgroup.alias("subgroup"), F.lit("").alias("scope"), p["v"].alias("value")))
    return F.filter(rows, lambda r: r["value"].isNotNull())


def _with_rest(outcome: Column, own: Column) -> Column:
    """Outcome rows and those not on treatment: ever enrolled less alive, at least none."""
    of = lambda rows, m: F.filter(rows, lambda r: r["metric"] == m)[0]["value"]
    rest = lambda rows: F.struct(F.lit("not_on_treatment_count").alias("metric"), F.lit("count").alias("unit"), own.alias("region"), F.lit("").alias("subgroup"), F.lit("snapshot").alias("scope"), F.greatest(of(rows, "ever_enrolled_art_count") - of(rows, "alive_on_art_count"), F.lit(0.0)).alias("value"))
    return let(outcome, lambda rows: F.when(F.size(rows) > 0, F.concat(rows, F.array(rest(rows)))))


def prepared(claims: DataFrame) -> DataFrame:
    """Claims with what the table mappers look at: __own (the row's region), __named and __glued (its label taken apart), and the tokens of cells, panels and texts."""
    c = claims.withColumns({"__own": row_region(F.col("row_label"), F.col("region")), "__named": label_and_count(F.col("row_label"))[0], "__glued": label_and_count(F.col("row_label"))[1]})
    c = read_tokens(c, "__cell", mappers.split_cells(F.col("raw_value")))
    c = read_tokens(c, "__panel", F.concat(F.when(F.col("__glued").isNotNull(), F.array("__glued")).otherwise(F.expr("cast(array() as array<string>)")), cell_tokens(F.col("raw_value"))))
    said = let(evidence(F.col("claim_text"), F.col("snippet")), lambda t: F.when(t.contains("has values"), F.element_at(F.split(t, "has values"), 2)).otherwise(t))
    return read_tokens(c, "__text", F.regexp_extract_all(said, F.lit(r"<?\d[\d,]*(?:\.\d+)?%?"), F.lit(0)))


def targeted() -> dict[str, Column]:
    """Families of regional tables in order: the rows each reads from prepared claims, null where it doesn't apply."""
    text, file, page, own = F.col("claim_text"), F.lower("filename"), F.col("page_index"), F.col("__own")
    outcome = F.when(file == DEAD_FIRST_FILE, laid_out(OUTCOME_DEAD_FIRST, "__cell", own)).otherwise(laid_out(OUTCOME, "__cell", own))
    partial = F.when(F.col("__cell_w").startswith("r"), laid_out(PARTIAL_NAMED, "__cell", own)).otherwise(let(F.coalesce(own, before_value(F.col("snippet"), F.get("__cell_t", 0))), lambda r: laid_out(PARTIAL, "__cell", r)))
    panels = let(laid_out(RESIDENCE_TWO, "__panel", F.col("__named"), every=True), lambda two: F.when(F.size(two) > 0, two).otherwise(laid_out(RESIDENCE, "__panel", F.col("__named"))))
    return {
        "viral_load": F.when(own.isNotNull() & (F.col("period_granularity") == "quarter"), laid_out(VIRAL_LOAD, "__cell", own)), "outcome": F.when(own.isNotNull() & text.startswith("Treatment Outcome:"), _with_rest(outcome, own)),
        "partial": F.when((file == RESIDENCE_FILE) & (page == 3), F.filter(partial, lambda r: r["region"].isNotNull())), "residence": F.when((file == RESIDENCE_FILE) & (page == 1) & text.startswith("Region Number of %:") & F.col("__named").isNotNull(), panels),
    }


def quick_facts(label: Column, value: Column, region: Column) -> Column:
    names = F.create_map(*[F.lit(x) for k, v in mappers.QUICK_FACTS.items() for x in (k, ":".join(v))])
    cell = lambda name: lambda s: F.struct(name[0].alias("metric"), F.lit("count").alias("unit"), region.alias("region"), name[1].alias("subgroup"), s["scope"].alias("scope"), numbers.dash_is_zero(s["cell"]).cast("double").alias("value"))
    rows = let(F.split(names[F.lower(F.trim(label))], ":"), lambda name: F.when(name.isNotNull(), F.transform(periods.scopes(mappers.split_cells(value)), cell(name))))
    return F.filter(rows, lambda r: r["value"].isNotNull())


def legacy_transmission(label: Column, text: Column, region: Column) -> Column:
    bases = F.create_map(*[F.lit(x) for pair in TRANSMISSION.items() for x in pair])
    base = bases[F.lower(F.trim(label))]
    return F.when(F.lower(text).rlike("mode of hiv transmission|types of sexual transmission") & base.isNotNull(), let(base, lambda b: laid_out(LEGACY, "__text", region, metric=b)))


def observations(claims: DataFrame) -> DataFrame:
    """Observations of normalised claims: the first family that reads a table row speaks for it, narrative claims go to the narrative mappers.

    Narratives speak only in surveillance and situation reports, quick facts only in monthly surveillance reports.

    claims: claim_id, filename, document_type, page_index, category, claim_text, row_label, raw_value, snippet, region, year, metric_type, period_granularity, period_label.
    """
    category, label, region, text, values = (F.col(c) for c in ("category", "row_label", "region", "claim_text", "__cell_n"))
    cascade = lambda r, g: F.when(F.size(values) >= 10, series(mappers.CASCADE, values, r, g)).otherwise(series(mappers.CASCADE_COMPACT, values, r, g))
    none, row = F.lit(""), category == "Structured Table Row"
    families = targeted() | {"facts": F.when((F.col("document_type") == "surveillance_report") & (F.col("period_granularity") == "month"), quick_facts(label, F.col("raw_value"), region)), "transmission": legacy_transmission(label, evidence(text, F.col("snippet")), region)}
    families = {name: F.when(row, rows) for name, rows in families.items()} | {
        "cascade": F.when(category.isin("Care Cascade Age Group", "Care Cascade Key Population"), cascade(region, label)).when(category == "Care Cascade Region", cascade(label, none)),
        "treatment": F.when(category == "Treatment Outcome", series(["alive_on_art", "dead", "lost_to_follow_up", "transferred_overseas", "stopped_treatment", "ever_enrolled_total", "lost_to_follow_up_rate"], values, label, none)),
        "growth": F.when(row & text.contains(GROWTH_MARK), series(["cases_2020", "cases_2025", "percent_increase"], values, region, label)),
    }
    read = prepared(claims.where(~category.isin(*NARRATIVE))).withColumns({f"__f_{name}": rows for name, rows in families.items()})
    found = F.coalesce(*[F.when(F.size(f"__f_{name}") > 0, F.col(f"__f_{name}")) for name in families])
    rows = read.select("claim_id", "period_label", F.inline(found))
    told = mappers.narrative(claims.where(category.isin(*NARRATIVE) & F.col("document_type").isin(*REPORTS)), BULLETINS)
    out = rows.unionByName(told.select(*rows.columns)).where("value is not null")
    period = F.when(F.col("scope") == "cumulative", periods.cumulative_label(1984, F.col("period_label"))).otherwise(F.col("period_label"))
    return out.withColumn("period_label", period).withColumn("observation_id", mappers.observation_id())


def scalar(value: Column, text: Column, category: Column) -> tuple[Column, Column]:
    """Number and unit of a claim; none for categories whose rows hold several, nor for years and reference numbers."""
    own, first = numbers.first_number(value), numbers.first_number(text)
    good_own, good_first = own.isNotNull() & ~numbers.is_reference(text, own), first.isNotNull() & ~numbers.is_reference(text, first)
    safe = ~category.isin(*classify.CATEGORY_UNSAFE)
    return F.when(safe, F.when(good_own, own).when(good_first, first)), F.when(safe, F.when(good_own, numbers.unit(value)).when(good_first, numbers.unit(text)))


def normalized(raw: DataFrame) -> DataFrame:
    """Claims as the mappers take them, from claim_id, local_path, page_index, category, claim_text, value, snippet, confidence."""
    name, text = F.element_at(F.split("local_path", "/"), -1), evidence(F.col("claim_text"), F.col("snippet"))
    year, quarter, month = periods.year(name, text), periods.quarter(name), periods.month(text)
    label = F.coalesce(extract.row_label(F.col("claim_text")), F.lit(""))
    number, unit = scalar(F.col("value"), F.col("claim_text"), F.col("category"))
    found, primary = classify.diseases(text, name)
    return raw.select(
        "claim_id", "local_path", "page_index", "category", "claim_text", "snippet", "confidence", name.alias("filename"), F.col("value").alias("raw_value"), label.alias("row_label"), year.alias("year"), quarter.alias("quarter"),
        month.alias("month"), periods.granularity(year, quarter, month).alias("period_granularity"), periods.label(year, quarter, month).alias("period_label"), F.array_join(found, "|").alias("diseases"), primary.alias("primary_disease"),
        classify.metric_type(F.col("category"), text).alias("metric_type"), classify.region(label, text).alias("region"), classify.document_type(name, F.col("category"), F.col("claim_text")).alias("document_type"),
        number.alias("numeric_value"), unit.alias("numeric_unit"),
    )


def cascade_rows(dimension: DataFrame, keys: list[str], metrics: list[str], total: str, alive: str) -> DataFrame:
    """Wide rows of a dimension as observations, one a metric, and not_on_treatment = total - alive."""
    wide = dimension.withColumn("not_on_treatment", F.greatest(F.col(total) - F.col(alive), F.lit(0)))
    cells = [F.col(m).cast("double").alias(m) for m in [*metrics, "not_on_treatment"]]
    return wide.select(*keys, *cells).unpivot(keys, [*metrics, "not_on_treatment"], "metric", "value").where("value is not null")


def cohort_subgroup(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.rlike("pregnant women|reported pregnant"), "pregnant_women").when(low.rlike("tgw|transgender women"), "tgw").otherwise("")


def narrative_subgroup(text: Column) -> Column:
    low = F.lower(text)
    return (
        F.when(low.rlike(" ofw|ofws|overseas filipino|worked overseas"), "migrant_workers").when(low.rlike(" among msm| men who have sex with men"), "msm").when(cohort_subgroup(text) != "", cohort_subgroup(text))
        .when(low.contains("transactional sex"), "transactional_sex").when(low.contains("children") & low.contains("10 years old"), "age_lt_10").when(low.contains("adolescents") & low.contains("10-19"), "age_10_19")
        .when(low.contains("youth aged 15-24"), "age_15_24").otherwise("")
    )


def metric_base(metric_type: Column, text: Column) -> Column:
    low = F.lower(text)
    return F.when((metric_type == "deaths") | low.contains("reported deaths"), "reported_deaths").when((metric_type == "new_cases") | low.rlike("newly diagnosed|newly reported|new hiv ab sero|sero-positive individuals"), "new_cases").otherwise("reported_cases")


def backed_out(estimate: Column, count: Column, pct: Column) -> Column:
    """The estimate, or the denominator that a count and its share imply."""
    return F.coalesce(estimate, F.try_divide(count, pct / 100))
