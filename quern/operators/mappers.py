"""Claims to observations.

A mapper is a gate and a list of rules; rules compile to one array-of-structs expression, so each claim is
read once and gives its rows by ``inline``. A user's own rule is one more Rule in the list.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers, text as texts
from . import markers
from .classify import region_code

# Metrics of table columns, in column order.
CASCADE = ["estimated_plhiv", "diagnosed_plhiv", "diagnosis_coverage", "on_art", "art_coverage", "vl_tested", "vl_testing_coverage", "vl_suppressed", "vl_suppression_among_tested", "suppression_among_on_art"]
CASCADE_COMPACT = [m for m in CASCADE if m != "vl_testing_coverage"]
OUTCOMES = ["alive_on_art", "lost_to_follow_up", "died", "transferred_out", "stopped", "total", "lost_to_follow_up_pct"]
VIRAL_LOAD = ["on_art", "vl_tested", "vl_testing_coverage", "vl_suppressed", "vl_suppression_among_tested"]
QUICK_FACTS = {
    "total reported cases": ("reported_cases", "total"), "asymptomatic cases": ("asymptomatic_cases", "total"), "aids cases": ("aids_cases", "total"), "male": ("reported_cases", "male"),
    "female": ("reported_cases", "female"), "less than 15 y/o": ("reported_cases", "age_lt_15"), "15-24 y/o": ("reported_cases", "age_15_24"), "25-34 y/o": ("reported_cases", "age_25_34"),
    "35-49 y/o": ("reported_cases", "age_35_49"), "50 y/o & above": ("reported_cases", "age_50_plus"), "reported deaths": ("reported_deaths", "total"), "newly started on art": ("new_art_starts", "total"),
    "total plhiv on art": ("plhiv_on_art", "total"),
}
# How region names are written, and number forms.
_REGION = r"(?:National Capital Region(?:\s*\(NCR\))?|Cordillera Administrative Region(?:\s*\(CAR\))?|Bangsamoro Autonomous Region in Muslim Mindanao\s*\(BARMM\)|Autonomous Region in Muslim Mindanao\s*\(ARMM\)|Region\s*[IVX0-9]+(?:\s*-?\s*[ABab]\b)?|NCR|CARAGA|BARMM|ARMM|NIR|CAR)"
_PCT, _COUNT = r"(<?\d+(?:\.\d+)?)%", r"(\d[\d,]*)"
# How bulletins say a region's count and share: pattern, and the groups of region, count and share.
REGION_FORMS = (
    (rf"(?i)({_REGION})\s+with\s+{_COUNT}\s*\({_PCT}\)", 1, 2, 3),
    (rf"(?i)({_REGION})\s*\({_PCT}\s*,\s*{_COUNT}\)", 1, 3, 2),
    (rf"(?i)\({_PCT}\s*,\s*{_COUNT}\)\s*were from the\s+({_REGION})", 3, 2, 1),
    (rf"(?i)({_REGION})\s+with\s+{_COUNT}\s*cases", 1, 2, 0),
)


@dataclass(frozen=True)
class Rule:
    """Patterns in order; the first that matches gives the count and the share.

    A pattern is text, with the groups of count and share that the rule names (0 for none), or a tuple of text and
    groups of its own; a group given as text is that number. ``{base}`` as metric stands for what the claim counts
    (``{cases}``: new cases if it counts those, else reported cases), the scope ``{since}`` for cumulative where the claim counts since 1984; ``minus`` turns the sign.
    """

    metric: str
    patterns: tuple[str | tuple, ...]
    count: int = 1
    share: int = 0
    subgroup: str = ""
    scope: str = ""
    region: str = "Philippines"
    minus: bool = False


@dataclass(frozen=True)
class Mapper:
    """Rules for claims whose lower-cased text holds one of the markers, and one of ``also`` where there are any.

    ``first_page`` keeps to page 0. ``fallback`` rules speak where the others found nothing. ``after`` are steps on the rows found:
    SQL of an array and what it becomes (:func:`shares_of`, :func:`drop_if`).
    """

    name: str
    markers: tuple[str, ...]
    rules: tuple[Rule, ...] = field(default_factory=tuple)
    first_page: bool = False
    also: tuple[str, ...] = ()
    fallback: tuple[Rule, ...] = ()
    after: tuple[Callable[[str], str], ...] = ()


_WORDS = ", ".join(f"'{w}', {n}D" for w, n in numbers.NUMBER_WORDS.items())
_ROW = "array<struct<metric: string, unit: string, region: string, subgroup: string, scope: string, value: double>>"
_NONE = f"cast(array() as {_ROW})"
#: How texts say that they count from the beginning.
SINCE = "from january 1984|from 1984 to|since 1984|since january 1984"


def _number(said: str) -> str:
    return rf"coalesce(try_cast(nullif(regexp_extract(regexp_replace({said}, '[,%]', ''), r'\d+(?:\.\d+)?', 0), '') as double), try_element_at(map({_WORDS}), lower(trim({said}))))"


def _group(text: str, pattern: str, group: int | str) -> str:
    if isinstance(group, str):
        return f"'{group}'"
    return f"nullif(regexp_extract({text}, r'{pattern}', {group}), '')" if group else "cast(null as string)"


def _rule(r: Rule, text: str) -> str:
    """SQL for the count and share rows of a rule, or null."""
    tried = []
    for p in r.patterns:
        pattern, count, share = p if isinstance(p, tuple) else (p, r.count, r.share)
        tried.append(f"if({text} rlike r'{pattern}', struct({_group(text, pattern, count)} as c, {_group(text, pattern, share)} as s), null)")
    counted = {"{base}": "base", "{cases}": "if(base = 'new_cases', base, 'reported_cases')"}.get(r.metric)
    metric = lambda suffix: f"concat({counted}, '{suffix}')" if counted else f"'{r.metric}{suffix}'"
    scope = "since" if r.scope == "{since}" else f"'{r.scope}'"
    row = lambda suffix, unit, said: f"struct({metric(suffix)} as metric, '{unit}' as unit, '{r.region}' as region, '{r.subgroup}' as subgroup, {scope} as scope, {said} as said, {-1 if r.minus else 1}D as sign)"
    return f"get(transform(filter(array(coalesce({', '.join(tried)})), f -> f is not null), f -> array({row('_count', 'count', 'f.c')}, {row('_pct', 'percent', 'f.s')})), 0)"


def _rules(rules: tuple[Rule, ...], text: str) -> str:
    said = f"filter(flatten(filter(array({', '.join(_rule(r, text) for r in rules)}), x -> x is not null)), x -> x.said is not null)"
    return f"filter(transform({said}, x -> struct(x.metric, x.unit, x.region, x.subgroup, x.scope, x.sign * {_number('x.said')} as value)), r -> r.value is not null)"


def compiled(mapper: Mapper, text: str) -> str:
    """SQL for an array of (metric, unit, region, subgroup, scope, value) from the columns ``text``, base, since and year."""
    out = _rules(mapper.rules, text)
    if mapper.fallback:
        out = f"transform(array({out}), a -> if(size(a) > 0, a, {_rules(mapper.fallback, text)}))[0]"
    for step in mapper.after:
        out = f"transform(array({out}), a -> {step('a')})[0]"
    return out


def value_of(rows: str, metric: str, subgroup: str = "") -> str:
    return f"get(filter({rows}, v -> v.metric = '{metric}' and v.subgroup = '{subgroup}'), 0).value"


def drop_if(metric: str, wrong: Callable[[str], str]) -> Callable[[str], str]:
    """Rows of a metric go where the SQL condition on the claim's rows holds: counts that were misread."""
    return lambda a: f"filter({a}, r -> not (r.metric = '{metric}' and coalesce({wrong(a)}, false)))"


def shares_of(total: str, parts: tuple[str, ...], subgroups: tuple[str, ...] = ("",), digits: int = 1) -> Callable[[str], str]:
    """Counts of ``parts`` in the count ``total`` that come without a share get it, unless they are larger."""
    counts = ", ".join(f"'{p}_count'" for p in parts)
    groups = ", ".join(f"'{g}'" for g in subgroups)

    def step(a: str) -> str:
        whole = value_of(a, f"{total}_count")
        share = "replace(r.metric, '_count', '_pct')"
        bare = f"r -> r.metric in ({counts}) and r.subgroup in ({groups}) and r.value <= {whole} and {whole} > 0 and not exists({a}, x -> x.metric = {share} and x.subgroup = r.subgroup)"
        made = f"r -> struct({share} as metric, 'percent' as unit, r.region, r.subgroup, r.scope, round(r.value / {whole} * 100, {digits}) as value)"
        return f"concat({a}, transform(filter({a}, {bare}), {made}))"

    return step


def counts_of(whole: str, parts: tuple[str, ...]) -> Callable[[str], str]:
    """Shares of subgroups without a count get it from the count of the subgroup ``whole``."""
    groups = ", ".join(f"'{p}'" for p in parts)

    def step(a: str) -> str:
        total = f"get(filter({a}, v -> v.unit = 'count' and v.subgroup = '{whole}'), 0).value"
        bare = f"r -> r.unit = 'percent' and r.subgroup in ({groups}) and {total} is not null and not exists({a}, x -> x.unit = 'count' and x.subgroup = r.subgroup)"
        return f"concat({a}, transform(filter({a}, {bare}), r -> struct(replace(r.metric, '_pct', '_count') as metric, 'count' as unit, r.region, r.subgroup, r.scope, round({total} * r.value / 100) as value)))"

    return step


def narrative(claims: DataFrame, topics: tuple[Mapper, ...]) -> DataFrame:
    """Observations of claims: every topic's rows in order, and of rows alike the first. A projection; nothing is shuffled.

    claims: claim_id, page_index, claim_text, snippet and, where known, year, metric_type and period_label. A topic without rules is
    the place of the regional mentions.
    """
    missing = {c: F.lit(None).cast(t) for c, t in (("year", "int"), ("metric_type", "string"), ("period_label", "string")) if c not in claims.columns}
    text = texts.evidence(F.col("claim_text"), F.col("snippet"))
    rows = claims.withColumns(missing).select("claim_id", "page_index", "year", "metric_type", "period_label", text.alias("evidence"), F.lower(text).alias("low"))
    words = list(dict.fromkeys(w for m in topics for w in (*m.markers, *m.also)))
    rows = markers.of_list(rows, "low", words, "__held").where(F.size("__held") > 0)  # most texts go here
    rows = rows.withColumns({"base": metric_base(F.col("metric_type"), F.col("low")), "since": F.when(F.col("low").rlike(SINCE), "cumulative").otherwise("")})
    holds = lambda ws: F.arrays_overlap("__held", F.array(*[F.lit(words.index(w)).cast("long") for w in ws]))
    found = []
    for m in topics:
        gate = holds(m.markers) & (holds(m.also) if m.also else F.lit(True)) & ((F.col("page_index") == 0) if m.first_page else F.lit(True))
        found.append(F.when(gate, F.expr(compiled(m, "evidence")) if m.rules else regional(F.col("evidence"), F.col("low"))).otherwise(F.expr(_NONE)))
    key = lambda r: F.concat_ws("|", r["metric"], r["region"], r["subgroup"], r["scope"])
    once = lambda a: F.transform(F.array(F.transform(a, key)), lambda keys: F.filter(a, lambda r, k: F.array_position(keys, key(r)) == k + 1))[0]
    every = F.transform(F.array(F.flatten(F.array(*found))), once)[0]
    return rows.select("claim_id", "period_label", F.inline(every)).withColumn("observation_id", observation_id())


def metric_base(metric_type: Column, low: Column) -> Column:
    """What a narrative counts where it doesn't say: deaths, new cases, else reported cases."""
    return F.when(metric_type.eqNullSafe("deaths") | low.contains("reported deaths"), "reported_deaths").when(metric_type.eqNullSafe("new_cases") | low.rlike("newly diagnosed|newly reported|new hiv ab sero|sero-positive individuals"), "new_cases").otherwise("reported_cases")


def regional(text: Column, low: Column) -> Column:
    """Count and share rows of every region mentioned in any of the forms, once each."""
    found = []
    for pattern, region, count, share in REGION_FORMS:
        part = lambda g, p=pattern: F.regexp_extract_all(text, F.lit(p), F.lit(g))
        shares = part(share) if share else F.transform(part(region), lambda x: F.lit(None).cast("string"))
        found.append(F.arrays_zip(part(region).alias("region"), part(count).alias("n"), shares.alias("pct")))
    group = F.when(low.rlike(" ofw|ofws|overseas filipino workers|worked overseas"), "migrant_workers").otherwise("")
    row = lambda m, suffix, unit, value: F.struct(F.concat(F.col("base"), F.lit(suffix)).alias("metric"), F.lit(unit).alias("unit"), region_code(m["region"]).alias("region"), group.alias("subgroup"), F.col("since").alias("scope"), value.cast("double").alias("value"))
    rows = F.transform(F.array_distinct(F.flatten(F.array(*found))), lambda m: F.array(row(m, "_count", "count", numbers.integer(m["n"])), row(m, "_pct", "percent", numbers.decimal(m["pct"]))))
    return F.filter(F.flatten(rows), lambda r: r["region"].isNotNull() & r["value"].isNotNull())


def observation_id() -> Column:
    return F.concat_ws(":", "claim_id", "metric", "region", F.nullif("subgroup", F.lit("")), F.nullif("scope", F.lit("")))


def regional_mentions(claims: DataFrame, text: str = "claim_text") -> DataFrame:
    """claim_id, region, count, share: every mention in any of the forms, distinct."""
    found = []
    for pattern, region, count, share in REGION_FORMS:
        part = lambda g, p=pattern: F.regexp_extract_all(text, F.lit(p), F.lit(g))
        shares = part(share) if share else F.transform(part(region), lambda x: F.lit(None).cast("string"))
        found.append(F.arrays_zip(part(region).alias("region"), part(count).alias("n"), shares.alias("pct")))
    rows = claims.select("claim_id", F.inline(F.flatten(F.array(*found))))
    out = rows.select("claim_id", region_code(F.col("region")).alias("region"), numbers.integer(F.col("n")).alias("count"), numbers.decimal(F.col("pct")).alias("share"))
    return out.where("region is not null").distinct()


def zipped(claims: DataFrame, schema: list[str], cells: Column, exact: bool = True) -> DataFrame:
    """Cells of table rows as one row a metric: claim_id, metric, unit, value. ``exact`` asks for as many cells as metrics."""
    metric = F.array(*map(F.lit, schema))
    rows = claims.withColumn("__c", cells)
    rows = rows.where(F.size("__c") == len(schema)) if exact else rows.where(F.size("__c") <= len(schema))
    out = rows.select("claim_id", F.inline(F.arrays_zip(F.slice(metric, 1, F.size("__c")).alias("metric"), F.col("__c").alias("cell"))))
    unit = F.when(F.col("cell").contains("%") | F.col("metric").rlike("coverage|pct|among"), "percent").otherwise("count")
    return out.select("claim_id", "metric", unit.alias("unit"), numbers.dash_is_zero(F.col("cell")).cast("double").alias("whole"), numbers.clean_token(F.col("cell")).alias("value")).withColumn("value", F.coalesce("value", F.when(~F.col("unit").eqNullSafe("percent"), F.col("whole")))).drop("whole").where("value is not null")


def split_cells(value: Column) -> Column:
    return F.filter(F.transform(F.split(value, r"\|"), lambda c: F.trim(c)), lambda c: c != "")


def treatment_outcomes(claims: DataFrame) -> DataFrame:
    """Seven-cell outcome rows as metrics, with not_on_treatment = total - alive, at least 0."""
    base = zipped(claims, OUTCOMES, split_cells(F.col("value")))
    derived = base.groupBy("claim_id").agg(F.max(F.when(F.col("metric") == "total", F.col("value"))).alias("t"), F.max(F.when(F.col("metric") == "alive_on_art", F.col("value"))).alias("a"))
    more = derived.where("t is not null and a is not null").select("claim_id", F.lit("not_on_treatment").alias("metric"), F.lit("count").alias("unit"), F.greatest(F.col("t") - F.col("a"), F.lit(0.0)).alias("value"))
    return base.unionByName(more)


def quick_facts(claims: DataFrame) -> DataFrame:
    """claims (claim_id, label, value): metric, subgroup, scope, value by the label and the number of cells."""
    from ..functions.periods import scopes

    names = F.create_map(*[F.lit(x) for k, v in QUICK_FACTS.items() for x in (k, ":".join(v))])
    rows = claims.withColumn("__m", names[F.lower(F.trim("label"))]).where("__m is not null")
    out = rows.select("claim_id", "__m", F.inline(scopes(split_cells(F.col("value")))))
    return out.select("claim_id", F.split("__m", ":")[0].alias("metric"), F.split("__m", ":")[1].alias("subgroup"), "scope", numbers.dash_is_zero(F.col("cell")).alias("value")).where("value is not null")


def graph(claims: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices (id, kind, name) and edges (src, dst, relation) of documents, diseases and metrics."""
    vertex = lambda column, kind: claims.where(F.col(column).isNotNull()).select(F.concat(F.lit(f"{kind}:"), F.col(column).cast("string")).alias("id"), F.lit(kind).alias("kind"), F.col(column).cast("string").alias("name"))
    vertices = vertex("document_id", "document").unionByName(vertex("disease", "disease")).unionByName(vertex("metric", "metric")).distinct()
    doc = F.concat(F.lit("document:"), F.col("document_id").cast("string"))
    edges = claims.select(F.inline(F.array(F.struct(doc.alias("src"), F.concat(F.lit("disease:"), F.col("disease")).alias("dst"), F.lit("mentions").alias("relation")), F.struct(doc.alias("src"), F.concat(F.lit("metric:"), F.col("metric")).alias("dst"), F.lit("reports").alias("relation")))))
    return vertices, edges.where("dst is not null").distinct()
