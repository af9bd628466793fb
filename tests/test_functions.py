"""Scalar functions on cases whose results follow from their rules."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from quern.functions import numbers, periods, text
from quern.operators import bulletins, chunks, classify, draws, extract, mappers, quality, regional, resolve, search, series
from quern.plans import QUERIES
from quern.sources import readers, sinks


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (_, t) in values.items()) or "x int"
    return spark.createDataFrame([tuple(v for v, _ in values.values()) or (0,)], schema).select(column.alias("r")).first().r


@pytest.mark.parametrize(
    ("name", "year", "quarter", "month", "label", "key"),
    [("HIV_STI_2025_Jul_Sep.pdf", 2025, "Q3", None, "2025 Q3", 202509), ("HIV_STI_2014_March.pdf", 2014, None, 3, "2014-03", 201403), ("report 2019", 2019, None, None, "2019", 201912), ("HIV 2024 Q3", 2024, "Q3", None, "2024 Q3", 202409), ("no period", None, None, None, "", None)],
)
def test_periods(spark, name, year, quarter, month, label, key):
    t = F.col("t")
    df = spark.createDataFrame([(name,)], "t string").select(periods.year(t).alias("y"), periods.quarter(t).alias("q"), periods.month(t).alias("m"))
    r = df.withColumn("l", periods.label(F.col("y"), F.col("q"), F.col("m"))).withColumn("k", periods.sort_key(F.col("l"))).first()
    assert (r.y, r.q, r.m, r.l, r.k) == (year, quarter, month, label, key)


@pytest.mark.parametrize(("said", "quarter"), [("Mar_Feb_Jan", "Q1"), ("Oct-Dec", "Q4"), ("Dec-Oct", None), ("jan feb mar apr", None), ("May q3", "Q3"), (None, None)])
def test_quarters_of_months(spark, said, quarter):
    assert one(spark, periods.quarter(F.col("t")), t=(said, "string")) == quarter


def test_periods_read_months_once_a_text(spark, sf):
    plan = QUERIES["d_periods"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 2  # for the quarter and for the month


def test_cumulative_label_sorts_by_its_last_year(spark):
    assert one(spark, periods.sort_key(F.col("t")), t=("1984-2026 Q1", "string")) == 202603


def test_decimal_year_and_back(spark):
    assert one(spark, periods.decimal_year(F.col("t")), t=("2024 Q3", "string")) == 2024.5
    assert one(spark, periods.from_decimal_year(F.col("x"), F.lit("quarter")), x=(2024.5, "double")) == "2024 Q3"


@pytest.mark.parametrize(("token", "value"), [("12,345a", 12345.0), ("<1%", 1.0), ("abc", None), ("", None)])
def test_clean_token(spark, token, value):
    assert one(spark, numbers.clean_token(F.col("t")), t=(token, "string")) == value


@pytest.mark.parametrize(("said", "value"), [("three", 3), ("1,234 cases", 1234), ("none", None)])
def test_integer(spark, said, value):
    assert one(spark, numbers.integer(F.col("t")), t=(said, "string")) == value


@pytest.mark.parametrize(("said", "code"), [("Region IV-A", "4A"), ("Region XIII", "CARAGA"), ("National Capital Region", "NCR"), ("nowhere", None)])
def test_region_code(spark, said, code):
    assert one(spark, classify.region_code(F.col("t")), t=(said, "string")) == code


def test_percent_is_null_for_zero(spark):
    assert one(spark, numbers.percent(F.col("a"), F.col("b")), a=(1.0, "double"), b=(0.0, "double")) is None
    assert one(spark, numbers.percent(F.col("a"), F.col("b")), a=(157350.0, "double"), b=(288000.0, "double")) == 54.6


def test_claim_text(spark):
    assert one(spark, text.claim_text(F.col("t")), t=("  therehavebeen  1, 234 casesreported to“HARP”; ", "string")) == 'there have been 1,234 cases reported to"HARP"'
    assert one(spark, text.claim_text(F.col("t")), t=(None, "string")) == ""


def test_value_run_stops_at_the_first_gap(spark):
    assert one(spark, chunks.value_run(F.col("t")), t=("NCR | 1 | 2% | x | 3", "string")) == ["1", "2%"]


def test_packed_chunks_keep_every_line(spark):
    lines = [f"line {k} " + "x" * 30 for k in range(50)]
    got = one(spark, chunks.packed(F.col("t"), 200), t=("\n".join(lines), "string"))
    assert "\n".join(got).split("\n") == lines and all(len(c) <= 200 for c in got)


def test_pages(spark):
    df = spark.createDataFrame([(1, "head\n## [Page 1]\na\n## [Page 2]\nb")], "doc_id long, text string")
    assert [(r.page_no, r.page_text.strip()[-1]) for r in chunks.pages(df).orderBy("page_no").collect()] == [(0, "d"), (1, "a"), (2, "b")]


def test_wrapped_lines(spark):
    df = spark.createDataFrame([(1, 0, "The treat-"), (1, 1, "ment of"), (1, 2, "people."), (1, 3, "Next")], "doc_id long, line_no int, line string")
    assert [r.line for r in chunks.wrapped_lines(df, ["doc_id"], "line_no").orderBy("line_no").collect()] == ["The treatment of people.", "Next"]


def test_positioned_rows(spark):
    words = [(1, 0.0, 10.0, 5.0, "NCR"), (1, 12.0, 20.0, 6.0, "total"), (1, 60.0, 70.0, 5.5, "12"), (1, 0.0, 9.0, 30.0, "CAR")]
    df = spark.createDataFrame(words, "page int, x0 double, x1 double, y0 double, word string")
    assert [r.row_text for r in chunks.positioned_rows(df, ["page"]).orderBy("row_no").collect()] == ["NCR total | 12", "CAR"]


def test_regional_mentions(spark):
    df = spark.createDataFrame([(1, "NCR with 989 (21%) and Region IV-A (15%, 700); (7%, 321) were from the Region VII")], "claim_id long, claim_text string")
    got = {(r.region, r["count"], r.share) for r in mappers.regional_mentions(df).collect()}
    assert got == {("NCR", 989, 21.0), ("4A", 700, 15.0), ("7", 321, 7.0)}


def test_treatment_outcomes_derive_the_rest(spark):
    df = spark.createDataFrame([("c", "10 | 4 | 2 | 1 | 1 | 18 | 22%")], "claim_id string, value string")
    got = {r.metric: r.value for r in mappers.treatment_outcomes(df).collect()}
    assert got["not_on_treatment"] == 8.0 and got["total"] == 18.0 and len(got) == 8


def test_narrative_rules_and_first_page_gate(spark):
    rows = [("a", 0, "120,000 (55%) PLHIV are currently on life-saving ART.", ""), ("b", 3, "120,000 (55%) PLHIV are currently on life-saving ART.", ""), ("c", 2, "In May 2019, there were 61 reported deaths. Of these 66% (40) were male while 21 were female.", None)]
    got = {(r.claim_id, r.metric, r.subgroup): r.value for r in mappers.narrative(spark.createDataFrame(rows, "claim_id string, page_index int, claim_text string, snippet string"), bulletins.BULLETINS).collect()}
    assert got == {("a", "plhiv_on_art_count", ""): 120000.0, ("a", "plhiv_on_art_pct", ""): 55.0, **{("c", f"reported_deaths_{w}", g): v for g, n, p in (("", 61.0, None), ("male", 40.0, 66.0), ("female", 21.0, 34.4)) for w, v in (("count", n), ("pct", p)) if v}}


def test_table_row_claims_carry_their_context(spark):
    df = spark.createDataFrame([(1, "Outcomes by region\nNCR | 1 | 2 | 3\nCAR | 4 | 5 | 6")], "doc_id long, text string")
    got = extract.table_rows(chunks.lines(df)).orderBy("line_no").collect()
    assert [r.claim_text for r in got] == ["Outcomes by region: NCR has values 1, 2, 3.", "Outcomes by region: CAR has values 4, 5, 6."]
    assert one(spark, extract.row_label(F.col("t")), t=(got[0].claim_text, "string")) == "NCR"


@pytest.fixture
def long_document(spark, tmp_path):
    """60 table rows, quantitative lines and narrative sentences each, and text far past 40 chunks of 2000 characters."""
    rows = [f"Area {k} | {k} | {k + 1} | {k + 2}" for k in range(60)]
    said = [f"In the quarter {k + 1000} cases and {k + 2000} deaths were reported in the area." for k in range(60)]
    text = "\n".join(rows + said + ["filler " * 250] * 60)
    spark.createDataFrame([(1, text, "src0", "en", len(text))], "doc_id long, text string, source string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_claims_of_a_long_document_are_not_capped(spark, long_document):
    from quern.plans import QUERIES

    def categories(name):
        return Counter(r.category for r in QUERIES[name](spark, long_document).collect())

    # the table runs into the first sentence; line and sentence claims alike in text are one
    for name in ("x_claims", "c10_review_queue"):
        assert categories(name)["Structured Table Row"] == 60 and categories(name)["Quantitative Narrative"] == 60
    assert extract.narrative_sentences(spark.read.parquet(f"{long_document}/documents.parquet")).count() >= 58
    assert QUERIES["x5_located_snippets"](spark, long_document).count() >= 58


def test_chunks_cover_the_whole_text(spark, long_document):
    from quern.plans import QUERIES

    text = spark.read.parquet(f"{long_document}/documents.parquet").first().text
    got = QUERIES["g2_chunks"](spark, long_document).orderBy("chunk_no").collect()
    assert len(got) > 40 and sum(r.n for r in got) + len(got) - 1 == len(text) and all(r.n <= 2000 for r in got)


def test_located_snippet(spark):
    df = spark.createDataFrame([("aaa the  cases bbb", "the cases"), ("xyz", "none")], "text string, snippet string")
    a, b = extract.located(df).collect()
    assert a.start == 4 and "the cases" in a.window and b.window is None


def test_coerced_payloads(spark):
    rows = [(1, '[{"claim_text": "a"}]'), (2, '{"points": [{"claim_text": "b"}]}'), (3, 'text {"findings": [{"claim_text": "c"}]} more'), (4, "nonsense")]
    got = {(r.id, r.claim_text) for r in extract.coerced(spark.createDataFrame(rows, "id int, raw string"), "raw").collect()}
    assert got == {(1, "a"), (2, "b"), (3, "c")}


def test_upsert_point_keeps_order(spark):
    df = spark.createDataFrame([([(202403, 1.0), (202409, 3.0)],)], "p array<struct<sort_key: int, value: double>>")
    new = F.struct(F.lit(202406).alias("sort_key"), F.lit(2.0).alias("value"))
    assert [tuple(x) for x in df.select(resolve.upsert_point(F.col("p"), new).alias("r")).first().r] == [(202403, 1.0), (202406, 2.0), (202409, 3.0)]


def test_average_ranks_and_median(spark):
    df = spark.createDataFrame([("a", v) for v in (10, 20, 20, 30)], "k string, v int")
    assert sorted(r.r for r in df.select(series.average_rank("v", ["k"]).alias("r")).collect()) == [1.0, 2.5, 2.5, 4.0]


def test_flat_series_without_spread(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("a", 1.0, 7.0)], "k string, decimal_year double, value double")
    r = series.fit(df, ["k"]).first()
    assert (r.slope, r.intercept, r.r2) == (0.0, 6.0, 0.0)


def test_outlier_score_and_quadrants(spark):
    df = spark.createDataFrame([("a", 1.0, 50.0), ("b", -4.0, 10.0), ("c", 0.5, 0.0), ("d", 0.1, 0.0)], "region string, residual double, rate double")
    assert [r.region for r in regional.outlier_score(df).collect()] == ["b", "a", "c"]


def test_persistence_default(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0)], "k string, t int, value double")
    assert draws.persistence(df, ["k"], "t").first().persistence == 0.65


def test_search_limit():
    assert (search.limit_of(None), search.limit_of(1000), search.limit_of(0), search.limit_of(5)) == (80, 200, 80, 5)


def test_longest_common():
    assert quality.longest_common("abcdef", "xxcdeyy") == 3 and quality.longest_common("", "a") == 0


def test_triage_and_strategy(spark):
    df = spark.createDataFrame([(10, 0.9, True, 0, 0.1, 0.9), (900, 0.0, False, 0, 0.1, 0.1)], "native_chars int, image_coverage double, has_table boolean, drawings int, short_ratio double, numeric_ratio double")
    assert [(r.needs_vision, r.reasons) for r in classify.triage(df).collect()] == [(True, ["little text", "image page", "dense table"]), (False, [])]


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿year,value\n2020,1.5\n2021,...\n".encode())
    got = readers.read_csv(spark, str(tmp_path / "a.csv"), "year int, value double, note string").orderBy("year").collect()
    assert [tuple(r) for r in got] == [(2020, 1.5, None), (2021, None, None)]
    assert readers.read_csv(spark, str(tmp_path / "missing.csv"), "year int").count() == 0
    (tmp_path / "b.jsonl").write_text('{"a": 1}\n\nbroken\n{"a": 2}\n')
    assert {r.a for r in readers.read_json_lines(spark, str(tmp_path / "b.jsonl"), "a int").collect()} >= {1, 2}
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    sinks.write_csv_union([df, df.withColumn("c", F.lit(3))], str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).columns == ["a", "b", "c"]
    assert [r.value for r in sinks.markdown(df).orderBy("value").collect()] == ["| 1 |  |", "| 2 | x |"]
    assert sinks.feed(rows=df).first().value.startswith('{"rows":[')
    with pytest.raises(ValueError, match="missing exports"):
        sinks.manifest(spark, {"a": df}, {"b"})
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "x.md").write_text("hi")
    (tmp_path / "docs" / "_skip.md").write_text("no")
    assert [r.text for r in readers.whole_texts(spark, str(tmp_path / "docs")).collect()] == ["hi"]
    assert readers.listing(spark, str(tmp_path / "docs"), "*.md").count() == 1  # Spark hides names that begin with _
