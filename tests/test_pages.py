"""Annex rows, region streams, page flags and policy tags on odd documents."""

from pyspark.sql import functions as F

from quern.operators import blocks, boards, pages, policy


def test_annex_rows_of_odd_texts():
    rows = lambda t: [(s, label, len(v)) for s, label, v, _, _ in blocks.annex_rows(t)]
    assert rows("") == [] and rows("1\n2\n3") == []
    ages = "Care Cascade by Age Group\n"
    assert rows(ages + "Youth\n1\n2\n3\n4") == []  # four values are too few
    assert rows(ages + "Youth\n1\n2\n3\n4\n5") == [("Age Group", "Youth", 5)]
    assert rows(ages + "\n".join(["Youth", *map(str, range(25))])) == [("Age Group", "Youth", 10)]  # values beyond ten belong to no label
    assert rows(ages + "Youth\n1\n2\nNote: cut\n3\n4\n5") == []
    # a region's number is a value until a row is full
    region = "REGION\n7\n" + "\n".join("11 12 13 14 15 16 17 18".split()) + "\nNCR\n1\n2\n3\n4\n5"
    assert rows(region) == [("Region", "7", 8), ("Region", "NCR", 5)]
    full = "REGION\n7\n" + "\n".join("11 12 13 14 15 16 17 18 8 1 2 3 4 5".split())
    assert rows(full) == [("Region", "7", 8), ("Region", "8", 5)]
    assert rows(ages + "Adults\n1\n2\n3\n4\n5\n6\n7\n8\n9\nYouth\n1\n2\n3\n4\n5") == [("Age Group", "Adults", 9), ("Age Group", "Youth", 5)]


def test_snippets_are_verbatim_and_lines_counted():
    (row,) = blocks.annex_rows("x\n\nCare Cascade by Age Group\n\nYouth\n(10-19)\n1\n2\n3\n4\n5")
    assert row[3] == "Youth\n(10-19)\n1\n2\n3\n4\n5" and row[4] == 4


def test_region_stream():
    rows = lambda t: list(blocks.region_stream(f"{blocks.TITLE}\n{t}"))
    assert rows("NCR | 1 | 2 | 3% | 4 | 5%") == [("NCR", [1, 2, 3, 4, 5])]
    assert rows("NCR | 1 | 2 | 3 | 4\nCAR | 5 | 6 | 7 | 8 | 9 | 10") == [("CAR", [5, 6, 7, 8, 9])]
    assert rows("NCR | 1,200 | 2 | x | 4 | 5 | 6") == []
    assert rows("1. A paragraph\nNCR | 1 | 2 | 3 | 4 | 5") == []
    assert list(blocks.region_stream("NCR | 1 | 2 | 3 | 4 | 5")) == []  # no title


def test_null_and_empty_documents(spark):
    docs = spark.createDataFrame([(1, None), (None, ""), (2, blocks.TITLE + "\nNCR | 1 | 2 | 3 | 4 | 5"), (2, blocks.TITLE + "\nNCR | 1 | 2 | 3 | 4 | 5")], "doc_id long, text string")
    assert [r.region for r in blocks.region_rows(docs).collect()] == ["NCR", "NCR"]
    assert blocks.annexes(docs).count() == 0 and blocks.annexes(docs.limit(0)).count() == 0


def test_claims_under_contract(spark):
    rows = spark.createDataFrame([("short", "s" * 60, 0.9), ("a claim of some length", " s ", 0.9), ("a claim of some length", "s" * 600, 0.9), ("a claim of some length", "s" * 60, 1.5), (None, None, None)], "claim_text string, snippet string, confidence double")
    got = blocks.built(rows).collect()
    assert [r.rejected for r in got] == ["claim too short", "snippet too short", None, "confidence out of range", "claim too short"]
    assert len(got[2].snippet) == 500


def test_page_flags(spark):
    df = spark.createDataFrame([("#### [Blank Page]",), ("#### [OCR Text Content]\n\n",), ("## [Page 2]\nx",), ("",)], "page_text string")
    assert [(r.is_blank, r.is_empty, r.n_lines) for r in pages.flags(df).collect()] == [(True, False, 0), (False, True, 0), (False, False, 1), (False, True, 0)]


def test_tags_keep_what_the_text_says(spark):
    rows = spark.createDataFrame([("See AO 2015-0017.", None, "DC_2020-0001.pdf", "guideline_policy"), (None, None, None, None)], "claim_text string, snippet string, filename string, document_type string")
    first, nothing = policy.tags(rows).collect()
    assert (first.policy_type, first.policy_reference, first.policy_type_from) == ("administrative_order", "2015-0017", "text")
    assert first.structured and not nothing.structured and nothing.policy_type is None


def test_year_end_takes_the_newest_readable_file(spark):
    rows = spark.createDataFrame([("a", 2023, 6, "NCR", 1.0), ("b", 2023, 9, "NCR", 2.0), ("b", 2023, 9, "CAR", 3.0)], "filename string, year int, month int, region string, alive double")
    assert {(r.filename, r.region) for r in boards.year_end(rows).collect()} == {("b", "NCR"), ("b", "CAR")}
    observed = spark.createDataFrame([(2023, "NCR", "alive", 9.0, 202309, 0.5)], "year int, region string, metric string, value double, sort_key int, confidence double")
    filled = spark.createDataFrame([(2023, "NCR", "alive", 1.0), (2023, "CAR", "ltfu", 4.0)], "year int, region string, metric string, value double")
    got = {r.region: r for r in boards.leakage_by_year(observed, filled).collect()}
    assert got["NCR"].alive == 9.0 and got["NCR"].missing_not_on_treatment and not got["NCR"].proxy
    assert got["CAR"].ltfu == 4.0 and got["CAR"].place == 1


def test_total_skips_what_is_no_number(spark):
    assert spark.range(1).select(blocks.total(F.array(F.lit("1,200"), F.lit("5%"), F.lit("x")))).first()[0] == 1205.0
