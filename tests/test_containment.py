"""Passages in documents against brute force over every pair."""

import pytest

from quern.operators.quality import longest_common
from quern.plans import QUERIES

PASSAGE = "The quick brown fox jumps over the lazy dog while seven wizards quietly mix potions in the old stone tower near the river."
ITEMS = [(1, PASSAGE), (2, "alpha beta"), (3, "one two three four five"), (4, "東京都の人口は千四百万人です"), (5, "naïve café au lait très bon et chaud"), (6, "...wide open plains beyond the far hills..."), (7, None)]
DOCUMENTS = [
    (1, f"Someone said, and rightly so, that {PASSAGE[:1].lower()}{PASSAGE[1:]} Others disagree."), (2, PASSAGE.upper()), (3, PASSAGE.replace(" ", "  \n")), (4, "X" + PASSAGE[1:]), (5, PASSAGE[:8] + "#" + PASSAGE[9:]),
    (6, "see ALPHA beta there"), (7, "xalpha betax"), (8, "none two three four fiveteen"), (9, "記事: 東京都の人口は千四百万人です。"), (10, "un Naïve café au lait très bon et chaudement"), (11, "the...wide open plains beyond the far hills...."), (12, None), (13, ""), (14, "alpha  beta"),
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("containment"))
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame(DOCUMENTS, "doc_id long, text string").write.parquet(f"{at}/documents.parquet")
    return at


def test_containment_finds_short_passages_other_scripts_and_cut_words(spark, tables):
    want = {(i, k) for i, p in ITEMS for k, t in DOCUMENTS if p is not None and t is not None and p.lower() in t.lower()}
    got = [tuple(r) for r in QUERIES["q1_containment"](spark, tables).select("item_id", "doc_id").collect()]
    assert sorted(got) == sorted(want) and {(2, 7), (3, 8), (4, 9)} <= want


def test_fuzzy_containment_finds_passages_wherever_they_stand(spark, tables):
    even = lambda t: " ".join(t.lower().split())
    want = {(i, k): round(longest_common(even(t), even(p)) / len(even(p)), 4) for i, p in ITEMS for k, t in DOCUMENTS if p and t}
    rows = QUERIES["q2_fuzzy_containment"](spark, tables).collect()
    got = {(r.item_id, r.doc_id): r.share for r in rows}
    assert len(got) == len(rows) and all(want[pair] == share for pair, share in got.items())
    assert {pair for pair, share in want.items() if share >= 0.95} <= set(got)
    assert got[1, 1] == got[1, 2] == got[1, 3] == 1.0 and got[1, 4] > 0.95 and 0.9 < got[1, 5] < 0.95
