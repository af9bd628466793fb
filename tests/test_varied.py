"""Merges and look-ups of yearly series and lists against brute force, with nulls, ties and empty sides."""

import random

from pyspark.sql import functions as F

from quern.operators import chunks, resolve, series
from quern.sources import readers


def brute_merge(structured, extracted, low, high):
    best = lambda rows: {k: max((s, v) for kk, y, s, v in rows if (kk, y) == k and v is not None) for k in {(kk, y) for kk, y, _, v in rows if v is not None}}
    known, more = best(structured), best(extracted)
    for key, year in sorted(more):
        sort, value = more[key, year]
        now, before = known.get((key, year)), known.get((key, year - 1))
        if now is None:
            ok = low <= value <= high if before is None else before[1] * 0.8 <= value <= before[1] * 1.35
        else:
            ok = now[1] * 0.8 <= value <= now[1] * 1.25 and sort > now[0]
        if ok:
            known[key, year] = (sort, value)
    return sorted((k, y, s, v) for (k, y), (s, v) in known.items())


def test_plausible_merge(spark):
    rng = random.Random(3)
    rows = lambda n: [(rng.choice("ab"), rng.randint(2000, 2012), rng.randint(1, 12), rng.choice([None, *map(float, range(60, 260, 7))])) for _ in range(n)]
    schema = "key string, year int, sort_key int, value double"
    for n, m in ((0, 12), (12, 0), (20, 40), (6, 90)):
        a, b = rows(n), [(k, y, s, v) for k, y, s, v in rows(m)]
        got = series.plausible_merge(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["key"], 100, 200)
        assert sorted((r.key, r.year, r.sort_key, r.value) for r in got.collect()) == brute_merge(a, b, 100, 200)


def test_first_source(spark):
    schema = "key string, value double"
    one, two = spark.createDataFrame([("a", 1.0), ("b", None)], schema), spark.createDataFrame([("b", 2.0), ("a", 9.0), ("c", None)], schema)
    assert sorted(map(tuple, series.first_source([one, two], ["key"]).collect())) == [("a", 1.0, 0), ("b", 2.0, 1)]


def test_aliases_and_appends(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, None), (5, "y"), (2, "x")], "id int, hash string")
    assert sorted(map(tuple, resolve.aliases(rows, "hash", "id").collect())) == [(2, 1), (2, 1)]
    out = resolve.appended(rows, spark.createDataFrame([(9,)], "id int"))
    assert out.where("id = 9").first().hash is None and out.count() == 7


def test_listed_keeps_order_and_repeats(spark):
    holders = spark.createDataFrame([("f", [3, 1, 3, 8]), ("g", []), ("h", None)], "key string, ids array<int>")
    items = spark.createDataFrame([(1, "one"), (3, "three")], "id int, name string")
    got = {r.key: r.name for r in resolve.listed(holders, items, "ids", "id", "name").select("key", "name").collect()}
    assert got == {"f": ["three", "one", "three"], "g": [], "h": []}


def test_month_tokens(spark):
    got = spark.createDataFrame([("MAY to june, mayor",), (None,), ("",)], "t string").select(chunks.month_tokens(F.col("t")).alias("m")).collect()
    assert [r.m for r in got] == [["may", "june"], None, []]


def test_official_series_of_one_area(spark):
    rows = spark.createDataFrame([("x", 2011, "all", "f", 1.0), ("x", 2009, "all", "f", 1.0), ("x", 2012, "one", "f", 1.0), ("y", 2012, "all", "f", 1.0), ("x", 2012, "all", "m", 1.0), ("x", 2013, "all", "f", None)], "indicator string, year int, area string, subgroup string, value double")
    assert [r.year for r in readers.official_series(rows, ["x"], 2010, "all", "f").collect()] == [2011]
    assert readers.official_series(rows, ["x", "y"]).count() == 4
