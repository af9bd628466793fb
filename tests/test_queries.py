"""Every registered query that has an oracle equals it at the smallest scale; the others give rows."""

import os
from collections import Counter

import duckdb
import pytest

from quern import plans
from quern.plans.registry import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return f"{v:.8g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19]
    return str(v)


def bag(rows, names, order):
    at = [names.index(c) for c in order]
    return Counter(tuple(plain(r[i]) for i in at) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    duck.execute(ORACLES[name])
    names, rows = [d[0] for d in duck.description], duck.fetchall()
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    assert bag(df.collect(), df.columns, order) == bag(rows, names, order)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_registry_is_reached_through_the_entry_module():
    import __spark_entry__

    assert set(plans.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert os.path.exists(__spark_entry__.__file__)
