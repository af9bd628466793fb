"""Where queries register: a name, a callable (spark, sf_dir) -> DataFrame and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, *ctes: str) -> Callable[[Query], Query]:
    """Register under the function's name; ``ctes`` go before the oracle's SELECT."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = (f"WITH {', '.join(ctes)} " if ctes else "") + oracle
        return f

    return add
