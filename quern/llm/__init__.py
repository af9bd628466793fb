"""Operators for training-data pipelines, with the queries that apply each to its whole table."""

from importlib import import_module

_MODULES = ("langid", "html_crf", "hnsw", "pii", "imatch", "chat", "sharding", "sentencepiece", "minhash", "mixing", "packing", "runs", "alignment")


def queries():
    return {k: q for m in _MODULES for k, q in import_module(f"{__name__}.{m}").QUERIES.items()}


def oracle_sql():
    return {k: q for m in _MODULES for k, q in import_module(f"{__name__}.{m}").ORACLE.items()}
