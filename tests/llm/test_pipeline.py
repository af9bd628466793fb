"""Every pipeline stage on its own: what it keeps, its columns, and rows that are null, empty, repeated or long."""

import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from quern.llm._common import table

from .test_operators import EDGES, SCHEMA, brute_components, brute_pii

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(EDGES, SCHEMA).withColumn("n_chars", F.length("text").cast("long"))


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_stage_keeps_the_columns_and_survives_odd_rows(spark, sf, odd, name):
    out = STAGES[name](spark, odd, sf)
    assert out.columns == odd.columns and out.count() >= 0
    assert STAGES[name](spark, odd.where("false"), sf).count() == 0


def test_language_stage_drops_only_texts_without_letters(spark, sf, odd):
    kept = [r.text for r in STAGES["language ID"](spark, odd, sf).collect()]
    assert sorted(kept) == sorted(t for _, t, *_ in EDGES if t and any(c.isalpha() for c in t))


def test_dedup_stage_keeps_one_of_each_group(spark, sf):
    docs = table(spark, sf, "documents")
    kept = STAGES["MinHash near-dedup"](spark, docs, sf)
    wanted = {c for c in brute_components([(r.doc_id, r.text) for r in docs.collect()], corpus_pipeline.PERCENT).values()}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted(wanted)


def test_redaction_stage_keeps_documents(spark, sf):
    docs = table(spark, sf, "documents")
    before, after = ({r.doc_id: r.text for r in df.collect()} for df in (docs, STAGES["personal data"](spark, docs, sf)))
    assert before.keys() == after.keys()
    assert all(brute_pii(t) == "" for t in after.values())
    assert all(after[k] == t for k, t in before.items() if brute_pii(t) == "" and not re.search(r"[A-Z]{2}\d\d|\d{3}-\d\d-", t))


def test_mixing_stage_repeats_within_the_cap(spark, sf):
    docs = table(spark, sf, "documents")
    times = STAGES["source mixing"](spark, docs, sf).groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert times <= 2


def test_run_encodes_what_the_stages_leave(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 0 and out.where("bytes_covered != bytes_decoded").count() == 0
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_dedup_stage_keeps_the_different_texts_of_one_id(spark, sf):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a, "en", "s"), (1, a, "en", "s"), (2, b, "en", "s"), (2, c, "en", "s"), (3, b, "en", "s"), (4, c + " more", "en", "s"), (5, a, "en", "s"), (None, a, "en", "s")]
    got = STAGES["MinHash near-dedup"](spark, spark.createDataFrame(rows, SCHEMA), sf)
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == sorted([(1, a), (2, b), (2, c), (3, b), (4, c + " more"), (0, a)])


def test_encoding_stage_takes_odd_rows(spark, sf, odd):
    got = STAGES["SentencePiece"](spark, odd, sf).collect()
    assert sorted((r.doc_id or 0, r.bytes_covered) for r in got) == sorted((d or 0, len((t or "").encode())) for d, t, *_ in EDGES)
    assert all(r.n_tokens == len(r.ids) for r in got)
    assert STAGES["SentencePiece"](spark, odd.where("false"), sf).count() == 0
