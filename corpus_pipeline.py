"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. ``run`` writes each stage's result as Parquet in the shared folder and hands it, reread,
to the next, so a lost executor never costs more than the stage it was in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm import langid, minhash, mixing, pii, sentencepiece
from quern.llm._common import store, table


#: Near copies are texts whose sets of five-word shingles are alike by 0.80 or more (the thin query of the operator takes 0.85).
PERCENT = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language can be told (no letters, or null) go; a missing lang is filled in."""
    model = langid.train(langid.labelled(docs))
    named = langid.identify(docs.withColumnsRenamed({c: f"in_{c}" for c in docs.columns if c in ("lang_pred", "score")}), model)
    return named.where("lang_pred != 'und'").withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (similarity of PERCENT or more) the document with the smallest doc_id stays, once.

    Rows without a doc_id all stay, and so do the different texts of a doc_id that names several.
    """
    texts = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("lo"), F.max(F.xxhash64("text")).alias("hi"))
    several = store(texts.where("lo != hi").select("doc_id"), "several")
    some = not several.isEmpty()
    one = docs.join(several, "doc_id", "left_anti") if some else docs
    kept = minhash.near_duplicates(one, PERCENT).where("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.join(kept.unionByName(several) if some else kept, "doc_id", "left_semi").withColumn("__text", F.xxhash64("text"))
    once = named.withColumn("__row", F.row_number().over(Window.partitionBy("doc_id", "__text").orderBy("text"))).where("__row = 1").select(*docs.columns)
    return once.unionByName(docs.where("doc_id is null").select(*docs.columns))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts become ``[KIND]``; no document goes."""
    return pii.redact(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, or go, as often as the mix to the sources' target weights takes them."""
    return mixing.repeated(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and how many bytes the pieces cover and the decoded text has; a null or empty text has no ids, repeated rows are each encoded."""
    import public_tokenizers

    model = sentencepiece.read_model(public_tokenizers.path(sentencepiece.MODEL))
    encoded = sentencepiece.encode(docs, model)
    covered = F.coalesce(F.get("ends", F.size("ends") - 1), F.lit(0))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", covered.cast("long").alias("bytes_covered"), F.octet_length("decoded").cast("long").alias("bytes_decoded"))


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("personal data", redact_personal_data),
    ("source mixing", mix_sources),
    ("SentencePiece", encode_pieces),
]

#: Language models, MinHash and SentencePiece can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
