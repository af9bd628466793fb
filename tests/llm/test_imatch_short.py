"""Short texts that the sparse lexicons keep nothing of still differ."""

from pyspark.sql import functions as F

from quern.llm import imatch


def test_short_texts_have_fingerprints_of_their_own(spark):
    rows = [(k, f"word{k}") for k in range(300)] + [(300, "word7"), (301, ""), (302, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = imatch.fingerprints(docs).select("doc_id", imatch.shown("text_fp").alias("fp"), imatch.likeness("text_fp", "next_fp").alias("next"), F.size("text_fp").alias("n")).collect()
    fp, near = {r.doc_id: r.fp for r in found}, {r.doc_id: r.next for r in found}
    assert len({fp[k] for k in range(300)}) == 300 and fp[300] == fp[7] and fp[301] == fp[302]
    assert all(near[k] == 0.0 for k in range(1, 300)) and near[302] == 1.0
    assert {r.n for r in found} == {len(imatch.RATES) * imatch.REPEATS + 1}
