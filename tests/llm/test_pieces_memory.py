"""Python workers outlive their tasks: what the encoder remembers must not."""

import public_tokenizers
from pyspark.sql import functions as F

from quern.llm import sentencepiece
from quern.llm._common import table


def test_workers_remember_no_words_after_encoding(spark, sf):
    model = sentencepiece.read_model(public_tokenizers.path(sentencepiece.MODEL))
    docs = table(spark, sf, "documents").repartition(4)
    encoded = sentencepiece.encode(docs, model).agg(F.sum(F.size("ids")).alias("n")).first().n
    assert encoded > 0

    def left(batches):
        import pyarrow as pa

        words = sentencepiece.codec(model).words
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(words.known) + len(words.again)] * batch.num_rows, pa.int64())], ["n"])

    assert spark.range(64).repartition(16).mapInArrow(left, "n long").agg(F.max("n")).first()[0] == 0
