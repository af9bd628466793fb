"""The fit's sample: bounded a language, whatever ids are, and no language left out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import langid


def test_every_language_is_drawn_within_the_bound(spark):
    many = spark.range(6000).select("id", F.concat(F.lit("l"), F.col("id") % 1200).alias("lang"))
    hot = spark.range(3000).select(F.lit(None).cast("long").alias("id"), F.lit("hot").alias("lang"))
    same = spark.range(3000).select(F.lit(7).cast("long").alias("id"), F.lit("same").alias("lang"))
    rows = many.unionByName(hot).withColumn("text", F.concat(F.lit("text "), F.monotonically_increasing_id()))
    rows = rows.unionByName(same.withColumn("text", F.lit("one text"))).withColumnRenamed("id", "doc_id")
    n = {r.lang: r["count"] for r in langid.drawn(rows, 3).groupBy("lang").count().collect()}
    assert len(n) == 1202 and n["hot"] == 3 and n["same"] == 1 and max(n.values()) == 3 and min(n[f"l{k}"] for k in range(1200)) == 3


def test_two_steps_equal_plain_machines():
    """Families and pairs against a brute-force run: each machine solved by Newton steps on the same objective."""
    texts = {"en": "the cat sat on the mat and this that with", "nl": "de kat zat op het matje en dit dat met een", "fr": "le chat est sur les tapis avec une des", "es": "el gato esta sobre los tapices con una de"}
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for lang, words in texts.items():
        for _ in range(12):
            text = " ".join(rng.choice(words.split(), 30))
            slots, _ = langid._grams([text])
            idx, n = np.unique(slots, return_counts=True)
            rows.append((idx, n / n.sum()))
            labels.append(lang)
    model = langid.Model(sorted(texts)).fit(labels, rows)
    used = np.unique(np.concatenate([i for i, _ in rows]))
    at = {int(s): k for k, s in enumerate(used)}
    dense = np.zeros((len(rows), len(used) + 1))
    for r, (idx, val) in enumerate(rows):
        dense[r, [at[int(i)] for i in idx]] = val * model.scale
    dense[:, -1] = 1
    for k, (a, b) in enumerate(model.pairs):
        of_a, of_b = model.members(a), model.members(b)
        use = [i for i, lang in enumerate(labels) if lang in of_a | of_b]
        x, y = dense[use], np.array([1.0 if labels[i] in of_a else -1.0 for i in use])
        w = np.zeros(x.shape[1])
        for _ in range(50):
            on = 1 - y * (x @ w) > 0
            w = np.linalg.solve(np.eye(x.shape[1]) + 20 * x[on].T @ x[on], 20 * x[on].T @ y[on])
        mine = x[:, :-1] @ (model.weights[k][used] / model.scale) + model.bias[k]
        assert np.corrcoef(mine, x @ w)[0, 1] > 0.98, (a, b)
        assert ((mine > 0) == (x @ w > 0)).all()
    sides = {"en": "germanic", "nl": "germanic", "fr": "romance", "es": "romance"}
    got, _ = model.predict([" ".join(t.split()) for t in texts.values()])
    assert got == list(texts) and {model_family for model_family in model.families} == set(sides.values())


def test_ties_go_to_the_first_in_order():
    model = langid.Model(["xx", "yy"])
    assert model.predict(["abc abc", "", None])[0] == ["xx", "und", "und"]
    assert model.predict(["abc"])[1][0] == pytest.approx(0.5)
