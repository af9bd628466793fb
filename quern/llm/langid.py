"""Language identification in two steps: family first, then one against one inside the family.

Features are letter bigrams and trigrams (lower-case; any run of other characters is one space), hashed
into ``SLOTS`` and counted relative to the text's length. Linear support vector machines (dual
coordinate descent) tell families apart and, inside a family, each pair of languages; votes decide,
then margins. A text's margin is the mean of the weights of its n-grams, so whole texts of any length
are scored in one vectorised pass with a table of weights that is a constant size.

Fitting uses at most SAMPLE labelled documents of each language (the first by a hash of doc_id and text);
their features, not their texts, come to the driver. That bound is the only one: every language is
learned, and prediction reads every whole text.

Defined results: null text or text without letters is ``und`` with score 0; with no labelled text every
document is ``und``; with one language all others are it, with score 1; a null doc_id counts as in
training; repeated rows are each predicted; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import store, table

SLOTS = 1 << 15
SAMPLE = 400
#: Counts of up to so many languages are broadcast.
FEW_LANGS = 10_000
#: Language families by ISO 639-1 code. A language not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl da sv no nb nn is af lb fy".split(),
    "romance": "fr es it pt ro ca gl oc".split(),
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz ky".split(),
    "indo-aryan": "hi ur bn pa mr gu ne".split(),
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}
#: Slope of the logistic curve that turns a margin into a score.
SLOPE = 3.0
_CHUNK = 1 << 18


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slot of every bigram and trigram of the texts, and where each text's slots begin (with the end)."""
    lowered = [t.lower() for t in texts]
    c = np.frombuffer("".join(f"\0{t}\0" for t in lowered).encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(t) + 2 for t in lowered])
    letter = _letters()[c]
    first = np.zeros(len(c), bool)
    first[ends[:-1]] = first[0] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep |= first
    # a text's first place is kept and counts as a space; what follows a letter is one too
    c = np.where(letter, c, 32)[keep].astype(np.uint32)
    starts = np.flatnonzero(first[keep])
    n = np.diff(np.append(starts, len(c)))
    two, three = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA6B), None
    three = two[:-1] * np.uint32(0xC2B2AE35) + c[2:] * np.uint32(0x27D4EB2F) + np.uint32(1)
    mix = lambda h: ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(17)).astype(np.int32)
    # n-grams that reach into the next text are left out
    tail = np.zeros(len(c) + 1, bool)
    tail[starts + n - 1] = True
    inside2 = ~tail[: len(c) - 1]
    inside3 = ~(tail[: len(c) - 2] | tail[1 : len(c) - 1])
    slots = np.concatenate([mix(two)[inside2], mix(three)[inside3]])
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), n)
    owner = np.concatenate([owner[: len(c) - 1][inside2], owner[: len(c) - 2][inside3]])
    return slots, owner


def chunks(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= _CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def margins(texts: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean weight of each text's n-grams for each row of ``weights``, and the number of n-grams."""
    out, counts = [], []
    for part in chunks(texts):
        slots, owner = _grams(part)
        n = np.bincount(owner, minlength=len(part))
        out.append(np.stack([np.bincount(owner, weights=w[slots], minlength=len(part)) for w in weights], 1) / np.maximum(n, 1)[:, None] if len(weights) else np.zeros((len(part), 0)))
        counts.append(n)
    return (np.concatenate(out), np.concatenate(counts)) if out else (np.zeros((0, len(weights))), np.zeros(0, int))


def svm(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last one is the bias) of a squared-hinge linear SVM by dual coordinate descent."""
    w, alpha = np.zeros(SLOTS + 1), np.zeros(len(y))
    norms = np.array([float(v @ v) + 1.0 for _, v in rows])
    order = np.random.default_rng(0)
    for _ in range(rounds):
        largest = 0.0
        for i in order.permutation(len(y)):
            idx, val = rows[i]
            gradient = y[i] * (w[idx] @ val + w[-1]) - 1 + alpha[i] / (2 * cost)
            new = max(alpha[i] - gradient / (norms[i] + 1 / (2 * cost)), 0.0)
            step = (new - alpha[i]) * y[i]
            if step:
                w[idx] += step * val
                w[-1] += step
                largest = max(largest, abs(step))
            alpha[i] = new
        if largest < 1e-3:
            break
    return w


class Model:
    """Families, their languages, and one weight row for each pair of families and each pair inside a family."""

    def __init__(self, langs: list[str], family: dict[str, str] = FAMILY):
        self.langs = sorted(langs)
        groups: dict[str, list[str]] = {}
        for code in self.langs:
            groups.setdefault(family.get(code, code), []).append(code)
        self.families = dict(sorted(groups.items()))
        names = list(self.families)
        self.pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
        self.pairs += [(a, b) for codes in self.families.values() for i, a in enumerate(codes) for b in codes[i + 1 :]]
        self.weights, self.bias = np.zeros((len(self.pairs), SLOTS)), np.zeros(len(self.pairs))
        self.scale = 100.0

    def members(self, side: str) -> set[str]:
        return set(self.families.get(side, [])) | {side}

    def fit(self, labels: list[str], rows: list[tuple[np.ndarray, np.ndarray]]) -> Model:
        for k, (a, b) in enumerate(self.pairs):
            of_a, of_b = self.members(a), self.members(b)
            use = [i for i, lang in enumerate(labels) if lang in of_a | of_b]
            w = svm([(rows[i][0], rows[i][1] * self.scale) for i in use], np.array([1.0 if labels[i] in of_a else -1.0 for i in use]))
            self.weights[k], self.bias[k] = w[:-1] * self.scale, w[-1]
        return self

    def _vote(self, sides: list[str], m: dict[tuple[str, str], np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Winner's index and its smallest margin, for each text; votes first, then summed margins, then order."""
        if len(sides) == 1:
            return np.zeros(n, int), np.full(n, np.inf)
        won, total, least = np.zeros((len(sides), n)), np.zeros((len(sides), n)), np.full((len(sides), n), np.inf)
        for i, a in enumerate(sides):
            for j in range(i + 1, len(sides)):
                v = m[a, sides[j]]
                for side, signed in ((i, v), (j, -v)):
                    won[side] += signed > 0 if side == j else signed >= 0
                    total[side] += np.tanh(signed)
                    least[side] = np.minimum(least[side], signed)
        best = np.argmax(won * 1e3 + total, 0)
        return best, least[best, np.arange(n)]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        texts = [t or "" for t in texts]
        values, grams = margins(texts, self.weights)
        m = {pair: values[:, k] + self.bias[k] for k, pair in enumerate(self.pairs)}
        n = len(texts)
        names = list(self.families)
        lang, score = np.full(n, "und", object), np.zeros(n)
        if not names:
            return lang.tolist(), score
        family, margin = self._vote(names, m, n)
        for f, name in enumerate(names):
            codes = self.families[name]
            inner, inner_margin = self._vote(codes, m, n)
            here = family == f
            lang[here] = np.array(codes, object)[inner[here]]
            score[here] = 1 / (1 + np.exp(-SLOPE * np.minimum(margin, inner_margin)[here]))
        lang[grams == 0], score[grams == 0] = "und", 0.0
        return lang.tolist(), score


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            slots, _ = _grams([text])
            if len(slots):
                idx, n = np.unique(slots, return_counts=True)
                yield pd.DataFrame({"lang": [lang], "idx": [idx.astype(np.int32).tobytes()], "val": [(n / n.sum()).astype(np.float32).tobytes()]})


def drawn(labelled: DataFrame, sample: int) -> DataFrame:
    """lang and text of the ``sample`` rows of each language that come first by a hash of doc_id and text.

    Rows are first thinned to about twice the sample by the same hash (so the ranking sees few), then ranked;
    rows alike in doc_id and text count once.
    """
    mark = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1)
    marked = labelled.select("lang", "text", mark.alias("mark"))
    per_lang = store(marked.groupBy("lang").agg(F.approx_count_distinct("mark").alias("n")), "langs")
    thinned = marked.join(F.broadcast(per_lang) if per_lang.count() <= FEW_LANGS else per_lang, "lang").where(F.col("mark") / float(1 << 63) <= F.lit(2.0 * sample + 100) / F.col("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("mark"))
    return thinned.select("lang", "text", "mark").distinct().withColumn("rank", rank).where(F.col("rank") <= sample).select("lang", "text")


def train(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` rows (doc_id, text, lang) of each language."""
    got = drawn(labelled, sample).mapInPandas(_features, "lang string, idx binary, val binary").toPandas().sort_values(["lang", "idx", "val"])
    rows = [(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32).astype(float)) for i, v in zip(got["idx"], got["val"], strict=True)]
    return Model(sorted(set(got["lang"]))).fit(list(got["lang"]), rows)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.drop("lang_pred", "score").schema.add("lang_pred", "string").add("score", "double")
    columns = [f.name for f in schema.fields][:-2]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                lang, score = shared.value.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), pa.array(lang, pa.string()), pa.array(score)], [*columns, "lang_pred", "score"])

    return docs.drop("lang_pred", "score").mapInArrow(run, schema)


def labelled(docs: DataFrame) -> DataFrame:
    return docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")


def op1_family_then_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(labelled(docs))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")


QUERIES = {"op1_family_then_pair": op1_family_then_pair}
ORACLE: dict[str, str] = {}
