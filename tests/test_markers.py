"""Many markers in one pass against nested ``contains``, at lane borders, with odd rows, and in several blocks."""

import random
import time

import numpy as np
import pytest

from quern.operators import markers


def nested(texts, words):
    return [sorted(k for k, w in enumerate(words) if t is not None and w is not None and w in t) for t in texts]


def ours(spark, texts, words):
    df = spark.createDataFrame([(k, t, 7) for k, t in enumerate(texts)], "id long, text string, found int").repartition(3)
    table = spark.createDataFrame(list(enumerate(words)), "id long, marker string")
    rows = {r.id: list(r.found) for r in markers.contained(df, "text", table).collect()}
    assert rows == {r.id: list(r.found) for r in markers.of_list(df, "text", words).collect()}
    return [rows[k] for k in range(len(texts))]


@pytest.mark.parametrize("seed", range(6))
def test_against_nested_contains(spark, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(markers, "LANE", 16)
    word = lambda n: "".join(rng.choice("abé東") for _ in range(n))
    words = list(dict.fromkeys(word(rng.randint(1, 9)) for _ in range(200)))
    texts = [None, "", *(word(rng.randint(0, 120)) for _ in range(60))]
    if seed % 2:
        monkeypatch.setattr(markers, "TABLE", 1 << 17)  # several automata
    assert ours(spark, texts, words) == nested(texts, words)


def test_empty_null_and_equal_markers(spark):
    assert ours(spark, ["ab", None, ""], ["b", None, "", "b", "ab"]) == [[0, 2, 4], [], [2]]
    assert ours(spark, ["ab"], []) == [[]]
    assert markers.of_list(spark.createDataFrame([], "text string"), "text", ["a"]).count() == 0


def test_lanes_meet():
    machine = markers.Automaton([b"needle", b"dle", b"e"])
    text = b"x" * (markers.LANE - 3) + b"needle" + b"y" * (2 * markers.LANE) + b"needle"
    data = np.frombuffer(text, np.uint8)
    found = sorted(zip(*(x.tolist() for x in machine.scan(data, np.array([0, len(text)]))), strict=True))
    want = sorted((0, k, i + len(m)) for k, m in enumerate((b"needle", b"dle", b"e")) for i in range(len(text)) if text.startswith(m, i))
    assert found == want


def test_time_hardly_grows_with_the_markers():
    rng = random.Random(0)
    word = lambda: "".join(rng.choice("etaoinshrdlu ") for _ in range(12)).encode()
    text = b" ".join(word() for _ in range(300_000))
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    took = []
    for n in (100, 10_000):
        machine = markers.Automaton(list({word() for _ in range(n)}))
        began = time.process_time()
        machine.scan(data, offsets)
        took.append(time.process_time() - began)
    assert took[1] < 4 * took[0] + 1
