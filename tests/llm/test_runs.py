"""Periodic runs of words against brute force over every period, and the collapsed texts."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from quern.llm import runs

WORD = re.compile(r"[^ \x09-\x0D]+")


def brute(words, least=24, power=3):
    """Every maximal stretch of words equal at each distance, kept where no smaller distance does as well."""
    n, found = len(words), []
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            end = i + q
            length = end - start
            smaller = any(all(words[k] == words[k + d] for k in range(start, end - d)) for d in range(1, q))
            if length >= max(least, power * q) and not smaller:
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, found):
    dropped = {k for start, length, q in found for k in range(start + q, start + length)}
    return " ".join(w for k, w in enumerate(words) if k not in dropped)


def ours(text, **limits):
    data = np.frombuffer(text.encode(), np.uint8)
    found, n, begin, end = runs.text_runs(data, **limits)
    return found, runs.collapsed(data, begin, end, found).decode()


def made(rng):
    """A text of few different words with planted repeats of several periods, some overlapping."""
    words = []
    for _ in range(rng.randint(1, 5)):
        alphabet = ["a", "bb", "ccc", "é", "東京"][: rng.randint(1, 5)]
        block = [rng.choice(alphabet) for _ in range(rng.randint(1, 14))]
        words += (block * rng.randint(1, 30))[: rng.randint(1, 160)]
    return words


@pytest.mark.parametrize("seed", range(120))
def test_against_brute_force(seed):
    rng = random.Random(seed)
    words = made(rng)
    text = "".join(w + rng.choice([" ", "  ", "\n", "\t\r"]) for w in words)
    want = brute(words)
    assert ours(text) == (want, brute_collapsed(words, want))


@pytest.mark.parametrize(("least", "power"), [(6, 2), (4, 4), (1, 2), (30, 3)])
def test_other_limits(least, power):
    rng = random.Random(least * 10 + power)
    for _ in range(40):
        words = made(rng)[:120]
        assert ours(" ".join(words), least=least, power=power)[0] == brute(words, least, power)


def test_fibonacci_and_thue_morse_words():
    a, b = "a", "ab"
    while len(b) < 400:
        a, b = b, b + a
    tm = "".join("ab"[bin(k).count("1") % 2] for k in range(300))
    for letters in (b[:400], tm, "ab" * 30 + tm + "ba" * 40):
        assert ours(" ".join(letters))[0] == brute(list(letters))


def test_equal_hashes_of_unlike_words_are_told_apart(monkeypatch):
    monkeypatch.setattr(runs, "word_hashes", lambda data, begin, end: (end - begin).astype(np.uint64))
    words = ["ab", "cd", "ef"] * 20 + ["ab", "xy"] * 20
    assert ours(" ".join(words))[0] == brute(words)


def test_long_texts():
    rng = random.Random(1)
    prose = [str(rng.random()) for _ in range(60_000)]
    text = " ".join(prose[:30_000] + ["x"] * 40_000 + prose[30_000:] + prose[:50] * 4)
    found, _ = ours(text)
    assert found == [(30_000, 40_000, 1), (100_000, 200, 50)] or found == brute(text.split(" "))
    assert ours("y" * 3_000_000 + " " + "z " * 30)[0] == [(1, 30, 1)]
    assert ours(" ".join(["w" * 2_500_000] * 24))[0] == [(0, 24, 1)]


def expected(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def test_query_on_a_table(spark):
    from quern.llm import queries

    rows = {r.doc_id: r for r in queries()["op13_lcp_runs"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(rows) == len({d.doc_id for d in docs})
    some = 0
    for d in docs:
        words, r = expected(d.doc_id, d.text), rows[d.doc_id]
        ids = {w: k for k, w in enumerate(dict.fromkeys(words))}
        want = brute([ids[w] for w in words]) if len(words) < 1500 else ours(" ".join(words))[0]
        assert r.n_runs == len(want)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in want).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(words, want).encode()).hexdigest()
        best = min(want, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        some += bool(want)
    assert some > 10


def test_odd_rows(spark):
    rows = [(1, None), (1, ""), (None, "a " * 30), (2, " \t\n"), (2, "a " * 30), (2, "a " * 30)]
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, runs string, n_words int")
    got = runs.detect(docs).collect()
    assert sorted((r.n_words, len(r.runs), r.collapsed) for r in got) == [(0, 0, "")] * 3 + [(30, 1, "a")] * 3
    assert runs.detect(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_ties_of_the_strongest_run(spark):
    df = spark.sql("select array(named_struct('start', 9L, 'length', 30L, 'period', 5L), named_struct('start', 4L, 'length', 60L, 'period', 10L), named_struct('start', 4L, 'length', 36L, 'period', 6L)) as runs")
    assert df.select(runs.strongest(df.runs).alias("b")).first().b.asDict() == {"start": 4, "length": 36, "period": 6}
