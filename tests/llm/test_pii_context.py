"""Context words count within the whole window before and after a span, also across earlier matches."""

import random
import re

from quern.llm import pii

SSN = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")


def brute(text):
    return [m for m in SSN.finditer(text) if re.search("ssn|social security", (text[max(0, m.start() - pii.WINDOW) : m.start()] + " " + text[m.end() : m.end() + pii.WINDOW]).lower())]


def test_numbers_after_the_first_keep_their_context(spark):
    rng = random.Random(3)
    words = ["SSN", "ssn:", "social security", "no", "🙂", "and more", ", ", "a rather long stretch of other words", *[f"{n}-45-6789 or" for n in (123, 234, 345, 456)]]  # adjacent numbers could be a card
    texts = ["SSN 123-45-6789, 234-56-7890", "SSN 123-45-6789 " + "x" * 40 + " 234-56-7890", "123-45-6789 SSN"] + [" ".join(rng.choices(words, k=14)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: [(s.start, s.stop) for s in r.spans if s.kind == "ssn"] for r in pii.detect(df).collect()}
    redacted = {r.doc_id: r.text for r in pii.redact(df).collect()}
    for k, text in enumerate(texts):
        found = brute(text)
        assert spans[k] == [m.span() for m in found], text
        want = text
        for m in reversed(found):
            want = want[: m.start()] + "[SSN]" + want[m.end() :]
        assert redacted[k] == want
    assert redacted[0] == "SSN [SSN], [SSN]" and len(spans[1]) == 1 and len(spans[2]) == 1


def test_an_unconfirmed_match_does_not_cut_the_context(spark):
    df = spark.createDataFrame([(1, "card no 12, 4111111111111111")], "doc_id long, text string")
    assert [(s.kind, s.score) for s in pii.detect(df).first().spans] == [("card", 1.0)]


def test_an_iban_ends_where_its_country_says(spark):
    rows = [(1, "BE68 5390 0754 7034 PAID"), (2, "BE68539007547034PAID"), (3, "DE89 3704 0044 0532 0130 00, GB82WEST12345698765432"), (4, "XX68 5390 0754 7034")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in pii.redact(df).collect()} == {1: "[IBAN] PAID", 2: rows[1][1], 3: "[IBAN], [IBAN]", 4: rows[3][1]}


def test_overlapping_kinds_go_together(spark):
    text = "mail +12125551234@x.yz now 4111 1111 1111 1111"
    r = pii.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r.text == "mail [EMAIL] now [CARD]"


def test_long_texts_take_time_in_proportion(spark):
    import time

    for text, n in (("12," * 330_000, 0), ("m1@x.yz " * 40_000, 40_000), ("SSN 123-45-6789, " * 20_000, 20_000)):
        began = time.time()
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        assert len(pii.detect(df).first().spans) == n
        assert n == 0 or pii.redact(df).first().text.count("[") == n
        assert time.time() - began < 60, text[:20]
