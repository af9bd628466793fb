"""Each operator against brute force on small data, and on rows that are null, empty, long, repeated, tied or oddly named."""

import hashlib
import html
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern.llm import chat, hnsw, html_crf, imatch, langid, minhash, mixing, pii, sentencepiece, sharding
from quern.llm._common import table

LONG = "the quick brown fox " * 20_000
#: null, empty, blank, repeated, tied, very long, unusual texts; extra columns whose names operators use inside.
EDGES = [
    (1, None, "en", "a"), (2, "", "en", None), (3, "   \n ", None, "a"), (4, "one two three four five six", "en", "b"), (4, "one two three four five six", "en", "b"), (5, "one two three four five six", "en", "b"),
    (None, "no id here", "en", "b"), (6, LONG, "en", "a"), (7, "x@y.z, +1 (212) 555-1234, 4111111111111111, 1.2.3.4, 999.1.1.1", None, "c"), (8, "naïve café 日本語 🙂\x00 ▁ end ", "fr", "c"), (9, "12345 !!! ...", "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def edges(spark):
    df = spark.createDataFrame(EDGES, SCHEMA)
    extra = ("size", "spans", "stretch", "guest", "bucket", "key", "rank", "slot", "shard", "h", "lex", "kept", "lang_pred", "score", "label", "n_chars")
    return df.withColumns({c: F.lit(1).cast("long") for c in extra})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA).withColumn("n_chars", F.lit(0).cast("long"))


# --- 1


def test_langid_edges(spark, edges, empty):
    model = langid.train(langid.labelled(edges.select("doc_id", "text", F.coalesce("lang", F.lit("de")).alias("lang"))))
    rows = langid.identify(edges.select("doc_id", "text"), model).collect()
    assert len(rows) == len(EDGES)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    none = langid.train(langid.labelled(empty))
    assert {r.lang_pred for r in langid.identify(edges.select("doc_id", "text"), none).collect()} == {"und"}
    assert langid.identify(empty.select("doc_id", "text"), none).count() == 0
    out = langid.identify(edges, model)
    assert out.count() == len(EDGES) and out.columns.count("score") == 1


def test_langid_held_out_accuracy(spark, sf):
    docs = table(spark, sf, "documents")
    got = langid.op1_family_then_pair(spark, sf).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred != 'und'").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.93


def test_langid_prediction_does_not_depend_on_batches():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdef ,é") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    model = langid.Model(["en", "de", "fr"])
    model.weights = np.random.default_rng(0).normal(size=model.weights.shape)
    together, apart = model.predict(texts), [model.predict([t]) for t in texts]
    assert together[0] == [a[0][0] for a in apart] and np.allclose(together[1], [a[1][0] for a in apart])


# --- 2


def brute_article(page):
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
    return "\n\n".join(p for p in parts if p)


def test_html_articles_are_whole(spark, sf):
    pages = {r.page_id: r.html for r in table(spark, sf, "pages").collect()}
    for r in html_crf.op2_block_crf(spark, sf).collect():
        assert r.text == brute_article(pages[r.page_id]) and r.n_chars == len(r.text)


#: Layouts that training never sees, some of whose names hint at nothing.
UNSEEN = {
    "article": ['div class="rich_text"', 'section id="story-column"', 'div class="c-xyz"|article', 'div class="postcontent prose"', 'div role="main"|div'],
    "menu": ['div id="topnav"|nav|ul', 'ul class="tabs"', 'div class="zz9"|ul'], "header": ['div class="brand top"', 'div id="page-logo"'], "footer": ['div class="legal"', 'div class="q1"|footer'],
    "side": ['div class="rail"', 'div class="more popular"'], "advert": ['div class="ads"', 'section class="sponsor"'], "notice": ['div class="gdpr"', 'div class="toast alert"'],
    "form": ['div class="signup"|form', 'form class="contact"'], "comment": ['div class="replies"', 'ul class="thread"|li', 'section id="discussion"'], "share": ['div class="follow"', 'div class="toolbar"'],
}


def test_html_unseen_layouts(spark, sf):
    texts = html_crf.sample_texts(table(spark, sf, "pages"))
    train, held = texts[::2], [html.escape(t, False) for t in texts[1::2]]
    field = html_crf.train(train)
    rng = random.Random(5)
    long, short = [t for t in held if t.count(" ") > 5], [t for t in held if t.count(" ") <= 5]
    right = total = 0
    for _ in range(200):
        page, labels = html_crf.laid_out(rng, long, short, UNSEEN, 0.0)
        found = html_crf.blocks(page)
        got = field.viterbi(html_crf.page_features(found))
        right, total = right + sum(a == b for a, b in zip(got, labels, strict=True)), total + len(labels)
    assert right / total > 0.93, right / total


@pytest.mark.parametrize("page", ["<div>x " * 100_000, '<a "' * 100_000, "<svg>x" * 50_000, "<div>" * 50_000 + "</p>" * 50_000, "<div>" * 30_000 + "<li>a</li>" * 30_000, "<!--" * 100_000, "<p>" + "&" * 200_000])
def test_html_odd_pages_take_time_in_proportion(page):
    import time

    began = time.time()
    found = html_crf.blocks(page)
    html_crf.Field(np.zeros(len(html_crf.FEATURES)), np.zeros((2, 2))).viterbi(html_crf.page_features(found))
    assert time.time() - began < 10


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    field = html_crf.Field(rng.normal(size=len(html_crf.FEATURES)), rng.normal(size=(2, 2)))
    for n in range(1, 8):
        rows = [list(rng.integers(0, len(html_crf.FEATURES), 4)) for _ in range(n)]
        score = lambda path, rows=rows: sum(field.weights[r].sum() * y for r, y in zip(rows, path, strict=True)) + sum(field.steps[a, b] for a, b in zip(path, path[1:], strict=False))
        best = max(([k >> i & 1 for i in range(n)] for k in range(2**n)), key=score)
        assert score(field.viterbi(rows)) == pytest.approx(score(best))


def test_html_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>broken <b>markup <p>two < three &amp; &#233;"), (3, "u", "<p>broken <b>markup <p>two < three &amp; &#233;"), (4, "u", "<article>" + "<p>word &nbsp; x</p>" * 20_000 + "</article>"), (5, "u", "<script>var a='<p>no</p>'</script>"), (6, "u", "<!-- <p>open")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    field = html_crf.train(["Home", "About us", "word x", "Some long article text that goes on and on here.", "And another one, longer than the first, which ends with a question?"])
    got = {r.page_id: r.text for r in html_crf.extract(df, field).collect()}
    assert html_crf.extract(df, field).count() == len(rows)
    assert got[1] == got[2] == got[5] == got[6] == ""
    assert got[4] == "\n\n".join(["word x"] * 20_000)
    assert [b.text for b in html_crf.blocks(rows[2][2])] == ["broken markup", "two < three & é"]
    assert html_crf.extract(df.where("false"), html_crf.train([])).count() == 0


# --- 3


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub("[ -]", "", m)) <= 19 and luhn(re.sub("[ -]", "", m))), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
)


def brute_pii(text):
    out = [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, p, ok) in enumerate(BASE) for m in re.finditer(p, text or "") if ok(m[0])]
    return ",".join(x[2] for x in sorted(out))


HARD = [
    "a@b.co_d@e.fr f@g.h.i. @x.y a@b@c.com .a-b+c%d@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3 1.2.3.4a", "4111 1111-1111 1111 4111111111111112 411111111111111 1234-5678 90", "+1 (743) 555-3824 +12 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 +44.20.7946.0958, +1(",
    "é🙂 x@y.zz 🙂1.1.1.1é", "12-34" * 50, "a" * 100_000, "1" * 100_000, "1." * 50_000, "+1 " * 30_000, "a@" * 30_000, ("m1@x.yz " * 3000),
]


def test_pii_equals_brute_force(spark, edges):
    rng = random.Random(2)
    texts = HARD + ["".join(rng.choice("a1.@+- ()9b") for _ in range(rng.randint(0, 80))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    base = F.filter("spans", lambda s: s.kind_no < 4)
    got = pii.detect(df).select("doc_id", F.concat_ws(",", F.transform(base, lambda s: F.concat_ws(":", s.kind, s.start, s.stop))).alias("s")).collect()
    assert {r.doc_id: r.s for r in got} == {k: brute_pii(t) for k, t in enumerate(texts)}
    assert pii.detect(edges).count() == len(EDGES)


def test_pii_checksums_and_context(spark):
    rows = [(1, "IBAN GB82 WEST 1234 5698 7654 32."), (2, "IBAN GB82 WEST 1234 5698 7654 33."), (3, "his ssn is 078-05-1120"), (4, "part 078-05-1120")]
    got = {r.doc_id: [s.kind for s in r.spans] for r in pii.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == ["iban"] and "iban" not in got[2] and got[3] == ["ssn"] and got[4] == []


def test_redaction_leaves_no_base_span(spark, edges, empty):
    out = pii.redact(edges)
    assert out.columns == edges.columns and out.count() == len(EDGES)
    row = out.where("doc_id = 7").first()
    assert row.text == "[EMAIL], [PHONE], [CARD], [IP], 999.1.1.1" and row.n_chars == len(row.text)
    assert out.where("doc_id = 6").first().text == LONG
    assert pii.redact(empty).count() == 0


# --- 4


def test_imatch_edited_texts_and_equal_texts(spark, edges, empty):
    rows = imatch.fingerprints(edges).select("doc_id", "n_chars", "edited_sha256", imatch.shown("text_fp").alias("fp"), imatch.likeness("text_fp", "edited_fp").alias("near")).collect()
    assert len(rows) == len(EDGES)
    order = sorted(EDGES, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    wanted = defaultdict(list)
    for k, (doc, text, *_) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        third = len(text) // 3
        wanted[doc].append((len(text), hashlib.sha256((text[: len(text) - third] + after[:third]).encode()).hexdigest()))
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.n_chars, r.edited_sha256))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in wanted.items()}
    assert len({r.fp for r in rows if r.doc_id in (4, 5)}) == 1
    assert all(0 <= r.near <= 1 for r in rows)
    assert imatch.fingerprints(empty).count() == 0


def test_imatch_single_document_is_its_own_neighbour(spark):
    r = imatch.fingerprints(spark.createDataFrame([(5, "alone and long enough")], "doc_id long, text string")).first()
    assert r.edited_sha256 == hashlib.sha256(b"alone and longalone a").hexdigest() and r.next_fp == r.text_fp


def brute_edited(rows):
    """Edited texts by (doc_id, text) of rows in the order of the operator."""
    out = defaultdict(list)
    for k, (doc, text) in enumerate(rows):
        third = len(text) // 3
        out[doc].append(hashlib.sha256((text[: len(text) - third] + rows[(k + 1) % len(rows)][1][:third]).encode()).hexdigest())
    return {d: sorted(x) for d, x in out.items()}


def test_imatch_neighbours_of_far_null_and_repeated_ids(spark):
    rows = [(k * k * 7, f"text number {k} of many") for k in range(3000)] + [(10**15, "far away text"), (-(2**63), "least of all ids"), (2**63 - 1, "largest of all ids")]
    rows += [(None, f"text without id {k}") for k in range(1500)] + [(49, "text number 7 of many")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string")
    h = {(r.doc_id, r.text): r.h for r in df.select("*", F.xxhash64("text").alias("h")).collect()}
    wanted = brute_edited(sorted(((d, t) for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), h[r])))
    got = defaultdict(list)
    for r in imatch.fingerprints(df).collect():
        got[r.doc_id].append(r.edited_sha256)
    assert {d: sorted(x) for d, x in got.items()} == wanted


def test_imatch_prints_and_likeness_equal_brute_force(spark):
    """Lexicon, selected terms, the terms each randomised lexicon keeps, and likenesses, computed plainly; only Spark's xxhash64 is borrowed."""
    import math

    rng = random.Random(5)
    rows = [(k, " ".join(rng.choices([f"w{j}" for j in range(300)], k=rng.choice([0, 2, 8, 40])))) for k in range(400)]
    band = (1.0, 5.0)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in imatch.fingerprints(df, band).withColumn("near", imatch.likeness("text_fp", "next_fp")).withColumn("like", imatch.likeness("text_fp", "edited_fp")).collect()}
    cut = {d: len(t) // 3 for d, t in rows}
    texts = {(d, "own"): t for d, t in rows} | {(d, "edited"): t[: len(t) - cut[d]] + rows[d - 1][1][: cut[d]] for d, t in rows}
    words = {w for t in texts.values() for w in t.split()}
    hashed = {r.w: r for r in spark.createDataFrame([(w,) for w in words], "w string").selectExpr("w", "xxhash64(w) t", *[f"xxhash64(xxhash64(w), {k}) h{k}" for k in range(3)]).collect()}
    freq = defaultdict(int)
    for _, t in rows:
        for w in set(t.split()):
            freq[w] += 1
    lex = {w for w, n in freq.items() if band[0] <= math.log(len(rows) / n) <= band[1]}
    kept = {}
    for key, t in texts.items():
        chosen = sorted((hashed[w] for w in (set(t.split()) & lex or set(t.split()))), key=lambda r: r.t)
        lists = []
        for rep in range(imatch.REPEATS):
            low = 0
            for rate in imatch.RATES:
                lists.append(tuple(r.t for r in chosen if r[f"h{rep}"] >> low & ((1 << rate) - 1) == 0))
                low += rate
        kept[key] = [*lists, tuple(r.t for r in chosen)]
    lists = sorted({x for ks in kept.values() for x in ks if x})
    hash_of = {tuple(r.k): r.h for r in spark.createDataFrame([(list(x),) for x in lists], "k array<long>").selectExpr("k", "int(shiftright(xxhash64(k), 32)) h").collect()}
    fp = {key: [hash_of.get(x) for x in ks] for key, ks in kept.items()}

    def like(a, b):
        both = [(x, y) for x, y in zip(a, b, strict=True) if x is not None or y is not None]
        return sum(x == y for x, y in both) / len(both) if both else 1.0

    for d, _ in rows:
        r, own, edited, after = got[d], fp[d, "own"], fp[d, "edited"], fp[rows[d - 1][0], "own"]
        assert (list(r.text_fp), list(r.edited_fp), list(r.next_fp)) == (own, edited, after)
        assert r.like == pytest.approx(like(own, edited)) and r.near == pytest.approx(like(own, after))


def test_imatch_tells_edits_from_strangers(spark, sf):
    r = imatch.op4_imatch(spark, sf).agg(F.avg("near_edited").alias("a"), F.avg("near_next").alias("b")).first()
    assert r.a > 0.05 > r.b


# --- 5


def brute_nearest(rows, queries, k):
    out = {}
    for q, v in queries:
        scored = sorted((-float(np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w))), i) for i, w in rows if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_hnsw_recall_scores_and_hot_vectors(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(1500, 16)).astype(np.float32)
    v[200:700] = v[200]
    rows = [(int(i), [float(x) for x in r]) for i, r in enumerate(v)]
    df = spark.createDataFrame([*rows, rows[3]], "vec_id long, embedding array<float>")
    got = hnsw.nearest(df, df.where("vec_id % 50 = 0"), shard_rows=400).collect()
    wanted = brute_nearest([(i, np.array(x)) for i, x in rows], [(i, np.array(x)) for i, x in rows if i % 50 == 0], 5)
    found = defaultdict(dict)
    for r in got:
        found[r.query_id][r["rank"]] = (r.vec_id, r.score)
    assert set(found) == set(wanted) and all(sorted(x) == [1, 2, 3, 4, 5] for x in found.values())
    hits = sum(len({i for i, _ in wanted[q]} & {i for i, _ in found[q].values()}) for q in wanted)
    assert hits / (5 * len(wanted)) >= 0.9
    assert [found[250][k][0] for k in range(1, 6)] == [200, 201, 202, 203, 204]
    assert all(found[q][1][1] == pytest.approx(wanted[q][0][1], abs=1e-12) for q in wanted)


def test_hnsw_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [1.0, None]), (5, [2.0, 0.0]), (6, [1.0, 1.0, 1.0]), (50, [0.0, 1.0]), (100, [1e-30, 1e-30])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = [(r.query_id, r["rank"], r.vec_id) for r in hnsw.nearest(df, df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 5), (0, 2, 100), (0, 3, 50), (50, 1, 100), (50, 2, 0), (50, 3, 5), (100, 1, 0), (100, 2, 5), (100, 3, 50)]
    assert hnsw.nearest(df.where("false"), df.where("false")).count() == 0


# --- 6


def test_chat_round_trip(spark, sf):
    rows = table(spark, sf, "conversations").orderBy("conv_id", "turn").collect()
    wanted = defaultdict(list)
    for r in rows:
        wanted[r.conv_id].append((r.role, r.text or ""))
    wanted[-7] = [("user", chat.PROBE), ("assistant", chat.PROBE)]
    got = {r.conv_id: r for r in chat.op6_event_sourced_chat(spark, sf).collect()}
    assert set(got) == set(wanted)
    for conv, turns in wanted.items():
        r, learned = got[conv], "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_chars == len(learned) and r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert r.formatted_chars == sum(len(chat.render_turn(a, b)) for a, b in turns)


@pytest.mark.parametrize("role", ["user", "", "a: b", "<x>#\\", "assistant"])
@pytest.mark.parametrize("text", ["", "</turn>\n### user: x</turn>\n", "\\l\\h\\b", "tail\\", "a\nb\n\n"])
def test_chat_template_is_reversible(role, text):
    formatted = chat.render_turn("user", "first") + chat.render_turn(role, text)
    assert [(a, b) for a, b, _, _ in chat.parse(formatted)] == [("user", "first"), (role, text)]
    assert formatted.count("</turn>") == 2


def test_chat_fold():
    assert chat.fold([("delta", "a"), ("delta", "b"), ("regenerate", ""), ("delta", "c"), ("edit", "d"), ("delta", "e")]) == "de"


def test_chat_log_with_ties_repeats_and_contradictions(spark):
    log = [
        (1, 7, 0, "user", 1, "delta", "a"), (1, 7, 0, "user", 2, "delta", "b"), (1, 7, 0, "user", 2, "delta", "b"), (1, 7, 0, "user", 1, "delta", "a"),  # replayed
        (1, 8, 1, "user", 1, "delta", "x"), (1, 8, 2, "assistant", 2, "delta", "y"),  # turn and role change on the way
        (2, 7, 0, "user", 5, "delta", "p"), (2, 7, 0, "user", 5, "edit", "q"), (2, 7, 0, "user", 5, "delta", "z"),  # tied
        (2, 9, None, None, None, "delta", "n"), (2, 9, None, None, 1, "delta", "o"), (None, None, 0, "user", 1, "delta", None),
    ]
    events = spark.createDataFrame(log, "conv_id long, message long, turn long, role string, seq long, kind string, text string").repartition(5)
    got = {(r.conv_id, r.message): (r.turn, r.role, r.text) for r in chat.fold_messages(events).collect()}
    assert got == {(1, 7): (0, "user", "ab"), (1, 8): (2, "assistant", "xy"), (2, 7): (0, "user", "q"), (2, 9): (None, "", "no"), (None, None): (0, "user", "")}


def test_hnsw_leaves_out_the_querys_own_row_only(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.9, 0.1]), (0, [1.0, 0.0]), (1, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 3)) for r in hnsw.nearest(df, df.where("vec_id % 50 = 0")).collect())
    assert got == [(0, 1, 0, 0.994), (0, 1, 0, 0.994), (0, 2, 1, 0.0), (0, 2, 1, 0.11)]


def test_chat_edges(spark):
    rows = [(1, 1, "user", None), (1, None, None, "x"), (None, 0, "assistant", "y"), (1, 1, "user", None), (2, 0, "assistant", "z" * 200_000), (2, 0, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit(1))
    got = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold_messages(chat.as_events(df)))).collect()}
    digest = lambda turns: hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
    assert got[1].turns_sha256 == digest([("", "x"), ("user", ""), ("user", "")])
    assert got[None].turns_sha256 == digest([("assistant", "y")])
    assert got[2].turns_sha256 == digest([("assistant", "a"), ("assistant", "z" * 200_000)]) and got[2].loss_chars == 200_001
    assert chat.read_back(chat.render(chat.fold_messages(chat.as_events(df.where("false"))))).count() == 0


# --- 7


def test_shards_are_even_and_gapless(spark, sf):
    got = sharding.op7_virtual_slots(spark, sf).toPandas()
    bytes_ = got.groupby("shard")["size"].sum()
    assert set(got["shard"]) <= set(range(8)) and bytes_.max() - bytes_.min() <= got["size"].max()
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in got.groupby("shard"))


def test_sharding_edges(spark, edges, empty):
    got = sharding.shard_documents(edges).collect()
    import zlib

    assert len(got) == len(EDGES)
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, *_ in EDGES)
    assert sharding.shard_documents(empty).count() == 0


def test_rebalancing_moves_little_and_into_the_new_shard_only():
    rng = random.Random(1)
    totals = {s: rng.randint(1, 1000) for s in range(4096)}
    old = sharding.rebalanced(sharding.first_map(4096, 8), totals, 8, 0.0)
    new = sharding.rebalanced(old, totals, 9)
    moved = {s for s in old if old[s] != new[s]}
    assert {new[s] for s in moved} == {8} and sum(totals[s] for s in moved) <= sum(totals.values()) / 9
    fewer = sharding.rebalanced(old, totals, 7)
    assert all(fewer[s] == old[s] for s in old if old[s] < 7) and set(fewer.values()) == set(range(7))


# --- 8


@pytest.fixture(scope="module")
def model():
    import public_tokenizers

    return sentencepiece.read_model(public_tokenizers.path(sentencepiece.MODEL))


def test_pieces_equal_the_library_and_spans_tile_the_text(model):
    codec = sentencepiece.Codec(model)
    rng = random.Random(3)
    texts = ["", " ", "  ", "\n", " \n \n", "▁", "a▁ b", "\x00", "日本語 🙂\n\n x ", LONG[:5000], " lead", "trail  "] + ["".join(rng.choice("ab \n,.é▁🙂") for _ in range(rng.randint(0, 40))) for _ in range(500)]
    for text, (ids, begins, ends) in zip(texts, codec.encode(texts), strict=True):
        assert ids.tolist() == codec.model.encode(text)
        assert codec.decode(ids) == codec.model.decode(ids.tolist())
        at = 0
        for b, e in zip(begins.tolist(), ends.tolist(), strict=True):
            assert b <= at or b == at
            at = max(at, e)
        assert at == len(text.encode())


def test_sentencepiece_edges(spark, edges, empty, model):
    got = sentencepiece.encode(edges, model).collect()
    assert len(got) == len(EDGES)
    assert all(list(r.ids) == [] and r.decoded == "" for r in got if r.doc_id in (1, 2))
    assert next(r for r in got if r.doc_id == 6).decoded == LONG
    assert sentencepiece.encode(empty, model).count() == 0


def charsmap(rules):
    """A compiled map for a test: a double array with one node a byte, laid out far apart."""
    units, strings, at = {0: 0}, b"", {}
    for new in rules.values():
        at.setdefault(new, len(strings))
        strings += new + b"\0" if at[new] == len(strings) else b""
    children = defaultdict(set)
    for key in rules:
        for k in range(len(key)):
            children[key[:k]].add(key[k])
    place, base = {b"": 0}, 256
    bases = {}
    for prefix in sorted(set(children) | set(rules), key=len):
        bases[prefix] = base
        for c in children[prefix]:
            place[prefix + bytes([c])] = base ^ c
        base += 256
    for prefix, node in place.items():
        offset = node ^ bases[prefix]
        label = prefix[-1] if prefix else 0
        units[node] = (offset << 10 if offset < 1 << 21 else (offset >> 8) << 10 | 512) | label | (256 if prefix in rules else 0)
        if prefix in rules:
            units[bases[prefix]] = 1 << 31 | at[rules[prefix]]
    size = base + 256
    array = np.zeros(size, "<u4")
    for k, u in units.items():
        array[k] = u
    return np.array([array.nbytes], "<u4").tobytes() + array.tobytes() + strings


def test_longest_prefix_normalisation_keeps_offsets():
    rules = {"ﬁ".encode(): b"fi", b"a": b"A", b"ab": b"X", "é".encode(): b"e", b"\t": b" "}
    normal = sentencepiece.Normalizer(charsmap(rules), dummy_prefix=True, trim=True, escape=True)
    out, begin, end = normal("\t ﬁab\ta  é ")
    text = "\t ﬁab\ta  é ".encode()
    assert out.decode() == "▁fiX▁A▁e"
    pieces = [text[b:e].decode() for b, e in zip(begin[3:], end[3:], strict=True)]
    assert pieces[:3] == ["ﬁ", "ﬁ", "ab"] and pieces[-1] == "é"
    assert normal("")[0] == b""


# --- 9


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(rows, percent=85):
    sets = defaultdict(list)
    for doc, text in rows:
        if doc is not None:
            sets[doc].append(shingles(text))
    of = {d: d for d in sets}

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    flat = [(d, s) for d, ss in sets.items() for s in ss if s]
    for i, (a, x) in enumerate(flat):
        for b, y in flat[:i]:
            if 100 * len(x & y) >= percent * len(x | y) and find(a) != find(b):
                p, q = sorted((find(a), find(b)))
                of[q] = p
    return {d: find(d) for d in sets}


def test_minhash_components_equal_brute_force(spark):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(400)]
    rows, k = [], 0
    for size in (1, 2, 3, 40, 60):
        base = [rng.choice(words) for _ in range(rng.choice([6, 40, 150]))]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            rows.append((k, " ".join(copy)))
            k += 1
    rng.shuffle(rows)
    rows += [(500, "A b\tc"), (501, "a B c "), (502, None), (503, ""), (504, "  ")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows)
    assert all(r.n_shingles == len(shingles(dict(rows)[r.doc_id])) and r.kept == (r.doc_id == r.component_id) for r in got)


def test_minhash_chain_is_one_component(spark):
    """Every text links to the one before only: no star holds them together."""
    words = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(12):
        rows.append((k, " ".join(words)))
        words = words[8:] + [f"n{k}_{j}" for j in range(8)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows) and set(got.values()) == {0}


def test_banding_follows_the_threshold():
    assert minhash.banding(85)[:2] == (20, 5) and minhash.banding(80)[:2] == (25, 4)
    for percent in (50, 70, 80, 85, 90, 95):
        bands, rows, least = minhash.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= 2e-5 and least < percent / 100


def test_minhash_edges(spark, edges, empty):
    got = minhash.near_duplicates(edges).collect()
    assert len(got) == len(EDGES)
    wanted = brute_components([(d, t) for d, t, *_ in EDGES])
    assert all(r.component_id == wanted[r.doc_id] for r in got if r.doc_id is not None)
    assert all(r.kept for r in got if r.doc_id is None)
    assert minhash.near_duplicates(empty).count() == 0


def test_word_hashes_are_position_free():
    texts = ["the cat", "a the cat the", "The\tCAT ", "", "x" * 300 + " the"]
    data, offsets = minhash._texts(pa.array(texts))
    words, n = minhash.word_hashes(data, offsets)
    assert n.tolist() == [2, 4, 2, 0, 2]
    assert words[0] == words[3] == words[5] == words[6] == words[9] and words[1] == words[4] == words[7]


# --- 10


def test_mix_targets_and_caps(spark, edges, empty):
    rng = random.Random(8)
    rows = [(k, " ".join("w" * 1 for _ in range(rng.randint(0, 300))), rng.choice(["a", "b", "b", "b", "c", None])) for k in range(400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    sizes = pd.Series({s: sum(len(t.split()) for _, t, x in rows if x == s) for s in ("a", "b", "c", None)})
    total, weights, target, full = sizes.sum(), dict(zip(("a", "b", "c", None), (3, 1, 2, 3), strict=True)), {}, set()
    while True:
        left, open_ = 1.5 * total - sum(2 * sizes[s] for s in full), [s for s in weights if s not in full]
        target = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_} | {s: 2.0 * sizes[s] for s in full}
        over = {s for s in open_ if target[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    for s in weights:
        mine = got[got["source"].isna()] if s is None else got[got["source"] == s]
        assert mine["target"].iloc[0] == pytest.approx(target[s]) and mine["source_size"].iloc[0] == sizes[s]
        assert mine["taken"].sum() == pytest.approx(target[s], abs=0.002 * total)
    assert (got["taken"] <= 2 * got["size"]).all() and len(got) == 400
    again = mixing.mix(spark.createDataFrame(rows[::-1], "doc_id long, text string, source string")).toPandas()
    assert sorted(zip(got["doc_id"], got["taken"], strict=True)) == sorted(zip(again["doc_id"], again["taken"], strict=True))
    assert mixing.mix(edges).count() == len(EDGES)
    assert mixing.mix(empty).count() == 0


def test_mix_small_sources_reach_their_targets_beside_a_large_corpus(spark):
    """80M words make blocks of 610; sources of a few words have targets of twice that, one with a small weight beside huge ones has less."""
    key = lambda name: F.struct(F.lit(False).alias("isnull"), name.alias("name"))
    big = spark.range(800).select(F.col("id").alias("doc_id"), key(F.concat(F.lit("big"), F.col("id") % 4)).alias("skey"), F.lit(100_000).cast("long").alias("size"))
    tail = spark.range(3000).select((F.col("id") + 1000).alias("doc_id"), key(F.concat(F.lit("tail"), F.col("id") % 1000)).alias("skey"), (F.col("id") % 50 + 1).alias("size"))
    rows = big.unionByName(tail).withColumn("h", F.md5(F.col("doc_id").cast("string")))
    got = mixing.mix_sized(rows, mixing.SHARE, mixing.CAP, mixing.WEIGHTS, mixing.PER_SOURCE).toPandas()
    assert len(got) == 3800 and (got["taken"] <= 2 * got["size"]).all()
    for source, rows in got.groupby("source"):
        off = abs(rows["taken"].sum() - rows["target"].iloc[0])
        assert off <= (0.5 if source.startswith("tail") else 0.005 * rows["target"].iloc[0]), source
    assert got[got["source"].str.startswith("tail")].eval("taken == 2 * size").all()


def test_schedule_gives_every_source_its_share_at_any_time(spark):
    """The slots themselves: as many as ``mix`` counts, blocks in turn, and early slots divided like all of them."""
    rows = [(False, f"s{k}", size, target) for k, (size, target) in enumerate([(50_000, 30_000.0), (7, 14.0), (9000, 18_000.0), (400, 1.3), (0, 0.0), (100_000, 12_345.6)])]
    targets = spark.createDataFrame(rows, "isnull boolean, name string, source_size long, target double").select(F.struct("isnull", "name").alias("skey"), "source_size", "target")
    stretched = mixing.stretches(targets, per_source=512)
    of = {r.skey.name: r for r in stretched.collect()}
    slots = [(r.time, r.skey.name, r["rank"], r.block) for r in mixing.schedule(stretched).orderBy("time").collect()]
    assert len({t for t, *_ in slots}) == len(slots)
    for name, r in of.items():
        mine = [(k, b) for _, s, k, b in slots if s == name]
        assert len(mine) == r.slots and abs(r.slots - r.target / r.block) < 1
        assert mine == [(k, k % r.n_blocks) for k in range(r.slots)]
    half = Counter(s for _, s, *_ in slots[: len(slots) // 2])
    assert all(abs(half[name] - r.slots / 2) <= 12 for name, r in of.items())


def test_mix_spreads_rows_without_doc_id(spark):
    rows = [(None if k % 2 else 7, f"word{k} " * (k % 9 + 1), "a" if k % 3 else "b") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).toPandas()
    assert len(got) == 300 and (got["taken"] <= 2 * got["size"]).all()
    assert all(abs(r["taken"].sum() - r["target"].iloc[0]) <= 1 for _, r in got.groupby("source"))


def test_mix_takes_the_blocks_of_its_schedule(spark, monkeypatch):
    """With another schedule the mix is another: it takes what the slots name, word by word."""
    rows = [(k, f"w{k} " * (k * 7 % 60), "abc"[k % 7 % 3]) for k in range(240)]
    plain, slots = mixing.schedule, []

    def backwards(stretched):
        n = stretched.select("skey", "n_blocks", "block").withColumnRenamed("block", "words")
        turned = plain(stretched).join(n, "skey").withColumn("block", F.col("n_blocks") - 1 - F.col("block"))
        slots.extend(turned.collect())
        return turned.drop("n_blocks", "words")

    monkeypatch.setattr(mixing, "schedule", backwards)
    got = {r.doc_id: r.taken for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), per_source=16).collect()}
    want = {}
    for name in "abc":
        times, words = Counter(r.block for r in slots if r.skey.name == name), next((r.words for r in slots if r.skey.name == name), 1)
        mark = lambda k, t: hashlib.md5(f"{k}:{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest()
        lo = 0
        for k, t, _ in sorted((r for r in rows if r[2] == name), key=lambda r: mark(*r[:2])):
            want[k] = sum(times[i // words] for i in range(lo, lo + len(t.split())))
            lo += len(t.split())
    assert got == want and any(want.values())
