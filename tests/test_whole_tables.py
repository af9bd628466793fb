"""Queries over whole tables against brute force: no ordinary row is left out."""

import hashlib
import re
from collections import Counter

import duckdb

from quern.plans import QUERIES
from quern.plans.registry import ORACLES

TEXTS = {1: "One. Two! 3 three?", 2: "123 begins with digits. A. B.", 3: "Él dijo. Luego se fue.", 4: "Go. A! Then on.", 5: "  ", 6: None}
HTML = """<a href="/a">Fish &amp; Chips</a><a class="x" href="/b">plain</a><a href="/c">a &lt; b</a><a href="/d"><b>R&amp;D</b></a>"""


def documents(spark, at):
    spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string").write.parquet(f"{at}/documents.parquet")
    return str(at)


def test_postings_of_every_document(spark, tmp_path):
    got = {(r.term, r.doc_id): r.tf for r in QUERIES["z3_all_postings"](spark, documents(spark, tmp_path)).collect()}
    assert got == Counter((w, k) for k, t in TEXTS.items() for w in re.split("[^a-z0-9]+", (t or "").lower()) if w)


def test_postings_query_keeps_a_row_a_term_and_document(spark, tmp_path):
    rows = QUERIES["z3_postings"](spark, documents(spark, tmp_path)).select("term", "doc_id", "tf").collect()
    want = Counter((w, k) for k, t in TEXTS.items() for w in re.split("[^a-z0-9]+", (t or "").lower()) if w)
    assert {(r.term, r.doc_id): r.tf for r in rows} == want and len(rows) == len(want)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert {(t, k): n for t, k, n in con.execute(f"SELECT term, doc_id, tf FROM ({ORACLES['z3_postings']})").fetchall()} == want


def test_sentences_of_every_document(spark, tmp_path):
    got = {r.doc_id: r.n for r in QUERIES["g6_all_sentences"](spark, documents(spark, tmp_path)).collect()}
    want = {k: sum(bool(s.strip()) for s in re.split(r"(?<=[.!?])\s+(?=[A-Z0-9<(])", t or "")) for k, t in TEXTS.items()}
    assert got == {k: n for k, n in want.items() if n} and {2, 3, 4} <= set(got)


def test_labels_with_entities(spark, tmp_path):
    spark.createDataFrame([(1, HTML)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted(r.label for r in QUERIES["s8_all_link_labels"](spark, str(tmp_path)).collect()) == ["Fish & Chips", "R&D", "a < b", "plain"]


def test_link_labels_leave_no_link_out(spark, tmp_path):
    more = """<a href="/e">two\nlines</a><a\thref="/f">&#8211; a &amp;lt; b&nbsp;</a><a href="/g"></a><a href="/h">plain</a>"""
    spark.createDataFrame([(1, HTML), (2, more), (3, "no link"), (4, None)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(tuple(r) for r in QUERIES["s8_link_labels"](spark, str(tmp_path)).select("page_id", "label").collect())
    assert got == [(1, "Fish & Chips"), (1, "R&D"), (1, "a < b"), (1, "plain"), (2, ""), (2, "- a &lt; b"), (2, "plain"), (2, "two\nlines")]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == sorted(con.execute(f"SELECT page_id, label FROM ({ORACLES['s8_link_labels']})").fetchall())


def test_chunks_of_every_document(spark, tmp_path):
    def packed(text):
        done, now = [], ""
        for line in text.split("\n"):
            joined = f"{now}\n{line}" if now else line
            done, now = ([*done, now], line) if now and len(joined) > 2000 else (done, joined)
        return [c for c in [*done, now] if c.strip(" ")]

    texts = {1: "a" * 5000, 2: "\n".join(f"line {i} " + "x" * (i % 90) for i in range(3000)), 3: "", 4: None, 5: "short\n\n\nend"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.chunk_no): (r.n, r.digest) for r in QUERIES["g2_chunks"](spark, str(tmp_path)).collect()}
    want = {(k, i): (len(c), hashlib.md5(c.encode()).hexdigest()) for k, t in texts.items() if t is not None for i, c in enumerate(packed(t))}
    assert got == want and sum(k == 2 for k, _ in want) > 40


def test_artifacts_beside_letters_that_are_not_ascii(spark, tmp_path):
    artifacts = ["a ROOM.", "éroom", "roomé 1", "1234567é", "ñ1234567ñ", "rd.x", "a\u017ftreet", "webſite", "facebook", "faceboo\u212as", "room\u0301", "🙂fax", "123 / 12345678"]
    others = ["rooms", "_room", "rd. x", "rd.é", "\u017ftreet", "faceboo\u212a", "hosp\u0131tal", "123456", "123456７", "a1234567", "", "   ", "\t\n", None]
    spark.createDataFrame(list(enumerate(artifacts + others)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.kind for r in QUERIES["c9_artifact"](spark, str(tmp_path)).collect()}
    assert got == {k: "artifact" if k < len(artifacts) else "text" for k in range(len(artifacts + others))}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == dict(con.execute(f"SELECT doc_id, kind FROM ({ORACLES['c9_artifact']})").fetchall())


def test_numbers_of_orders_at_the_edge_of_rounding(spark, tmp_path):
    prices = [209150.0, 484050.0, 209149.99, 50.0, 1950.5, 0.0, 0.4, -0.5, -1234.5, None, 450.0, 123456789.75]
    orders = spark.createDataFrame([(k, p) for k, p in enumerate(prices)], "o_orderkey long, o_totalprice double")
    orders.selectExpr("*", "if(o_orderkey = 4, null, timestamp_ntz'1996-03-05 00:00:00') AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    names = "o_orderkey, first_number, unit, whole, reference, share"
    got = sorted(tuple(r) for r in QUERIES["m_numbers"](spark, str(tmp_path)).select(*names.split(", ")).collect())
    assert got == sorted(con.execute(f"SELECT {names} FROM ({ORACLES['m_numbers']})").fetchall())
    assert [r[-1] for r in got[:2]] == [209.2, 484.1]


def test_progress_at_the_edge_of_rounding(spark, tmp_path):
    pairs = [(18, 4000), (37, 2000), (143, 2000), (149, 2000), (148, 8000), (111, 6000), (20, 4000), (700, 500), (12, 12)]  # done, total
    orders = [(key, customer) for customer, (k, m) in enumerate(pairs, 1) for key in (k - 10, m - 11 + 9000)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    names = "claim_id, percent, rate, eta_seconds"
    got = sorted(tuple(r) for r in QUERIES["w20_progress"](spark, str(tmp_path)).select(*names.split(", ")).collect())
    assert got == sorted(con.execute(f"SELECT {names} FROM ({ORACLES['w20_progress']})").fetchall())
    assert [r[1] for r in got] == [0.5, 1.9, 7.2, 7.5, 1.9, 1.9, 0.5, 140.0, 100.0]
