"""Cross-tokenizer alignment against brute force over the libraries' own tokens."""

import hashlib
from collections import Counter, defaultdict

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from quern.llm import alignment, bpe, sentencepiece  # noqa: E402

A = bpe.read_file(public_tokenizers.path(bpe.MODEL))
B = sentencepiece.read_model(public_tokenizers.path(sentencepiece.MODEL))
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [None, "", " ", "  ", "a ", "x▁y", "▁", "<|endoftext|> <s> </s>", "aa aaa aaaa aaaaa " * 9, "naïve 東京 🙂\n\n\tx\x00\x1c", "don't it's 12345 67", " lead and  trail  ", "\n", "unbelievably internationalisation", "é" * 40, "\r\n;\r x"]


class Brute:
    def __init__(self):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_tokenizers.path(bpe.MODEL))
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=B)
        self.byte = bpe.alphabet()

    def sides(self, text):
        a = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()) for i in self.b.encode(text) for p in [self.b.id_to_piece(i)]]
        want = (" " + text).encode()
        good = b"".join(x for _, x in a) == want and b"".join(x for _, x in b) == want
        return (a, b) if text and good else ([], [])

    @staticmethod
    def spans(side):
        at, out = 0, []
        for i, x in side:
            out.append((i, at, at + len(x)))
            at += len(x)
        return out

    def rows(self, texts):
        docs = []
        for t in texts:
            a, b = (self.spans(s) for s in self.sides(t or ""))
            cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
            groups = []
            for low, high in zip([0, *cuts], cuts):
                side = lambda s: ",".join(str(i) for i, x, y in s if low <= x and y <= high)  # noqa: B023, E731
                groups.append(f"{side(a)}|{side(b)}")
            links = [(i, j) for i, x, y in a for j, p, q in b if x < q and p < y]
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
            docs.append((len(a), len(b), len(groups), links, digest))
        counts = Counter(p for d in docs for p in set(d[3]))
        best = defaultdict(int)
        for (i, _), n in counts.items():
            best[i] = max(best[i], n)
        return [(n_a, n_b, n_g, len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), d) for n_a, n_b, n_g, links, d in docs], counts


@pytest.fixture(scope="module")
def brute():
    return Brute()


def ours(spark, texts, hot=alignment.HOT, parts=5):
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], "doc_id long, text string, row string, n_a int").repartition(parts)
    scores, counts = alignment.cross_tokenizer(docs, A, B, hot)
    rows = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in scores.collect()}
    return [rows[k] for k in range(len(texts))], {(r.a, r.b): r.n for r in counts.collect()}


@pytest.mark.parametrize("hot", [alignment.HOT, 40, 1])
def test_odd_texts(spark, brute, hot):
    texts = [*ODD, *ODD]
    assert ours(spark, texts, hot) == brute.rows(texts)


def test_documents_of_a_table(spark, brute):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    texts = [d.text if d.text is None or len(d.text) < 2500 else d.text[:2500] for d in docs]
    assert ours(spark, texts, hot=300) == brute.rows(texts)


def test_whole_long_texts_in_stretches(spark, brute, monkeypatch):
    texts = ["some words, " * 300 + "  end ", "x" * 900 + " y" * 500]
    cut, whole = alignment.Aligner(A, B), alignment.Aligner(A, B)
    monkeypatch.setattr(cut, "stretches", lambda t: list(bpe.segments(" " + t, 100)))
    for t in texts:
        rows = []
        for own in (cut, whole):
            doc, units = alignment._Document(), own.stretches(t)
            for got in own.align(units):
                doc.add(got)
            rows.append(doc.row(own))
        assert len(cut.stretches(t)) > 5 and rows[0] == rows[1]


def test_same_bytes(brute):
    own = alignment.Aligner(A, B)
    for i, j in enumerate(own.same.tolist()):
        if j >= 0:
            assert own.a.pieces[i] == own.b_pieces[j]
    assert sum(own.same >= 0) > 10_000


def test_empty_table_and_null_ids(spark):
    empty, _ = alignment.cross_tokenizer(spark.createDataFrame([], "doc_id long, text string"), A, B)
    assert empty.count() == 0
    rows, _ = alignment.cross_tokenizer(spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "a b")], "doc_id long, text string"), A, B)
    assert sorted(map(str, (r.count_sum for r in rows.collect()))) == [str(3 * rows.first().n_links)] * 3


def test_query_runs_over_the_whole_table(spark):
    from quern.llm import queries

    rows = queries()["op11_identity_path"](spark, "/root/testdata/sf0.001")
    assert set(COLUMNS) < set(rows.columns)
    assert rows.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
