"""Harmonic packing: ids equal the tokenizers library's, every id in exactly one piece, little padding, defined edge cases."""

import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from quern.llm import bpe, packing  # noqa: E402

FILE = bpe.read_file(public_tokenizers.path(bpe.MODEL))
ODD = ["", " ", "a", "  two  spaces ", "<|endoftext|> x<|endoftext|>", "naïve 東京 🙂\n\n\tx", "\x1c!\x1c ?", "it's we'll", "a" * 5000, " " * 50_000 + "x", "\n" * 900 + "x", "12345 " * 700, "\r\n \r\n x", "　x y"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(bpe.MODEL))


def test_ids_equal_the_library(spark, library):
    texts = ODD + [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    ours = bpe.byte_bpe(FILE)
    assert [ours.ids(t).tolist() for t in texts] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_plain_special_strings(library):
    library.encode_special_tokens = True
    want = library.encode("x <|endoftext|> y", add_special_tokens=False).ids
    library.encode_special_tokens = False
    assert bpe.byte_bpe(FILE).ids("x <|endoftext|> y", specials=False).tolist() == want


def test_segments_tile_and_keep_ids(library):
    text = "".join(ODD) + " some  words\n and\t lines. " * 400
    parts = list(bpe.segments(text, 50))
    assert "".join(parts) == text and len(parts) > 100
    ids = [i for p in parts for i in library.encode(p, add_special_tokens=False).ids]
    assert ids == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [1024, 64, 7])
def test_cuts_fill_bins(capacity):
    for n in range(4 * capacity):
        pieces = list(packing.cuts(n, capacity))
        assert sum(length for length, _ in pieces) == n
        assert all(length * kind <= capacity and length > 0 for length, kind in pieces)


def check(pieces, docs, library, capacity):
    """Pieces tile every document, sequences are gapless and no longer than the capacity."""
    by_doc = {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    want = {}
    for doc_id, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want.setdefault((doc_id, len(ids)), []).append(np.array(ids, "<u4").tobytes())
    assert by_doc.keys() == want.keys()
    for key, texts in want.items():
        if len(texts) == 1:
            laid = sorted(by_doc[key], key=lambda p: p.start)
            assert [p.start for p in laid] == np.cumsum([0, *(p.length for p in laid)])[:-1].tolist()
            assert b"".join(bytes(p.ids) for p in laid) == texts[0]
        else:
            assert sum(p.length for p in by_doc[key]) == len(texts) * key[1]
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append(p)
    padding = 0
    for held in by_sequence.values():
        held.sort(key=lambda p: p.offset)
        ends = np.cumsum([p.length for p in held])
        assert [p.offset for p in held] == [0, *ends[:-1]] and ends[-1] <= capacity
        padding += 0 if ends[-1] & (ends[-1] - 1) == 0 else capacity - ends[-1]
    return padding


def test_documents_of_a_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(40)
    pieces = packing.pack(docs, FILE).collect()
    padding = check(pieces, [(r.doc_id, r.text) for r in docs.collect()], library, packing.CAPACITY)
    assert padding < 0.01 * sum(p.length for p in pieces)


def test_odd_rows_and_small_capacity(spark, library):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, None), (3, "same"), (3, "same"), (99, None)]
    docs = spark.createDataFrame([(i, t, 1, "x", 5) for i, t in rows], "doc_id long, text string, start int, ids string, origin int").repartition(7)
    check(packing.pack(docs, FILE, capacity=64).collect(), rows, library, 64)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), FILE).count() == 0


def test_sequences_are_padded(spark):
    docs = spark.createDataFrame([(k, "word " * k) for k in range(60)], "doc_id long, text string")
    pieces = packing.pack(docs, FILE, capacity=64)
    rows = packing.sequences(pieces, 64, pad=7).collect()
    assert sum(r.length for r in rows) == sum(p.length for p in pieces.collect())
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == (r.length if r.length & (r.length - 1) == 0 else 64)
        assert (ids[r.length :] == 7).all()


def test_query_digests(spark):
    from quern.llm import queries

    rows = queries()["op12_harmonic_packing"](spark, "/root/testdata/sf0.001").collect()
    pieces = packing.pack(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), FILE).collect()
    assert {(r.doc_id, r.start, r.length, r.ids_crc32) for r in rows} == {(p.doc_id, p.start, p.length, zlib.crc32(bytes(p.ids))) for p in pieces}
