"""Alignment of two tokenizers over a corpus: groups of tokens that end together, and links between overlapping tokens.

A is a byte-level BPE over a space and the text, B a SentencePiece model over the text (which adds that
space). Byte offsets at which tokens of both end cut a text into groups; an A and a B token are linked where
their byte ranges overlap. A pair of ids counts the documents that hold it linked.

Fast path: ``same`` maps every A id to the B id with the same bytes. A group of one token each whose ids it
maps to each other is only an entry of the document's list of A ids; tasks count those lists in one
vector as long as A's vocabulary. Only links of the other groups are pairs that a shuffle counts.

1. ``align`` reads every whole text once and stores, for each row, its numbers, its digest, its same ids and
   its pairs, each with how often they occur. Everything is computed on arrays for a batch of texts.
2. ``pair_counts`` counts documents for each pair: sums in tasks, then a shuffle of one row a pair and task.
3. ``scored`` adds the counts up for each row. Counts of same ids, the highest count of every A id and pairs so frequent that at
   most HOT of them can exist go to the tasks as arrays (their size is proven: two vectors and HOT rows); the
   other pairs, each in less than 1 / HOT of all rows, are joined, so no key of that join is hot.

Long texts are read in stretches that begin with a space after a visible character, where neither tokenizer
has a token across (for B, vocabularies that have such pieces are read whole); memory follows the stretch and
the document's distinct pairs.

Defined results: a null or empty text, and one whose tokens' bytes differ from the space and the text (it
holds U+2581), have no tokens: zeros and an empty digest; repeated rows count as documents of their own, a null doc_id too;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, sentencepiece
from ._common import store, table

#: At most so many pairs are sent to every task as frequent ones.
HOT = 1 << 18
#: Bytes of text aligned at once, and distinct pairs that a task counts before it hands them on.
CHUNK, MOST = 1 << 20, 1 << 21


class Aligner:
    """Both tokenizers, the bytes of their tokens, and ``same``: A id to the B id with the same bytes, or -1."""

    def __init__(self, a_file: bytes, b_model: bytes):
        self.a, self.b = bpe.byte_bpe(a_file), sentencepiece.codec(b_model)
        model = self.b.model
        self.b_pieces = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace(sentencepiece.SPACE, " ").encode() for i in range(model.get_piece_size())]
        by_bytes: dict[bytes, int] = {}
        for i in sorted(range(len(self.b_pieces)), key=lambda i: (model.is_byte(i), i)):  # a piece before a byte
            if not (model.is_control(i) or model.is_unknown(i)):
                by_bytes.setdefault(self.b_pieces[i], i)
        self.same = np.array([by_bytes.get(p, -1) for p in self.a.pieces], np.int64)
        self.n_b = len(self.b_pieces)
        self.a_lengths, self.b_lengths = self.a.lengths, np.array([len(p) for p in self.b_pieces], np.int64)
        self.a_bytes, self.b_bytes = pa.array(self.a.pieces, pa.binary()), pa.array(self.b_pieces, pa.binary())
        # decimal ids with what follows them: another of its side, the other side, the next group
        self.words = pa.array([f"{i}{s}" for s in ",|;" for i in range(max(len(self.a.pieces), self.n_b))])
        self.n_words = len(self.words) // 3

    def tokens(self, units: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """A's and B's ids of stretches that begin with a space."""
        rest = [u[1:] for u in units]
        return [self.a.ids(u, specials=False) for u in units], self.b.ids(rest, [self.b.normalise(t)[0] for t in rest])

    def align(self, units: list[str]) -> list[tuple[int, int, int, int, bytes, np.ndarray, np.ndarray] | None]:
        """For each stretch: n_a, n_b, n_groups, n_links, its groups as text (with a last ``;``), A ids of its same groups, and
        keys a * n_b + b of its other links; None where bytes differ."""
        a_of, b_of = self.tokens(units)
        raw = [u.encode() for u in units]
        size = np.array([len(r) for r in raw])
        fits = [self._bytes(self.a_bytes, a) == r and self._bytes(self.b_bytes, b) == r for a, b, r in zip(a_of, b_of, raw, strict=True)]
        good = np.flatnonzero(fits)
        out: list = [None] * len(units)
        if not len(good):
            return out
        a, b = np.concatenate([a_of[k] for k in good]).astype(np.int64), np.concatenate([b_of[k] for k in good]).astype(np.int64)
        unit_end = np.cumsum(size[good])
        a_end, b_end = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        a_start, b_start = a_end - self.a_lengths[a], b_end - self.b_lengths[b]
        cut = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(cut, a_end), np.searchsorted(cut, b_end)
        in_a, in_b = np.bincount(a_group, minlength=len(cut)), np.bincount(b_group, minlength=len(cut))
        # the B tokens that an A token overlaps follow one another
        first, last = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
        n_links = last - first
        one = (in_a == 1) & (in_b == 1)
        one_a = one[a_group]
        fast = np.zeros(len(a), bool)
        fast[one_a] = self.same[a[one_a]] == b[one[b_group]]
        slow = np.flatnonzero(~fast)
        link_a = np.repeat(slow, n_links[slow])
        within = np.arange(len(link_a)) - np.repeat(np.cumsum(n_links[slow]) - n_links[slow], n_links[slow])
        keys = a[link_a] * self.n_b + b[first[link_a] + within]
        # the groups as text: A's ids of a group, then B's
        a_at = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[a_group]
        b_at = np.arange(len(b)) + np.cumsum(in_a)[b_group]
        said = np.empty(len(a) + len(b), np.int64)
        said[a_at] = a + self.n_words * np.append(a_group[1:] != a_group[:-1], True)
        said[b_at] = b + 2 * self.n_words * np.append(b_group[1:] != b_group[:-1], True)
        text = self.words.take(pa.array(said, pa.int32()))
        marks, data = np.frombuffer(text.buffers()[1], np.int32)[: len(said) + 1], text.buffers()[2]
        # what belongs to each stretch
        bound = lambda ends: np.concatenate([[0], np.searchsorted(ends, unit_end, "right")])
        a_of, b_of, g_of = bound(a_end), bound(b_end), bound(cut)
        links_to = np.concatenate([[0], np.cumsum(n_links)])
        slow_of = np.searchsorted(link_a, a_of)
        for k, unit in enumerate(good):
            lo, hi = a_of[k], a_of[k + 1]
            words = data[marks[lo + b_of[k]] : marks[hi + b_of[k + 1]]].to_pybytes()
            counts = hi - lo, b_of[k + 1] - b_of[k], g_of[k + 1] - g_of[k], links_to[hi] - links_to[lo]
            out[unit] = (*map(int, counts), words, a[lo:hi][fast[lo:hi]], keys[slow_of[k] : slow_of[k + 1]])
        return out

    @staticmethod
    def _bytes(pieces: pa.Array, ids: np.ndarray) -> bytes:
        data = pieces.take(pa.array(ids.astype(np.int32))).buffers()[2]
        return data.to_pybytes() if data else b""

    def stretches(self, text: str) -> list[str]:
        """A space and the text, cut where both tokenizers may be cut."""
        return list(bpe.segments(" " + text)) if self.b.by_stretch else [" " + text]


@functools.lru_cache(maxsize=2)
def aligner(a_file: bytes, b_model: bytes) -> Aligner:
    return Aligner(a_file, b_model)


class _Document:
    """Sums over the stretches of one text."""

    def __init__(self):
        self.counts, self.digest, self.held, self.fits, self.some = [0, 0, 0, 0], hashlib.sha256(), b"", True, False
        self.same: list[np.ndarray] = []
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, got: tuple | None) -> None:
        if got is None or not self.fits:
            self.fits = False
            return
        self.counts = [x + y for x, y in zip(self.counts, got[:4], strict=True)]
        self.digest.update(self.held)
        self.digest.update(got[4][:-1])
        self.held, self.some = b";", True
        self.same.append(got[5])
        self.pairs.append(np.unique(got[6], return_counts=True))
        if len(self.pairs) > 64:
            self.pairs = [_summed(self.pairs)]
            self.same = [np.concatenate(self.same)]

    def row(self, own: Aligner) -> tuple:
        if not self.fits or not self.some:
            return 0, 0, 0, 0, "", b"", b"", b"", b""
        ids, n = np.unique(np.concatenate(self.same), return_counts=True)
        keys, times = _summed(self.pairs)
        # a link of the same bytes inside another group is counted where all of them are
        plain = own.same[keys // own.n_b] == keys % own.n_b
        ids, n = _summed([(ids, n), (keys[plain] // own.n_b, times[plain])])
        packed = (x.astype("<i8").tobytes() for x in (ids, n, keys[~plain], times[~plain]))
        return *self.counts, self.digest.hexdigest(), *packed


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of (keys, numbers) parts, with the sums of their numbers."""
    keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(inverse, weights=np.concatenate([p[1] for p in parts]), minlength=len(keys)).astype(np.int64)


ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, same_ids binary, same_times binary, pair_keys binary, pair_times binary"


def align(docs: DataFrame, a_file: bytes, b_model: bytes) -> DataFrame:
    """row (a number), doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and, packed as 64-bit numbers, A ids linked to the same bytes and keys a * n_b + b of other links, with how often each occurs."""
    shared = docs.sparkSession.sparkContext.broadcast((a_file, b_model))
    names = ["row", "doc_id", *(f.split()[0] for f in ALIGNED.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, row = aligner(*shared.value), TaskContext.get().partitionId() << 33
        kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * 4

        def frame(ids: list, done: list[tuple], first: int, kind: pa.DataType) -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(range(first, first + len(ids)), pa.int64()), pa.array(ids, kind), *columns], names)

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            ids, done, open_, units, size = [], [], [], [], 0

            def settle():
                for (doc, _), got in zip(units, own.align([u for _, u in units]), strict=True):
                    doc.add(got)
                units.clear()

            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                doc = _Document()
                ids.append(doc_id)
                open_.append(doc)
                t = text.as_py() or ""
                if sentencepiece.SPACE in t:
                    doc.fits = False
                elif t:
                    for unit in own.stretches(t):
                        units.append((doc, unit))
                        size += len(unit)
                        if size >= CHUNK:
                            settle()
                            # the last text may go on
                            done += [d.row(own) for d in open_[:-1]]
                            open_, size = open_[-1:], 0
            settle()
            done += [d.row(own) for d in open_]
            if ids:
                yield frame(ids, done, row, kind)
                row += len(ids)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"row long, doc_id {id_type}, {ALIGNED}")


def pair_counts(aligned: DataFrame, a_file: bytes, b_model: bytes) -> DataFrame:
    """a, b, n, same: how many rows of ``align`` hold each pair of ids linked."""
    shared = aligned.sparkSession.sparkContext.broadcast((a_file, b_model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*shared.value)
        vector, pairs = np.zeros(len(own.same), np.int64), (np.zeros(0, np.int64), np.zeros(0, np.int64))

        def rows(a, b, n, same):
            for low in range(0, len(a), 1 << 16):
                part = slice(low, low + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(x[part]) for x in (a, b, n, np.full(len(a), same))], ["a", "b", "n", "same"])

        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                ids, keys = (np.frombuffer(b"".join(part.column(c).to_pylist()), "<i8") for c in ("same_ids", "pair_keys"))
                vector += np.bincount(ids, minlength=len(vector))  # an id stands once in a row's list
                pairs = _summed([pairs, (keys, np.ones(len(keys), np.int64))])
                if len(pairs[0]) > MOST:
                    yield from rows(pairs[0] // own.n_b, pairs[0] % own.n_b, pairs[1], False)
                    pairs = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        some = np.flatnonzero(vector)
        yield from rows(some, own.same[some], vector[some], True)
        yield from rows(pairs[0] // own.n_b, pairs[0] % own.n_b, pairs[1], False)

    counted = aligned.select("same_ids", "pair_keys").mapInArrow(run, "a long, b long, n long, same boolean")
    return counted.groupBy("a", "b", "same").agg(F.sum("n").alias("n"))


def scored(aligned: DataFrame, counts: DataFrame, a_file: bytes, b_model: bytes, hot: int = HOT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``align``."""
    spark = aligned.sparkSession
    size = len(aligner(a_file, b_model).same)
    vector = lambda df: np.bincount(df["a"], weights=df["n"], minlength=size).astype(np.int64)
    best = vector(counts.groupBy("a").agg(F.max("n").alias("n")).toPandas())  # a row an A id
    same = vector(counts.where("same").select("a", "n").toPandas())
    others = counts.where("not same")
    total = others.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = F.col("n") * hot >= total  # at most ``hot`` pairs can be
    n_b = aligner(a_file, b_model).n_b
    often = others.where(frequent).select((F.col("a") * n_b + F.col("b")).alias("key"), "n").toPandas().sort_values("key")
    shared = spark.sparkContext.broadcast((best, same, often["key"].to_numpy(np.int64), often["n"].to_numpy(np.int64), n_b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, same, hot_keys, hot_n, n_b = shared.value
        for batch in batches:
            n_best, count_sum, rare, times = [], [], [], []
            for row in zip(*(batch.column(c).to_pylist() for c in ("same_ids", "same_times", "pair_keys", "pair_times")), strict=True):
                ids, often_, keys, n = (np.frombuffer(x, "<i8") for x in row)
                at = np.searchsorted(hot_keys, keys)
                known = at < len(hot_keys)
                known[known] = hot_keys[at[known]] == keys[known]
                count, a = hot_n[at[known]], keys[known] // n_b
                n_best.append(int(often_[same[ids] == best[ids]].sum() + n[known][count == best[a]].sum()))
                count_sum.append(int(same[ids] @ often_ + count @ n[known]))
                rare.append(keys[~known])
                times.append(n[~known])
            offsets = pa.array(np.cumsum([0, *map(len, rare)]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x) if x else [], pa.int64())) for x in (rare, times)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), *lists], [*kept, "n_best", "count_sum", "rare", "times"])

    kept = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = ", ".join(f"{c} {aligned.schema[c].dataType.simpleString()}" for c in kept)
    known = store(aligned.mapInArrow(run, f"{schema}, n_best long, count_sum long, rare array<bigint>, times array<bigint>"), "align-known")
    rare = known.select("row", F.inline(F.arrays_zip("rare", "times"))).select("row", F.col("rare").alias("key"), "times")
    looked = others.where(~frequent).join(counts.groupBy("a").agg(F.max("n").alias("best")), "a").select((F.col("a") * n_b + F.col("b")).alias("key"), "n", (F.col("n") == F.col("best")).alias("is_best"))
    more = rare.join(looked, "key").groupBy("row").agg(F.sum(F.col("n") * F.col("times")).alias("more_sum"), F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("more_best"))
    none = F.lit(0).cast("long")
    return known.join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", none)).alias("n_best"), (F.col("count_sum") + F.coalesce("more_sum", none)).alias("count_sum"), "groups_sha256"
    )


def cross_tokenizer(docs: DataFrame, a_file: bytes, b_model: bytes, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Scores of every row of ``docs`` (doc_id, text), and the counts of all pairs (a, b, n, same)."""
    aligned = store(align(docs, a_file, b_model), "align-rows")
    counts = store(pair_counts(aligned, a_file, b_model), "align-counts")
    return scored(aligned, counts, a_file, b_model, hot), counts


def op11_identity_path(spark: SparkSession, sf_dir: str, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    import public_tokenizers

    a, b = a_path or public_tokenizers.path(bpe.MODEL), b_path or public_tokenizers.path(sentencepiece.MODEL)
    return cross_tokenizer(table(spark, sf_dir, "documents"), bpe.read_file(a), sentencepiece.read_model(b))[0]


QUERIES = {"op11_identity_path": op11_identity_path}
ORACLE: dict[str, str] = {}
