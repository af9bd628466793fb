"""Packing documents into sequences by reciprocal-capacity classes (harmonic packing).

A document is its ids and an end id. Whole sequences are cut off its front; what is left falls into class m
if m such pieces fit into a sequence, so a bin of class m always takes m pieces and no bin is ever searched
for. Where m pieces would leave more than SLACK of a sequence empty, the piece is cut to the length that
m + 1 pieces share exactly, and the rest is classed again.

Each task fills the bins of its own documents; only pieces of its unfilled bins (a constant number: at most
m - 1 for each class) go on, to be filled with those of FAN - 1 other tasks, and so on until one group is
left. Its last pieces are laid end to end and cut at sequences' ends, the last one at powers of two, so
that nothing is padded there. Ids leave a task once, with their piece; rounds are tables in the shared folder.

Memory: a task holds one text with its ids (about 12 bytes a byte of the longest text) and at most one open
bin a class; a later round's group holds FAN times the constant number of pieces.

Defined results: a null or empty text is the end id alone; repeated rows and null doc_ids are documents of
their own; an empty table gives no rows; other columns are ignored. Which pieces share a sequence follows
from how Spark deals the rows to tasks, which rereading the same files repeats.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from ._common import store, table

CAPACITY, END = 1024, 0
#: A piece stays uncut if a bin of its like leaves at most 1 / SLACK of a sequence empty.
SLACK = 64
#: Tasks (later groups) whose unfilled bins are filled together.
FAN = 16
#: Rows of an Arrow batch that leave a task at once.
ROWS = 4096

FIELDS = "start long, length long, ids binary, doc_tokens long, kind int, origin long, place long, sequence_id long, offset long"
NAMES = ["doc_id", *(f.split()[0] for f in FIELDS.split(", "))]


def cuts(n: int, capacity: int = CAPACITY) -> Iterator[tuple[int, int]]:
    """(length, class) of the pieces that ``n`` ids are cut into; a class's pieces fit into a sequence as many times as it says."""
    for _ in range(n // capacity):
        yield capacity, 1
    n %= capacity
    while n:
        fit = capacity // n
        if capacity - fit * n <= capacity // SLACK:
            yield n, fit
            return
        yield capacity // (fit + 1), fit + 1
        n -= capacity // (fit + 1)


class Bins:
    """One open bin for each class; pieces are (doc_id, start, length, ids, doc_tokens, class)."""

    def __init__(self, first: int):
        self.open: dict[int, list[tuple]] = {}
        self.next = first

    def add(self, piece: tuple) -> list[tuple]:
        """Rows of the bin that this piece fills, else none."""
        held = self.open.setdefault(piece[5], [])
        held.append(piece)
        return self._close(self.open.pop(piece[5])) if len(held) == piece[5] else []

    def _close(self, pieces: list[tuple]) -> list[tuple]:
        offset, rows = 0, []
        for p in pieces:
            rows.append((*p, None, None, self.next, offset))
            offset += p[2]
        self.next += 1
        return rows

    def unfilled(self, origin: int) -> list[tuple]:
        pieces = [p for kind in sorted(self.open) for p in self.open[kind]]
        return [(*p, origin, k, None, None) for k, p in enumerate(pieces)]

    def flush(self, capacity: int) -> list[tuple]:
        """Rows of all unfilled bins' pieces end to end, cut at full sequences and, at the end, at powers of two."""
        pieces = [p for kind in sorted(self.open) for p in self.open[kind]]
        total = sum(p[2] for p in pieces)
        sizes = [capacity] * (total // capacity) + [1 << b for b in reversed(range(capacity.bit_length())) if total % capacity >> b & 1]
        rows: list[tuple] = []
        bin_rows, room, left = [], iter(sizes), 0
        for doc_id, start, length, ids, n, kind in pieces:
            at = 0
            while at < length:
                if not left:
                    rows += self._close(bin_rows) if bin_rows else []
                    bin_rows, left = [], next(room)
                took = min(left, length - at)
                bin_rows.append((doc_id, start + at, took, ids[4 * at : 4 * (at + took)], n, kind))
                at, left = at + took, left - took
        return rows + (self._close(bin_rows) if bin_rows else [])


def _id(round_: int, group: int) -> int:
    """First sequence id of a group: rounds, groups and their bins have 7, 28 and 28 bits."""
    return round_ << 56 | group << 28


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _schema(doc_id: pa.DataType) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([("doc_id", doc_id), *((n, kinds[k]) for n, k in (f.split() for f in FIELDS.split(", ")))])


def pieces_of(rows: Iterable[tuple], capacity: int) -> Iterator[tuple]:
    """Pieces of (doc_id, ids) rows, the end id among the ids."""
    for doc_id, ids in rows:
        data, start, n = ids.astype("<u4").tobytes(), 0, len(ids)
        for length, kind in cuts(n, capacity):
            yield doc_id, start, length, data[4 * start : 4 * (start + length)], n, kind
            start += length


def pack(docs: DataFrame, tokenizer: bytes, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id and offset of every piece of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {FIELDS}"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, task = bpe.byte_bpe(shared.value), TaskContext.get().partitionId()
        bins, names = Bins(_id(0, task)), None
        last = np.array([end], np.uint32)
        for batch in batches:
            names, rows, ids = _schema(batch.schema.field("doc_id").type), [], batch.column("doc_id").to_pylist()
            own = ((i, np.append(encoder.ids(t.as_py() or ""), last)) for i, t in zip(ids, batch.column("text"), strict=True))
            for piece in pieces_of(own, capacity):
                rows += bins.add(piece)
                if len(rows) >= ROWS:
                    yield _batch(rows, names)
                    rows = []
            if rows:
                yield _batch(rows, names)
        if names:
            yield _batch(bins.unfilled(task), names)

    packed = store(docs.select("doc_id", "text").mapInArrow(first, schema), "pack-0")
    out, last_task = [packed], packed.agg(F.max("origin")).first()[0]
    round_ = 0
    while last_task is not None:
        round_ += 1
        ends, last_task = last_task < FAN, last_task // FAN
        packed = store(_again(packed.where("sequence_id is null"), schema, round_, capacity, ends), f"pack-{round_}")
        out.append(packed)
        if ends:
            break
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole.where("sequence_id is not null").drop("kind", "origin", "place")


def _again(rest: DataFrame, schema: str, round_: int, capacity: int, ends: bool) -> DataFrame:
    """Unfilled bins of FAN groups filled together; where only one group is left, ``ends``, the rest is laid end to end."""
    group = F.expr(f"origin div {FAN}")

    def run(held: pa.Table) -> pa.Table:
        held = held.sort_by([("origin", "ascending"), ("place", "ascending")])
        number = held.column("origin")[0].as_py() // FAN
        bins, rows = Bins(_id(round_, number)), []
        names = _schema(held.schema.field("doc_id").type)
        for p in zip(*(held.column(c).to_pylist() for c in NAMES[:6]), strict=True):
            rows += bins.add(p)
        rows += bins.flush(capacity) if ends else bins.unfilled(number)
        return pa.Table.from_batches([_batch(rows, names)])

    return rest.groupBy(group).applyInArrow(run, schema)


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad: int = END) -> DataFrame:
    """sequence_id, length, ids of every sequence of ``pack``, padded to ``capacity`` unless its length is a power of two."""
    laid = F.sort_array(F.collect_list(F.struct("offset", "ids", "length")))
    rows = pieces.groupBy("sequence_id").agg(laid.alias("p"), F.sum("length").alias("length"))
    ids = F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))")
    empty = F.when(F.bit_count("length") == 1, F.lit(0)).otherwise(F.lit(capacity) - F.col("length")).cast("int")
    return rows.select("sequence_id", "length", F.concat(ids, F.unhex(F.repeat(F.lit(pad.to_bytes(4, "little").hex()), empty))).alias("ids"))


def op12_harmonic_packing(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    packed = pack(table(spark, sf_dir, "documents"), bpe.read_file(path or public_tokenizers.path(bpe.MODEL)))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {"op12_harmonic_packing": op12_harmonic_packing}
ORACLE: dict[str, str] = {}
