"""Thousands of markers looked for in every text at once.

Markers become one automaton of flat arrays (Aho-Corasick): ``step`` leads from a state and a byte's class to
the next state, ``own`` and ``link`` tell which markers end there. Texts are read in lanes of equal length,
all lanes a byte at a time, so a batch costs one array look-up a byte, whatever the number of markers. Lanes of one text
overlap by the longest marker, so nothing is lost between them.

An automaton's size is checked before it is broadcast: markers that would need more than TABLE bytes are
dealt by a hash to several automata, and the texts are read once for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes that the arrays of one automaton may take.
TABLE = 64 << 20
#: Bytes of a lane, and of text read at once.
LANE, CHUNK = 1024, 4 << 20


class Automaton:
    """Arrays for a set of different, non-empty markers."""

    def __init__(self, markers: list[bytes]):
        used = sorted(set(b"".join(markers)))
        self.classes = np.zeros(256, np.int32)  # 0: a byte that no marker has
        self.classes[used] = np.arange(1, len(used) + 1)
        self.width, self.longest = len(used) + 1, max(map(len, markers), default=1)
        trie: list[dict[int, int]] = [{}]
        own = [-1]
        depth = [0]
        for k, marker in enumerate(markers):
            at = 0
            for c in self.classes[list(marker)].tolist():
                if c not in trie[at]:
                    trie[at][c] = len(trie)
                    trie.append({})
                    own.append(-1)
                    depth.append(depth[at] + 1)
                at = trie[at][c]
            own[at] = k
        self.own, self.link = np.array(own), np.zeros(len(trie), np.int64)
        self.step = np.zeros((len(trie), self.width), np.int32)
        fail = np.zeros(len(trie), np.int64)
        for s in np.argsort(depth, kind="stable").tolist():  # a state's suffix is nearer to the root
            row = self.step[fail[s]].copy()
            for c, child in trie[s].items():
                fail[child], row[c] = row[c], child
            self.step[s] = row
            self.link[s] = fail[s] if self.own[fail[s]] >= 0 else self.link[fail[s]]
        self.says = (self.own >= 0) | (self.link > 0)

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, marker, end) of every occurrence in texts laid end to end; ``offsets`` are their begins and the last end."""
        size = np.diff(offsets)
        n = -(-size // LANE)
        text = np.repeat(np.arange(len(size)), n)
        first = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * LANE
        warm = np.minimum(first, self.longest - 1)
        begin, length = offsets[text] + first - warm, np.minimum(size[text] - first, LANE) + warm
        order = np.argsort(-length, kind="stable")
        text, begin, length, warm = text[order], begin[order], length[order], warm[order]
        kinds, step, state = self.classes[data], self.step.ravel(), np.zeros(len(text), np.int64)
        hits = []
        for j in range(int(length[0]) if len(length) else 0):
            active = int(np.searchsorted(-length, -j, "left"))  # lanes longer than j
            now = step[state[:active] * self.width + kinds[begin[:active] + j]]
            state[:active] = now
            lane = np.flatnonzero(self.says[now])
            lane = lane[j >= warm[lane]]
            if len(lane):
                hits.append((text[lane], now[lane], begin[lane] + j + 1))
        if not hits:
            return (np.zeros(0, np.int64),) * 3
        text, at, end = (np.concatenate(x) for x in zip(*hits, strict=True))
        out = []
        while len(at):  # every marker that ends here: the state's own, then those of its links
            some = self.own[at] >= 0
            out.append((text[some], self.own[at[some]], end[some]))
            text, end, at = text, end, self.link[at]
            text, end, at = text[at > 0], end[at > 0], at[at > 0]
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


#: Bytes of markers that come to the driver at once.
COLLECTED = 4 << 20


def _blocks(markers: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    """Markers (id, marker) in blocks whose automata fit into TABLE."""
    different = markers.where("marker is not null and marker != ''").groupBy("marker").agg(F.min("id").alias("id"))
    total = different.agg(F.coalesce(F.sum(F.octet_length("marker")), F.lit(0))).first()[0]
    n = max(1, -(-total // COLLECTED))
    for k in range(n):
        part = different.where(F.pmod(F.xxhash64("marker"), F.lit(n)) == k) if n > 1 else different
        yield from _fitting([(r.id, r.marker.encode()) for r in part.collect()])


def _fitting(rows: list[tuple[int, bytes]]) -> Iterator[list[tuple[int, bytes]]]:
    """Rows cut where their automaton's table would grow over TABLE; a marker that is too long alone is one block."""
    width, block, size = len(set(b"".join(m for _, m in rows))) + 1, [], 1
    for row in rows:
        if block and (size + len(row[1])) * 4 * width > TABLE:
            yield block
            block, size = [], 1
        block.append(row)
        size += len(row[1])
    if block:
        yield block


def contained(texts: DataFrame, column: str, markers: DataFrame, name: str = "found") -> DataFrame:
    """``texts`` with the sorted ids of the ``markers`` (id long, marker) that stand in ``column``.

    Markers alike count as the one with the smallest id; null ones stand nowhere, the empty one in every text.
    A null text holds nothing. A column called ``name`` is replaced.
    """
    out = texts.drop(name)
    empty = markers.where("marker = ''").agg(F.min("id")).first()[0]
    found = [F.array(F.lit(empty).cast("long"))] if empty is not None else []
    for k, block in enumerate(_blocks(markers)):
        out = _pass(out, column, block, f"__m{k}")
        found.append(F.col(f"__m{k}"))
    none = F.expr("cast(array() as array<bigint>)")
    joined = F.array_sort(F.flatten(F.array(*found))) if found else none
    return out.withColumn(name, F.when(F.col(column).isNotNull(), joined).otherwise(none)).select(*[c for c in texts.columns if c != name], name)


def _pass(texts: DataFrame, column: str, block: list[tuple[int, bytes]], name: str) -> DataFrame:
    automaton = Automaton([m for _, m in block])
    shared = texts.sparkSession.sparkContext.broadcast((automaton, np.array([i for i, _ in block], np.int64)))
    schema = texts.selectExpr("*", f"cast(array() as array<bigint>) as {name}").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, ids = shared.value
        for batch in batches:
            raw = pc.fill_null(batch.column(column).cast(pa.binary()), b"")
            marks = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64)
            data = np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] else np.zeros(0, np.uint8)
            low, pairs = 0, []
            while low < len(raw):
                high = max(low + 1, int(np.searchsorted(marks, marks[low] + CHUNK, "right")) - 1)
                high = min(high, len(raw))
                text, marker, _ = machine.scan(data[marks[low] : marks[high]], marks[low : high + 1] - marks[low])
                pairs.append(np.unique((text + low) * len(ids) + marker))
                low = high
            pairs = np.concatenate(pairs) if pairs else np.zeros(0, np.int64)
            offsets = np.searchsorted(pairs, np.arange(len(raw) + 1) * len(ids)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[pairs % len(ids)]))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, name])

    return texts.mapInArrow(run, schema)


def of_list(texts: DataFrame, column: str, markers: list[str], name: str = "found") -> DataFrame:
    """``contained`` for a list that the caller holds; ids are places in it."""
    different: dict[str, int] = {}
    for k, m in enumerate(markers):
        if m is not None:
            different.setdefault(m, k)
    out, found = texts.drop(name), []
    for block in _fitting([(k, m.encode()) for m, k in different.items() if m]):
        out = _pass(out, column, block, f"__m{len(found)}")
        found.append(F.col(f"__m{len(found)}"))
    if "" in different:
        found.append(F.array(F.lit(different[""]).cast("long")))
    none = F.expr("cast(array() as array<bigint>)")
    joined = F.array_sort(F.flatten(F.array(*found))) if found else none
    return out.withColumn(name, F.when(F.col(column).isNotNull(), joined).otherwise(none)).select(*[c for c in texts.columns if c != name], name)
