"""Periodic runs of words: stretches that repeat with a period, found in every whole text.

Descending-LCP Kruskal. Suffixes of a text's words are sorted (prefix doubling) and neighbours united in
classes by decreasing common prefix; each class is an ordered set of positions, the smaller is put into the
larger. Positions i < j that become neighbours at common prefix c lie at distance d = j - i; if d is within
c, the words from i on have period d for d + c words. For the start of a run (no such repeat one word
earlier) that is the whole run, and no smaller period is possible, for its position would lie between.
Only prefixes long enough for the least run are ever united, so ordinary prose costs one hash a word.

A run is a stretch of consecutive words with smallest period q, length >= max(LEAST, POWER * q), that no
neighbouring word extends keeping the period. Texts are read whole, in tasks, from Arrow batches; nothing
is shuffled. Words are compared as bytes: equal hashes are checked, letter by letter.

Memory is about 40 bytes a word and 60 bytes a byte of a stretch of CHUNK bytes; a text that repeats itself
takes 4 bytes a word more for each doubling of its longest repeat, and one with few words that differ some
200 bytes a word for its position sets.

Defined results: null, empty and wordless texts have no runs; repeated rows and null doc_ids are each
looked at; other columns stay as they are; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import table

LEAST, POWER = 24, 3
#: Bytes hashed at once.
CHUNK = 1 << 20
#: Positions in a block of an ordered set.
BLOCK = 1024
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


@functools.cache
def _constants(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20250107)
    draw = lambda k: rng.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = 0x9E3779B97F4A7C15
    run = lambda b: np.cumprod(np.r_[np.uint64(1), np.full(CHUNK * 2, b, np.uint64)], dtype=np.uint64)
    return draw(256), run(base), draw(n)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word of a text's bytes."""
    edge = np.diff(np.concatenate([[True], _SPACE[data], [True]]).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, in stretches of about CHUNK bytes that end with a word."""
    letters, powers, _ = _constants(16)
    inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    out, low = np.empty(len(begin), np.uint64), 0
    while low < len(begin):
        high = max(low + 1, int(np.searchsorted(end, begin[low] + CHUNK, "right")))
        first, last = begin[low], end[high - 1]
        if last - first > 2 * CHUNK:  # one giant word
            h = np.zeros(1, np.uint64)
            for at in range(int(first), int(last), CHUNK):
                part = data[at : min(at + CHUNK, last)]
                h = _mix(h) + np.sum(letters[part] * powers[: len(part)], dtype=np.uint64, keepdims=True)
            out[low] = h[0]
        else:
            part = data[first:last]
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters[part] * powers[: len(part)], dtype=np.uint64)])
            at = begin[low:high] - first
            out[low:high] = (sums[end[low:high] - first] - sums[at]) * _inverse_powers(inverse)[at]
        low = high
    return _mix(out + (end - begin).astype(np.uint64))


@functools.cache
def _inverse_powers(inverse: np.uint64) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(CHUNK * 2, inverse, np.uint64)], dtype=np.uint64)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words."""
    factors = _constants(n)[2]
    h = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        h += words[k : k + len(h)] * factors[k]
    return h


def word_ids(data: np.ndarray, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A number for each different word."""
    _, first, ids = np.unique(hashes, return_index=True, return_inverse=True)
    size, same = end - begin, first[ids]
    if not (size == size[same]).all() or not _equal(data, begin, begin[same], size):
        known: dict[bytes, int] = {}
        raw = data.tobytes()
        ids = np.array([known.setdefault(raw[b:e], len(known)) for b, e in zip(begin, end, strict=True)])
    return ids


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> bool:
    """Whether the stretches of ``size`` bytes at a and b are alike, all of them."""
    stops, low = np.cumsum(size), 0
    while low < len(size):
        high = max(low + 1, int(np.searchsorted(stops, stops[low] + CHUNK)))
        n = size[low:high]
        if high == low + 1:
            same = np.array_equal(data[a[low] : a[low] + n[0]], data[b[low] : b[low] + n[0]])
        else:
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            same = np.array_equal(data[np.repeat(a[low:high], n) + within], data[np.repeat(b[low:high], n) + within])
        if not same:
            return False
        low = high
    return True


def suffixes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the common prefix of each with the one before it (0 for the first)."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int32)
    levels, step = [rank], 1
    while step < n and rank.max() < n - 1:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:].astype(np.int64) + 1
        rank = np.unique(rank.astype(np.int64) * (n + 1) + after, return_inverse=True)[1].astype(np.int32)
        levels.append(rank)
        step *= 2
    order = np.argsort(rank, kind="stable")
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n, np.int64)
    for k in reversed(range(len(levels))):
        at = np.flatnonzero((a < n) & (b < n))
        # equal ranks at a level stand for equal words only if neither suffix ends before
        same = at[(levels[k][a[at]] == levels[k][b[at]]) & (np.maximum(a[at], b[at]) + (1 << k) <= n)]
        common[same + 1] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    return order, common


class Positions:
    """An ordered set of positions in blocks; ``add`` tells the new one's neighbours."""

    __slots__ = ("blocks", "size")

    def __init__(self, first: int):
        self.blocks, self.size = [[first]], 1

    def add(self, p: int) -> tuple[int, int]:
        """Puts ``p`` in; the position before and after it, or -1."""
        blocks = self.blocks
        k = 0
        if len(blocks) > 1:
            low, high = 0, len(blocks)
            while low < high:  # the last block that begins before p
                mid = (low + high) // 2
                if blocks[mid][0] < p:
                    low = mid + 1
                else:
                    high = mid
            k = max(0, low - 1)
        block = blocks[k]
        at = bisect_left(block, p)
        before = block[at - 1] if at else -1
        after = block[at] if at < len(block) else blocks[k + 1][0] if k + 1 < len(blocks) else -1
        block.insert(at, p)
        self.size += 1
        if len(block) > BLOCK:
            blocks.insert(k + 1, block[BLOCK // 2 :])
            del block[BLOCK // 2 :]
        return before, after

    def __iter__(self) -> Iterator[int]:
        return (p for b in self.blocks for p in b)


def seeds(order: np.ndarray, common: np.ndarray, least: int, power: int) -> list[tuple[int, int, int]]:
    """(i, distance, common prefix) of positions that become neighbours with a prefix of ``least`` words and ``power`` - 1 distances or more."""
    at = np.flatnonzero(common >= least)
    at = at[np.argsort(-common[at], kind="stable")]
    of: dict[int, int] = {}
    sets: dict[int, Positions] = {}
    found = []

    def root(x: int) -> int:
        if x not in of:
            of[x], sets[x] = x, Positions(x)
            return x
        while of[x] != x:
            of[x] = of[of[x]]
            x = of[x]
        return x

    for a, b, c in zip(order[at - 1].tolist(), order[at].tolist(), common[at].tolist(), strict=True):
        a, b = root(a), root(b)
        if sets[a].size < sets[b].size:
            a, b = b, a
        of[b] = a
        large, reach = sets[a], c // (power - 1)
        members = list(sets.pop(b))
        for k, p in enumerate(members):  # ascending: before p may stand one of its own, after it only what was there
            before, after = large.add(p)
            if 0 <= before and p - before <= reach and (k == 0 or before != members[k - 1]):
                found.append((before, p - before, c))
            if p < after <= p + reach and (k + 1 == len(members) or members[k + 1] > after):
                found.append((p, after - p, c))
    return found


def runs_of(ids: np.ndarray, least: int = LEAST, power: int = POWER) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    order, common = suffixes(ids)
    got = np.array(seeds(order, common, max(1, least - least // power), power), np.int64).reshape(-1, 3)
    i, d, c = got.T
    starts = (i == 0) | (ids[i - 1] != ids[i + d - 1])
    whole = starts & (d + c >= least)
    return sorted(zip(i[whole].tolist(), (d + c)[whole].tolist(), d[whole].tolist(), strict=True), key=lambda r: (r[0], r[2]))


def text_runs(data: np.ndarray, least: int = LEAST, power: int = POWER) -> tuple[list[tuple[int, int, int]], int, np.ndarray, np.ndarray]:
    """Runs of a text's bytes, the number of its words, and where they begin and end."""
    begin, end = words_of(data)
    gram = least - least // power
    if len(begin) < least:
        return [], len(begin), begin, end
    hashes = word_hashes(data, begin, end)
    grams = np.sort(gram_hashes(hashes, gram))
    if not (grams[1:] == grams[:-1]).any():
        return [], len(begin), begin, end
    return runs_of(word_ids(data, begin, end, hashes), least, power), len(begin), begin, end


def collapsed(data: np.ndarray, begin: np.ndarray, end: np.ndarray, runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats - of a run's, the first period - joined by one space."""
    drop = np.zeros(len(begin) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    keep = np.cumsum(drop[:-1]) == 0
    begin, end = begin[keep], end[keep]
    if not len(begin):
        return b""
    # a word and one byte after it, which becomes the space; words next to each other are copied in one stretch
    mark = np.zeros(len(data) + 2, np.int8)
    mark[begin] += 1
    mark[end + 1] -= 1
    kept = np.cumsum(mark[:-1], dtype=np.int8) > 0
    padded = np.append(data, np.uint8(32))
    out = np.where(_SPACE[padded], np.uint8(32), padded)[kept]
    return out[:-1].tobytes()


def detect(docs: DataFrame, least: int = LEAST, power: int = POWER) -> DataFrame:
    """``docs`` (text) with n_words, runs (an array of start, length, period) and collapsed (the text without repeats)."""
    taken = [c for c in docs.columns if c not in ("n_words", "runs", "collapsed")]
    docs = docs.select(*taken)
    schema = docs.selectExpr("*", "0L as n_words", "array(named_struct('start', 0L, 'length', 0L, 'period', 0L)) as runs", "'' as collapsed").schema
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                n_words, runs, texts = [], [], []
                for t in part.column("text"):
                    data = np.frombuffer(t.as_py().encode() if t.is_valid else b"", np.uint8)
                    found, n, begin, end = text_runs(data, least, power)
                    n_words.append(n)
                    runs.append([{"start": s, "length": m, "period": q} for s, m, q in found])
                    texts.append(collapsed(data, begin, end, found).decode())
                columns = [*(part.column(c) for c in taken), pa.array(n_words, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*taken, "n_words", "runs", "collapsed"])

    return docs.mapInArrow(run, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties go to the smallest start, then period."""
    more = lambda x, y: x["length"] * y["period"] - y["length"] * x["period"]
    first = lambda x, y: (more(x, y) > 0) | ((more(x, y) == 0) & ((x["start"] < y["start"]) | ((x["start"] == y["start"]) & (x["period"] < y["period"]))))
    return F.aggregate(runs, F.get(runs, 0), lambda best, x: F.when(first(x, best), x).otherwise(best))


def made_periodic(docs: DataFrame) -> DataFrame:
    """``docs`` where the words of every tenth text (by a hash of its doc_id) repeat from some word on, as the query asks."""
    word = r"[^ \x09-\x0D]++"
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(word), F.lit(0))
    rows = docs.withColumn("__h", h).withColumn("__w", F.when(F.col("__h") % 10 == 0, words))
    again = (
        "transform(array(named_struct('w', __w, 'n', bigint(size(__w)), 'g', __h div 10)), x -> transform(array(named_struct('a', x.g % x.n, 'p', 1 + (x.n - x.g % x.n) div (3 + x.g % 8))),"
        " y -> array_join(concat(slice(x.w, 1, int(y.a)), transform(sequence(0L, x.n - y.a - 1), i -> element_at(x.w, int(y.a + i % y.p + 1)))), ' '))[0])[0]"
    )
    return rows.withColumn("text", F.when(F.size("__w") > 0, F.expr(again)).otherwise(F.col("text"))).drop("__h", "__w")


def op13_lcp_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = made_periodic(table(spark, sf_dir, "documents").select("doc_id", "text"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = strongest(F.col("runs"))
    found = detect(docs).withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op13_lcp_runs": op13_lcp_runs}
ORACLE: dict[str, str] = {}
