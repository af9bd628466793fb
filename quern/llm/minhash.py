"""MinHash near-duplicate detection, confirmed on full shingle sets.

1. One pass over the texts computes, inside tasks, each document's number of distinct 5-word shingles, a
   128-bit key of its word sequence, a signature of MINIMA universal-hash minima (its low bytes are
   kept) and one hash for each band. Documents with equal keys form a class, represented once from here on.
2. Classes that share a band hash are candidates. Within such a bucket every class meets the bucket's
   most popular class (the one whose buckets hold most classes: an original rather than one of its edits),
   so candidates grow with the classes, not with their square. Signatures sort out the hopeless pairs,
   shingle sets decide the others, and alternating large-star and small-star join links to components.
3. Buckets that still hold several components get the exact rest: the classes outside a bucket's largest
   component meet all its classes, in blocks of BLOCK; an inverted index gives exact overlaps, and only links
   between different components come out - at most one less than there are classes. A large group of near
   copies costs its size times the few classes its star missed; a bucket of many unrelated classes (all five
   minima alike, sets unlike) would cost its square.
A link at the threshold is missed where no band agrees, (1 - 0.85**5)**20 = 8e-6, or, in a bucket of two,
where signatures agree five standard errors less than they should (3e-7).

Texts cross the network at most once (only to pick those that have candidates). Loops cut their lineage by
tables in the shared folder. Nothing but counts reaches the driver.

Defined results: null, empty or wordless text has no shingles and is linked with nothing; a text of
fewer than five words is one shingle; rows with one doc_id are one document (whatever their texts); a null
doc_id is linked with nothing and kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import drop_stored, store, table

WORDS = 5
#: Link where 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Minima of a signature, and the largest chance to miss a link at the threshold by banding.
MINIMA, MISS = 100, 1e-5
#: Classes of a block that meet another block in one task.
BLOCK = 256
_CHUNK = 1 << 20
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@functools.cache
def _constants() -> tuple[np.ndarray, ...]:
    rng = np.random.default_rng(20240229)
    draw = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return draw(256), draw(WORDS), draw(MINIMA), draw(MINIMA), draw(1), draw(4)


@functools.lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    run = lambda b: np.cumprod(np.r_[np.uint64(1), np.full((1 << bits) - 1, b, np.uint64)], dtype=np.uint64)
    return run(base), run(inverse)


def banding(percent: int) -> tuple[int, int, float]:
    """Bands, rows of a band, and the share of signature bytes that lets a pair on to its full sets (five standard errors under the threshold)."""
    p = percent / 100
    rows = max((r for r in range(1, 11) if (1 - p**r) ** (MINIMA // r) <= MISS), default=1)
    return MINIMA // rows, rows, p - 5 * (p * (1 - p) / MINIMA) ** 0.5


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a column's strings end to end, and where each begins (with the end)."""
    import pyarrow.compute as pc

    col = pc.fill_null(column.cast(pa.binary()), b"")
    data = col.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a stretch of texts, and the number of words of each text."""
    table, *_ = _constants()
    lo, hi = offsets[0], offsets[-1]
    b = _LOWER[data[lo:hi]]
    space = _SPACE[b]
    starts_text = offsets[:-1] - lo
    inner = starts_text[(starts_text > 0) & (starts_text < len(b))]
    after = np.append(True, space)  # a space or a text's beginning comes before this byte
    after[inner] = True
    before = np.append(space, True)  # a space or a text's end comes at this byte
    before[inner] = True
    begin = np.flatnonzero(~space & after[:-1])
    end = np.flatnonzero(~space & before[1:]) + 1
    up, down = _powers(max(20, int(max(1, len(b))).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[b] * up[: len(b)], dtype=np.uint64)])
    words = _mix((sums[end] - sums[begin]) * down[begin])
    n = np.diff(np.searchsorted(begin, np.append(starts_text, len(b))))
    return words, n


def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles (with repeats) of a stretch of texts, how many each text has, and a 128-bit key of each text's words."""
    _, factors, _, _, _, keys = _constants()
    words, n = word_hashes(data, offsets)
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    m = np.where(n >= WORDS, n - WORDS + 1, np.minimum(n, 1))
    begin = np.repeat(first - np.concatenate([[0], np.cumsum(m)])[:-1], m) + np.arange(m.sum())
    size = np.repeat(np.minimum(n, WORDS), m)
    padded = np.concatenate([words, np.zeros(WORDS, np.uint64)])
    h = np.zeros(len(begin), np.uint64)
    for k in range(WORDS):
        h += np.where(k < size, padded[begin + k] * factors[k], np.uint64(0))
    h = _mix(h + size.astype(np.uint64))
    # the key: position-weighted sums of word hashes, twice
    place = (np.arange(len(words)) - np.repeat(first, n)).astype(np.uint64)
    key = np.zeros((len(n), 2), np.uint64)
    some = n > 0
    if some.any():
        for j in range(2):
            terms = _mix(words * keys[2 * j] + place * keys[2 * j + 1])
            key[some, j] = _mix(np.add.reduceat(terms, first[some]) + n[some].astype(np.uint64))
    return h, m, key


def stretches(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of about _CHUNK bytes."""
    low = 0
    while low < len(offsets) - 1:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + _CHUNK, "right")) - 1)
        yield low, min(high, len(offsets) - 1)
        low = min(high, len(offsets) - 1)


def minima(h: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Signature (MINIMA values) of each text that has shingles."""
    _, _, a, b, _, _ = _constants()
    first = np.concatenate([[0], np.cumsum(m)])[:-1][m > 0]
    out = np.empty((MINIMA, len(first)), np.uint32)
    for k in range(MINIMA):
        out[k] = np.minimum.reduceat(((h * a[k] + b[k]) >> np.uint64(32)).astype(np.uint32), first)
    return out.T


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    _, _, _, _, c, _ = _constants()
    out = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None], len(signature), 0) * c[0]
    for r in range(rows):
        out = _mix(out + signature[:, r : bands * rows : rows].astype(np.uint64) * np.uint64(2 * r + 0x9E3779B97F4A7C15))
    return out


def sketches(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, key (null without words), bands (an array of longs), sig (bytes)."""
    n_bands, rows, _ = banding(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _texts(batch.column("text"))
            for low, high in stretches(offsets):
                h, m, key = shingle_hashes(data, offsets[low : high + 1])
                some = m > 0
                bounds = np.concatenate([[0], np.cumsum(m)])
                distinct = np.array([len(np.unique(h[bounds[i] : bounds[i + 1]])) for i in range(len(m))], np.int64)
                sig = minima(h, m) if some.any() else np.zeros((0, MINIMA), np.uint32)
                keys = [k.tobytes() if s else None for k, s in zip(key, some, strict=True)]
                bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some * n_bands)]), pa.int32()), pa.array(band_hashes(sig, n_bands, rows).view(np.int64).ravel()))
                sigs = iter(sig.astype(np.uint8))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), pa.array(distinct), pa.array(keys, pa.binary()), bands, pa.array([next(sigs).tobytes() if s else None for s in some], pa.binary())],
                    ["doc_id", "n_shingles", "key", "bands", "sig"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_shingles long, key binary, bands array<bigint>, sig binary")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """key and the sorted distinct shingles (64-bit, as bytes) of every text with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _texts(batch.column("text"))
            for low, high in stretches(offsets):
                h, m, key = shingle_hashes(data, offsets[low : high + 1])
                bounds = np.concatenate([[0], np.cumsum(m)])
                rows = [(key[i].tobytes(), np.unique(h[bounds[i] : bounds[i + 1]]).tobytes()) for i in np.flatnonzero(m)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary()) for k in range(2)], ["key", "shingles"])

    return docs.select("text").mapInArrow(run, "key binary, shingles binary")


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed(pairs: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` (a, b, a_shingles, b_shingles) whose sets are near enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [[np.frombuffer(x, np.uint64) for x in batch.column(c).to_pylist()] for c in ("a_shingles", "b_shingles")]
            keep = pa.array([linked(x, y, percent) for x, y in zip(*sets, strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    return pairs.mapInArrow(run, pairs.select("a", "b").schema)


def stars(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over (a, b) edges."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    own = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    if large:
        wanted = both.join(own, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        smaller = both.where("b < a")
        least = smaller.groupBy("a").agg(F.min("b").alias("m"))
        wanted = smaller.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return wanted.where("a != b").distinct()


def settled(edges: DataFrame) -> bool:
    """Whether (a, b) edges, b the smaller, are stars: every a has one edge and none is the b of another."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("up")).unionByName(edges.select(F.col("b").alias("id"), F.lit(0).alias("up")))
    of = ends.groupBy("id").agg(F.sum("up").alias("ups"), F.count(F.lit(1)).alias("n"))
    return of.where("ups > 1 or ups = 1 and n > 1").agg(F.count(F.lit(1))).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) for every id that has an edge (a, b)."""
    edges = store(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not settled(edges):
        old = edges
        edges = store(stars(stars(edges, True), False), "edges")
        drop_stored(old)
    # every id now has one edge, to its component
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


class _Union:
    def __init__(self, labels: list):
        self.of = {x: x for x in labels}

    def find(self, x):
        while self.of[x] != x:
            self.of[x] = self.of[self.of[x]]
            x = self.of[x]
        return x


def block_links(reps: list[int], comps: list[int], sets: list[np.ndarray], asking: list[bool], percent: int) -> list[tuple[int, int]]:
    """Links that join different components, from the members that ask to any: exact overlaps from an inverted index."""
    union = _Union(comps)
    sizes = np.array([len(s) for s in sets])
    flat, member = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    _, shingle, counts = np.unique(flat, return_inverse=True, return_counts=True)
    posting = member[np.argsort(shingle, kind="stable")]
    first = np.concatenate([[0], np.cumsum(counts)])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    popular = np.add.reduceat(counts[shingle], bounds[:-1]) / sizes
    out = []
    for i in np.argsort(-popular, kind="stable"):
        if not asking[i]:
            continue
        roots = np.array([union.find(c) for c in comps])
        if (roots == roots[i]).all():
            if (roots == roots[0]).all():
                break
            continue
        own = shingle[bounds[i] : bounds[i + 1]]
        n = counts[own]
        at = np.repeat(first[own] - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())
        both = np.bincount(posting[at], minlength=len(sets))
        for j in np.flatnonzero((100 * both >= percent * (sizes[i] + sizes - both)) & (roots != roots[i])):
            x, y = union.find(comps[i]), union.find(comps[j])
            if x != y:
                union.of[x] = y
                out.append((reps[i], reps[j]))
    return out


def remaining_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) inside buckets that hold several components. members: bucket, key, rep, component, n."""
    of = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("size"))
    of = of.groupBy("bucket").agg(F.max_by("component", F.struct("size", F.bitwise_not("component"))).alias("major"), (F.sum("size") - F.max("size")).alias("minors"))
    rows = members.join(of, "bucket").withColumn("asks", F.col("component") != F.col("major"))
    deal = lambda n: F.pmod(F.xxhash64("key"), F.ceil(F.col(n) / BLOCK))
    spread = lambda n: F.sequence(F.lit(0).cast("long"), F.ceil(F.col(n) / BLOCK) - 1)
    # a row stands in its own block among those asked, for every block that asks; one that asks, also in each of those
    asked = F.transform(spread("minors"), lambda p: F.struct(p.alias("p"), deal("n").alias("q"), (F.col("asks") & (deal("minors") == p)).alias("asks")))
    guests = F.filter(F.transform(spread("n"), lambda q: F.struct(deal("minors").alias("p"), q.alias("q"), F.lit(True).alias("asks"))), lambda x: F.col("asks") & (x.q != deal("n")))
    rows = rows.withColumn("at", F.explode(F.concat(asked, guests))).select("bucket", "key", "rep", "component", "at.*")
    rows = rows.join(sets, "key").select("bucket", "p", "q", "rep", "component", "asks", "shingles")

    def run(group):
        got = block_links(group["rep"].tolist(), group["component"].tolist(), [np.frombuffer(x, np.uint64) for x in group["shingles"]], group["asks"].tolist(), percent)
        import pandas as pd

        return pd.DataFrame(got, columns=["a", "b"]).astype("int64")

    return rows.groupBy("bucket", "p", "q").applyInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id long, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = store(sketches(docs, percent), "sketches")
    named = sketched.where("key is not null and doc_id is not null")
    classes = named.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    classes = store(classes, "classes")
    rows = classes.select("key", "rep", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = store(rows.join(shared, "bucket"), "members")
    popular = members.groupBy("key").agg(F.sum("n").alias("popular"))
    centre = members.join(popular, "key").groupBy("bucket").agg(F.max_by(F.struct("key", "rep"), F.struct("popular", -F.col("rep"), "key")).alias("c"))
    pairs = members.join(centre, "bucket").where("key != c.key").select("key", "rep", F.col("c.key").alias("c_key"), F.col("c.rep").alias("c_rep")).distinct()
    pairs = store(pairs, "pairs")

    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    sets = store(shingle_sets(docs.join(wanted.hint("merge"), "doc_id", "left_semi")).dropDuplicates(["key"]), "sets")
    sig = classes.select("key", "sig")
    agreeing = F.expr("aggregate(sequence(1, length(sig)), 0, (n, i) -> n + int(substring(sig, i, 1) = substring(c_sig, i, 1)))")
    likely = pairs.join(sig, "key").join(sig.select(F.col("key").alias("c_key"), F.col("sig").alias("c_sig")), "c_key").where(agreeing >= banding(percent)[2] * MINIMA)
    a, b = (sets.select(F.col("key").alias(k), F.col("shingles").alias(s)) for k, s in (("key", "a_shingles"), ("c_key", "b_shingles")))
    tested = likely.join(a, "key").join(b, "c_key").select(F.col("rep").alias("a"), F.col("c_rep").alias("b"), "a_shingles", "b_shingles")
    links = store(confirmed(tested, percent), "links")

    first = components(links)
    placed = members.join(first, members.rep == first.id, "left").select("bucket", "key", "rep", "n", F.coalesce("component", "rep").alias("component"))
    placed = store(placed, "placed")
    # a bucket of two has been decided, and buckets of the same members are looked at once
    mixed = placed.where("n > 2").groupBy("bucket", "n").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.bit_xor(F.xxhash64("key")).alias("same")).where("lo < hi")
    mixed = mixed.groupBy("n", "same").agg(F.min("bucket").alias("bucket")).select("bucket")
    rest = store(remaining_links(placed.join(mixed, "bucket", "left_semi"), sets, percent), "rest")

    copies = named.join(classes.select("key", "rep"), "key").where("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    final = components(first.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(rest).unionByName(copies))
    out = sketched.join(final, sketched.doc_id == final.id, "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op9_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op9_minhash_components": op9_minhash_components}
ORACLE: dict[str, str] = {}
