"""The exact rest of buckets that hold several components, against all pairs."""

import random

import numpy as np
from pyspark.sql import functions as F

from quern.llm import minhash


def test_mixed_buckets_give_every_component_link(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(9)
    base = [rng.randrange(2**60) for _ in range(60)]
    members, sets = [], {}
    for k in range(70):
        own = set(base if k % 3 else base[:30]) | {rng.randrange(2**60) for _ in range(rng.randrange(0, 9))}
        sets[k] = np.array(sorted(own), np.uint64)
        members.append((k % 2, bytes([k]), k, k if k > 40 else 0, 35))
    df = spark.createDataFrame(members, "bucket long, key binary, rep long, component long, n long")
    kept = spark.createDataFrame([(bytes([k]), v.tobytes()) for k, v in sets.items()], "key binary, shingles binary")
    links = minhash.remaining_links(df, kept, 85).collect()
    of = {k: c for _, _, k, c, _ in members}

    def roots(pairs):
        up = {c: c for c in of.values()}

        def find(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in pairs:
            x, y = sorted((find(of[a]), find(of[b])))
            up[y] = x
        return {k: find(c) for k, c in of.items()}

    every = [(a, b) for a in sets for b in sets if a < b and a % 2 == b % 2 and minhash.linked(sets[a], sets[b], 85)]
    assert all(minhash.linked(sets[r.a], sets[r.b], 85) for r in links)
    assert roots([(r.a, r.b) for r in links]) == roots(every) and len(links) < len(every)
