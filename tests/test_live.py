"""Claims sink over restarts and failures, live stall flags, checkpoints in arrays, and releases that fail half way."""

import random
import time

import pytest
from pyspark.sql import functions as F

from quern.operators import draws
from quern.plans import live
from quern.sources import releases, views
from quern.streaming import intake, stalls

COLUMNS = ["doc_id", "line_no", "category", "claim_text", "metric_type", "region", "year"]


def rows(df):
    return sorted(map(str, df.select(*COLUMNS).collect()))


@pytest.fixture
def parts(spark, sf, tmp_path):
    docs = views.table(spark, sf, "documents").limit(120).withColumn("text", F.concat(F.col("text"), F.lit("\nIn May there were 12 cases and 34% of "), F.col("doc_id").cast("string"), F.lit(" deaths reported.\nNCR | 1 | 2 | 30% | 4")))
    for k in range(4):
        docs.where(F.pmod("doc_id", F.lit(4)) == k).coalesce(1).write.parquet(str(tmp_path / f"p{k}"))
    return docs.schema, tmp_path


def arrive(tmp_path, k, name):
    (tmp_path / "in").mkdir(exist_ok=True)
    file = next((tmp_path / f"p{k}").glob("*.parquet"))
    (tmp_path / "in" / f"{name}.parquet").write_bytes(file.read_bytes())
    time.sleep(0.05)


def drain(spark, schema, tmp_path, claims=live.normalized_claims):
    stream = intake.follow(spark, str(tmp_path / "in"), schema, 1)
    intake.claims_into(stream, str(tmp_path / "out"), str(tmp_path / "log"), claims)


def test_claims_equal_the_batch_after_restarts(spark, parts):
    schema, at = parts
    arrive(at, 0, "a"), arrive(at, 1, "b")
    drain(spark, schema, at)
    arrive(at, 2, "c"), arrive(at, 3, "d"), arrive(at, 1, "again")
    seen = []

    def fails_once(batch):
        seen.append(1)
        if len(seen) == 2:
            raise RuntimeError("lost")
        return live.normalized_claims(batch)

    with pytest.raises(Exception, match="lost"):
        drain(spark, schema, at, fails_once)
    drain(spark, schema, at)
    batch = live.normalized_claims(spark.read.parquet(*(str(at / f"p{k}") for k in range(4))))
    assert len(rows(batch)) > 200
    assert rows(intake.current_claims(spark, str(at / "out"))) == rows(batch)


def test_a_file_or_a_folder_is_followed(spark, sf, tmp_path):
    schema = views.table(spark, sf, "events").schema
    for name, path in (("file", f"{sf}/events.parquet"), ("folder", str(tmp_path / "events.parquet"))):
        if name == "folder":
            views.table(spark, sf, "events").repartition(3).write.parquet(path)
        intake.drain(intake.follow(spark, path, schema).select("event_id"), str(tmp_path / f"o{name}"), str(tmp_path / f"c{name}"))
        assert spark.read.parquet(str(tmp_path / f"o{name}")).count() == views.table(spark, sf, "events").count()


def flags_of(events, seen, limits=((240, "slow"), (900, "stalled"))):
    out = []
    for key in {k for k, _ in events}:
        ts = sorted({t for k, t in events if k == key})
        for t, later in zip(ts, [*ts[1:], seen]):
            out += [(key, name, t) for s, name in limits if later - t >= s]
    return sorted(out)


def test_flags_over_several_batches_with_late_rows(spark, tmp_path):
    stalls.with_timers(spark)
    batches = [[("a", 0), ("b", 10)], [("a", 100), ("b", 2000)], [("a", 1000), ("b", 1990), (None, 5)], [("c", 9000)], [("d", 30_000)]]
    (tmp_path / "in").mkdir()
    for k, batch in enumerate(batches):
        df = spark.createDataFrame(batch, "user string, s long").select("user", F.timestamp_seconds("s").alias("ts")).coalesce(1)
        df.write.parquet(str(tmp_path / f"b{k}"))
        (tmp_path / "in" / f"{k}.parquet").write_bytes(next((tmp_path / f"b{k}").glob("*.parquet")).read_bytes())
        time.sleep(0.05)
    stream = intake.follow(spark, str(tmp_path / "in"), df.schema, 1)
    intake.drain(stalls.stall_flags(stream, "ts", "user", "1 hour"), str(tmp_path / "out"), str(tmp_path / "log"))
    got = [(r.user, r.flag, int(r.last_event.timestamp())) for r in spark.read.schema("user string, flag string, last_event timestamp").parquet(str(tmp_path / "out")).select("user", "flag", F.col("last_event")).collect()]
    # b's row of 1990 is no news after 2000, and d's silence isn't over
    events = [e for b in batches for e in b if e[0] and e != ("b", 1990)]
    assert sorted(got) == flags_of(events, 30_000 - 3600)


def test_a_stopped_key_is_told_of_without_an_event(spark, tmp_path):
    stalls.with_timers(spark)
    (tmp_path / "in").mkdir()
    df = spark.createDataFrame([("stopped",)], "user string").withColumn("ts", F.current_timestamp()).coalesce(1)
    schema = df.schema
    df.write.parquet(str(tmp_path / "b"))
    (tmp_path / "in" / "a.parquet").write_bytes(next((tmp_path / "b").glob("*.parquet")).read_bytes())
    stream = stalls.stall_flags(intake.follow(spark, str(tmp_path / "in"), schema), "ts", "user", live=True, slow=1, stalled=3)
    running = stream.writeStream.format("memory").queryName("stall_flags_live").outputMode("append").option("checkpointLocation", str(tmp_path / "log")).trigger(processingTime="1 second").start()
    try:
        for _ in range(60):
            time.sleep(1)
            if spark.table("stall_flags_live").count() >= 2:
                break
        assert [(r.user, r.flag) for r in spark.table("stall_flags_live").orderBy("flag").collect()] == [("stopped", "slow"), ("stopped", "stalled")]
    finally:
        running.stop()


def test_checkpoint_in_arrays(spark):
    paths = spark.sql("""select * from values
      ('a', array(1, 2, 3), array(1.0D, 2.0D, 3.0D), array(named_struct('year', 2, 'value', 2.0D), named_struct('year', 3, 'value', 3.0D)), array(1)),
      ('b', array(1, 2), array(1.0D, null), array(named_struct('year', 2, 'value', 9.0D)), array(1)),
      ('c', cast(array() as array<int>), cast(array() as array<double>), null, cast(array() as array<int>)) as t(key, years, values, forecast, observed_years)""")
    seen = spark.createDataFrame([("a", 2, 20.0), ("c", 5, 1.0), ("x", 1, 1.0), ("b", None, 1.0)], "key string, year int, value double")
    out = {r.key: r for r in draws.with_checkpoint(paths, seen, ["key"]).collect()}
    assert out["a"]["values"] == [1.0, 20.0, 3.0] and [f.year for f in out["a"].forecast] == [3] and out["a"].observed_years == [1, 2]
    assert out["b"]["values"] == [1.0, None] and [f.year for f in out["b"].forecast] == [2] and out["b"].observed_years == [1]
    assert out["c"]["values"] == [] and out["c"].forecast is None and out["c"].observed_years == [5]


def test_a_failed_release_leaves_the_old_one(spark, tmp_path):
    root = str(tmp_path)
    assert releases.pinned(spark, root) == (0, {})
    one = spark.createDataFrame([(1, "old")], "k int, v string")
    assert releases.publish(spark, root, {"a": one, "b": one}) == 1
    pin = releases.pinned(spark, root)
    broken = one.withColumn("v", F.raise_error(F.lit("killed")).cast("string"))
    with pytest.raises(Exception, match="killed"):
        releases.publish(spark, root, {"a": one.withColumn("v", F.lit("new")), "b": broken})
    assert releases.pinned(spark, root) == pin
    fresh = spark.createDataFrame([(1, "new"), (2, "more")], "k int, v string")
    assert releases.publish(spark, root, {"a": releases.upserted(releases.read(spark, pin, "a"), fresh, ["k"])}) == 2
    now = releases.pinned(spark, root)
    assert sorted(map(tuple, releases.read(spark, now, "a").collect())) == [(1, "new"), (2, "more")]
    assert releases.read(spark, now, "b").first().v == "old"  # a feed not in the release stays
    assert releases.read(spark, pin, "a").first().v == "old"  # who pinned the first still reads it
    assert releases.pinned(spark, root, 1) == pin


def test_upserts_touch_only_their_buckets(spark, tmp_path):
    rng, rows = random.Random(5), []
    (tmp_path / "in").mkdir()
    for k in range(4):
        batch = [(rng.choice([None, *range(40)]) if k < 3 else 7, k * 100 + i // 2, f"{k}-{i}") for i in range(30)]
        rows += batch
        df = spark.createDataFrame(batch, "key int, at int, say string").coalesce(1)
        df.write.parquet(str(tmp_path / f"b{k}"))
        (tmp_path / "in" / f"{k}.parquet").write_bytes(next((tmp_path / f"b{k}").glob("*.parquet")).read_bytes())
        time.sleep(0.05)
    stream = intake.follow(spark, str(tmp_path / "in"), df.schema, 1)
    target = str(tmp_path / "table")
    for _ in range(2):  # the second call finds nothing new
        intake.upsert_into(stream, target, str(tmp_path / "log"), ["key"], ["at", "say"], 8)
    want = {key: max((at, say) for k, at, say in rows if k == key) for key in {k for k, _, _ in rows}}
    got = {r.key: (r["at"], r.say) for r in intake.upserted(spark, target, df.schema).collect()}
    assert got == want
    assert len(list((tmp_path / "table" / "batch=3").glob("bucket=*"))) == 1  # the last batch has one key
