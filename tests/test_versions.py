"""Version log and bucketed upserts."""
import os
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from vehiscope.plans import maintenance as M
from vehiscope.sources import versions as V
from vehiscope.streaming import upserts as U

SCHEMA = "id long, status string, ts long"


def ids(df):
    return sorted(r.id for r in df.collect())


def test_versions_times_and_restore(spark, tmp_out):
    assert V.entry(spark, tmp_out) is None
    for k, day in enumerate((1, 2, 3), 1):
        assert V.write(spark.range(k), tmp_out, time=f"2025-01-0{day}") == k
    assert ids(V.read(spark, tmp_out)) == [0, 1, 2]
    assert ids(V.read(spark, tmp_out, version=1)) == [0]
    assert ids(V.read(spark, tmp_out, as_of="2025-01-02T12:00:00")) == [0, 1]
    with pytest.raises(ValueError, match="no version at"):
        V.read(spark, tmp_out, as_of="2024-12-31")
    with pytest.raises(ValueError, match="no version 9"):
        V.read(spark, tmp_out, version=9)
    assert V.restore(spark, tmp_out, 1, time="2025-01-04") == 4
    assert ids(V.read(spark, tmp_out)) == [0] and ids(V.read(spark, tmp_out, version=3)) == [0, 1, 2]
    log = [tuple(r) for r in V.history(spark, tmp_out).orderBy("version").select("version", "parent", "kind", "restored", "rows").collect()]
    assert log == [(1, None, "write", None, 1), (2, 1, "write", None, 2), (3, 2, "write", None, 3), (4, 3, "restore", 1, 1)]


def test_a_second_writer_of_a_version_is_refused(spark, tmp_out):
    V.write(spark.range(1), tmp_out)
    parent = V.entry(spark, tmp_out)
    data = V.write_data(spark.range(2), tmp_out)
    V.commit(spark, tmp_out, {V.DATA: data}, "write", parent)
    with pytest.raises(V.Conflict):
        V.commit(spark, tmp_out, {V.DATA: V.write_data(spark.range(3), tmp_out)}, "write", parent)
    assert ids(V.read(spark, tmp_out)) == [0, 1]
    assert not [f for f in os.listdir(os.path.join(tmp_out, "_log")) if f.endswith(".tmp")]


def test_a_broken_write_or_restore_changes_nothing(spark, tmp_out, monkeypatch):
    V.write(spark.range(2), tmp_out)
    V.write(spark.range(3), tmp_out)
    bad = spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        V.write_release({"a": spark.range(4), "b": bad}, tmp_out)
    monkeypatch.setattr(V, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        V.restore(spark, tmp_out, 1)
    assert ids(V.read(spark, tmp_out)) == [0, 1, 2] and V.numbers(spark, tmp_out) == [1, 2]


def test_vacuum_keeps_what_a_kept_version_names(spark, tmp_out):
    for k in (1, 2, 3):
        V.write(spark.range(k), tmp_out)
    V.restore(spark, tmp_out, 1)
    gone = V.vacuum(spark, tmp_out, keep=1)
    assert len(gone) == 2 and not any(os.path.exists(p) for p in gone)
    assert ids(V.read(spark, tmp_out)) == [0] and V.numbers(spark, tmp_out) == [4]
    with pytest.raises(ValueError):
        V.vacuum(spark, tmp_out, keep=0)


def latest(rows):
    out = {}
    for r in rows:
        if r[0] not in out or (r[2], ) >= (out[r[0]][2], ):
            out[r[0]] = r
    return sorted(out.values(), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upserts_merge_and_compact(spark, tmp_out):
    rng = random.Random(5)
    rows = [(k, "base", 1) for k in range(60)] + [(None, "base", 1)]
    U.create(spark.createDataFrame(rows, SCHEMA), tmp_out, ["id"], ["ts"], buckets=8)
    for step in range(4):
        more = [(rng.randrange(80), f"s{step}", rng.randrange(4)) for _ in range(6)] + [(None, f"s{step}", step)]
        more = list({r[0]: r for r in more}.values())
        rows += more
        U.upsert(spark.createDataFrame(more, SCHEMA), tmp_out)
        assert got(U.current(spark, tmp_out)) == latest(rows)
        if step == 1:
            U.compact(spark, tmp_out)
            assert got(U.current(spark, tmp_out)) == latest(rows)
    assert got(U.current(spark, tmp_out, version=1)) == latest(rows[:61])
    kinds = [r.kind for r in V.history(spark, tmp_out).orderBy("version").collect()]
    assert kinds == ["create", "upsert", "upsert", "compact", "upsert", "upsert"]
    with pytest.raises(ValueError, match="columns differ"):
        U.upsert(spark.createDataFrame([(1,)], "id long"), tmp_out)


def scanned(df):
    return [f.partition(U.BUCKET + "=")[2].partition("/")[0] for f in df.inputFiles()]


def test_a_one_bucket_delta_merges_one_bucket(spark, tmp_out):
    df = spark.range(500).selectExpr("id", "'b' as status", "1L as ts")
    U.create(df, tmp_out, ["id"], ["ts"], buckets=16)
    U.upsert(spark.createDataFrame([(7, "new", 2)], SCHEMA), tmp_out)
    entry, table = U._state(spark, tmp_out)
    bucket = spark.range(7, 8).select(U.bucket_of(["id"], 16)).first()[0]
    assert table["deltas"][0]["buckets"] == [bucket]
    # the merge reads this bucket of the base and the delta; the others are not shuffled
    assert set(scanned(U._merged(spark, table, {bucket}))) == {str(bucket)}
    plan = U.current(spark, tmp_out)._jdf.queryExecution().executedPlan().toString()
    first, rest = plan.split("Exchange", 1)
    assert first.count("FileScan") + first.count("Scan parquet") >= 1 and "Union" in first
    before, after = U.versions_of_changed_buckets(spark, tmp_out, 1, 2)
    assert set(scanned(before)) | set(scanned(after)) == {str(bucket)}
    change = M.signed_changes(before, after, ["id"])
    assert sorted(map(tuple, change.select("id", "status", M.SIGN).collect())) == [(7, "b", -1), (7, "new", 1)]
    # compaction rewrites the bucket and nothing else
    U.compact(spark, tmp_out)
    _, done = U._state(spark, tmp_out)
    assert not done["deltas"] and done["base"][-1]["buckets"] == [bucket]
    assert bucket not in done["base"][0]["buckets"] and U.current(spark, tmp_out).count() == 500


def test_concurrent_upserts_are_all_kept(spark, tmp_out):
    U.create(spark.range(20).selectExpr("id", "'b' as status", "1L as ts"), tmp_out, ["id"], ["ts"], buckets=4)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: U.upsert(spark.createDataFrame([(k, f"w{k}", 2)], SCHEMA), tmp_out), range(6)))
    assert [r.status for r in U.current(spark, tmp_out).orderBy("id").limit(6).collect()] == [f"w{k}" for k in range(6)]


def test_an_upsert_during_a_compaction_is_kept(spark, tmp_out, monkeypatch):
    U.create(spark.range(20).selectExpr("id", "'b' as status", "1L as ts"), tmp_out, ["id"], ["ts"], buckets=4)
    U.upsert(spark.createDataFrame([(1, "x", 2)], SCHEMA), tmp_out)
    dealt = U._dealt

    def slow(*args):
        monkeypatch.setattr(U, "_dealt", dealt)
        U.upsert(spark.createDataFrame([(2, "y", 2)], SCHEMA), tmp_out)
        return dealt(*args)
    monkeypatch.setattr(U, "_dealt", slow)
    U.compact(spark, tmp_out)
    found = {r.id: r.status for r in U.current(spark, tmp_out).collect()}
    assert found[1] == "x" and found[2] == "y" and len(found) == 20


def test_stream_of_upserts(spark, tmp_out):
    src, tgt = os.path.join(tmp_out, "src"), os.path.join(tmp_out, "tgt")
    base = spark.createDataFrame([(1, "E", 1), (2, "E", 1)], SCHEMA)
    U.create(base, tgt, ["id"], ["ts"], buckets=4)
    spark.createDataFrame([(2, "P", 2), (3, "E", 1), (1, "old", 0)], SCHEMA).repartition(3).write.parquet(src)
    U.start_upsert_load(spark, src, base.schema, tgt, os.path.join(tmp_out, "ck"), max_files_per_trigger=1).awaitTermination(120)
    assert {r.id: r.status for r in U.current(spark, tgt).collect()} == {1: "E", 2: "P", 3: "E"}
