"""Streaming incremental load, snapshots, categorisation, numeric-type check."""
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from vehiscope.operators.aggregates import exact_quantiles
from vehiscope.plans import extras as X
from vehiscope.plans import quality as D
from vehiscope.streaming import incremental as INC

SCHEMA = "id long, status string, ts long"


def load(spark, rows, src, tgt, ck, files=1):
    spark.createDataFrame(rows, SCHEMA).repartition(files).write.mode("append").parquet(src)
    schema = spark.createDataFrame([], SCHEMA).schema
    INC.start_incremental_load(spark, src, schema, tgt, ck, max_files_per_trigger=1).awaitTermination(120)
    return {r.id: r.status for r in INC.latest_version(spark, tgt, ["id"], [F.col("ts").desc()]).collect()}


def test_incremental_merge_latest_wins(spark, tmp_out):
    src, tgt = os.path.join(tmp_out, "src"), os.path.join(tmp_out, "tgt")
    one = load(spark, [(1, "E", 1), (2, "E", 1), (2, "P", 2), (4, "E", 9)], src, tgt, os.path.join(tmp_out, "ck"), 3)
    assert one == {1: "E", 2: "P", 4: "E"}
    # a row that comes late does not overwrite a newer one
    two = load(spark, [(1, "T", 3), (3, "E", 3), (4, "P", 5)], src, tgt, os.path.join(tmp_out, "ck"))
    assert two == {1: "T", 2: "P", 3: "E", 4: "E"}
    # a new checkpoint continues the published dataset, also after compaction
    INC.compact(spark, tgt, ["id"], [F.col("ts").desc()])
    three = load(spark, [(5, "E", 1), (2, "T", 7)], os.path.join(tmp_out, "src2"), tgt, os.path.join(tmp_out, "ck2"))
    assert three == {1: "T", 2: "T", 3: "E", 4: "E", 5: "E"}


def test_versions_are_the_targets_own(spark, tmp_out):
    df = spark.createDataFrame([(1, "E", 1)], SCHEMA)
    assert [INC.append_delta(df, tmp_out) for _ in range(2)] == [1, 2]
    os.remove(os.path.join(tmp_out, "delta", "version=2", "_SUCCESS"))  # an unfinished write
    assert INC.append_delta(df, tmp_out) == 2
    assert INC.read_version(spark, tmp_out, 2).count() == 1
    with pytest.raises(ValueError, match="no finished version 7"):
        INC.read_version(spark, tmp_out, 7)
    with pytest.raises(ValueError, match="nothing is published"):
        INC.latest_version(spark, tmp_out + "/none", ["id"], [])


def test_snapshots_and_restore(spark, tmp_out):
    root = os.path.join(tmp_out, "snap")
    X.write_snapshot(spark.range(3), root, 1)
    X.write_snapshot(spark.range(5), root, 2)
    assert X.read_snapshot(spark, root, 1).count() == 3
    out = X.restore_snapshot(spark, root, 1, os.path.join(tmp_out, "live"))
    assert out.count() == 3


def test_categorize_first_rule_wins(spark):
    df = spark.createDataFrame([("ENGINE AND ENGINE COOLING",), ("AIR BAGS",), (None,), ("x",)], "c string")
    rules = [("engine", "POWERTRAIN"), ("air ?bag", "RESTRAINTS"), ("cool", "COOLING")]
    got = [r[0] for r in df.select(X.categorize("c", rules)).collect()]
    assert got == ["POWERTRAIN", "RESTRAINTS", "OTHER", "OTHER"]


def test_numeric_types(spark):
    df = spark.createDataFrame([(2020, "x", 1.5)], "year int, make string, displ double")
    assert D.numeric_types(df, ["year", "make", "displ"]) == [
        ("year", "int", True), ("make", "string", False), ("displ", "double", True)]


def test_changed_rows_and_upsert(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string")
    after = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "id long, v string")
    ch = sorted((r.id, r.change) for r in X.changed_rows(before, after, ["id"]).collect())
    assert ch == [(2, "update"), (3, "delete"), (4, "insert")]
    up = sorted((r.id, r.v) for r in X.upsert(before, after, ["id"]).collect())
    assert up == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]


def test_changed_rows_sees_nulls_keys_and_columns(spark):
    schema = "id long, a string, b string"
    before = spark.createDataFrame([(1, "a", None), (None, "x", "y"), (2, "p", "q")], schema)
    after = spark.createDataFrame([(1, None, "a"), (None, "x", "y"), (2, "p", "q")], schema)
    assert [tuple(r) for r in X.changed_rows(before, after, ["id"]).collect()] == [(1, "update")]
    gone = X.changed_rows(before, after.drop("b"), ["id"]).collect()
    assert sorted(map(str, map(tuple, gone))) == ["(1, 'update')", "(2, 'update')", "(None, 'update')"]


def test_upsert_and_append_check_columns_and_order(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    twice = spark.createDataFrame([(2, "z"), (2, "c")], "id long, v string")
    for updates in (twice, twice.orderBy("v")):
        assert sorted(map(tuple, X.upsert(base, updates, ["id"]).collect())) == [(1, "a"), (2, "c")]
    assert X.upsert(base, twice, ["id"], [F.col("v").desc()]).where("id = 2").first().v == "z"
    assert X.append(base, twice).count() == 4
    for op in (lambda: X.upsert(base, twice.select("id"), ["id"]), lambda: X.append(base, twice.select("id"))):
        with pytest.raises(ValueError, match="columns differ"):
            op()


@pytest.mark.parametrize("values", [[1.0], [3, 1, 2, 2, 5, None, 9], list(range(1000)) * 3, [7] * 50 + [8], []])
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    own = [v for v in values if v is not None]
    got = exact_quantiles(df, "v", [0, 0.25, 0.5, 0.9, 1], splits=8)
    assert got == ([None] * 5 if not own else [pytest.approx(float(x)) for x in np.quantile(own, [0, 0.25, 0.5, 0.9, 1])])


def test_complaint_mileage_exact_and_approx(spark):
    schema = "MAKETXT string, MODELTXT string, MILEAGE long"
    df = spark.createDataFrame([("ford", "f", 10), (" FORD", "F", 20), ("Ford", "f ", 30),
                                ("ford", "f", None)], schema)
    r = X.complaint_mileage(df).first()
    assert (r.make_norm, r.model_norm, r.with_mileage, r.avg_mileage, r.median_mileage) == (
        "FORD", "F", 3, 20.0, 20.0)
    assert X.complaint_mileage(df, approx=True).first().median_mileage == 20.0
