"""Exact quantiles in one lazy plan."""
import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from vehiscope.operators import aggregates as A
from vehiscope.plans import extras as X

ODD = [0.0, -0.0, 5e-324, -5e-324, 2.0 ** -1022, 2.0 ** -1022 - 5e-324, 1.0, 1.0 - 2 ** -53, 1.0 + 2 ** -52, 2.0, 3.0, 4.0,
       4.0 - 2 ** -51, 1e308, 1.7976931348623157e308, float("inf"), float("-inf"), -1.5, 0.1, -0.1, 1e-310, 8.0, 1000000.0]


def bits(x):
    n = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -n if x < 0 else n


def test_order_key_is_the_stored_form(spark):
    rng = random.Random(3)
    values = ODD + [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    values += [2.0 ** e * f for e in range(-1074, 1024, 7) for f in (1.0, 1.0 + 2 ** -52, 1.5) if 2.0 ** e * f < math.inf]
    values = [v for v in values if not math.isnan(v)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", A.order_key(F.col("v")).alias("k")).collect():
        assert r.k == bits(r.v), r.v
    nan = spark.createDataFrame([(math.nan,)], "v double").select(A.order_key(F.col("v")).alias("k")).first().k
    assert nan > bits(math.inf)


def expected(values, probs):
    own = sorted(v for v in values if v is not None)
    if not own:
        return [None] * len(probs)
    out = []
    for p in probs:
        at = p * (len(own) - 1)
        a, b = own[int(at)], own[min(int(at) + 1, len(own) - 1)]
        out.append(a if a == b or at == int(at) else a + (at - int(at)) * (b - a))
    return out


PROBS = [0, 0.25, 0.5, 0.9, 1]


@pytest.mark.parametrize("values", [[], [None], [1.0], [3, 1, 2, 2, 5, None, 9], list(range(500)) * 2, [7] * 50 + [8],
                                    [-1.5, -1.5, 0.0, 1e-310, 1e300], [math.inf, 1.0, -math.inf, math.inf, math.inf]])
def test_quantiles_of_a_column(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double").repartition(3)
    got = list(A.grouped_quantiles(df, [], "v", PROBS).first())
    assert got == expected([None if v is None else float(v) for v in values], PROBS)


@pytest.mark.parametrize("kind", ["tinyint", "int", "bigint", "float", "decimal(10,2)"])
def test_quantiles_of_each_type(spark, kind):
    rng = random.Random(4)
    top = {"tinyint": 127, "int": 2 ** 31 - 1, "bigint": 2 ** 53}.get(kind, 1000)
    values = [rng.randrange(-top, top) for _ in range(300)] + [-top, top, top, 0, 1, 65535 % top, 65536 % top]
    df = spark.createDataFrame([(v,) for v in values], "v long").select(F.col("v").cast(kind).alias("v"))
    assert list(A.grouped_quantiles(df, [], "v", PROBS).first()) == expected([float(v) for v in values], PROBS)


def test_quantiles_of_groups_with_a_hot_one(spark):
    rng = random.Random(9)
    rows = [(None if k == 3 else k, "g", rng.choice([None, rng.gauss(0, 1e3), float(rng.randrange(50))])) for k in range(5) for _ in range(40)]
    rows += [(9, "hot", float(rng.randrange(100_000))) for _ in range(4000)] + [(8, "none", None)]
    df = spark.createDataFrame(rows, "a long, b string, v double").repartition(4)
    got = {(r.a, r.b): list(r)[2:] for r in A.grouped_quantiles(df.where("a is not null"), ["a", "b"], "v", PROBS).collect()}
    want = {}
    for a, b, v in rows:
        if a is not None and v is not None:
            want.setdefault((a, b), []).append(v)
    assert got == {k: expected(v, PROBS) for k, v in want.items()}


def test_no_job_before_an_action_and_no_percentile(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("v"), (F.col("id") % 3).alias("g"))
    group = "quantiles-test"
    spark.sparkContext.setJobGroup(group, "")
    frames = [A.profile_numeric(df, "v"), X.iqr_outliers(df, "v"), A.grouped_quantiles(df, ["g"], "v", [0.5])]
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("", "")
    for f in frames:
        plan = f._jdf.queryExecution().executedPlan().toString()
        assert "percentile" not in plan and "median" not in plan.replace("median#", "").replace("AS median", "")
    assert frames[0].first().median == pytest.approx(float(np.median([i % 97 for i in range(1000)])))
    assert frames[1].where("is_outlier").count() == 0


def test_outliers_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert [r.is_outlier for r in X.iqr_outliers(df, "v").collect()] == [False, False]
