"""Scalar functions and type conversions, with the traps of the blueprint."""
import datetime as dt

from pyspark.sql import functions as F

from vehiscope.functions import scalar as S


def col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_norm_key_strips_all_edge_whitespace(spark):
    df = col(spark, ["\t f-150 \n", " Ford", None, "a b"])
    got = [r[0] for r in df.select(S.norm_key("x")).collect()]
    assert got == ["F-150", "FORD", None, "A B"]


def test_map_code_unmapped_is_null(spark):
    df = col(spark, ["Regular Gasoline", "E85", None, "Electricity", "Diesel"])
    got = [r[0] for r in df.select(S.map_code("x")).collect()]
    assert got == [None, None, None, "ELEC", "BD"]


def test_icontains_null_is_false(spark):
    df = col(spark, ["Gas or ELECTRICity", None, "Diesel"])
    got = [r[0] for r in df.select(S.icontains("x", "Electric")).collect()]
    assert got == [True, False, False]


def test_ratio_zero_as_one(spark):
    df = spark.createDataFrame([(12, 0), (12, 4)], "n long, d long")
    got = [r[0] for r in df.select(S.ratio_zero_as_one("n", "d")).collect()]
    assert got == [12.0, 3.0]


def test_round_even_matches_numpy(spark):
    vals = [0.25, 0.45, 2.65, 23.65, 0.35, -0.25]
    df = col(spark, vals, "double")
    got = [r[0] for r in df.select(S.round_even("x", 1)).collect()]
    import numpy as np
    assert got == [float(np.round(v, 1)) for v in vals]
    assert got[:4] == [0.2, 0.4, 2.6, 23.6]


def test_rate_and_pct_diff_do_not_raise_on_zero(spark):
    df = spark.createDataFrame([(5, 0, 0.0, 1.0)], "n long, d long, a double, b double")
    r = df.select(S.rate("n", "d").alias("r"), S.pct_diff("a", "b").alias("p")).first()
    assert r.r is None and r.p is None


def test_label_and_minmax(spark):
    df = spark.createDataFrame([(5.0, 10, None), (15.0, None, 7)], "v double, a int, b int")
    rows = df.select(S.label("v", 10, "lo", "hi").alias("l"), S.row_min("a", "b").alias("mn"),
                     S.row_max("a", "b").alias("mx")).collect()
    assert [(r.l, r.mn, r.mx) for r in rows] == [("lo", 10, 10), ("hi", 7, 7)]


def test_parse_ymd(spark):
    df = col(spark, ["20191221", "20191221.0", "2019x", None])
    got = [r[0] for r in df.select(S.parse_ymd("x")).collect()]
    assert got == [dt.date(2019, 12, 21), None, None, None]


def test_parse_num_and_require_int(spark):
    df = col(spark, ["2018", "2018.5", "x"])
    rows = df.select(S.parse_num("x").alias("n")).select(
        "n", S.require_int("n").alias("i")).collect()
    assert [(r.n, r.i) for r in rows] == [(2018.0, 2018), (2018.5, 2018), (None, None)]


def test_require_int_strict_raises(spark):
    import pytest
    df = spark.createDataFrame([(None,)], "x double")
    with pytest.raises(Exception):
        df.select(S.require_int("x", strict=True)).collect()


def test_to_nullable_int_rejects_fraction(spark):
    import pytest
    ok = spark.createDataFrame([(3.0,), (None,)], "x double")
    assert [r[0] for r in ok.select(S.to_nullable_int("x")).collect()] == [3, None]
    bad = spark.createDataFrame([(3.5,)], "x double")
    with pytest.raises(Exception):
        bad.select(S.to_nullable_int("x")).collect()


def test_fmt_and_parse_iso(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 2),)], "d date")
    r = df.select(S.fmt_date("d").alias("t")).select("t", S.parse_iso("t").alias("p")).first()
    assert r.t == "2020-01-02" and r.p == dt.date(2020, 1, 2)
    assert col(spark, ["bad"]).select(S.parse_iso("x")).first()[0] is None


def test_nullify_tokens(spark):
    df = col(spark, ["NA", "None", "null", "", "Nano", "N/A", "#N/A", "x"])
    got = [r[0] for r in df.select(S.nullify("x")).collect()]
    assert got == [None, None, None, None, "Nano", None, None, "x"]
