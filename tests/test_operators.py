"""Operators and jobs on hand-written rows (edge cases of FIXTURES part C)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from vehiscope import constants as K
from vehiscope.operators import aggregates as A
from vehiscope.operators import filters as C
from vehiscope.operators.dedupe import attach_group_count, dedupe_first, flag_duplicates
from vehiscope.operators.expand import explode_by_union, explode_ranked, explosion_metrics
from vehiscope.operators.joins import join_complaints
from vehiscope.operators.ranking import top_k
from vehiscope.plans import analysis as Q
from vehiscope.plans import cleaning as P
from vehiscope.plans import integration as I

VEH_SCHEMA = ("id long, year int, make string, model string, VClass string, drive string, "
              "trany string, cylinders double, displ double, fuelType string, fuelType1 string, "
              "fuelType2 string, city08 int, highway08 int, comb08 int, co2TailpipeGpm double")
VEH_DEFAULT = dict(id=1, year=2020, make="Ford", model="F-150", VClass="Truck", drive="AWD",
                   trany="Auto", cylinders=6.0, displ=3.5, fuelType="Regular",
                   fuelType1="Regular Gasoline", fuelType2=None, city08=20, highway08=25,
                   comb08=22, co2TailpipeGpm=400.0)
VEH_COLS = [c.split()[0] for c in VEH_SCHEMA.split(", ")]


def vehicles(spark, *rows):
    data = [tuple({**VEH_DEFAULT, **r}[c] for c in VEH_COLS) for r in rows]
    return spark.createDataFrame(data, VEH_SCHEMA)


CMP_SCHEMA = ("ODINO long, CMPLID long, MFGTXT string, MAKETXT string, MODELTXT string, "
              "YEARTXT string, CRASH string, DATEA string, FIRE string, INJURED int, DEATHS int, "
              "COMPDESC string, VIN string, MILEAGE long, ord int")
CMP_DEFAULT = dict(ODINO=1, CMPLID=10, MFGTXT="Ford", MAKETXT="FORD", MODELTXT="F-150",
                   YEARTXT="2020", CRASH="N", DATEA="20200102", FIRE="N", INJURED=0, DEATHS=0,
                   COMPDESC="ENGINE", VIN=None, MILEAGE=1000, ord=0)
CMP_COLS = [c.split()[0] for c in CMP_SCHEMA.split(", ")]


def complaints(spark, *rows):
    data = [tuple({**CMP_DEFAULT, **r}[c] for c in CMP_COLS) for r in rows]
    return spark.createDataFrame(data, CMP_SCHEMA)


ST_SCHEMA = ("id long, fuel_type_code string, station_name string, state string, "
             "latitude double, longitude double, status_code string, access_code string")
ST_DEFAULT = dict(id=1, fuel_type_code="ELEC", station_name="s", state="CA", latitude=35.0,
                  longitude=-100.0, status_code="E", access_code="public")
ST_COLS = [c.split()[0] for c in ST_SCHEMA.split(", ")]


def stations(spark, *rows):
    data = [tuple({**ST_DEFAULT, **r}[c] for c in ST_COLS) for r in rows]
    return spark.createDataFrame(data, ST_SCHEMA)


def ids(df, col="id"):
    return sorted(r[0] for r in df.select(col).collect())


AS_OF = dt.date(2025, 3, 31)


# ---------------------------------------------------------------- cleaning
def test_c4_c5_null_measure_kept_only_if_electric(spark):
    df = vehicles(spark, dict(id=1, comb08=None, city08=30, fuelType="Electricity"),
                  dict(id=2, comb08=None, city08=30, fuelType="Diesel"),
                  dict(id=3, comb08=250, fuelType=None),
                  dict(id=4, comb08=250, fuelType="Gas or ELECTRICity"),
                  dict(id=5, comb08=0))
    out = C.cap_unless(C.drop_zero(df, "comb08"))
    assert ids(out) == [1, 4]


def test_c3_all_measures_null_dropped(spark):
    df = vehicles(spark, dict(id=1, comb08=None, city08=None, highway08=None), dict(id=2))
    assert ids(C.require_any(df, K.VEHICLE_MEASURES)) == [2]


def test_c6_drops_null_year_c7_keeps_it(spark):
    df = vehicles(spark, dict(id=1, year=None), dict(id=2, year=2030), dict(id=3, year=2024))
    assert ids(C.not_after_year(df, "year", AS_OF, keep_null=False)) == [3]
    assert ids(C.not_after_year(df, "year", AS_OF, keep_null=True)) == [1, 3]


def test_c9_mileage_cap_inclusive_null_kept(spark):
    df = complaints(spark, dict(CMPLID=1, MILEAGE=None), dict(CMPLID=2, MILEAGE=1000000),
                    dict(CMPLID=3, MILEAGE=1000001))
    assert ids(C.cap(df, "MILEAGE", 1000000), "CMPLID") == [1, 2]


def test_c10_c11_bbox_and_null_island(spark):
    df = stations(spark, dict(id=1, latitude=18.0, longitude=-65.0),
                  dict(id=2, latitude=72.01), dict(id=3, latitude=0.0, longitude=-70.0),
                  dict(id=4, latitude=0.0, longitude=0.0))
    assert ids(C.in_bbox(df)) == [1]
    wide = (-90.0, 90.0, -180.0, 180.0)
    assert ids(C.drop_null_island(C.in_bbox(df, box=wide))) == [1, 2, 3]


def test_k1_keeps_first_by_order_with_null_in_key(spark):
    df = vehicles(spark, dict(id=7, drive=None), dict(id=3, drive=None))
    assert ids(dedupe_first(df, K.VEHICLE_DEDUPE_KEYS, ["id"])) == [3]


def test_keep_first_needs_an_order(spark):
    df = vehicles(spark, dict(id=1))
    with pytest.raises(ValueError):
        dedupe_first(df, ["id"], [])


def test_k3_runs_before_fuel_filter(spark):
    df = stations(spark, dict(id=5, fuel_type_code="LPG", access_code="a"),
                  dict(id=5, fuel_type_code="ELEC", access_code="b"), dict(id=6))
    assert ids(P.clean_stations(df, ["access_code"])) == [6]


def test_k6_flags_every_member_null_keys_grouped(spark):
    df = stations(spark, dict(id=1), dict(id=1), dict(id=2), dict(id=None), dict(id=None))
    out = flag_duplicates(df, ["id"])
    assert sorted((r.id if r.id is not None else -1, r.dup_count) for r in out.collect()) == [
        (-1, 2), (-1, 2), (1, 2), (1, 2)]


# ---------------------------------------------------------------- expansion
def test_e1_explode(spark):
    df = vehicles(spark, dict(id=1, fuelType1=None, fuelType2=None),
                  dict(id=2, fuelType1="G", fuelType2="E"))
    df = C.rename(df, K.VEHICLE_RENAMES)
    out = explode_ranked(df)
    rows = sorted((r.id, r.fuel_rank, r.fuel_used) for r in out.collect())
    assert rows == [(1, 1, None), (2, 1, "G"), (2, 2, "E")]
    assert sorted(explode_by_union(df).collect()) == sorted(out.collect())
    m = explosion_metrics(df).first()
    assert (m.rows_before, m.dual_fuel, m.rows_after) == (2, 1, 3)


# ---------------------------------------------------------------- complaints job
def test_clean_complaints_rejects_unparseable_year(spark):
    raw = complaints(spark, dict(ODINO=1, CMPLID=1, YEARTXT="2018", ord=1),
                     dict(ODINO=1, CMPLID=2, YEARTXT="2019", ord=2),
                     dict(ODINO=2, CMPLID=3, YEARTXT="x"),
                     dict(ODINO=3, CMPLID=4, YEARTXT="2018.5"),
                     dict(ODINO=4, CMPLID=5, DATEA="20260101"),
                     dict(ODINO=5, CMPLID=6, DATEA="2019x"))
    out = P.clean_complaints(raw, AS_OF, ["ord"])
    got = sorted((r.ODINO, r.CMPLID, r.YEARTXT) for r in out.collect())
    assert got == [(1, 1, 2018), (3, 4, 2018), (5, 6, 2020)]
    rej = P.complaint_rejects(raw, AS_OF, ["ord"]).collect()
    assert [(r.ODINO, r.reason) for r in rej] == [(2, "YEARTXT is not numeric")]


# ---------------------------------------------------------------- aggregates / joins
def test_a1_all_null_group_sums_zero_mean_null_and_null_key_dropped(spark):
    c = complaints(spark, dict(CMPLID=1, INJURED=None, MILEAGE=None, CRASH="Y"),
                   dict(CMPLID=2, INJURED=None, MILEAGE=None, CRASH=None),
                   dict(CMPLID=3, MODELTXT=None))
    r = A.complaint_rollup(I.normalized_complaints(
        c.withColumn("YEARTXT", F.col("YEARTXT").cast("int")))).collect()
    assert len(r) == 1
    assert (r[0].total_complaints, r[0].crash_incidents, r[0].total_injured,
            r[0].avg_complaint_mileage) == (2, 1, 0, None)


def test_a5_drops_null_state_a6_counts_it(spark):
    s = stations(spark, dict(id=1, state="CA"), dict(id=2, state=None))
    assert A.stations_by_fuel(s).first().total_stations == 1
    assert A.stations_nationwide(s).first().stations_nationwide == 2


def test_j1_fill_zero_and_a2_variants_then_distinct(spark):
    v = vehicles(spark, dict(id=1, trany="Auto"), dict(id=2, trany="Manual"),
                 dict(id=3, model="Other"))
    v = P.clean_vehicles(v, AS_OF, ["id"])
    c = P.clean_complaints(complaints(spark, dict(ODINO=1, MAKETXT=" ford "),
                                      dict(ODINO=2, MAKETXT="FORD", MILEAGE=None)),
                           AS_OF, ["ord"])
    out = I.vehicle_complaints_analysis(v, c).collect()
    by_model = {r.model: r for r in out}
    assert len(out) == 2  # id 1 and 2 differ only in trany: one row after the distinct
    f = by_model["F-150"]
    assert (f.total_complaints, f.vehicle_variants, f.avg_complaint_mileage) == (2, 2, 1000.0)
    o = by_model["Other"]
    assert (o.total_complaints, o.crash_incidents, o.total_injured,
            o.avg_complaint_mileage, o.vehicle_variants) == (0, 0, 0, 0.0, 1)


def test_j1_preserves_left_rows(spark):
    v = P.clean_vehicles(vehicles(spark, dict(id=1), dict(id=2, model="Y", fuelType2="E85")), AS_OF)
    c = I.normalized_complaints(P.clean_complaints(complaints(spark, dict(ODINO=1)), AS_OF))
    j = join_complaints(v, A.complaint_rollup(c))
    assert j.count() == v.count() == 3


def test_fuel_infra_unmapped_dropped_and_zero_denominator(spark):
    v = P.clean_vehicles(vehicles(spark, dict(id=1, fuelType1="LPG"),
                                  dict(id=2, fuelType1="Regular Gasoline")), AS_OF)
    s = stations(spark, dict(id=1))
    out = I.fuel_infrastructure_analysis(v, s).collect()
    assert [(r.fuel_type_code, r.total_stations, r.vehicles_per_station) for r in out] == [
        ("LPG", 0, 1.0)]


# ---------------------------------------------------------------- analysis
def test_q1_null_mpg_in_neither_group(spark):
    df = spark.createDataFrame([(None, 5), (40, 1), (20, 3)], "comb08 int, total_complaints long")
    r = Q.efficiency_vs_complaints(df, 30).first()
    assert (r.high_mpg_count, r.low_mpg_count, r.high_mpg_avg, r.low_mpg_avg) == (1, 1, 1.0, 3.0)


def _comp(spark, rows):
    schema = ("year int, make string, model string, fuel_used string, fuel_rank int, "
              "comb08 int, total_complaints long, stations_nationwide long")
    return spark.createDataFrame(rows, schema)


def test_q11_strict_then_relaxed(spark):
    strict_rows = [(2020, "A", "m", "E", 1, 40, 1, 2000), (2020, "B", "m", "E", 1, 31, 20, 600)]
    r = Q.best_overall(_comp(spark, strict_rows)).collect()
    assert [(x.make, x.rule) for x in r] == [("A", "strict")]
    relaxed_rows = [(2020, "B", "m", "E", 1, 31, 20, 600), (2020, "C", "m", "E", 1, 29, 1, 600)]
    r = Q.best_overall(_comp(spark, relaxed_rows)).collect()
    assert [(x.make, x.rule) for x in r] == [("B", "relaxed")]


def test_top_k_skips_null_and_breaks_ties(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 5), (4, 1)], "id int, v int")
    assert [r.id for r in top_k(df, "v", 2, ["id"]).collect()] == [2, 3]


def test_stage_audit_counts(spark):
    raw = vehicles(spark, dict(id=1, year=2005), dict(id=2), dict(id=3),  # 3 dup of 2
                   dict(id=4, make=None), dict(id=5, fuelType2="E85", model="X"))
    a = {r.step: (r.rows_in, r.rows_out) for r in P.vehicle_audit(raw, AS_OF).collect()}
    assert a["min_year"] == (5, 4)
    assert a["required_fields"] == (4, 3)
    assert a["dedupe"] == (3, 2)
    assert a["explode_dual_fuel"] == (2, 3)
    assert P.clean_vehicles(raw, AS_OF).count() == 3


def test_group_count_skew_safe_plan(spark):
    df = vehicles(spark, dict(id=1), dict(id=2))
    plan = attach_group_count(df, ["make"], "n")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_station_audit_dead_first_row_does_not_win(spark):
    raw = stations(spark, dict(id=5, access_code="a", latitude=0.0, longitude=0.0),
                   dict(id=5, access_code="b"), dict(id=6, fuel_type_code="LPG"))
    a = {r.step: (r.rows_in, r.rows_out) for r in P.station_audit(raw, ["access_code"]).collect()}
    assert a["in_bbox"] == (3, 2)
    assert a["dedupe"] == (2, 2)
    assert a["alt_fuel_only"] == (2, 1)
    assert P.clean_stations(raw, ["access_code"]).count() == 1


def test_t13_corrected_map_counts_plain_e85(spark):
    v = P.clean_vehicles(vehicles(spark, dict(id=1, fuelType1="Regular Gasoline", fuelType2="E85")),
                         AS_OF)
    s = stations(spark, dict(id=1, fuel_type_code="E85"))
    assert I.fuel_infrastructure_analysis(v, s).count() == 0
    out = I.fuel_infrastructure_analysis(v, s, K.FUEL_CODE_MAP_CORRECTED).collect()
    assert [(r.fuel_type_code, r.vehicle_count, r.total_stations) for r in out] == [("E85", 1, 1)]


def test_t15_unmapped_rows_count_as_poor_unless_mapped_only(spark):
    schema = "fuel_type_code string, stations_nationwide long, total_complaints long"
    df = spark.createDataFrame([(None, 0, 9), ("ELEC", 50, 1), ("ELEC", 5000, 2)], schema)
    r = Q.infrastructure_vs_complaints(df, 100).first()
    assert (r.poor_infra_count, r.poor_infra_avg) == (2, 5.0)
    r = Q.infrastructure_vs_complaints(df, 100, mapped_only=True).first()
    assert (r.poor_infra_count, r.poor_infra_avg) == (1, 1.0)


def test_hot_keys_bound_and_salted_join_equals_plain_join(spark):
    from vehiscope.operators.skew import hot_keys, skew_safe_join
    rows = [(1, i) for i in range(60)] + [(k, k) for k in range(2, 42)]  # key 1 holds 60%
    df = spark.createDataFrame(rows, "k int, v int")
    counts = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert hot_keys(counts, ["k"], "n", partitions=4).count() == 0  # 60 rows are not five shares of 25
    hot = hot_keys(counts, ["k"], "n", partitions=16)
    got = [(r.k, r._vs_b) for r in hot.collect()]
    assert got == [(1, 10)]  # ceil(60 * 16 / 100) buckets; fewer than 16 / 5 hot keys possible
    right = counts.withColumn("x", F.col("k") * 10)
    salted = skew_safe_join(df, right.drop("n"), ["k"], hot, "left")
    plain = df.join(right.drop("n"), ["k"], "left")
    assert sorted(tuple(r) for r in salted.collect()) == sorted(tuple(r) for r in plain.collect())


def test_identical_rows_of_a_duplicate_group_come_apart_after_the_join(spark):
    from vehiscope.operators.dedupe import flag_duplicates
    rows = [(1, "x")] * 70_000 + [(1, "y"), (2, "z"), (None, "n"), (None, "n")]
    df = spark.createDataFrame(rows, "k int, v string")
    out = flag_duplicates(df, ["k"])
    got = {(r.k, r.v): (r.n, r.dup_count) for r in out.groupBy("k", "v", "dup_count").agg(F.count("*").alias("n")).collect()}
    assert got == {(1, "x"): (70_000, 70_001), (1, "y"): (1, 70_001), (None, "n"): (2, 2)}


def test_scratch_folder_must_be_shared_on_a_cluster():
    from vehiscope import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_scratch_folders_differ_between_calls(spark):
    from vehiscope.session import shared_path
    assert shared_path(spark, "a") != shared_path(spark, "a")


def test_audit_needs_an_order_beyond_the_key(spark):
    df = spark.createDataFrame([(1, "a", "20200101", "2020", 1)], "ODINO long, MAKETXT string, DATEA string, YEARTXT string, MILEAGE long")
    with pytest.raises(ValueError, match="arbitrary"):
        P.complaint_audit(df, AS_OF, ["ODINO"])


def test_x3_abbreviations_inside_names(spark):
    from vehiscope.plans.extras import aggressive_key, standard_words
    words = {"Chevy": "Chevrolet", "chevy truck": "GMC", "vw": "Volkswagen", "GMC": "General", "(new)": "", "a.b": "dot"}
    want = {"CHEVY SILVERADO": "CHEVROLET SILVERADO", "Chevy-Truck 10": "GMC 10", "chevy  Truck": "GMC",
            "CHEVYTRUCK": "CHEVYTRUCK", "Big Chevy": "BIG CHEVROLET", "vw vw": "VOLKSWAGEN VOLKSWAGEN",
            "(NEW) vw": "VOLKSWAGEN", "AXB a.b": "AXB DOT", "-": "", "": "", " \u00a0Chevy\tX ": "CHEVROLET X", None: None}
    df = spark.createDataFrame([(k,) for k in want], "name string")
    got = {r.name: r.w for r in df.select("name", standard_words("name", words).alias("w")).collect()}
    assert got == want
    k = df.where("name IN ('CHEVY SILVERADO')").select(aggressive_key("name", words=words).alias("k")).first().k
    assert k == spark.range(1).select(aggressive_key(F.lit("Chevrolet Silverado")).alias("k")).first().k
    assert spark.range(1).select(standard_words(F.lit("a-b"), {}).alias("w")).first().w == "A B"
    with pytest.raises(ValueError):
        standard_words("name", {" - ": "x"})
    # the names join in P4
    v = P.clean_vehicles(vehicles(spark, dict(make="Chevrolet", model="Silverado")))
    c = spark.createDataFrame([("CHEVY", "SILVERADO", 2020, 5, None, None, None, None, None)],
                              "MAKETXT string, MODELTXT string, YEARTXT int, CMPLID long, CRASH string, FIRE string, INJURED int, DEATHS int, MILEAGE double")
    total = I.vehicle_complaints_analysis(v, c, lambda x: aggressive_key(x, words=words)).first().total_complaints
    assert total == 1
