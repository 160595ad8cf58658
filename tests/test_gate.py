"""Write, audit, publish: one read of the raw rows, a failing rule publishes nothing."""
import os

import pytest
from pyspark.sql import functions as F

from vehiscope import __main__ as cli
from vehiscope import constants as K
from vehiscope.plans import cleaning, gate, quality
from vehiscope.plans.pipeline import Tables
from vehiscope.session import input_bytes, size_shuffles
from vehiscope.sources import bindings as B
from vehiscope.sources import versions

SF_SMALL = "/root/testdata/sf0.001"

#: The test tables hold a missing maker and dates that cannot be parsed.
KNOWN = ["vehicles.no_missing_critical", "complaints.no_missing_critical"]
NO_MINIMUM = {n: (cols, 0) for n, (cols, _) in K.CONTRACT.items()}


def rows_of(df):
    return sorted(map(repr, df.collect()))


def load(spark, t, root, **over):
    given = {"spec": NO_MINIMUM, "station_order": B.STATION_ORDER, "vehicle_order": B.VEHICLE_ORDER,
             "complaint_order": B.COMPLAINT_ORDER, "year_range": (1900, 2100), "report_only": KNOWN, **over}
    return gate.load(spark, t.raw_vehicles, t.raw_complaints, t.raw_stations, root, **given)


def test_a_load_equals_the_plain_jobs(spark, tmp_out):
    t = Tables(spark, SF_SMALL)
    done = load(spark, t, tmp_out + "/r")
    got = versions.read_release(spark, tmp_out + "/r")
    for name, want in {"vehicles": t.vehicles, "complaints": t.complaints, "stations": t.stations,
                       "vehicle_complaints_analysis": t.vca, "fuel_infrastructure_analysis": t.infra,
                       "comprehensive_vehicle_analysis": t.comp}.items():
        assert got[name].columns == want.columns and rows_of(got[name]) == rows_of(want), name
    rejects = cleaning.complaint_rejects(t.raw_complaints, order_by=B.COMPLAINT_ORDER)
    assert rows_of(got["complaint_rejects"].select("CMPLID")) == rows_of(rejects.select("CMPLID"))
    assert done["tables"]["complaint_rejects"]["rows"] == rejects.count() > 0
    # stage counts are those of C16, rules those of D2-D6
    audits = {"vehicles": cleaning.vehicle_audit(t.raw_vehicles, order_by=B.VEHICLE_ORDER),
              "complaints": cleaning.complaint_audit(t.raw_complaints, order_by=B.COMPLAINT_ORDER),
              "stations": cleaning.station_audit(t.raw_stations, order_by=B.STATION_ORDER)}
    stages = gate.load_stages(spark, done)
    for name, audit in audits.items():
        mine = stages.where((F.col("dataset") == name) & (F.col("step_no") > 0)).drop("dataset")
        assert rows_of(mine) == rows_of(audit.select("step_no", "step", "rows_in", "rows_out").withColumn(
            "step_no", F.col("step_no").cast("int"))), name
    checks = quality.vehicle_checks(t.vehicles).unionByName(quality.complaint_checks(t.complaints)).unionByName(
        quality.station_checks(t.stations)).unionByName(quality.vehicle_rules(t.vca, (1900, 2100)))
    rules = gate.load_rules(spark, done)
    plain = rules.where("rule NOT IN ('required_columns', 'min_rows')")
    assert rows_of(plain.select(*checks.columns)) == rows_of(checks)
    assert {(r.dataset, r.tests_total - r.tests_passed) for r in quality.scorecard(rules).collect()} >= {
        ("vehicles", 1), ("complaints", 1), ("stations", 0)}


def test_the_raw_rows_are_read_once_by_a_write(spark, tmp_out):
    path = tmp_out + "/raw"
    Tables(spark, SF_SMALL).raw_complaints.write.parquet(path)
    job = gate.complaints_job(spark.read.parquet(path), order_by=B.COMPLAINT_ORDER)
    plan = job.df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("CollectMetrics") == 2


@pytest.mark.parametrize("broken", ["vehicles", "minimum", "range"])
def test_a_failing_rule_leaves_the_old_version(spark, tmp_out, broken):
    t, root = Tables(spark, SF_SMALL), tmp_out + "/r"
    first = load(spark, t, root)
    before = {n: rows_of(df) for n, df in versions.read_release(spark, root).items()}
    over = {}
    if broken == "vehicles":  # two vehicles with one id
        twice = t.raw_vehicles.unionByName(t.raw_vehicles.withColumn("model", F.concat("model", F.lit(" II"))))
        t = Tables(spark, SF_SMALL, _over={"raw_vehicles": twice})
    elif broken == "minimum":
        over["spec"] = {**NO_MINIMUM, "vehicle_complaints_analysis": (["year"], 10 ** 9)}
    else:
        over["year_range"] = (2300, 2400)
    with pytest.raises(gate.GateFailed) as failed:
        load(spark, t, root, **over)
    assert {"vehicles": "no_duplicate_id_rank", "minimum": "min_rows", "range": "year_in_range"}[broken] in str(failed.value)
    assert versions.numbers(spark, root) == [first["version"]]
    assert {n: rows_of(df) for n, df in versions.read_release(spark, root).items()} == before
    refused = failed.value.tables["vehicles"]  # kept for inspection
    assert versions.frame(spark, refused).count() == refused["rows"]


def test_missing_columns_and_empty_tables(spark, tmp_out):
    df = spark.range(5).selectExpr("id AS year")
    with pytest.raises(gate.GateFailed, match="t.required_columns: 1"):
        gate.Load(spark, tmp_out + "/a").stage(gate.table_job("t", df, gate.analysis_rules(), (["year", "make"], 0)))
    t = Tables(spark, SF_SMALL)
    empty = Tables(spark, SF_SMALL, _over={"raw_" + n: getattr(t, "raw_" + n).limit(0) for n in ("vehicles", "complaints", "stations")})
    done = load(spark, empty, tmp_out + "/b")
    assert {x["rows"] for x in done["tables"].values()} == {0}
    assert all(df.count() == 0 for df in versions.read_release(spark, tmp_out + "/b").values())


def test_two_loads_at_once_publish_one(spark, tmp_out):
    one, two = gate.Load(spark, tmp_out + "/r"), gate.Load(spark, tmp_out + "/r")
    for run in (one, two):
        run.stage(gate.table_job("t", spark.range(3).toDF("x")))
    one.publish()
    with pytest.raises(versions.Conflict):
        two.publish()


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_command_line_publishes_or_refuses(spark, tmp_out, capsys):
    v = _write(os.path.join(tmp_out, "veh.csv"),
               "id,year,make,model,VClass,drive,trany,cylinders,displ,fuelType,fuelType1,"
               "fuelType2,city08,highway08,comb08,co2TailpipeGpm\n"
               "1,2020,Ford,F-150,Truck,AWD,Auto,6,3.5,Regular,Regular Gasoline,,20,25,22,400\n"
               "2,2021,Tesla,Model 3,Car,RWD,Auto,NA,NA,Electricity,Electricity,,130,120,125,0\n")
    r = ["0"] * 49
    r[0:6] = ["10", "100", "FORD", "FORD", "F-150", "2020"]
    r[6], r[7], r[8], r[17] = "Y", "20200102", "N", "1000"
    c = _write(os.path.join(tmp_out, "cmp.tsv"), "\t".join(r) + "\n")
    s = _write(os.path.join(tmp_out, "st.csv"),
               "id,fuel_type_code,station_name,state,latitude,longitude,status_code,access_code\n"
               "1,ELEC,a,CA,35,-100,E,public\n")
    args = ["--vehicles", v, "--complaints", c, "--stations", s, "--out", tmp_out + "/out", "--as-of", "2025-03-31"]
    assert cli.main(args) == 1  # the least numbers of rows of the contract
    assert "min_rows" in capsys.readouterr().err
    assert versions.numbers(spark, tmp_out + "/out/release") == []
    assert cli.main([*args, "--min-rows-percent", "0", "--single-line"]) == 0
    assert "vehicle_complaints_analysis 2" in capsys.readouterr().out
    assert versions.numbers(spark, tmp_out + "/out/release") == [1]


def test_partitions_follow_the_input_unless_submitted(spark, tmp_out):
    path = _write(os.path.join(tmp_out, "x.csv"), "x" * 1000)
    assert input_bytes(spark, path) == 1000 and input_bytes(spark, tmp_out + "/*.csv") == 1000
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert size_shuffles(spark, 1 << 50) == int(before)  # named when the session was built
