"""A1, A3 and P4 from changed rows alone."""
import os

from pyspark.sql import functions as F

from vehiscope.operators.aggregates import complaint_rollup
from vehiscope.plans import catalog
from vehiscope.plans import integration as I
from vehiscope.plans import maintenance as M
from vehiscope.plans.pipeline import Tables

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def test_update_reads_states_and_changes_only(spark, tmp_out):
    t = Tables(spark, SF)
    vehicles, complaints = catalog._earlier(t)

    def kept(name, df):
        df.write.parquet(os.path.join(tmp_out, name))
        return spark.read.parquet(os.path.join(tmp_out, name))
    v, c = kept("v", M.vehicle_state(vehicles)), kept("c", M.complaint_state(complaints))
    dv = kept("dv", M.vehicle_state(M.signed_changes(vehicles, t.vehicles, ["id", "fuel_rank"])))
    dc = kept("dc", M.complaint_state(M.signed_changes(complaints, t.complaints, ["ODINO"])))
    old = kept("old", I.vehicle_complaints_analysis(vehicles, complaints))
    new = M.updated_analysis(old, M.merged(v, dv), M.merged(c, dc), M.touched_keys(dv, dc))
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "part.parquet" not in plan
    read = {os.path.relpath(f.removeprefix("file:"), tmp_out).split("/")[0] for f in new.inputFiles()}
    assert read <= {"v", "c", "dv", "dc", "old"}
    assert rows(new) == rows(t.vca)
    assert rows(M.analysis_from(M.merged(v, dv), M.merged(c, dc))) == rows(t.vca)
    assert M.merged(c, dc).count() > 0 and dc.count() > 0 and dv.count() > 0


COMPLAINTS = ("CMPLID long, ODINO long, YEARTXT long, MAKETXT string, MODELTXT string, CRASH string, FIRE string, "
              "INJURED long, DEATHS long, MILEAGE long")


def test_groups_come_and_go_and_nulls(spark):
    before = spark.createDataFrame([(1, 1, 2020, " ford", "F", "Y", None, 1, None, 100), (2, 2, 2020, "FORD", "f", "N", "Y", None, 1, None),
                                    (3, 3, 2021, "KIA", "R", None, None, None, None, None), (4, 4, None, "KIA", "R", "Y", "Y", 1, 1, 1)], COMPLAINTS)
    after = spark.createDataFrame([(1, 1, 2020, "ford", "F", "N", None, 1, 2, None), (2, 2, 2020, "FORD", "f", "N", "Y", None, 1, None),
                                   (None, 5, 2022, "VW", "G", "Y", "N", 3, 0, 50), (4, 4, None, "KIA", "R", "Y", "Y", 2, 1, 1)], COMPLAINTS)
    change = M.signed_changes(before, after, ["ODINO"])
    assert sorted((r.ODINO, r[M.SIGN]) for r in change.collect()) == [(1, -1), (1, 1), (3, -1), (4, -1), (4, 1), (5, 1)]
    got = M.rollup_of(M.merged(M.complaint_state(before), M.complaint_state(change)))
    assert rows(got) == rows(complaint_rollup(I.normalized_complaints(after)))
    none = M.signed_changes(before, before, ["ODINO"])
    assert none.count() == 0 and rows(M.merged(M.complaint_state(before), M.complaint_state(none))) == rows(M.complaint_state(before))


def test_vehicle_rows_with_null_keys(spark):
    t = Tables(spark, SF)
    odd = t.vehicles.limit(3).withColumn("model", F.lit(None).cast("string")).withColumn("id", F.col("id") + 10_000_000)
    after = t.vehicles.unionByName(odd)
    state = M.merged(M.vehicle_state(t.vehicles), M.vehicle_state(M.signed_changes(t.vehicles, after, ["id", "fuel_rank"])))
    dv = M.vehicle_state(M.signed_changes(t.vehicles, after, ["id", "fuel_rank"]))
    c = M.complaint_state(t.complaints)
    new = M.updated_analysis(t.vca, state, c, M.touched_keys(dv, c.limit(0)))
    assert rows(new) == rows(I.vehicle_complaints_analysis(after, t.complaints))


def test_clean_tables_are_made_once(spark, monkeypatch):
    """Of all that is written, only the clean complaints read the raw ones; the
    clean vehicles are read by the rest too."""
    seen, write = [], catalog.materialize

    def noted(df, path, *more):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        seen.append(("l_orderkey#" in plan, "p_brand#" in plan))
        return write(df, path, *more)
    monkeypatch.setattr(catalog, "materialize", noted)
    got = catalog.queries()["X11_maintained_P4"](spark, SF)
    assert [s for s in seen if s != (False, False)] == [(False, True), (True, True)]
    assert rows(got) == rows(Tables(spark, SF).vca)
    for q in ("X11_maintained_A1", "X11_maintained_A3"):
        plan = catalog.queries()[q](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "l_orderkey#" not in plan and "p_brand#" not in plan


def test_earlier_rows_null_keys_and_repeats(spark):
    """A null key is in no side of the change set; a row may be in both."""
    df = spark.createDataFrame([(5, 1), (5, 1), (38, 2), (3, 3), (None, 4), (22, None)], "id long, v long")
    got = catalog._changed(df, "id", "id % 10 <> 3", "id % 11 = 5", "v", F.col("v") + 1)
    assert got.schema.simpleString() == df.schema.simpleString()
    assert rows(got) == rows(spark.createDataFrame(
        [(5, 2), (5, 2), (-5, 1), (-5, 1), (38, 3), (-38, 2), (22, None)], "id long, v long"))
