"""Metamorphic checks on the bound tables (sf0.001): results do not depend on
input row order or partitioning once keep-first orders are total; the
explosion adds exactly one row per dual-fuel vehicle; the left join keeps the
left row count."""
from pyspark.sql import functions as F

from vehiscope.operators import aggregates as A
from vehiscope.operators.joins import join_complaints
from vehiscope.plans import cleaning as P
from vehiscope.plans import integration as I
from vehiscope.plans.pipeline import Tables
from vehiscope.sources import bindings as B

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_p4_invariant_to_row_order_and_partitioning(spark):
    t = Tables(spark, SF)
    shuffled = {
        "raw_vehicles": t.raw_vehicles.repartition(7).orderBy(F.rand(3)),
        "raw_complaints": t.raw_complaints.repartition(5).orderBy(F.rand(5)),
        "raw_stations": t.raw_stations.repartition(3).orderBy(F.rand(7)),
    }
    u = Tables(spark, SF, _over=shuffled)
    assert _rows(u.vca) == _rows(t.vca)
    assert _rows(u.comp) == _rows(t.comp)
    assert _rows(u.infra) == _rows(t.infra)


def test_explosion_adds_one_row_per_dual_fuel_vehicle(spark):
    t = Tables(spark, SF)
    base = P.clean_vehicles_unexploded(t.raw_vehicles, order_by=B.VEHICLE_ORDER)
    n_dual = base.filter(F.col("secondary_fuel").isNotNull()).count()
    assert t.vehicles.count() == base.count() + n_dual


def test_left_join_keeps_left_rows(spark):
    t = Tables(spark, SF)
    rollup = A.complaint_rollup(I.normalized_complaints(t.complaints))
    assert join_complaints(t.vehicles, rollup).count() == t.vehicles.count()
