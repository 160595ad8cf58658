"""Physical-plan properties that matter at scale (checked on sf0.001)."""
from vehiscope.operators import filters as C
from vehiscope.plans.pipeline import Tables

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# (no cross join / no Python evaluation is checked for every registered
# query in test_oracle.py, on the same DataFrame that is compared)


def test_keep_first_limits_before_shuffle(spark):
    p = plan(Tables(spark, SF).vehicles)
    final, exchange = p.index("WindowGroupLimit"), p.index("Exchange")
    partial = p.rindex("WindowGroupLimit")
    assert final < exchange < partial
    assert ", Final" in p[final:exchange].split("\n")[0] and ", Partial" in p[partial:].split("\n")[0]


def test_station_sides_broadcast(spark):
    t = Tables(spark, SF)
    assert "BroadcastExchange" in plan(t.infra)
    assert "BroadcastExchange" in plan(t.comp)


def test_scan_reads_only_needed_columns(spark):
    p = plan(Tables(spark, SF).vca)
    for unused in ("l_quantity", "l_discount", "l_tax", "p_retailprice", "c_acctbal"):
        assert unused not in p


def test_p4_moves_the_vehicle_rows_twice(spark):
    t = Tables(spark, SF)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        p = plan(t.vca)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # exchanges whose rows carry a vehicle column that no key and no roll-up has
    wide = [x for x in p.split("\n") if "Exchange hashpartitioning" in x and "secondary_fuel" in x]
    keyed = [x for x in p.split("\n") if "Exchange hashpartitioning" in x and "_vs_s" in x]
    assert len(wide) == 1 and len(keyed) == 1


def test_null_keeping_filters_reach_the_scan(spark, tmp_out):
    df = spark.createDataFrame([(1, 2.0, None)], "y int, m double, d date")
    df.write.parquet(tmp_out + "/t")
    t = spark.read.parquet(tmp_out + "/t")
    assert "PushedFilters: [Or(IsNull(y),LessThanOrEqual(y,2025))]" in plan(C.not_after_year(t, "y", "2025-03-31", True))
    assert "PushedFilters: [Or(IsNull(m),LessThanOrEqual(m,1000000.0))]" in plan(C.cap(t, "m", 1000000.0))
    assert "PushedFilters: [Or(IsNull(d),LessThanOrEqual(d,2025-03-31))]" in plan(C.not_after(t, "d", "2025-03-31"))


def test_audit_plans_no_sort_aggregate(spark):
    t = Tables(spark, SF)
    from vehiscope.plans import cleaning as P
    assert "SortAggregate" not in plan(P.complaint_audit(t.raw_complaints))


def test_cluster_conf_sizes_partitions():
    from vehiscope.session import cluster_conf
    c = cluster_conf(100 * (1 << 40), executors=1000, cores_per_executor=4)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (256 << 20)
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = cluster_conf(1 << 20, executors=10)
    assert int(small["spark.sql.shuffle.partitions"]) == 3 * 10 * 4


def _scans(df) -> int:
    lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    return sum("Relation" in x and "l_orderkey#" in x for x in lines)


def test_a2_makes_the_complaints_once(spark):
    """Groups are counted before the join, so no count runs it again."""
    from vehiscope.plans import catalog
    for q in ("A2", "J2"):
        assert _scans(catalog.queries()[q](spark, SF)) == 1


def test_l4_publishes_written_layers(spark, monkeypatch):
    """Neither version is made from the raw rows again."""
    from vehiscope.plans import catalog
    from vehiscope.sources import versions as V
    seen, write = [], V.write_data
    monkeypatch.setattr(V, "write_data", lambda df, *a, **k: seen.append(_scans(df)) or write(df, *a, **k))
    rows = {r["name"]: r["rows"] for r in catalog.queries()["L4_release"](spark, SF).collect()}
    t = Tables(spark, SF)
    assert seen == [0] * 6
    assert rows == {"vehicle_complaints_analysis": t.vca.count(), "fuel_infrastructure_analysis": t.infra.count(),
                    "comprehensive_vehicle_analysis": t.comp.count()}
