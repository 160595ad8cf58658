"""Sources and sinks on small files written to a fresh folder."""
import os

import pytest

from vehiscope.sources import readers as RD
from vehiscope.sources import sinks as SK


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_s1_quoted_newline_and_doubled_quote_and_tokens(spark, tmp_out):
    p = _write(os.path.join(tmp_out, "v.csv"),
               'id,year,make,model,comb08\n'
               '1,2020,"Ford ""Blue""","F-150\nCrew",NA\n'
               '2,x,None,Camry,30\n')
    rows = sorted(RD.read_vehicles(spark, p).collect(), key=lambda r: r.id)
    assert len(rows) == 2
    assert rows[0].make == 'Ford "Blue"' and rows[0].model == "F-150\nCrew"
    assert rows[0].comb08 is None and rows[0].year == 2020
    assert rows[1].year is None and rows[1].make is None and rows[1].comb08 == 30


def test_s2_positions_and_width_check(spark, tmp_out):
    cols = [str(i) for i in range(49)]
    cols[0], cols[1], cols[3], cols[5], cols[7], cols[17] = "11", "111", "FORD", "2020", "20200102", "1500"
    p = _write(os.path.join(tmp_out, "c.tsv"), "\t".join(cols) + "\n")
    r = RD.read_complaints(spark, p).first()
    assert (r.ODINO, r.CMPLID, r.MAKETXT, r.YEARTXT, r.DATEA, r.MILEAGE, r.VIN) == (
        11, 111, "FORD", "2020", "20200102", 1500.0, "14")
    bad = _write(os.path.join(tmp_out, "bad.tsv"), "\t".join(cols[:10]) + "\n")
    with pytest.raises(ValueError):
        RD.read_complaints(spark, bad)


def test_s3_stations_csv(spark, tmp_out):
    p = _write(os.path.join(tmp_out, "s.csv"),
               "id,fuel_type_code,state,zip,latitude,longitude\n5,ELEC,CA,01234,35.5,-100\n")
    r = RD.read_stations(spark, p).first()
    assert (r.id, r.zip, r.latitude) == (5, "01234", 35.5)


def test_s4_json_unnest_and_missing_field(spark, tmp_out):
    p = _write(os.path.join(tmp_out, "st.json"),
               '{"fuel_stations": [{"id": 1, "fuel_type_code": "ELEC", "zip": "01234", '
               '"ev_connector_types": ["J1772"], "open_date": "2020-01-02"}, '
               '{"id": 2, "fuel_type_code": "CNG"}]}')
    rows = sorted(RD.read_station_json(spark, p).collect(), key=lambda r: r.id)
    assert [(r.id, r.fuel_type_code) for r in rows] == [(1, "ELEC"), (2, "CNG")]
    assert rows[0].ev_connector_types == ["J1772"] and str(rows[0].open_date) == "2020-01-02"
    q = _write(os.path.join(tmp_out, "none.json"), '{"error": "no data"}')
    assert RD.read_station_json(spark, q, schema=None).count() == 0


def test_headers_are_matched_by_name_and_bad_rows_set_aside(spark, tmp_out):
    folder = os.path.join(tmp_out, "veh")
    os.makedirs(folder)
    _write(os.path.join(folder, "a.csv"), "id,year,make\n1,2020,Ford\n2,2021\n3,2021,\"Two\nlines\"\n")
    _write(os.path.join(folder, "b.csv"), "make,id,year\nKia,4,2019\nVW,5,2018,extra\n")
    got = {r.id: (r.year, r.make) for r in RD.read_vehicles(spark, folder).collect()}
    assert got == {1: (2020, "Ford"), 3: (2021, "Two\nlines"), 4: (2019, "Kia")}
    bad = {os.path.basename(r.file): (r.record, r.reason) for r in RD.malformed_rows(spark, folder).collect()}
    assert {k: v[0] for k, v in bad.items()} == {"a.csv": "2,2021", "b.csv": "VW,5,2018,extra"}


def test_complaint_rows_of_another_width_are_set_aside(spark, tmp_out):
    good = "\t".join(str(i) for i in range(49))
    path = _write(os.path.join(tmp_out, "c.tsv"), "\n".join([good, "\t".join("x" * 10), good, "\t".join(["y"] * 52)]) + "\n")
    assert RD.read_complaints(spark, path).count() == 2
    assert RD.malformed_rows(spark, path, "\t", header=False, width=49).count() == 2


def test_station_documents_without_the_field_are_reported(spark, tmp_out, caplog):
    path = _write(os.path.join(tmp_out, "d.json"), '{"other": 1}\n{"fuel_stations": [{"id": 1}, {"id": 2}, {"id": 3}]}\n')
    with caplog.at_level("WARNING"):
        assert RD.read_station_json(spark, path, multi_line=False).count() == 3
    assert "no fuel_stations" in caplog.text


def test_s6_s7_s9_write_read_and_compare(spark, tmp_out):
    df = spark.range(2000).selectExpr("id", "id % 7 AS k", "repeat('x', 20) AS s")
    paths = SK.write_layers({"a": df, "b": df.filter("k = 0")}, os.path.join(tmp_out, "layer"))
    counts = {r.name: r.rows for r in SK.layer_counts(spark, paths).collect()}
    assert counts == {"a": 2000, "b": 286}
    cmp = {r.format: r for r in SK.compare_formats(df, os.path.join(tmp_out, "cmp")).collect()}
    assert cmp["parquet"].bytes < cmp["csv"].bytes
    assert cmp["csv"].pct_smaller_than_csv == 0.0 and cmp["parquet"].pct_smaller_than_csv > 0


def test_l1_to_l4_publish_compact_and_partial_failure(spark, tmp_out):
    df = spark.range(100).selectExpr("id", "id % 3 AS k").repartition(5)
    src = SK.write_layer(df, os.path.join(tmp_out, "src"))
    SK.publish_table(df, "vs_t_l1", path=os.path.join(tmp_out, "tbl"))
    SK.analyze_table(spark, "vs_t_l1")
    size = sum(os.path.getsize(f.removeprefix("file:")) for f in spark.table("vs_t_l1").inputFiles())
    assert SK.compact_table(spark, "vs_t_l1", os.path.join(tmp_out, "tbl"), size // 2 + 1) == 2
    spark.catalog.refreshTable("vs_t_l1")
    assert spark.table("vs_t_l1").count() == 100 and len(spark.table("vs_t_l1").inputFiles()) == 2
    assert SK.files_for(0) == 1 and SK.files_for(1 << 40) == 4096
    out = SK.load_all(spark, {"vs_ok": src, "vs_missing": os.path.join(tmp_out, "nope")},
                      location=os.path.join(tmp_out, "wh")).collect()
    res = {r.dataset: (r.ok, r.rows, r.status) for r in out}
    assert res == {"vs_ok": (True, 100, "PARTIAL FAILURE"),
                   "vs_missing": (False, None, "PARTIAL FAILURE")}


def test_run_files_end_to_end(spark, tmp_out):
    from vehiscope.plans.pipeline import run_files
    v = _write(os.path.join(tmp_out, "veh.csv"),
               "id,year,make,model,VClass,drive,trany,cylinders,displ,fuelType,fuelType1,"
               "fuelType2,city08,highway08,comb08,co2TailpipeGpm\n"
               "1,2020,Ford,F-150,Truck,AWD,Auto,6,3.5,Regular,Regular Gasoline,,20,25,22,400\n"
               "2,2021,Tesla,Model 3,Car,RWD,Auto,NA,NA,Electricity,Electricity,,130,120,125,0\n"
               "3,2005,Ford,Old,Truck,AWD,Auto,6,3.5,Regular,Regular Gasoline,,20,25,22,400\n")
    row = ["0"] * 49
    lines = []
    for odino, cmplid, make, model in [(10, 100, " ford ", "F-150"), (10, 101, "FORD", "F-150"),
                                       (11, 110, "TESLA", "MODEL 3")]:
        r = list(row)
        r[0], r[1], r[2], r[3], r[4], r[5] = str(odino), str(cmplid), make, make, model, "2020"
        r[6], r[7], r[8], r[9], r[10], r[11], r[14], r[17] = "Y", "20200102", "N", "1", "0", "ENGINE", "", "1000"
        if model == "MODEL 3":
            r[5] = "2021"
        lines.append("\t".join(r))
    c = _write(os.path.join(tmp_out, "cmp.tsv"), "\n".join(lines) + "\n")
    s = _write(os.path.join(tmp_out, "st.csv"),
               "id,fuel_type_code,station_name,state,latitude,longitude,status_code,access_code\n"
               "1,ELEC,a,CA,35,-100,E,public\n2,ELEC,b,,36,-101,P,public\n")
    t = run_files(spark, v, c, s, os.path.join(tmp_out, "out"))
    vca = {r.model: r for r in t.vca.collect()}
    assert set(vca) == {"F-150", "Model 3"}
    assert vca["F-150"].total_complaints == 1 and vca["F-150"].crash_incidents == 1
    assert vca["Model 3"].total_complaints == 1
    infra = {r.fuel_type_code: r for r in t.infra.collect()}
    assert infra["ELEC"].total_stations == 1
    comp = {r.model: r.stations_nationwide for r in t.comp.collect()}
    assert comp == {"F-150": 0, "Model 3": 2}


def test_many_files_are_read_by_header(spark, tmp_out):
    folder = os.path.join(tmp_out, "many files [1]")
    os.mkdir(folder)
    heads = ["id,year,make", "year,id", "make,id,year,\"odd \"\"name\"\"\""]
    for i in range(300):
        text = heads[i % 3] + "\n" + [f"{i},2020,Kia\n", f"2021,{i}\n", f"VW,{i},2022,x\n"][i % 3]
        _write(os.path.join(folder, f"part {i}.csv"), "\n" + text if i == 5 else text)
    _write(os.path.join(folder, "empty.csv"), "")
    _write(os.path.join(folder, "z.csv"), 'id,year,make\n900,2020,"Two\nlines"\n901,2021,Kia\n')
    sc = spark.sparkContext
    sc.setJobGroup("discovery", "headers")
    df = RD.read_vehicles(spark, folder.replace("[", "\\[").replace("]", "\\]"))
    sc.setJobGroup("rest", "rows")
    assert len(sc.statusTracker().getJobIdsForGroup("discovery")) <= 8  # not one a file
    # three headers, and the one file with a line break inside a field
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 4
    assert df.columns.count('odd "name"') == 1
    got = {r.id: (r.year, r.make) for r in df.collect()}
    assert len(got) == 302 and got[900] == (2020, "Two\nlines") and got[901] == (2021, "Kia")
    assert all(got[i] == [(2020, "Kia"), (2021, None), (2022, "VW")][i % 3] for i in range(300))


def test_files_without_line_breaks_are_read_in_splits(spark, tmp_out):
    path = _write(os.path.join(tmp_out, "v.csv"), "id,year,make\n" + "".join(f"{i},2020,\"a, b\"\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = RD.read_vehicles(spark, path)
        assert df.rdd.getNumPartitions() > 3 and df.where("make = 'a, b'").count() == 20000
        assert RD.read_vehicles(spark, path, multi_line=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_every_complaint_file_has_its_width_checked(spark, tmp_out):
    _write(os.path.join(tmp_out, "a.tsv"), "\t".join(map(str, range(49))) + "\n")
    assert RD.read_complaints(spark, tmp_out).count() == 1
    _write(os.path.join(tmp_out, "b.tsv"), "\t".join(map(str, range(48))) + "\n")
    with pytest.raises(ValueError, match="48 columns, expected 49.*b.tsv"):
        RD.read_complaints(spark, tmp_out)
    with pytest.raises(ValueError, match="no line"):
        RD.read_stations(spark, _write(os.path.join(tmp_out, "none.csv"), ""))


def test_the_place_of_a_row_follows_the_names_of_the_files(spark, tmp_out):
    from vehiscope.plans.pipeline import ROW, ingest_files
    veh = _write(os.path.join(tmp_out, "v.csv"), "id,year\n1,2020\n")
    cmp = _write(os.path.join(tmp_out, "c.tsv"), "\t".join(map(str, range(49))) + "\n")
    os.mkdir(tmp_out + "/st")
    for name, n, head in (("a", 3, "id,state\n"), ("b", 4000, "state,id\n"), ("c", 800, "id,state\n")):
        _write(f"{tmp_out}/st/{name}.csv", head + "".join(f"7,{name}{i}\n" if head[0] == "i" else f"{name}{i},7\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        st = ingest_files(spark, veh, cmp, tmp_out + "/st", tmp_out + "/out")["raw_stations"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [f"{name}{i}" for name, n in (("a", 3), ("b", 4000), ("c", 800)) for i in range(n)]
    assert [r.state for r in st.orderBy(ROW).select("state").collect()] == want
