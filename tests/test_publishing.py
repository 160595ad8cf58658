"""Publishing as one step: concurrent readers, failing loads, changed columns."""
import os
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from vehiscope.sources import sinks as SK
from vehiscope.sources import versions as V


def name():
    return f"vs_p_{uuid.uuid4().hex}"


def test_readers_see_one_version_or_the_next(spark, tmp_out):
    table, root = name(), os.path.join(tmp_out, "t")
    paths = [SK.write_layer(spark.range(n).withColumn("n", F.lit(n)), os.path.join(tmp_out, f"src{n}")) for n in (10, 20)]
    one, two = name(), name()
    SK.publish_table(spark.read.parquet(paths[0]), table, path=root)
    SK.load_all(spark, {one: paths[0], two: paths[0]}, location=os.path.join(tmp_out, "all"))
    stop, wrong, seen = threading.Event(), [], 0

    def look():
        nonlocal seen
        while not stop.is_set():
            try:
                spark.catalog.refreshTable(table)
                r = spark.table(table).agg(F.count("*"), F.min("n"), F.max("n")).first()
                if r[0] != r[1] or r[1] != r[2]:
                    wrong.append(r)
                both = V.read_release(spark, os.path.join(tmp_out, "all"))
                counts = {df.count() for df in both.values()}
                if len(both) != 2 or len(counts) != 1:
                    wrong.append(counts)
                seen += 1
            except Exception as e:
                wrong.append(e)
    reader = threading.Thread(target=look)
    reader.start()
    bad = spark.range(5).select(F.col("id"), F.raise_error(F.lit("broken")).cast("int").alias("n"))
    for k in range(4):
        SK.publish_table(spark.read.parquet(paths[(k + 1) % 2]), table, path=root)
        SK.compact_table(spark, table, root, 1 << 20)
        with pytest.raises(Exception, match="broken"):
            SK.publish_table(bad, table, path=root)
        SK.load_all(spark, dict.fromkeys((one, two), paths[(k + 1) % 2]), location=os.path.join(tmp_out, "all"))
    stop.set()
    reader.join()
    assert not wrong and seen > 3
    assert spark.table(table).count() == 10 and spark.table(two).count() == 10


def test_replaced_folders_go_after_some_versions(spark, tmp_out):
    table = name()
    for n in range(1, 6):
        SK.publish_table(spark.range(n), table, path=tmp_out, keep=2)
    assert len(os.listdir(os.path.join(tmp_out, "data"))) == 2
    assert V.read(spark, tmp_out, version=4).count() == 4 and spark.table(table).count() == 5


def test_a_table_without_a_path_has_no_gap_either(spark):
    table = name()
    SK.publish_table(spark.range(3), table)
    first = spark.table(table).inputFiles()
    SK.publish_table(spark.range(4), table)
    assert spark.table(table).count() == 4 and not set(first) & set(spark.table(table).inputFiles())
    assert all(os.path.exists(f.removeprefix("file:")) for f in first)


def test_changed_columns_are_reported_or_refused(spark, tmp_out, caplog):
    table, root = name(), os.path.join(tmp_out, "t")
    SK.publish_table(spark.range(3), table, path=root)
    wider = spark.range(2).withColumn("more", F.lit("x"))
    with pytest.raises(SK.SchemaChanged, match="more"):
        SK.publish_table(wider, table, path=root, on_schema_change="fail")
    assert spark.table(table).count() == 3 and V.numbers(spark, root) == [1]
    with caplog.at_level("WARNING"):
        SK.publish_table(wider, table, path=root)
    assert "more" in caplog.text and spark.table(table).columns == ["id", "more"]
    assert SK.schema_changes(spark.range(1).schema, wider.schema) == [("more", None, "string")]


def test_a_load_keeps_what_it_does_not_replace(spark, tmp_out):
    a, b, where = name(), name(), os.path.join(tmp_out, "wh")
    one = SK.write_layer(spark.range(1), os.path.join(tmp_out, "one"))
    two = SK.write_layer(spark.range(2).withColumn("x", F.lit(1)), os.path.join(tmp_out, "two"))
    assert {r.status for r in SK.load_all(spark, {a: one, b: one}, location=where).collect()} == {"SUCCESS"}
    out = {r.dataset: (r.ok, r.rows, r.status) for r in
           SK.load_all(spark, {a: os.path.join(tmp_out, "none"), b: two}, location=where, on_schema_change="fail").collect()}
    assert out == {a: (False, None, "PARTIAL FAILURE"), b: (False, None, "PARTIAL FAILURE")}
    out = SK.load_all(spark, {a: os.path.join(tmp_out, "none"), b: two}, location=where).collect()
    assert {r.dataset: r.rows for r in out} == {a: None, b: 2}
    assert {n: df.count() for n, df in V.read_release(spark, where).items()} == {a: 1, b: 2}
    assert spark.table(a).count() == 1 and spark.table(b).count() == 2
