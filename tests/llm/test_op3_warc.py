import hashlib

import duckdb

from vehiscope.llm import warc as W

from .conftest import SF, clashing


def leaves(spark, rows):
    return spark.createDataFrame(rows, "file_id long, idx long, offset long, length long, hash string")


def test_audit_finds_exactly_the_damage(spark):
    a = [(f, i, 10 * i, 10, hashlib.sha256(f"{f}/{i}".encode()).hexdigest()) for f in range(20) for i in range(40 + f)]
    b = [r for r in a if r[:2] not in {(3, 17), (19, 58)}]
    b = [(*r[:4], "0" * 64) if r[:2] in {(0, 0), (7, 16), (7, 31)} else r for r in b] + [(5, 45, 450, 9, "1" * 64)]
    got = {(r.file_id, r.idx): r.status for r in W.audit(leaves(spark, a), leaves(spark, b)).collect()}
    assert got == {(3, 17): "missing", (19, 58): "missing", (0, 0): "corrupt", (7, 16): "corrupt", (7, 31): "corrupt",
                   (5, 45): "extra"}


def test_equal_and_empty_replicas(spark):
    a = leaves(spark, [(0, i, i, 1, str(i)) for i in range(20)])
    assert W.audit(a, a).count() == 0
    assert W.audit(a.limit(0), a.limit(0)).count() == 0
    assert W.audit(a, a.limit(0)).count() == 20


def test_files_round_trip(spark, tmp_out):
    pages = spark.read.parquet(f"{SF}/pages.parquet").repartition(3)
    pages = pages.unionByName(spark.createDataFrame([(None, None, None), (9, "u\r\nv", "x\r\n\r\ny é")], pages.schema))
    path = tmp_out + "/warc"
    W.write_warc(pages, path)
    found = []
    for r in spark.read.format("binaryFile").load(path).collect():
        for at, length, head, body in W.parse(bytes(r.content)):
            assert head["WARC-Type"] == "resource" and bytes(r.content)[at:at + 5] == b"WARC/"
            found.append((head["WARC-Target-URI"], body.decode()))
    want = [((r.url or "").replace("\r", "%0D").replace("\n", "%0A"), r.html or "") for r in pages.collect()]
    assert sorted(found) == sorted(want)
    got = W.read_leaves(spark, path)
    assert got.count() == len(want)
    bad = got.collect()[5]
    other = got.withColumn("hash", W.F.when((W.F.col("file_id") == bad.file_id) & (W.F.col("idx") == bad.idx), "x")
                           .otherwise(W.F.col("hash")))
    diff = W.audit(got.drop("uri"), other.drop("uri")).collect()
    assert [(r.file_id, r.idx, r.offset, r.length) for r in diff] == [(bad.file_id, bad.idx, bad.offset, bad.length)]


def test_query_equals_sql(spark, tmp_out, monkeypatch):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    pages = pages.unionByName(pages.selectExpr("page_id + 1000 AS page_id", "url", "html")).unionByName(spark.createDataFrame(
        [(None, None, None), (13, "a\nb", "#x"), (13, "a\nb", "#x"), (13, "", ""), (11, None, "é"), (400, "z", None)], pages.schema))
    pages = clashing(pages, "hash", "length", "idx", "copies")
    path = tmp_out + "/sf"
    pages.repartition(2).write.parquet(path + "/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{path}/pages.parquet/*.parquet')")
    monkeypatch.setattr(W, "COPY_CHUNK", 1)
    want = con.sql(W.OP3_SQL)
    got = W.op3_warc_fixity(spark, path).select(*want.columns).collect()
    assert len(got) >= 4 and sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


def test_offsets_of_the_query_locate_records_in_its_files(spark, monkeypatch):
    monkeypatch.setattr(W, "RECORDS_PER_FILE", 20)
    made = []
    monkeypatch.setattr(W, "run_folder", lambda s, n, f=W.run_folder: made.append(f(s, n)) or made[-1])
    got = W.op3_warc_fixity(spark, SF).collect()
    assert {r.status for r in got} == {"corrupt", "missing"}
    files = [{}, {}]
    for k, folder in enumerate(made):
        for f in spark.read.format("binaryFile").load(folder).collect():
            assert f.file_id not in files[k]
            files[k][f.file_id] = bytes(f.content)
    assert len(files[0]) > 2
    for r in got:
        data = files[0][r.file_id]
        assert hashlib.sha256(data[r.offset:r.offset + r.length]).hexdigest() == r.expected
        assert (r.offset, r.length) == list(W.parse(data))[r.idx][:2]
        parts = {hashlib.sha256(files[1][r.file_id][o:o + n]).hexdigest() for o, n, *_ in W.parse(files[1][r.file_id])}
        assert r.expected not in parts and (r.found in parts) == (r.status == "corrupt")


def test_registered_query_leaves_no_archive(spark, tmp_out, monkeypatch):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    many = spark.range(500).selectExpr("CAST(13 AS BIGINT) AS page_id", "'u' AS url", "'same' AS html")
    path = tmp_out + "/sf"
    pages.unionByName(many).repartition(3).write.parquet(path + "/pages.parquet")
    monkeypatch.setattr(W, "RECORDS_PER_FILE", 50)
    monkeypatch.setattr(W, "COPY_CHUNK", 64)
    made = []
    monkeypatch.setattr(W, "run_folder", lambda s, n, f=W.run_folder: made.append(f(s, n)) or made[-1])
    want = sorted(map(str, W.op3_warc_fixity(spark, path).collect()))
    assert len(want) >= 500 and len(made) == 2
    got = sorted(map(str, W.op3_query(spark, path).collect()))
    assert got == want and len(made) == 4

    def there(folder):
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)

    assert [there(f) for f in made] == [True, True, False, False]


def test_query_on_empty_pages(spark, tmp_out):
    spark.read.parquet(f"{SF}/pages.parquet").limit(0).write.parquet(tmp_out + "/sf/pages.parquet")
    assert W.op3_query(spark, tmp_out + "/sf").count() == 0
