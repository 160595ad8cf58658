"""WARC archives and their Merkle fixity audit.

Pages become WARC resource records; a record's place in the archive is its file,
its number in the file and its byte range. The audit hashes every record of a
replica (the leaves), then ordered ranges of ``FANOUT`` neighbours into nodes,
up to one root per file and on to one root of the archive. Two replicas are
compared from the root down: only branches whose hashes differ are opened, until
the differing records, with their byte ranges, are found.

Records are spread over files by hash, about ``RECORDS_PER_FILE`` in each, so no
file and no task grows with the data; identical pages are numbered before they
are spread. The places are made from digests, lengths and keys. A page that is there
once finds its file from its own digest, so it is moved once a replica, to its file;
only pages that may have copies (a set of fixed size says so) are brought together
first. One replica lies on disk at a time, unless its files are asked for.

Defined results
    null URL or page text: empty; line ends in a URL are percent-encoded; null
    page_id: a record like any other; repeated rows: a record each; a record
    that only the first (second) replica has is ``missing`` (``extra``), one with
    another digest ``corrupt``; equal replicas or empty tables: empty result;
    very long pages are hashed whole; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vehiscope.llm.common import _delete, bit_set, in_bit_set, run_folder, scratch, table, written

FANOUT = 16
RECORDS_PER_FILE = 1000
#: Copies of one page that are made from one array.
COPY_CHUNK = 65_536
CRLF = "\r\n"


def _head(url: Column, html: Column) -> Column:
    """The header of a page's record, with the blank line below it."""
    uri = F.replace(F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    body = F.coalesce(html, F.lit(""))
    h = F.md5(F.concat_ws("\n", uri, body).cast("binary"))
    uuid = F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return F.concat(
        F.lit(f"WARC/1.0{CRLF}WARC-Type: resource{CRLF}WARC-Record-ID: <urn:uuid:"), uuid,
        F.lit(f">{CRLF}WARC-Date: 2024-01-01T00:00:00Z{CRLF}WARC-Target-URI: "), uri,
        F.lit(f"{CRLF}Content-Type: text/html{CRLF}Content-Length: "), F.octet_length(body).cast("string"),
        F.lit(CRLF + CRLF))


def record(url: Column, html: Column) -> Column:
    """The WARC record of a page, without the two line ends that close it."""
    return F.concat(_head(url, html), F.coalesce(html, F.lit("")))


def _closed(rec: Column) -> Column:
    return F.concat(rec, F.lit(CRLF + CRLF))


def _files(records: int) -> int:
    return max(1, math.ceil(records / RECORDS_PER_FILE))


def _file_of(key: str, copy: Column, files: int) -> Column:
    """The file of a copy of a record with ``key`` and ``hash``."""
    name = F.md5(F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")), "hash", copy.cast("string")).cast("binary"))
    return F.pmod(F.conv(F.substring(name, 1, 8), 16, 10).cast("long"), F.lit(files))


def _copies(counted: DataFrame, *spread: str) -> DataFrame:
    """A row for each of a row's ``copies``, numbered as ``copy``; ``spread``
    deals the copies of one row to tasks in portions."""
    portions = counted.withColumn("from", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPY_CHUNK).cast("long"))))
    if spread:
        portions = portions.repartition(*spread, "from")
    return portions.withColumn("copy", F.explode(F.sequence(
        F.col("from"), F.least(F.col("from") + COPY_CHUNK, F.col("copies")) - 1)))


def layout(rows: DataFrame, key: str = "page_id") -> DataFrame:
    """Places of records. ``rows``: key, length, hash and any further columns
    that depend on them; returns file_id, idx, offset and the columns of rows."""
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    total = counted.agg(F.sum("copies")).first()[0] or 0
    each = _copies(counted).withColumn("file_id", _file_of(key, F.col("copy"), _files(total)))
    order = Window.partitionBy("file_id").orderBy(F.col(key).asc_nulls_first(), "hash", "copy")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return each.select("file_id", (F.row_number().over(order) - 1).cast("long").alias("idx"),
                       F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"), *rows.columns)


def _parents(level: DataFrame) -> DataFrame:
    """One node for FANOUT neighbours: the hash of their numbers and hashes."""
    kids = F.array_sort(F.collect_list(F.struct("node", "hash")))  # FANOUT at most
    text = F.array_join(F.transform(kids, lambda k: F.concat_ws(":", k["node"].cast("string"), k["hash"])), ";")
    return (level.groupBy("part", F.floor(F.col("node") / FANOUT).alias("up")).agg(text.alias("t"))
            .select("part", F.col("up").alias("node"), F.sha2("t", 256).alias("hash")))


def _height(n: int) -> int:
    """Levels above n leaves until one node is left."""
    h = 0
    while n > 1:
        n, h = -(-n // FANOUT), h + 1
    return h


def tree(leaves: DataFrame, in_file: int, in_archive: int, name: str) -> list[DataFrame]:
    """Levels from the leaves to the root: ``part, node, hash``. The first
    ``in_file + 1`` levels have a part per file; the roots of the files are the
    leaves of the archive's part -1."""
    levels = [written(leaves.select(F.col("file_id").alias("part"), F.col("idx").alias("node"), "hash"), f"{name}-0")]
    for k in range(1, in_file + 1):
        levels.append(written(_parents(levels[-1]), f"{name}-{k}"))
    levels.append(levels[-1].select(F.lit(-1).cast("long").alias("part"), F.col("part").alias("node"), "hash"))
    for k in range(in_archive):
        levels.append(written(_parents(levels[-1]), f"{name}-{in_file + 1 + k}"))
    return levels


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    a = a.select("part", "node", F.col("hash").alias("ha"))
    b = b.select("part", "node", F.col("hash").alias("hb"))
    return a.join(b, ["part", "node"], "full").where(~F.col("ha").eqNullSafe(F.col("hb"))).select("part", "node")


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """Differing records of two replicas: ``file_id, idx, offset, length,
    expected, found, status``. Leaves: file_id, idx, offset, length, hash."""
    size = a.select("file_id", "idx").unionByName(b.select("file_id", "idx")).agg(F.max("idx"), F.max("file_id")).first()
    in_file, in_archive = _height((size[0] or 0) + 1), _height((size[1] or 0) + 1)
    ta, tb = tree(a, in_file, in_archive, "merkle-a"), tree(b, in_file, in_archive, "merkle-b")
    open_ = _differing(ta[-1], tb[-1])
    for k in range(len(ta) - 2, -1, -1):
        if k == in_file:  # from the archive's leaves to the roots of the files
            open_ = open_.select(F.col("node").alias("part"), F.lit(0).cast("long").alias("node"))
            open_ = open_.select("part", "node")
            continue
        up = open_.select("part", F.col("node").alias("up"))

        def below(level: DataFrame) -> DataFrame:
            return level.withColumn("up", F.floor(F.col("node") / FANOUT)).join(up, ["part", "up"], "left_semi")

        open_ = written(_differing(below(ta[k]), below(tb[k])), f"merkle-differing-{k}")
    bad = open_.select(F.col("part").alias("file_id"), F.col("node").alias("idx"))
    left = a.join(bad, ["file_id", "idx"]).select(
        "file_id", "idx", F.col("offset").alias("oa"), F.col("length").alias("la"), F.col("hash").alias("expected"))
    right = b.join(bad, ["file_id", "idx"]).select(
        "file_id", "idx", F.col("offset").alias("ob"), F.col("length").alias("lb"), F.col("hash").alias("found"))
    return left.join(right, ["file_id", "idx"], "full").select(
        "file_id", "idx", F.coalesce("oa", "ob").alias("offset"), F.coalesce("la", "lb").alias("length"),
        "expected", "found", F.when(F.col("found").isNull(), "missing").when(F.col("expected").isNull(), "extra")
        .otherwise("corrupt").alias("status"))


def write_warc(pages: DataFrame, path: str) -> None:
    """Write pages as WARC files, one per partition of ``pages`` and
    RECORDS_PER_FILE records: every record ends with two line ends."""
    (pages.select(record(F.col("url"), F.col("html")).alias("value"))
     .write.option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def write_replica(records: DataFrame, path: str, order: list[Column], compression: str = "none") -> None:
    """Write ``file_id, value`` as one WARC file per file_id, in the given order:
    ``value`` is a record without the two line ends that close it."""
    (records.repartition("file_id").sortWithinPartitions("file_id", *order).select("file_id", "value")
     .write.partitionBy("file_id").option("lineSep", CRLF + CRLF).option("compression", compression)
     .option("zlib.compress.level", "BEST_SPEED").text(path))


def parse(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, payload) of the records of one file."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        head = dict(x.split(": ", 1) for x in data[at:end].decode().split(CRLF)[1:])
        stop = end + 4 + int(head["Content-Length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut")
        yield at, stop + 4 - at, head, data[end + 4:stop]
        at = stop + 4


def read_leaves(spark: SparkSession, path: str) -> DataFrame:
    """Leaves of the WARC files in a folder; those of `write_replica` have their
    file_id, others count by their order of name."""
    files = spark.read.format("binaryFile").load(path)

    def cut(frames):
        import gzip
        import hashlib
        for f in frames:
            for name, data in zip(f["path"], f["content"]):
                if data[:2] == b"\x1f\x8b":
                    data = gzip.decompress(data)
                rows = [(name, i, o, n, hashlib.sha256(data[o:o + n]).hexdigest(), h["WARC-Target-URI"])
                        for i, (o, n, h, _) in enumerate(parse(data))]
                yield pd.DataFrame(rows, columns=["name", "idx", "offset", "length", "hash", "uri"])

    if "file_id" in files.columns:
        return (files.select(F.col("file_id").cast("string").alias("path"), "content").mapInPandas(
            cut, "name string, idx long, offset long, length long, hash string, uri string")
            .select(F.col("name").cast("long").alias("file_id"), "idx", "offset", "length", "hash", "uri"))
    leaves = files.select("path", "content").mapInPandas(
        cut, "name string, idx long, offset long, length long, hash string, uri string")
    names = leaves.select("name").distinct().withColumn("file_id", F.dense_rank().over(Window.orderBy("name")).cast("long") - 1)
    return leaves.join(names, "name").select("file_id", "idx", "offset", "length", "hash", "uri")


#: Damage of the registered query's second replica: every 97th page has its first
#: byte changed, every 389th page is lost.
FLIPPED, LOST = (97, 13), (389, 11)


def _damaged(pages: DataFrame) -> tuple[Column, Column, Column]:
    """The record of a page, the one in the second replica, and whether that is lost."""
    flip = (F.pmod("page_id", F.lit(FLIPPED[0])) == FLIPPED[1]) & (F.octet_length("html") > 0) & (F.ascii("html") < 128)
    lost = F.coalesce(F.pmod("page_id", F.lit(LOST[0])) == LOST[1], F.lit(False))
    other = F.when(flip, F.concat(F.when(F.substring("html", 1, 1) == "#", "+").otherwise("#"),
                                  F.expr("substr(html, 2)"))).otherwise(F.col("html"))
    url, html = F.col("url"), F.col("html")
    # the damaged copy keeps the header: its record id is that of the good page
    return record(url, html), F.concat(_head(url, html), F.coalesce(other, F.lit(""))), lost


def placed(hashed: DataFrame, counted: DataFrame, records: int) -> DataFrame:
    """Pages with the file_id of each of their records. ``hashed``: page_id, url,
    html, hash; ``counted``: page_id, hash, copies of the pages that are there more
    than once; ``records``: number of all."""
    names = ["page_id", "url", "html", "hash", "copy"]
    once = hashed.withColumn("copy", F.lit(0).cast("long")).select(*names)
    if counted.head(1):
        # pages are told apart by their number before they are hashed; one that
        # only seems to have copies has one
        perhaps = in_bit_set(bit_set(counted, "page_id"), "page_id")
        same = F.col("r.page_id").eqNullSafe(F.col("c.page_id")) & (F.col("r.hash") == F.col("c.hash"))
        many = hashed.where(perhaps).dropDuplicates(["page_id", "hash"]).alias("r").join(
            counted.alias("c"), same, "left").select("r.*", F.coalesce("copies", F.lit(1).cast("long")).alias("copies"))
        once = once.where(~perhaps).unionByName(_copies(many, "page_id", "hash").select(*names))
    return once.withColumn("file_id", _file_of("page_id", F.col("copy"), _files(records)))


def op3_warc_fixity(spark: SparkSession, sf_dir: str, scratch_archives: bool = False) -> DataFrame:
    """Audit of an archive of all pages against a replica with known damage, both
    read from their files. With ``scratch_archives`` each replica is compressed and
    its folder is deleted as soon as its leaves are read."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    good, bad, lost = _damaged(pages)
    hashed = pages.withColumn("hash", F.sha2(_closed(good), 256))
    with scratch(spark):
        places = written(layout(hashed.select("page_id", F.octet_length(_closed(good)).cast("long").alias("length"), "hash")),
                         "warc-places")
        copies = written(places.groupBy("page_id", "hash").agg(F.count("*").alias("copies")).where("copies > 1"), "warc-copies")
        each = placed(hashed, copies, places.count())
        order = [F.col("page_id").asc_nulls_first(), F.col("hash")]

        def leaves(records: DataFrame, value: Column, name: str) -> DataFrame:
            folder = run_folder(spark, name)
            write_replica(records.withColumn("value", value), folder, order, "gzip" if scratch_archives else "none")
            found = written(read_leaves(spark, folder).drop("uri"), f"{name}-leaves")
            if scratch_archives:
                _delete(spark, folder)
            return found

        a = leaves(each, good, "warc-a")
        # the index of the second replica: the n-th record of its file is number idx of the archive's
        index = places.where(~lost).select("file_id", F.col("idx").alias("number"), (F.row_number().over(
            Window.partitionBy("file_id").orderBy("idx")) - 1).cast("long").alias("idx"))
        b = written(leaves(each.where(~lost), bad, "warc-b").join(index, ["file_id", "idx"]).select(
            "file_id", F.col("number").alias("idx"), "offset", "length", "hash"), "warc-leaves-b")
        return written(places.select("file_id", "idx", "page_id").join(audit(a, b), ["file_id", "idx"]), "warc-audit", keep=True)


def op3_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: no archive is left behind."""
    return op3_warc_fixity(spark, sf_dir, scratch_archives=True)


OP3_SQL = f"""
WITH p AS (SELECT page_id, replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A') AS uri, coalesce(html, '') AS body FROM pages),
h AS (SELECT *, md5(uri || chr(10) || body) AS m FROM p),
b AS (SELECT page_id, body, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
  || 'WARC-Record-ID: <urn:uuid:' || m[1:8] || '-' || m[9:12] || '-' || m[13:16] || '-' || m[17:20] || '-' || m[21:32] || '>'
  || chr(13) || chr(10) || 'WARC-Date: 2024-01-01T00:00:00Z' || chr(13) || chr(10) || 'WARC-Target-URI: ' || uri
  || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(body)
  || chr(13) || chr(10) || chr(13) || chr(10) AS head, chr(13) || chr(10) || chr(13) || chr(10) AS tail FROM h),
r AS (SELECT page_id, CAST(strlen(head || body || tail) AS BIGINT) AS length, sha256(head || body || tail) AS expected,
  CASE WHEN page_id % {LOST[0]} = {LOST[1]} THEN NULL
    WHEN page_id % {FLIPPED[0]} = {FLIPPED[1]} AND strlen(body) > 0 AND ascii(body) < 128
    THEN sha256(head || CASE WHEN body[1] = '#' THEN '+' ELSE '#' END || substr(body, 2) || tail)
    ELSE sha256(head || body || tail) END AS found FROM b),
c AS (SELECT *, row_number() OVER (PARTITION BY page_id, expected) - 1 AS copy, count(*) OVER () AS total FROM r),
f AS (SELECT *, CAST('0x' || md5(concat_ws('|', coalesce(CAST(page_id AS VARCHAR), ''), expected, CAST(copy AS VARCHAR)))[1:8] AS BIGINT)
  % greatest(1, CAST(ceil(total / {RECORDS_PER_FILE}) AS BIGINT)) AS file_id FROM c),
o AS (SELECT *, row_number() OVER w - 1 AS idx, CAST(coalesce(sum(length) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM f WINDOW w AS (PARTITION BY file_id ORDER BY page_id NULLS FIRST, expected, copy))
SELECT file_id, idx, page_id, "offset", length, expected, found,
  CASE WHEN found IS NULL THEN 'missing' ELSE 'corrupt' END AS status FROM o WHERE found IS DISTINCT FROM expected
"""
