"""Raw-file sources S1-S5 and the layer reader S8.

CSV is read as text and typed afterwards: columns that are not in the typing
map stay text, missing columns are tolerated (schema drift, C13), the
missing-value tokens become null first (S5, trap T9) and every cast is a
``try_cast`` (trap T19). Quoted fields with embedded newlines and doubled
quotes need ``multiLine`` and ``escape='"'`` (trap T10). Files that hold such a
field are not splittable: a first job over the lines (`catalogue`) finds them, and
the other files are read in splits. The raw edge is ingested once into Parquet and
every later stage reads Parquet.
"""

from __future__ import annotations

import csv
import logging
import re
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions.scalar import nullify

log = logging.getLogger(__name__)

# types of the used columns (everything else stays text)
VEHICLE_TYPES = {
    "id": "bigint", "year": "int", "cylinders": "double", "displ": "double",
    "city08": "int", "highway08": "int", "comb08": "int", "co2TailpipeGpm": "double",
}
COMPLAINT_TYPES = {
    "ODINO": "bigint", "CMPLID": "bigint", "INJURED": "int", "DEATHS": "int",
    "MILEAGE": "double",
}
STATION_TYPES = {"id": "bigint", "latitude": "double", "longitude": "double"}


CORRUPT = "_vs_corrupt"


def _reader(spark: SparkSession, sep: str, header: bool, multi_line: bool):
    return (spark.read.option("sep", sep).option("header", header)
            .option("multiLine", multi_line).option("quote", '"').option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("columnPruning", False))  # else the width of a row is not checked


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """``file, first, broken``: each raw file's first line that is not blank, and
    the number of its lines with an odd number of quotes. Where there is none, no
    field of the file holds a line break, so the file can be read in splits.

    One job for any number of files: it reads the lines in splits and keeps one
    row a file; the first line is looked for where a file's first block starts.
    """
    line = F.col("value")
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), (F.col("_metadata.file_block_start") == 0).alias("head"),
        F.monotonically_increasing_id().alias("n"))
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return lines.groupBy("file").agg(
        F.min_by("value", F.when(F.col("head") & (F.trim(line) != ""), F.col("n"))).alias("first"),
        F.count_if(quotes % 2 == 1).alias("broken"))


def _names(first: str, sep: str) -> list[str]:
    """Column names of a header: as Spark names them, blank ones ``_c<number>``,
    those that differ in case only with their number behind them."""
    raw = next(csv.reader([first], delimiter=sep))
    low = [n.lower() for n in raw]
    return [f"_c{i}" if not n else f"{n}{i}" if low.count(n.lower()) > 1 else n for i, n in enumerate(raw)]


def _path_of(uri: str) -> str:
    """The path that a file's URI names, its glob characters taken literally."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(uri))


def _text_columns(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])


def _rows(spark: SparkSession, path: str, sep: str, header: bool, multi_line: bool | None,
          width: int | None = None, check_first: bool = False) -> DataFrame:
    """All rows as text with CORRUPT filled where a row is too short or too long.
    Files are grouped by header and by whether a field may hold a line break
    (``multi_line`` None; else as said): one reader a group, so columns are
    matched by name and a column that a file lacks is null there. Files without a
    line are left out; ``check_first`` refuses files whose first row has another
    width."""
    first = F.col("first")
    whole = (F.length(first) - F.length(F.replace(first, F.lit('"'), F.lit("")))) % 2 == 0
    # separators outside of quoted fields
    fields = F.size(F.split(F.regexp_replace(first, '"[^"]*"', ""), f"[{sep}]"))
    # one row a file, as long as the listing of the files itself
    known = catalogue(spark, path).where("first IS NOT NULL")
    kinds = (known.select("file", (first if header else F.lit("")).alias("first"),
                          (F.col("broken") > 0 if multi_line is None else F.lit(multi_line)).alias("multi"),
                          F.when(whole & (fields != width), F.struct("file", fields.alias("n"))).alias("shifted"))
             .groupBy("first", "multi").agg(F.sort_array(F.collect_list("file")).alias("files"), F.min("shifted").alias("shifted"))
             .orderBy("first", "multi").collect())
    wrong = [k.shifted for k in kinds if k.shifted]
    if check_first and wrong:
        raise ValueError(f"complaint file has {wrong[0].n} columns, expected {width}: {wrong[0].file}")
    if not kinds:
        raise ValueError(f"{path} holds no line")
    out = None
    for k in kinds:
        files = [_path_of(f) for f in k.files]
        names = [f"_c{i}" for i in range(width)] if not header else _names(k.first, sep)
        if header and k.first.count('"') % 2:  # a header over several lines
            parts = [(_reader(spark, sep, True, True).csv(f).columns, [f]) for f in files]
        else:
            parts = [(names, files)]
        for columns, some in parts:
            df = _reader(spark, sep, header, k.multi).schema(_text_columns(columns)).csv(some)
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def _good(rows: DataFrame) -> DataFrame:
    # the test of the first column is always true: Spark refuses plans that read
    # nothing but the corrupt column
    some = F.length(F.coalesce(F.col(f"`{rows.columns[0]}`"), F.lit(""))) >= 0
    return rows.filter(F.col(CORRUPT).isNull() & some).drop(CORRUPT)


def malformed_rows(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
                   multi_line: bool | None = None, width: int | None = None) -> DataFrame:
    """(file, record, reason) of the rows that the readers leave out."""
    rows = _rows(spark, path, sep, header, multi_line, width)
    some = F.length(F.coalesce(F.col(f"`{rows.columns[0]}`"), F.lit(""))) >= 0  # as in _good
    return (rows.withColumn("file", F.input_file_name()).filter(F.col(CORRUPT).isNotNull() & some)
            .select("file", F.col(CORRUPT).alias("record"),
                    F.lit("the row does not have the columns of the file").alias("reason")))


def typed(df: DataFrame, types: Mapping[str, str], tokens: Sequence[str] = K.NA_TOKENS) -> DataFrame:
    """Null tokens -> null on every text column, then ``try_cast`` the typed ones."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = nullify(c, tokens)
            if f.name in types:
                c = c.try_cast(types[f.name])
        out.append(c.alias(f.name))
    return df.select(*out)


def read_vehicles(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """Header CSV of vehicles (84 columns; the used ones are typed). Rows of
    another width are left out (``malformed_rows`` lists them)."""
    return typed(_good(_rows(spark, path, ",", True, multi_line)), VEHICLE_TYPES)


def read_complaints(spark: SparkSession, path: str,
                    positions: Sequence[int] = K.COMPLAINT_POSITIONS,
                    names: Sequence[str] = K.COMPLAINT_NAMES,
                    width: int = K.COMPLAINT_RAW_WIDTH,
                    multi_line: bool | None = None) -> DataFrame:
    """Headerless TSV; keep the listed positions and name them.

    The positions are a contract, so every row's width is checked: rows of
    another width are left out (``malformed_rows`` lists them), and a file whose
    first row has another width is an error (a shifted file), but where that row
    goes on over a line break.
    """
    raw = _good(_rows(spark, path, "\t", False, multi_line, width, check_first=True))
    sel = raw.select(*[F.col(f"_c{p}").alias(n) for p, n in zip(positions, names)])
    return typed(sel, COMPLAINT_TYPES)


def read_stations(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """S3: header CSV of stations; rows of another width are left out."""
    return typed(_good(_rows(spark, path, ",", True, multi_line)), STATION_TYPES)


STATION_JSON_FIELDS = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("fuel_type_code", T.StringType()),
    T.StructField("station_name", T.StringType()), T.StructField("street_address", T.StringType()),
    T.StructField("city", T.StringType()), T.StructField("state", T.StringType()),
    T.StructField("zip", T.StringType()), T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()), T.StructField("status_code", T.StringType()),
    T.StructField("access_code", T.StringType()), T.StructField("open_date", T.StringType()),
    T.StructField("ev_network", T.StringType()),
    T.StructField("ev_connector_types", T.ArrayType(T.StringType())),
    T.StructField("ev_pricing", T.StringType()),
])
STATION_JSON_SCHEMA = T.StructType([
    T.StructField("fuel_stations", T.ArrayType(STATION_JSON_FIELDS))])


def read_station_json(spark: SparkSession, path: str,
                      schema: T.StructType | None = STATION_JSON_SCHEMA,
                      multi_line: bool = True) -> DataFrame:
    """JSON documents ``{"fuel_stations": [{...}, ...]}``: one row per
    array element. A document without the field yields no rows (reported).
    With the default explicit schema no inference pass is made; ``zip`` stays
    text (leading zeros) and ``open_date`` is parsed to DATE.
    ``multi_line=False`` reads JSON Lines (one document per line, splittable)."""
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(path)
    if "fuel_stations" not in df.columns:
        log.warning("no fuel_stations field in %s: no station data", path)
        return spark.createDataFrame([], STATION_JSON_FIELDS)
    if df.filter(F.col("fuel_stations").isNull()).head(1):
        log.warning("a document in %s has no fuel_stations field: no station data from it", path)
    rows = df.select(F.inline(F.coalesce(F.col("fuel_stations"), F.array().cast(
        df.schema["fuel_stations"].dataType))))
    if "open_date" in rows.columns:
        rows = rows.withColumn("open_date", F.try_to_date(F.col("open_date").cast("string")))
    return rows


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """Read a processed or integrated layer back (Parquet keeps types)."""
    return spark.read.parquet(path)
