"""Capabilities the reference documents but does not code.

All are compositions of built-in operators. Windows appear only over
aggregates whose size is bounded by a small vocabulary (fuel codes x states,
fuel codes x years), never over raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import norm_key, round_even
from ..operators.aggregates import grouped_quantiles, stations_by_state, sum0
from ..operators.dedupe import dedupe_first
from ..sources import versions


# X1 ----------------------------------------------------------------------
def iqr_outliers(df: DataFrame, col: str, k: float = 1.5, approx: bool = False) -> DataFrame:
    """Flag values outside [Q1 - k*IQR, Q3 + k*IQR].

    The quartiles are exact and linearly interpolated (``grouped_quantiles``, a
    scalar subquery: no task ever holds all values, and nothing runs before an
    action); ``approx=True`` uses the fixed-size sketch."""
    if approx:
        found = df.agg(F.percentile_approx(F.col(col).cast("double"), F.array(F.lit(0.25), F.lit(0.75)), 10000).alias("q"))
        found = found.select(F.struct(F.get("q", F.lit(0)).alias("q0"), F.get("q", F.lit(1)).alias("q1")).alias("q"))
    else:
        found = grouped_quantiles(df, [], col, (0.25, 0.75)).select(F.struct("q0", "q1").alias("q"))
    q = found.scalar()
    reach = (q["q1"] - q["q0"]) * k
    out = (F.col(col) < q["q0"] - reach) | (F.col(col) > q["q1"] + reach)
    return df.withColumn("is_outlier", F.coalesce(out, F.lit(False)))


# X2 ----------------------------------------------------------------------
def vehicle_summary(vehicles: DataFrame, complaints: DataFrame) -> DataFrame:
    """Per (year, make, model): mean MPG, complaint count, most common
    component (ties: alphabetically first). Both sides are aggregated before
    the join; the mode is a ``min_by`` over per-component counts (partial
    aggregation, no window over complaints)."""
    v = (vehicles.withColumns({"make_norm": norm_key("make"), "model_norm": norm_key("model")})
         .groupBy("year", "make_norm", "model_norm")
         .agg(F.avg("comb08").alias("avg_mpg")))
    c = (complaints.withColumns({"make_norm": norm_key("MAKETXT"),
                                 "model_norm": norm_key("MODELTXT")})
         .na.drop(subset=["YEARTXT", "make_norm", "model_norm"])
         .groupBy(F.col("YEARTXT").alias("year"), "make_norm", "model_norm", "COMPDESC")
         .agg(F.count(F.lit(1)).alias("n")))
    top = c.groupBy("year", "make_norm", "model_norm").agg(
        F.sum("n").alias("complaint_count"),
        F.min_by("COMPDESC", F.struct(-F.col("n"), F.col("COMPDESC"))).alias("top_issue"))
    return (v.join(top, ["year", "make_norm", "model_norm"], "left")
            .na.fill(0, subset=["complaint_count"]))


# X3 ----------------------------------------------------------------------
def standard_words(col, words: Mapping[str, str]) -> Column:
    """Abbreviations inside a name: F1, then words (parted by whitespace or
    hyphens) are read from the left; where the longest run of words that ``words``
    lists begins, its replacement stands, else the word itself. Replacements are
    not read again; an empty one takes the words away; one blank parts the result.
    A null name stays null, a blank one is empty.

    One regular expression cuts the name into listed runs and single words
    (alternatives from the longest on, each up to the blank that ends it), a
    literal map replaces them: no join, no shuffle, no Python."""
    listed = {" ".join(_name_words(k)): " ".join(_name_words(v)) for k, v in words.items()}
    if "" in listed:
        raise ValueError("an abbreviation has no word")
    text = F.concat(F.trim(F.regexp_replace(norm_key(col), r"(?U)[\s-]+", " ")), F.lit(" "))
    runs = [_literal(k) for k in sorted(listed, key=lambda k: (-len(k), k))]
    parts = F.regexp_extract_all(text, F.lit(f"({'|'.join([*runs, '[^ ]+'])}) "), F.lit(1))
    if listed:
        from ..functions.scalar import map_code
        parts = F.transform(parts, lambda p: F.coalesce(map_code(p, listed), p))
    return F.array_join(F.filter(parts, lambda p: p != ""), " ")


def _name_words(name: str) -> list[str]:
    return name.upper().replace("-", " ").split()


def _literal(text: str) -> str:
    """A regular expression that matches just this text."""
    return "".join(c if c.isalnum() or c == " " or ord(c) > 127 else "\\" + c for c in text)


def aggressive_key(col, abbreviations: Mapping[str, str] | None = None,
                   words: Mapping[str, str] | None = None) -> Column:
    """F1 plus removal of hyphens and all whitespace. Optional lookup maps
    (none by default): ``words`` are abbreviations inside the name
    (``standard_words``), ``abbreviations`` those of a whole key."""
    k = F.regexp_replace(standard_words(col, words) if words else norm_key(col), r"(?U)[\s-]+", "")
    if abbreviations:
        from ..functions.scalar import map_code
        k = F.coalesce(map_code(k, {a.upper(): b.upper() for a, b in abbreviations.items()}), k)
    return k


# X4 / X5 / X6 ---------------------------------------------------------------
def mpg_complaint_ratio(vca: DataFrame) -> DataFrame:
    """Per (make, model): mean MPG, complaints, complaints per MPG point."""
    g = (vca.na.drop(subset=["make", "model"]).groupBy("make", "model")
         .agg(F.avg("comb08").alias("avg_mpg"),
              sum0("total_complaints").cast("bigint").alias("complaints")))
    return g.withColumn("complaints_per_mpg", F.try_divide(F.col("complaints"), F.col("avg_mpg")))


def class_incidents(vca: DataFrame) -> DataFrame:
    """Crash and fire incidents per vehicle class."""
    return (vca.na.drop(subset=["VClass"]).groupBy("VClass")
            .agg(sum0("crash_incidents").cast("bigint").alias("crash_incidents"),
                 sum0("fire_incidents").cast("bigint").alias("fire_incidents"),
                 F.count(F.lit(1)).alias("rows")))


def complaint_mileage(complaints: DataFrame, approx: bool = False) -> DataFrame:
    """Complaint mileage by normalised make and model: mean and median.

    The exact median is a rank selection over value counts
    (``grouped_quantiles``): no task holds the values of a hot group.
    ``approx=True`` uses ``percentile_approx``."""
    keys = ["make_norm", "model_norm"]
    c = complaints.withColumns({"make_norm": norm_key("MAKETXT"),
                                "model_norm": norm_key("MODELTXT")}).na.drop(subset=keys)
    own = [F.count("MILEAGE").alias("with_mileage"), F.avg("MILEAGE").alias("avg_mileage")]
    if approx:
        return c.groupBy(*keys).agg(*own, F.percentile_approx("MILEAGE", 0.5, 10000).cast("double").alias("median_mileage"))
    medians = grouped_quantiles(c, keys, "MILEAGE", [0.5]).withColumnRenamed("q0", "median_mileage")
    return c.groupBy(*keys).agg(*own).join(medians, keys, "left")


# X7 / X8 -------------------------------------------------------------------
def state_ranking(stations: DataFrame) -> DataFrame:
    """States ranked by station count within each fuel (ties share a rank)."""
    s = stations_by_state(stations)
    w = Window.partitionBy("fuel_type_code").orderBy(F.col("total_stations").desc())
    return s.withColumn("state_rank", F.rank().over(w))


def fuel_trend(infra: DataFrame) -> DataFrame:
    """Per fuel, vehicle count by year with the previous year's count and
    the change."""
    w = Window.partitionBy("fuel_type_code").orderBy("year")
    prev = F.lag("vehicle_count").over(w)
    return infra.select("fuel_type_code", "year", "vehicle_count",
                        prev.alias("prev_vehicle_count"),
                        (F.col("vehicle_count") - prev).alias("change"))


def stations_by_open_year(stations: DataFrame) -> DataFrame:
    """Per fuel and year of opening, stations opened and stations in all up
    to that year. The window runs over one row per fuel and year."""
    g = (stations.filter(F.col("open_date").isNotNull() & F.col("fuel_type_code").isNotNull())
         .groupBy("fuel_type_code", F.year("open_date").alias("open_year"))
         .agg(F.count(F.lit(1)).alias("opened")))
    w = (Window.partitionBy("fuel_type_code").orderBy("open_year")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return g.withColumn("stations_to_date", F.sum("opened").over(w))


def fuel_economy_ranking(infra: DataFrame) -> DataFrame:
    """Fuels ranked by their mean yearly combined MPG (exact mean of the
    tenths, then dense rank). The ranked input has one row per fuel code."""
    tenths = F.rint(F.col("avg_combined_mpg") * 10).cast("bigint")
    g = (infra.na.drop(subset=["fuel_type_code"]).groupBy("fuel_type_code")
         .agg(F.sum(tenths).alias("_t"), F.count(tenths).alias("_n")))
    g = g.select("fuel_type_code",
                 (F.rint(F.try_divide(F.col("_t"), F.col("_n"))) / 10).alias("avg_combined_mpg"))
    # bounded: at most one row per fuel code of the lookup
    w = Window.orderBy(F.col("avg_combined_mpg").desc())
    return g.withColumn("mpg_rank", F.dense_rank().over(w))


# X9 ----------------------------------------------------------------------
def infra_complaint_correlation(comp: DataFrame, places: int = 9) -> DataFrame:
    """Pearson correlation of nationwide stations and complaints."""
    return comp.agg(round_even(F.corr("stations_nationwide", "total_complaints"), places)
                    .alias("corr_stations_complaints"),
                    F.count(F.lit(1)).alias("rows"))


# X10 ---------------------------------------------------------------------
def categorize(col, rules: Sequence[tuple[str, str]], default: str = "OTHER") -> Column:
    """First matching (regex, category) rule, case-insensitive."""
    expr = None
    for pattern, category in rules:
        cond = F.coalesce(F.col(col).rlike(f"(?i){pattern}"), F.lit(False))
        expr = F.when(cond, F.lit(category)) if expr is None else expr.when(cond, F.lit(category))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


# X11 ---------------------------------------------------------------------
def _same_columns(base: DataFrame, updates: DataFrame) -> None:
    if set(base.columns) != set(updates.columns):
        raise ValueError(f"the columns differ: {sorted(set(base.columns) ^ set(updates.columns))}")


def append(base: DataFrame, rows: DataFrame) -> DataFrame:
    """X11: the rows of both; the columns must be the same."""
    _same_columns(base, rows)
    return base.unionByName(rows)


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str],
           order_by: Sequence | None = None) -> DataFrame:
    """X11: rows of ``updates`` replace rows of ``base`` with the same key (null
    keys compare equal); other base rows stay. Of several updates of a key the
    first by ``order_by`` wins, by default by all columns, so the choice never
    depends on the order of rows. The columns must be the same."""
    _same_columns(base, updates)
    rest = [c for c in base.columns if c not in keys]
    order = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in (order_by or [])]
    u = base.withColumn("_src", F.lit(1)).unionByName(updates.withColumn("_src", F.lit(0)))
    return dedupe_first(u, list(keys), [F.col("_src").asc(), *order,
                                        *[F.col(c).asc_nulls_last() for c in rest]]).drop("_src")


def changed_rows(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """X11: (key, change) for inserted, deleted and updated rows: a full outer
    join on the key (null keys compare equal) that compares every other column
    of either side, nulls included; a column that one side lacks is null there."""
    vals = [c for c in dict.fromkeys([*before.columns, *after.columns]) if c not in keys]

    def side(df: DataFrame, other: DataFrame, mark: str) -> DataFrame:
        kinds = {f.name: f.dataType for f in [*other.schema.fields, *df.schema.fields]}
        own = [F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in vals]
        return df.select(F.struct(*keys).alias(f"_k{mark}"), F.struct(F.lit(1).alias("_one"), *own).alias(f"_v{mark}"))

    b, a = side(before, after, "b"), side(after, before, "a")
    j = b.join(a, F.col("_kb").eqNullSafe(F.col("_ka")), "full_outer")
    change = (F.when(F.col("_vb").isNull(), F.lit("insert"))
              .when(F.col("_va").isNull(), F.lit("delete"))
              .when(~F.col("_vb").eqNullSafe(F.col("_va")), F.lit("update")))
    return (j.select(F.coalesce("_kb", "_ka").alias("_k"), change.alias("change"))
            .filter(F.col("change").isNotNull()).select("_k.*", "change"))


# X12 ---------------------------------------------------------------------
# Numbered snapshots of one folder each. A dataset whose versions have a log, a
# time and a restore without moving data is `sources.versions`.
def write_snapshot(df: DataFrame, root: str, version: int) -> str:
    """Write a dated/numbered snapshot ``root/version=N`` (never mutated)."""
    path = f"{root.rstrip('/')}/version={int(version)}"
    df.write.mode("errorifexists").parquet(path)
    return path


def read_snapshot(spark, root: str, version: int) -> DataFrame:
    """Read a previous version; one whose write has not finished (it has no
    ``_SUCCESS`` file yet) is refused."""
    path = f"{root.rstrip('/')}/version={int(version)}"
    fs, done = versions._hadoop(spark, f"{path}/_SUCCESS")
    if not fs.exists(done):
        raise ValueError(f"{root} has no finished version {version}")
    return spark.read.parquet(path)


def restore_snapshot(spark, root: str, version: int, target: str) -> DataFrame:
    """The snapshot becomes the newest version of the live dataset
    ``target`` (`sources.versions`); a restore that breaks off changes nothing."""
    versions.write(read_snapshot(spark, root, version), target, kind="restore")
    return versions.read(spark, target)
