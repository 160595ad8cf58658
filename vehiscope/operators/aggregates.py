"""Aggregations.

pandas ``groupby`` drops null keys (trap T11) while Spark makes a null group,
so every keyed aggregate drops null keys first. pandas ``sum`` of an all-null
group is 0 while Spark's is null (trap T2): sums are wrapped in ``coalesce``.
All aggregates are algebraic, so Spark runs them as partial (map-side) +
final hash aggregation: a hot key is pre-combined in every task before the
shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import ratio_zero_as_one, round_even


def _drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.na.drop("any", subset=list(keys))


def sum0(col: str) -> Column:
    """pandas-style sum: an all-null group sums to 0, as BIGINT for integers."""
    return F.coalesce(F.sum(col), F.lit(0))


# A1 ----------------------------------------------------------------------
def complaint_rollup(df: DataFrame, keys: Sequence[str] = ("YEARTXT", "make_norm", "model_norm"),
                     out_keys: Sequence[str] = ("year", "make_norm", "model_norm")) -> DataFrame:
    """A1: complaints per (year, make, model); null keys dropped.

    The mean mileage stays null for a group without any mileage; it only
    becomes 0 after the left join (J1), as in the reference.
    """
    return (_drop_null_keys(df, keys)
            .groupBy(*[F.col(k).alias(o) for k, o in zip(keys, out_keys)])
            .agg(F.count("CMPLID").alias("total_complaints"),
                 F.count_if(F.col("CRASH") == "Y").alias("crash_incidents"),
                 F.count_if(F.col("FIRE") == "Y").alias("fire_incidents"),
                 sum0("INJURED").cast("bigint").alias("total_injured"),
                 sum0("DEATHS").cast("bigint").alias("total_deaths"),
                 F.avg("MILEAGE").alias("avg_complaint_mileage")))


# A3 ----------------------------------------------------------------------
def fuel_year_rollup(df: DataFrame, keys: Sequence[str] = ("year", "fuel_type_code")) -> DataFrame:
    """A3: vehicle-fuel rows per (year, fuel code); null code dropped."""
    return (_drop_null_keys(df, keys).groupBy(*keys)
            .agg(F.count("id").alias("vehicle_count"),
                 F.avg("comb08").alias("avg_combined_mpg"),
                 F.avg("city08").alias("avg_city_mpg"),
                 F.avg("highway08").alias("avg_highway_mpg")))


# A4 / A5 / A6 --------------------------------------------------------------
def stations_by_state(df: DataFrame) -> DataFrame:
    """A4: stations and available ('E') stations per (fuel, state); null state dropped."""
    return (_drop_null_keys(df, ["fuel_type_code", "state"])
            .groupBy("fuel_type_code", "state")
            .agg(F.count("id").alias("total_stations"),
                 F.count_if(F.col("status_code") == "E").alias("available_stations")))


def stations_by_fuel(df: DataFrame) -> DataFrame:
    """A5: the second-level roll-up of A4 to fuel.

    Summing A4's per-state counts over states equals one aggregate by fuel
    over the stations that have a state, so it is written as ONE groupBy
    (one shuffle instead of two).
    """
    return (_drop_null_keys(df, ["fuel_type_code", "state"])
            .groupBy("fuel_type_code")
            .agg(F.count("id").alias("total_stations"),
                 F.count_if(F.col("status_code") == "E").alias("available_stations")))


def stations_by_fuel_two_level(df: DataFrame) -> DataFrame:
    """A5 written literally as the reference does (roll-up of A4)."""
    return (stations_by_state(df).groupBy("fuel_type_code")
            .agg(F.sum("total_stations").alias("total_stations"),
                 F.sum("available_stations").alias("available_stations")))


def stations_nationwide(df: DataFrame) -> DataFrame:
    """Stations per fuel; stations without a state ARE counted (trap T3)."""
    return (_drop_null_keys(df, ["fuel_type_code"]).groupBy("fuel_type_code")
            .agg(F.count("id").alias("stations_nationwide")))


# A7 ----------------------------------------------------------------------
def mean_where(df: DataFrame, col: str, branches: Mapping[str, Column]) -> DataFrame:
    """``avg(col)`` and row count under each predicate, all in ONE pass."""
    aggs = []
    for name, pred in branches.items():
        p = F.coalesce(pred, F.lit(False))
        aggs.append(F.avg(F.when(p, F.col(col))).alias(f"{name}_avg"))
        aggs.append(F.count_if(p).alias(f"{name}_count"))
    return df.agg(*aggs)


# A8 / A9 / A10 -------------------------------------------------------------
def brand_rollup(df: DataFrame, key: str = "make") -> DataFrame:
    """Per make: summed measures and the number of rows (``count(year)``)."""
    return (_drop_null_keys(df, [key]).groupBy(key)
            .agg(sum0("total_complaints").cast("bigint").alias("total_complaints"),
                 sum0("crash_incidents").cast("bigint").alias("crash_incidents"),
                 sum0("fire_incidents").cast("bigint").alias("fire_incidents"),
                 F.count("year").alias("vehicle_count")))


def class_rollup(df: DataFrame, key: str = "VClass") -> DataFrame:
    """Per class: mean MPG, mean complaints, number of rows."""
    return (_drop_null_keys(df, [key]).groupBy(key)
            .agg(F.avg("comb08").alias("comb08"),
                 F.avg("total_complaints").alias("total_complaints"),
                 F.count("year").alias("count")))


def having(df: DataFrame, col: str, more_than) -> DataFrame:
    """A10: HAVING ``col > more_than`` after an aggregate."""
    return df.filter(F.col(col) > F.lit(more_than))


# A11 ---------------------------------------------------------------------
def fuel_summary(infra: DataFrame) -> DataFrame:
    """Per fuel: summed vehicle count, the (constant) station counts,
    the mean of the yearly MPG means, then the F5 ratio; all rounded.

    The yearly means are already rounded to tenths, so their mean is taken
    exactly on integer tenths: float summation order then cannot move a value
    across a rounding tie.
    """
    tenths = F.rint(F.col("avg_combined_mpg") * 10).cast("bigint")
    g = (_drop_null_keys(infra, ["fuel_type_code"]).groupBy("fuel_type_code")
         .agg(sum0("vehicle_count").cast("bigint").alias("vehicle_count"),
              F.min("total_stations").alias("total_stations"),
              F.min("available_stations").alias("available_stations"),
              F.sum(tenths).alias("_t"), F.count(tenths).alias("_n")))
    return g.select(
        "fuel_type_code", "vehicle_count", "total_stations", "available_stations",
        (F.rint(F.try_divide(F.col("_t"), F.col("_n"))) / 10).alias("avg_combined_mpg"),
        round_even(ratio_zero_as_one("vehicle_count", "total_stations"), 1)
        .alias("vehicles_per_station"))


# A12 / A13 -----------------------------------------------------------------
def count_distinct(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Exact distinct count (nulls not counted)."""
    return df.agg(F.count_distinct(col).alias(name or f"distinct_{col}"))


def distinct_per_group(df: DataFrame, key: str = "id", col: str = "fuel_rank") -> DataFrame:
    """Distinct values per key, then a histogram of those counts."""
    per_key = (_drop_null_keys(df, [key]).groupBy(key)
               .agg(F.count_distinct(col).alias("n_values")))
    return per_key.groupBy("n_values").agg(F.count(F.lit(1)).alias("n_keys"))


# A14 / A15 -----------------------------------------------------------------
def value_counts(df: DataFrame, col: str, k: int | None = None, by: str = "count") -> DataFrame:
    """Value frequencies, nulls excluded; sorted by frequency (ties by
    value) or by value; ``k`` keeps the head (a top-k report)."""
    vc = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if by == "count":
        vc = vc.orderBy(F.col("count").desc(), F.col(col).asc())
    else:
        vc = vc.orderBy(F.col(col).asc())
    return vc.limit(k) if k is not None else vc


# A16 ---------------------------------------------------------------------
def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float],
                    splits: int = 256) -> list[float | None]:
    """Exact, linearly interpolated quantiles without a task that holds all
    values: a fixed-size sketch cuts the range into ``splits`` parts, a partial
    aggregate counts each part (``splits`` rows reach the driver), and only the
    parts that hold a wanted rank are numbered, by distinct value. None if the
    column holds no value."""
    vals = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    cuts = vals.agg(F.percentile_approx("v", [i / splits for i in range(1, splits)], 10000)).first()[0]
    if not cuts:
        return [None] * len(probs)
    bounds = F.array(*[F.lit(float(x)) for x in sorted(set(cuts))])
    part = F.size(F.filter(bounds, lambda b: b < F.col("v")))
    counts = vals.groupBy("v").agg(F.count(F.lit(1)).alias("n")).withColumn("part", part)
    sizes = sorted((r["part"], r["n"]) for r in counts.groupBy("part").agg(F.sum("n").alias("n")).collect())
    total = sum(n for _, n in sizes)
    at = [p * (total - 1) for p in probs]
    ranks = sorted({int(x) for x in at} | {min(int(x) + 1, total - 1) for x in at})
    start, wanted = 0, {}
    for p, n in sizes:
        wanted |= {r: (p, start) for r in ranks if start <= r < start + n}
        start += n
    starts = dict(wanted.values())
    upto = Window.partitionBy("part").orderBy("v")
    low = F.create_map(*[F.lit(x) for kv in starts.items() for x in kv])
    ends = (counts.filter(F.col("part").isin(list(starts)))
            .withColumn("end", F.sum("n").over(upto) + low[F.col("part")]))
    hit = F.filter(F.array(*[F.lit(r) for r in ranks]), lambda r: (r < F.col("end")) & (r >= F.col("end") - F.col("n")))
    found = {r["rank"]: r["v"] for r in ends.select("v", F.explode(hit).alias("rank")).collect()}
    return [found[int(x)] + (x - int(x)) * (found[min(int(x) + 1, total - 1)] - found[int(x)]) for x in at]


def order_key(v: Column) -> Column:
    """Doubles as 64-bit integers in the same order: exponent and fraction of the
    magnitude (as doubles are stored), with the sign; both zeros are 0, NaN is the
    largest. Powers of two and divisions by them are exact."""
    def key(x: Column) -> Column:
        size, guess = x["size"], x["guess"]
        # the logarithm may round up to, or fall short of, a whole number
        power = F.when(F.pow(F.lit(2.0), guess) > size, guess - 1).when(F.pow(F.lit(2.0), guess + 1) <= size, guess + 1).otherwise(guess)
        fraction = ((size / F.pow(F.lit(2.0), power) - 1.0) * 2.0 ** 52).cast("bigint")
        normal = F.shiftleft((power + 1023).cast("bigint"), 52) + fraction
        small = (size * 2.0 ** 537 * 2.0 ** 537).cast("bigint")  # below 2^-1022: units of 2^-1074
        return (F.when(F.isnan(size), F.lit((2047 << 52) + 1)).when(size == float("inf"), F.lit(2047 << 52))
                .when(size < 2.0 ** -1022, small).otherwise(normal)) * x["sign"]

    step = F.struct(F.abs(v).alias("size"), F.floor(F.log2(F.abs(v))).alias("guess"),
                    F.when(~F.isnan(v) & (v < 0), -1).otherwise(1).alias("sign"))
    return F.transform(F.array(step), key)[0]


def _levels(kind: T.DataType) -> tuple[int, ...]:
    """Bits of the order key below each level of a rank selection. No level has
    more than 2^22 parts of the one above: whole numbers of 32 bits are their own
    key, and a part of 32-bit fractions has 2^13 values at most."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return 16, 0
    return (42, 0) if isinstance(kind, T.FloatType) else (42, 21, 0)


def grouped_quantiles(df: DataFrame, keys: Sequence[str], col: str, probs: Sequence[float]) -> DataFrame:
    """``keys, q0, q1, ...``: exact, linearly interpolated quantiles of each group
    with a value (without ``keys``: one row, null without values). Nothing runs
    before an action, and no task ever holds all values of a group.

    The values are counted once (a partial aggregate). Then a rank is looked up by
    radix: the counts of the order key's highest bits say in which part it lies,
    the next bits are counted within this part only, and so on. What a window
    sorts is one row a part; what meets the value counts is a row a wanted rank."""
    spark, kind = df.sparkSession, df.select(col).schema[0].dataType
    levels, whole = _levels(kind), isinstance(kind, T.IntegralType)
    values = df.select(*keys, F.col(col).cast("bigint" if whole else "double").alias("_v")).where("_v is not null")
    counts = (values.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_k", F.col("_v") if whole else order_key(F.col("_v"))))
    own = "".join(f"`{k}`, " for k in keys)
    within = f"PARTITION BY {own[:-2]} " if keys else ""
    same = "".join(f" AND c.`{k}` <=> p.`{k}`" for k in keys)
    of_c = "".join(f"c.`{k}`, " for k in keys)
    few = "" if keys else "/*+ BROADCAST(p) */ "  # without keys: two rows a quantile
    low = [f"floor({float(p)!r}D * (_total - 1))" for p in probs]
    wanted = ", ".join([*low, *(f"least({x} + 1, _total - 1)" for x in low)])
    steps = [f"""_u0 AS (SELECT {own}shiftright(_k, {levels[0]}) AS _part, sum(_n) AS _n,
          sum(sum(_n)) OVER ({within}ORDER BY shiftright(_k, {levels[0]})) AS _upto,
          sum(sum(_n)) OVER ({within}) AS _total FROM {{counts}} GROUP BY {own}shiftright(_k, {levels[0]})),
      _p0 AS (SELECT {own}_rank, _upto - _n AS _before, _total, _part FROM _u0 LATERAL VIEW explode(filter(
          array_distinct(array({wanted})), r -> r < _upto AND r >= _upto - _n)) AS _rank)"""]
    for k, (above, bits) in enumerate(zip(levels, levels[1:]), 1):
        part = f"shiftright(c._k, {bits})"
        steps.append(f"""_u{k} AS (SELECT {few}{of_c}_rank, _before, _total, {part} AS _part, sum(c._n) AS _n, min(c._v) AS _v,
          _before + sum(sum(c._n)) OVER (PARTITION BY {of_c}_rank ORDER BY {part}) AS _upto
          FROM {{counts}} AS c JOIN _p{k - 1} AS p ON shiftright(c._k, {above}) = p._part{same}
          GROUP BY {of_c}_rank, _before, _total, {part}),
      _p{k} AS (SELECT {own}_rank, _upto - _n AS _before, _total, _part, _v FROM _u{k}
          WHERE _rank < _upto AND _rank >= _upto - _n)""")
    found = spark.sql(f"""WITH {', '.join(steps)}
      SELECT {own}map_from_entries(collect_list(struct(_rank, double(_v) AS _v))) AS _m, max(_total) AS _total
      FROM _p{len(levels) - 1} {'GROUP BY ' + own[:-2] if keys else ''}""", counts=counts)
    out = []
    for i, p in enumerate(probs):
        at = f"({float(p)!r}D * (_total - 1))"
        a, b = f"_m[floor({at})]", f"_m[least(floor({at}) + 1, _total - 1)]"
        # a whole rank and equal neighbours need no difference, which infinities lack
        out.append(f"CASE WHEN {a} = {b} OR {at} = floor({at}) THEN {a} ELSE {a} + ({at} - floor({at})) * ({b} - {a}) END AS q{i}")
    return found.selectExpr(*[f"`{k}`" for k in keys], *out)


def profile_numeric(df: DataFrame, col: str, approx: bool = False, places: int = 9) -> DataFrame:
    """Mean, median, min, max and sample standard deviation.

    The median is exact (``grouped_quantiles``, a scalar subquery of the same
    plan); ``approx=True`` switches to ``percentile_approx``. The standard deviation is rounded half-even to
    ``places`` decimals so the result does not depend on float summation order.
    """
    med = (F.percentile_approx(col, 0.5, 100000).cast("double") if approx
           else grouped_quantiles(df, [], col, [0.5]).scalar())
    return df.agg(F.avg(col).alias("mean"), med.alias("median"),
                  F.min(col).alias("min"), F.max(col).alias("max"),
                  round_even(F.stddev_samp(col), places).alias("std"))


# A17 / A18 / A19 / A20 -----------------------------------------------------------
def totals(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column totals in one aggregate."""
    return df.agg(*[sum0(c).alias(f"sum_{c}") for c in cols])


def share(df: DataFrame, pred: Column, name: str = "with") -> DataFrame:
    """Rows with / without a property and the percentage of each."""
    p = F.coalesce(pred, F.lit(False))
    n = F.count(F.lit(1))
    w = F.count_if(p)
    wo = F.count_if(~p)
    return df.agg(n.alias("rows"), w.alias(f"{name}_rows"), wo.alias(f"{name}out_rows"),
                  (F.try_divide(w, n) * 100).alias(f"{name}_pct"),
                  (F.try_divide(wo, n) * 100).alias(f"{name}out_pct"))


def col_range(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Min, max and the number of values outside [lo, hi]."""
    out = F.lit(False)
    if lo is not None:
        out = out | (F.col(col) < F.lit(lo))
    if hi is not None:
        out = out | (F.col(col) > F.lit(hi))
    return df.agg(F.min(col).alias("min"), F.max(col).alias("max"),
                  F.count_if(F.coalesce(out, F.lit(False))).alias("out_of_range"))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing values per column, one scan, long form (column, nulls)."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column", "nulls")


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named frame, as one DataFrame (name, rows)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows")
             for n, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
