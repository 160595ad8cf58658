"""Write, audit, publish: cleaning and integration behind a validation gate
(C16, D1-D7 as part of a load).

Every table of a load is written once, to a new folder that no reader knows. The
write itself counts the rows after each step (C16) and the violations of the row
rules (D2-D6): they are observed metrics of its plan, so the raw rows are read
once. Rules about duplicates need a group: they read the two or three key columns
of the written table. Only if all scored rules of all tables hold, one entry of the
version log (`sources.versions`) makes the tables visible together, with stage
counts, rules and the time of the load in it; else `GateFailed` is raised, the
published version stays the newest, and the refused folders stay for inspection.

The rules are observed above the last shuffle of a write, in its result tasks,
which Spark counts once however often a task is run. Stage counts below a shuffle
are a report only: map tasks that run again after a lost executor count again.

Defined results
    empty raw tables: written and published unless a minimum of rows is set
    (``spec``); a step whose input an empty relation replaced counts null;
    complaints whose year is no integer (V4) are published as
    ``complaint_rejects``; a null in a rule's column is no violation but where the
    rule is about nulls.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.scalar import icontains, parse_num, parse_ymd, require_int, to_nullable_int
from ..operators import filters as C
from ..operators.dedupe import dedupe_first
from ..operators.expand import explode_ranked
from ..operators.filters import _as_date
from ..sources import versions
from . import cleaning, integration
from .quality import _null_cells, mpg_inconsistent

#: Column that parts the rows of one write into published tables.
VERDICT = "verdict"
KEPT, REJECTED = "kept", "rejected"


class GateFailed(RuntimeError):
    """Blocking rules do not hold; ``rules`` lists all that were checked, ``tables``
    the folders that were written and not published."""

    def __init__(self, rules: list[dict], tables: Mapping[str, dict]):
        bad = [f"{r['dataset']}.{r['rule']}: {r['violations']}" for r in rules if r["blocking"] and not r["passed"]]
        super().__init__("not published, " + "; ".join(bad))
        self.rules, self.tables = rules, dict(tables)


@dataclass
class Job:
    """A table to write: its plan with the observations in it, the names of the
    steps in order as (observation, metric, step), the row rules and the keys that
    must be unique."""

    name: str
    df: DataFrame
    steps: list[tuple[Observation, str, str]]
    seen: Observation
    rules: list[str]
    unscored: Sequence[str] = ()
    unique: tuple[str, Sequence[str]] | None = None
    rejects: str | None = None
    extra: list[dict] = field(default_factory=list)


def _watched(raw: DataFrame, pre: Sequence[tuple[str, Column]], keys: Sequence[str],
             order_by: Sequence | None) -> tuple[DataFrame, list]:
    """Filters and keep-first of a cleaning job, with the rows after each."""
    alive, counts, steps, first = F.lit(True), [F.count(F.lit(1)).alias("n0")], [], Observation()
    steps.append((first, "n0", "input"))
    for i, (name, pred) in enumerate(pre, start=1):
        alive = alive & F.coalesce(pred, F.lit(False))
        counts.append(F.count_if(alive).alias(f"n{i}"))
        steps.append((first, f"n{i}", name))
    deduped = dedupe_first(raw.observe(first, *counts).filter(alive), list(keys),
                           None if order_by is None else list(order_by))
    return deduped, steps


def _violations(rules: Mapping[str, Column], sums: Mapping[str, Column]) -> list[Column]:
    return [*[F.count_if(F.coalesce(p, F.lit(False))).alias(r) for r, p in rules.items()],
            *[F.coalesce(F.sum(e), F.lit(0)).alias(r) for r, e in sums.items()]]


def vehicles_job(raw: DataFrame, as_of=K.DEFAULT_AS_OF, order_by: Sequence = ("id",),
                 min_year: int = K.VEHICLE_MIN_YEAR, mpg_cap=K.VEHICLE_MPG_CAP) -> Job:
    """P1 with C16 and D3/D4."""
    df, steps = _watched(raw, cleaning.vehicle_filter_steps(as_of, min_year, mpg_cap), K.VEHICLE_DEDUPE_KEYS, order_by)
    kept, seen = Observation(), Observation()
    df = df.observe(kept, F.count(F.lit(1)).alias("m0"))
    df = explode_ranked(C.rename(C.select_existing(df, K.VEHICLE_KEEP_COLUMNS), K.VEHICLE_RENAMES))
    rules = {"no_pre_min_year": F.col("year") < min_year, "no_zero_mpg": F.col("comb08") == 0,
             "no_high_mpg_non_electric": (F.col("comb08") > mpg_cap) & ~icontains("fuel_used", K.ELECTRIC_NEEDLE),
             "no_future_year": F.col("year") > _as_date(as_of).year, "mpg_consistency": mpg_inconsistent(df)}
    sums = {"no_missing_critical": _null_cells(["year", "make", "model", "comb08"])}
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *_violations(rules, sums))
    return Job("vehicles", df, [*steps, (kept, "m0", "dedupe"), (seen, "rows", "explode_dual_fuel")], seen,
               [*rules, *sums], unscored=["mpg_consistency"], unique=("no_duplicate_id_rank", ["id", "fuel_rank"]))


def complaints_job(raw: DataFrame, as_of=K.DEFAULT_AS_OF, order_by: Sequence | None = ("CMPLID",)) -> Job:
    """P2 with C16 and D5; the rejects of V4 come from the same write."""
    d = _as_date(as_of)
    typed = raw.withColumns({"_DATEA": parse_ymd("DATEA"), "_YEAR": parse_num("YEARTXT")})
    pre = [("required_fields", C.all_present_pred(K.COMPLAINT_REQUIRED)),
           ("not_future_date", C.not_after_pred("_DATEA", as_of, keep_null=True)),
           ("mileage_cap", C.cap_pred("MILEAGE", K.COMPLAINT_MAX_MILEAGE, keep_null=True)),
           ("not_future_year", C.not_after_year_pred("_YEAR", as_of, keep_null=True))]
    df, steps = _watched(typed, pre, ["ODINO"], order_by)
    integral = dict(raw.dtypes).get("MILEAGE") in ("tinyint", "smallint", "int", "bigint")
    df = df.withColumns({"DATEA": F.col("_DATEA"), "YEARTXT": F.col("_YEAR")})
    ok = F.col("YEARTXT").isNotNull()
    df = df.withColumns({"YEARTXT": require_int("YEARTXT"),
                         "MILEAGE": F.col("MILEAGE").cast("bigint") if integral else to_nullable_int("MILEAGE"),
                         VERDICT: F.when(ok, KEPT).otherwise(REJECTED)}).select(*K.COMPLAINT_NAMES, VERDICT)
    seen, mine = Observation(), F.col(VERDICT) == KEPT
    rules = {"no_future_date": mine & (F.col("DATEA") > F.lit(d)), "no_future_year": mine & (F.col("YEARTXT") > d.year)}
    sums = {"no_missing_critical": F.when(mine, _null_cells(K.COMPLAINT_REQUIRED))}
    df = df.observe(seen, F.count(F.lit(1)).alias("all"), F.count_if(mine).alias("rows"), *_violations(rules, sums))
    return Job("complaints", df, [*steps, (seen, "all", "dedupe"), (seen, "rows", "integer_year")], seen, [*rules, *sums],
               unique=("no_duplicate_odino", ["ODINO"]), rejects="complaint_rejects")


def stations_job(raw: DataFrame, order_by: Sequence | None = None, box=K.STATION_BBOX,
                 fuel_codes: Sequence[str] = K.ALT_FUEL_CODES) -> Job:
    """P3 with C16 and D6."""
    df, steps = _watched(raw, cleaning.station_filter_steps(box), ["id"], order_by)
    kept, seen = Observation(), Observation()
    df = C.keep_in(df.observe(kept, F.count(F.lit(1)).alias("m0")), "fuel_type_code", fuel_codes)
    df = C.select_existing(df, K.STATION_KEEP_COLUMNS)
    south, north, west, east = box
    lat, lon = F.col("latitude"), F.col("longitude")
    off = sum((F.coalesce(p, F.lit(False)).cast("int") for p in (
        (lat < south) | (lat > north), (lon < west) | (lon > east), (lat == 0) & (lon == 0))), F.lit(0))
    rules = {"allowed_fuel_codes": ~F.coalesce(F.col("fuel_type_code").isin(list(fuel_codes)), F.lit(False))}
    sums = {"no_missing_critical": _null_cells(K.STATION_REQUIRED), "coordinates_in_bounds": off}
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *_violations(rules, sums))
    return Job("stations", df, [*steps, (kept, "m0", "dedupe"), (seen, "rows", "alt_fuel_only")], seen, [*rules, *sums],
               unique=("no_duplicate_id", ["id"]))


def table_job(name: str, df: DataFrame, rules: Mapping[str, Column] | None = None,
              spec: tuple[Sequence[str], int] | None = None) -> Job:
    """A table with row rules, and its contract (D1): columns that must be there
    and a least number of rows, as ``spec``."""
    seen, rules = Observation(), dict(rules or {})
    extra = []
    if spec is not None:
        missing = [c for c in spec[0] if c not in df.columns]
        extra.append({"dataset": name, "rule": "required_columns", "violations": len(missing), "passed": not missing,
                      "scored": True})
        extra.append({"dataset": name, "rule": "min_rows", "least": spec[1], "scored": True})
        rules = {r: p for r, p in rules.items() if not missing}
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *_violations(rules, {}))
    return Job(name, df, [(seen, "rows", "output")], seen, list(rules), extra=extra)


def analysis_rules(year_range=K.VALIDATION_YEAR_RANGE) -> dict[str, Column]:
    """D2 as row rules."""
    lo, hi = year_range
    return {"year_in_range": (F.col("year") < lo) | (F.col("year") > hi), "positive_mpg": F.col("comb08") <= 0,
            "year_not_null": F.col("year").isNull(), "make_not_null": F.col("make").isNull(),
            "model_not_null": F.col("model").isNull()}


def _metrics(seen: Observation) -> dict:
    """What was observed; nothing if the optimizer replaced the observed rows by
    an empty relation, for which Spark has no metrics to convert."""
    try:
        return seen.get
    except Py4JJavaError as e:
        if "toPyRow" not in str(e):
            raise
        return {}


def _stage(job: Job, root: str) -> tuple[dict[str, dict], list[dict], list[dict]]:
    """Write a job's table to a new folder: (tables, stage counts, rules)."""
    spark, path = job.df.sparkSession, versions.new_folder(root)
    writer = job.df.write.format("parquet")
    if job.rejects:
        writer = writer.partitionBy(VERDICT)
    writer.save(path)
    seen = _metrics(job.seen)
    rows = seen.get("rows", 0)
    if not seen and spark.read.schema(job.df.schema).parquet(path).head(1):
        raise RuntimeError(f"the rules of {job.name} were not observed")
    schema = (job.df.drop(VERDICT) if job.rejects else job.df).schema.jsonValue()

    def entry(paths: list[str], n: int) -> dict:
        return {"schema": schema, "format": "parquet", "paths": paths, "rows": n}

    if job.rejects:
        lost = seen.get("all", 0) - rows
        tables = {job.name: entry([f"{path}/{VERDICT}={KEPT}"] if rows else [], rows),
                  job.rejects: entry([f"{path}/{VERDICT}={REJECTED}"] if lost else [], lost)}
    else:
        tables = {job.name: entry([path], rows)}
    counted = [(step, _metrics(obs).get(metric)) for obs, metric, step in job.steps]
    stages = [{"dataset": job.name, "step_no": i, "step": step, "rows_in": counted[max(i - 1, 0)][1], "rows_out": n}
              for i, (step, n) in enumerate(counted)]
    rules = [{"dataset": job.name, "rule": r, "violations": seen.get(r, 0), "passed": not seen.get(r, 0),
              "scored": r not in job.unscored} for r in job.rules]
    for e in job.extra:
        least = e.get("least")
        rules.append(e if least is None else {"dataset": job.name, "rule": e["rule"], "violations": max(0, least - rows),
                                              "passed": rows >= least, "scored": True})
    if job.unique:
        rule, keys = job.unique
        groups = versions.frame(spark, tables[job.name]).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        twice = groups.agg(F.sum(F.when(F.col("n") > 1, F.col("n")))).first()[0] or 0
        rules.append({"dataset": job.name, "rule": rule, "violations": twice, "passed": not twice, "scored": True})
    return tables, stages, rules


class Load:
    """A load in progress: stage tables, check them, publish them together."""

    def __init__(self, spark: SparkSession, root: str, report_only: Sequence[str] = ()):
        self.spark, self.root, self.report_only = spark, root.rstrip("/"), set(report_only)
        # a load that another one overtakes is refused by the log at the end
        self.parent = versions.entry(spark, self.root)
        self.tables: dict[str, dict] = {}
        self.stages: list[dict] = []
        self.rules: list[dict] = []

    def stage(self, *jobs: Job) -> dict[str, DataFrame]:
        """Write jobs at the same time and audit them; the written tables. Raises
        `GateFailed` if a scored rule of one of them does not hold, unless it is
        named as ``dataset.rule`` in ``report_only``."""
        with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
            for tables, stages, rules in pool.map(lambda j: _stage(j, self.root), jobs):
                self.tables.update(tables)
                self.stages += stages
                self.rules += [{**r, "blocking": r["scored"] and f"{r['dataset']}.{r['rule']}" not in self.report_only}
                               for r in rules]
        if any(r["blocking"] and not r["passed"] for r in self.rules):
            raise GateFailed(self.rules, self.tables)
        return {n: versions.frame(self.spark, t) for n, t in self.tables.items()}

    def publish(self, time=None) -> dict:
        """Make all staged tables visible as the next version; its log entry."""
        return versions.commit(self.spark, self.root, self.tables, "load", self.parent, time,
                               stages=self.stages, rules=self.rules)


_RULES = "dataset string, rule string, violations long, passed boolean, scored boolean"
_STAGES = "dataset string, step_no int, step string, rows_in long, rows_out long"


def load_rules(spark: SparkSession, entry: dict) -> DataFrame:
    """The rules of a published load, in the form of D3-D6 (so D7 takes them)."""
    return spark.createDataFrame([tuple(r[k] for k in ("dataset", "rule", "violations", "passed", "scored"))
                                  for r in entry["rules"]], _RULES)


def load_stages(spark: SparkSession, entry: dict) -> DataFrame:
    """The stage counts (C16) of a published load; step 0 is the input."""
    return spark.createDataFrame([tuple(s[k] for k in ("dataset", "step_no", "step", "rows_in", "rows_out"))
                                  for s in entry["stages"]], _STAGES)


def load(spark: SparkSession, raw_vehicles: DataFrame, raw_complaints: DataFrame, raw_stations: DataFrame, root: str,
         as_of=K.DEFAULT_AS_OF, station_order: Sequence | None = None, vehicle_order: Sequence = ("id",),
         complaint_order: Sequence | None = ("CMPLID",), spec: Mapping[str, tuple[Sequence[str], int]] = K.CONTRACT,
         year_range=K.VALIDATION_YEAR_RANGE, report_only: Sequence[str] = (), time=None) -> dict:
    """P1-P6 from raw tables to one published version below ``root``; its log
    entry. Readers use `versions.read_release`."""
    run = Load(spark, root, report_only)
    t = run.stage(vehicles_job(raw_vehicles, as_of, vehicle_order), complaints_job(raw_complaints, as_of, complaint_order),
                  stations_job(raw_stations, station_order))
    vca, infra, comp = "vehicle_complaints_analysis", "fuel_infrastructure_analysis", "comprehensive_vehicle_analysis"
    t = run.stage(table_job(vca, integration.vehicle_complaints_analysis(t["vehicles"], t["complaints"]),
                            analysis_rules(year_range), spec.get(vca)),
                  table_job(infra, integration.fuel_infrastructure_analysis(t["vehicles"], t["stations"]),
                            spec=spec.get(infra)))
    run.stage(table_job(comp, integration.comprehensive_vehicle_analysis(t[vca], t["stations"]), spec=spec.get(comp)))
    return run.publish(time)
