"""Benchmark: the headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints ONE JSON line. Timed units:
  pipeline  raw -> processed (P1-P3) -> integrated (P4-P6), written as Parquet
            into a fresh folder below the session's checkpoint folder
            (median of two runs after a warm-up run);
  P4 P5 P6  each integrated table rebuilt from the written processed layer;
  Q1..Q6 A14 A16  the analyses on the written integrated tables.
Every unit is executed fully (``noop`` sink); the value per query is the
median of ``BENCH_REPEAT`` runs after one warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vehiscope.operators import aggregates as A  # noqa: E402
from vehiscope.plans import analysis as Q  # noqa: E402
from vehiscope.plans import integration as I  # noqa: E402
from vehiscope.plans.pipeline import Tables, run  # noqa: E402
from vehiscope.session import get_spark, shared_path  # noqa: E402


def _exec(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _time(fn, repeat: int) -> float:
    _exec(fn())  # warm-up
    runs = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        _exec(fn())
        runs.append(time.perf_counter() - t0)
    return statistics.median(runs)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus)
    out = shared_path(spark, "bench", uuid.uuid4().hex)

    raw = Tables(spark, sf_dir)
    input_rows = sum(raw.spark.read.parquet(f"{sf_dir}/{t}.parquet").count()
                     for t in ("part", "lineitem", "customer", "nation"))

    # pipeline: warm-up, then the median of two timed runs (fresh folders)
    run(spark, sf_dir, out_dir=f"{out}/warmup")
    runs = []
    for i in range(2):
        t0 = time.perf_counter()
        t = run(spark, sf_dir, out_dir=f"{out}/run{i}")
        runs.append(time.perf_counter() - t0)
    pipeline_s = statistics.median(runs)

    # input rows of each unit (the tables it reads), for rows/s
    n = {k: getattr(t, k).count() for k in ("vehicles", "complaints", "stations", "vca",
                                            "infra", "comp")}
    inputs = {"P4": n["vehicles"] + n["complaints"], "P5": n["vehicles"] + n["stations"],
              "P6": n["vca"] + n["stations"], "Q1": n["vca"], "Q2": n["vca"], "Q3": n["vca"],
              "Q4": n["infra"], "Q5": n["comp"], "Q6": n["comp"], "A14": n["vehicles"],
              "A16": n["vehicles"]}
    qs = {
        "P4": lambda: I.vehicle_complaints_analysis(t.vehicles, t.complaints),
        "P5": lambda: I.fuel_infrastructure_analysis(t.vehicles, t.stations),
        "P6": lambda: I.comprehensive_vehicle_analysis(t.vca, t.stations),
        "Q1": lambda: Q.efficiency_vs_complaints(t.vca),
        "Q2": lambda: Q.brands_by_complaint_rate(t.vca),
        "Q3": lambda: Q.electric_vs_gasoline(t.vca),
        "Q4": lambda: Q.infrastructure_status(t.infra, 2024, 10000),
        "Q5": lambda: Q.infrastructure_vs_complaints(t.comp, 1000),
        "Q6": lambda: Q.class_performance(t.comp),
        "A14": lambda: A.value_counts(t.vehicles, "make"),
        "A16": lambda: A.profile_numeric(t.vehicles, "comb08"),
    }
    times = {"pipeline": round(pipeline_s, 4)}
    for k, fn in qs.items():
        times[k] = round(_time(fn, repeat), 4)
    total = round(sum(times.values()), 4)
    rps = {k: round(inputs[k] / v, 1) for k, v in times.items() if k in inputs and v > 0}
    rps["pipeline"] = round(input_rows / pipeline_s, 1)
    print(json.dumps({
        "metric": "total_sec_pipeline_plus_headline_queries",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "input_rows": input_rows,
        "input_rows_per_sec": rps,
        "spark": spark.version,
        "cpus": cpus,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "repeat": repeat,
    }))


if __name__ == "__main__":
    main()
