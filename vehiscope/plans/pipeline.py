"""The whole batch pipeline: raw -> processed -> integrated.

``Tables`` builds every layer lazily from the bound raw sources; ``run``
materialises the processed and integrated layers as Parquet in shared
storage (durable lineage cuts that survive executor loss) and returns the
re-read tables.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..session import materialize, shared_path
from ..sources import bindings as B
from . import cleaning, integration


@dataclass
class Tables:
    spark: SparkSession
    sf_dir: str
    as_of: object = K.DEFAULT_AS_OF
    _over: dict = field(default_factory=dict)

    # raw (bound to the test tables)
    @cached_property
    def raw_vehicles(self) -> DataFrame:
        return self._over.get("raw_vehicles") or B.raw_vehicles(self.spark, self.sf_dir)

    @cached_property
    def raw_complaints(self) -> DataFrame:
        return self._over.get("raw_complaints") or B.raw_complaints(self.spark, self.sf_dir)

    @cached_property
    def raw_stations(self) -> DataFrame:
        return self._over.get("raw_stations") or B.raw_stations(self.spark, self.sf_dir)

    # processed
    @cached_property
    def vehicles(self) -> DataFrame:
        return self._over.get("vehicles") or cleaning.clean_vehicles(
            self.raw_vehicles, self.as_of, B.VEHICLE_ORDER)

    @cached_property
    def complaints(self) -> DataFrame:
        return self._over.get("complaints") or cleaning.clean_complaints(
            self.raw_complaints, self.as_of, B.COMPLAINT_ORDER)

    @cached_property
    def stations(self) -> DataFrame:
        return self._over.get("stations") or cleaning.clean_stations(
            self.raw_stations, B.STATION_ORDER)

    # integrated
    @cached_property
    def vca(self) -> DataFrame:
        return self._over.get("vca") or integration.vehicle_complaints_analysis(
            self.vehicles, self.complaints)

    @cached_property
    def infra(self) -> DataFrame:
        return self._over.get("infra") or integration.fuel_infrastructure_analysis(
            self.vehicles, self.stations)

    @cached_property
    def comp(self) -> DataFrame:
        return self._over.get("comp") or integration.comprehensive_vehicle_analysis(
            self.vca, self.stations)


#: Place of a raw row in its files.
ROW = "_vs_row"
PROCESSED = ("vehicles", "complaints", "stations")
INTEGRATED = {"vca": "vehicle_complaints_analysis",
              "infra": "fuel_infrastructure_analysis",
              "comp": "comprehensive_vehicle_analysis"}


def _write_all(jobs: dict[str, tuple[DataFrame, str]], parallel: bool) -> dict[str, DataFrame]:
    """Materialise independent datasets; with ``parallel`` the write jobs are
    submitted from separate driver threads, so the scheduler runs them at the
    same time (one job's narrow stage does not leave the cluster idle)."""
    if not parallel or len(jobs) == 1:
        return {n: materialize(df, path) for n, (df, path) in jobs.items()}
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futs = {n: pool.submit(materialize, df, path) for n, (df, path) in jobs.items()}
        return {n: f.result() for n, f in futs.items()}


def run(spark: SparkSession, sf_dir: str, as_of=K.DEFAULT_AS_OF,
        out_dir: str | None = None, parallel: bool = True) -> Tables:
    """Build and materialise both layers; later layers read the written ones,
    so P6 reuses the stored P4 instead of recomputing it. Independent layers
    (P1-P3, then P4 and P5) are written concurrently."""
    return layers(Tables(spark, sf_dir, as_of), out_dir or shared_path(spark, "pipeline"), parallel)


def layers(t: Tables, root: str, parallel: bool = True) -> Tables:
    """The tables of ``t``, both layers written below ``root``: each raw source is
    read and cleaned once, whatever is asked of the result."""
    over = t._over | _write_all({n: (getattr(t, n), f"{root}/processed/{n}") for n in PROCESSED}, parallel)
    t2 = Tables(t.spark, t.sf_dir, t.as_of, dict(over))
    over.update(_write_all({n: (getattr(t2, n), f"{root}/integrated/{INTEGRATED[n]}")
                            for n in ("vca", "infra")}, parallel))
    t3 = Tables(t.spark, t.sf_dir, t.as_of, dict(over))
    over["comp"] = materialize(t3.comp, f"{root}/integrated/{INTEGRATED['comp']}")
    return Tables(t.spark, t.sf_dir, t.as_of, over)


def ingest_files(spark: SparkSession, vehicles_csv: str, complaints_tsv: str, stations: str, root: str,
                 stations_format: str = "csv", parallel: bool = True, multi_line: bool | None = None) -> dict[str, DataFrame]:
    """Raw files as Parquet below ``root``/raw, each row with its place (``ROW``)."""
    from ..sources import readers as RD
    st = (RD.read_station_json(spark, stations, multi_line=multi_line is not False) if stations_format == "json"
          else RD.read_stations(spark, stations, multi_line))
    raw = {"raw_vehicles": RD.read_vehicles(spark, vehicles_csv, multi_line),
           "raw_complaints": RD.read_complaints(spark, complaints_tsv, multi_line=multi_line),
           "raw_stations": st}
    # files are read in any order and in splits; rows of a split keep theirs
    place = F.struct(F.input_file_name().alias("file"), F.input_file_block_start().alias("start"),
                     F.monotonically_increasing_id().alias("row"))
    return _write_all({n: (df.withColumn(ROW, place), f"{root}/raw/{n}")
                       for n, df in raw.items()}, parallel)


def load_files(spark: SparkSession, vehicles_csv: str, complaints_tsv: str, stations: str, out_dir: str,
               as_of=K.DEFAULT_AS_OF, stations_format: str = "csv", multi_line: bool | None = None, spec=K.CONTRACT,
               report_only: tuple | list = ()) -> dict:
    """The pipeline on raw files behind the validation gate: the log entry of the
    version published at ``out_dir``/release, or `gate.GateFailed`."""
    from . import gate
    root = out_dir.rstrip("/")
    # one folder a load: a load that is refused leaves the earlier raw rows alone
    raw = ingest_files(spark, vehicles_csv, complaints_tsv, stations, f"{root}/loads/{uuid.uuid4().hex}",
                       stations_format, True, multi_line)
    return gate.load(spark, raw["raw_vehicles"], raw["raw_complaints"], raw["raw_stations"], f"{root}/release", as_of,
                     station_order=[ROW], spec=spec, report_only=report_only)


def run_files(spark: SparkSession, vehicles_csv: str, complaints_tsv: str, stations: str,
              out_dir: str, as_of=K.DEFAULT_AS_OF, stations_format: str = "csv",
              parallel: bool = True, multi_line: bool | None = None) -> Tables:
    """The pipeline on raw files: header CSV of vehicles, headerless TSV of
    complaints, stations as header CSV or ``{"fuel_stations": [...]}`` JSON.
    The raw edge is ingested once into Parquet (files without line breaks inside
    fields in splits; ``multi_line`` says so of all files, else it is found out),
    each row with its place in the files (``ROW``), which is
    the keep-first order of the stations; then the layers are built as in
    ``run``."""
    root = out_dir.rstrip("/")
    over = ingest_files(spark, vehicles_csv, complaints_tsv, stations, root, stations_format, parallel, multi_line)
    over.update({
        "vehicles": cleaning.clean_vehicles(over["raw_vehicles"], as_of),
        "complaints": cleaning.clean_complaints(over["raw_complaints"], as_of),
        "stations": cleaning.clean_stations(over["raw_stations"], [ROW]),
    })
    over.update(_write_all({n: (over[n], f"{root}/processed/{n}") for n in PROCESSED}, parallel))
    t2 = Tables(spark, "", as_of, dict(over))
    over.update(_write_all({n: (getattr(t2, n), f"{root}/integrated/{INTEGRATED[n]}")
                            for n in ("vca", "infra")}, parallel))
    t3 = Tables(spark, "", as_of, dict(over))
    over["comp"] = materialize(t3.comp, f"{root}/integrated/{INTEGRATED['comp']}")
    return Tables(spark, "", as_of, over)
