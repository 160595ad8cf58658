"""Command line: load raw files and publish both layers behind the gate.

spark-submit --master ... -m vehiscope (or python -m vehiscope) \\
    --vehicles v.csv --complaints c.tsv --stations s.csv --out /shared/folder \\
    [--stations-format json] [--as-of 2025-03-31] [--single-line] [--min-rows-percent 100]

Exit status 0: published; 1: a scored rule does not hold, the published version is
the one from before. The session is the submission's; without a number of shuffle
partitions from there, it follows the size of the input.
"""
from __future__ import annotations

import argparse
import datetime as dt
import sys

from . import constants as K
from .plans.gate import GateFailed
from .plans.pipeline import load_files
from .session import input_bytes, size_shuffles, submitted_session


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="vehiscope")
    ap.add_argument("--vehicles", required=True)
    ap.add_argument("--complaints", required=True)
    ap.add_argument("--stations", required=True)
    ap.add_argument("--stations-format", choices=["csv", "json"], default="csv")
    ap.add_argument("--out", required=True)
    ap.add_argument("--as-of", default=dt.date.today().isoformat())
    ap.add_argument("--single-line", action="store_true", help="no field of any file holds a line break (else it is found out)")
    ap.add_argument("--min-rows-percent", type=int, default=100, help="share of the least numbers of rows that is asked for")
    ap.add_argument("--report-only", action="append", default=[], metavar="DATASET.RULE",
                    help="a scored rule that is reported but refuses no load")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    spark = submitted_session(master=a.master)
    size_shuffles(spark, input_bytes(spark, a.vehicles, a.complaints, a.stations))
    spec = {n: (cols, least * a.min_rows_percent // 100) for n, (cols, least) in K.CONTRACT.items()}
    try:
        done = load_files(spark, a.vehicles, a.complaints, a.stations, a.out, dt.date.fromisoformat(a.as_of),
                          a.stations_format, False if a.single_line else None, spec, a.report_only)
    except GateFailed as e:
        for r in e.rules:
            print(f"{r['dataset']}.{r['rule']}: {r['violations']} {'ok' if r['passed'] else 'FAILED'}"
                  f"{'' if r['blocking'] else ' (report only)'}")
        print(e, file=sys.stderr)
        return 1
    print("version", done["version"])
    for name, t in done["tables"].items():
        print(name, t["rows"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
