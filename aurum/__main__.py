"""Run the layered bronze -> silver -> gold run over the test tables.

    python -m aurum [SF_DIR] [--root PATH] [--master local[8]]

Prints one JSON line per stage metric.  The output root defaults to a fresh
folder under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json

from aurum.config import LITERACY
from aurum.plans import layers as L
from aurum.plans import mapping as MP
from aurum.session import build_session, shared_path


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="aurum")
    ap.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.01")
    ap.add_argument("--root", default=None)
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    spark = build_session("aurum", args.master)
    root = args.root or shared_path(spark, "runs")
    run = L.run(spark, MP.sources(MP.load_tables(spark, args.sf_dir)), root, LITERACY)
    for m in run.metrics:
        print(json.dumps({k: v for k, v in m.items() if k != "traceback"}, default=str))
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
