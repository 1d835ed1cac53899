"""Print the formatted physical plan of registered queries (after running them, so AQE's final plan shows).

    python tools/explain.py NAME [NAME ...] [--sf /root/testdata/sf0.01]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="+")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    from aurum.plans.registry import QUERIES
    from aurum.session import build_session
    spark = build_session("explain", "local[8]", 8)
    for name in args.names:
        df = QUERIES[name](spark, args.sf)
        df.collect()   # run this Dataset's own plan: the adaptive plan below is the final one
        print(f"===== {name}")
        print(df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    spark.stop()


if __name__ == "__main__":
    main()
