"""Benchmark: wall seconds per registered query at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run to completion with the ``noop`` sink (full execution, no
transfer to the driver).  The layered bronze/silver/gold run that the gold
queries read is timed on its own (``layers_run``).  A small untimed warm-up
job runs first.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from aurum.session import build_session
    spark = build_session("aurum-bench", f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "4g")})
    from aurum.plans import registry as R

    times: dict[str, float] = {}
    errors: dict[str, str] = {}

    # JVM warm-up (not timed): one small aggregate and join, so the first timed
    # entry does not carry class loading and JIT compilation alone
    warm = spark.range(200_000).selectExpr("id % 97 AS k", "id AS v")
    warm.join(warm.groupBy("k").count(), "k").write.format("noop").mode("overwrite").save()

    t0 = time.time()
    run = R.layers(spark, sf_dir)
    times["layers_run"] = round(time.time() - t0, 3)
    stages = {m["stage"]: m["latency_seconds"] for m in run.metrics}

    for name, fn in R.QUERIES.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as exc:  # keep benchmarking the rest
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {"metric": "total_wall_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
           "cpus": cpus, "layers_stages": stages}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
