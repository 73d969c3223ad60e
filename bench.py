"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The registered queries themselves, each from a fresh layer chain (nothing
memoised between them) and forced with a ``noop`` write, so the whole plan
runs without collecting rows to the driver; then the imputation benchmark from
stored readings, and the batch run from delimited files to Gold.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from forgeline.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    spark.sparkContext.setLogLevel("ERROR")

    from forgeline.operators import impute
    from forgeline.plans import layers as L
    from forgeline.plans import q_tables
    from forgeline.plans.pipeline import run_from_files
    from forgeline.plans.queries import QUERIES
    from forgeline.session import scratch_path

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    def forget():
        # no stored layer, table or run is shared between timed queries
        for memo in (L._CHAINS, q_tables._ROOTS, q_tables._RUNS):
            memo.clear()

    def registered(name):
        return lambda: noop(QUERIES[name](spark, sf_dir))

    # prepared before the clock starts: the exported files, and deduplicated readings for the benchmark alone
    sources = q_tables._export_sources(spark, sf_dir)
    deduped = L.FixtureChain(spark, sf_dir).t_deduped()

    names = ["m08_gold", "w11_unit_windows", "u01_sensor_dedup", "u01_pressure_dedup", "m03_imputation_benchmark", "w12_rolling_zscore_alerts", "a13_dataset_overview"]
    plan = [(n, registered(n)) for n in names]
    plan.append(("m03_from_stored_dedup", lambda: noop(impute.evaluate_imputation(deduped, L.TEMPERATURE_CONTEXT))))
    plan.append(("files_to_gold_run", lambda: run_from_files(spark, sources, scratch_path(spark, f"bench-{uuid.uuid4().hex}"), batch_id="bench")))
    times = {}
    for name, fn in plan:
        forget()
        t0 = time.time()
        fn()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
