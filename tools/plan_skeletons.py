"""Print the physical operator skeleton of the headline plans (AQE off, static plan).

    python tools/plan_skeletons.py /root/testdata/sf0.01 > /tmp/plans.txt
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def skeleton(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        m = re.match(r"^([\s:+\-]*)(\*\(\d+\) )?([A-Za-z]+)(.*)$", line)
        if not m:
            continue
        indent, _, op, rest = m.groups()
        detail = ""
        if op in ("Exchange",):
            detail = " " + rest.strip().split(",")[0][:70]
        elif op in ("Window",):
            k = re.search(r"partitionBy=?\[?([^\]]*)", rest)
            detail = " " + (re.search(r"\[([^\]]*)\]\s*$", rest) or re.search(r"(\[.*)", rest)).group(1)[-90:]
        elif op in ("FileScan",):
            pf = re.search(r"PushedFilters: (\[[^\]]*\])", rest)
            detail = " " + (pf.group(1)[:80] if pf else "")
        elif op in ("BroadcastHashJoin", "SortMergeJoin", "HashAggregate", "SortAggregate", "ObjectHashAggregate"):
            detail = " " + rest.strip()[:60]
        out.append(f"{indent}{op}{detail}")
    return "\n".join(out)


def main() -> None:
    from forgeline.operators import dedup, features, units
    from forgeline.plans import layers as L
    from forgeline.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    c = L.FixtureChain(spark, sf)
    sensors, inc = c.sensors(), c.i_silver()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    plans = {
        "U01 sensor dedup": dedup.dedup_sensor(c.p_parsed(), "pressure_bar"),
        "W11 unit normalisation": units.normalize_temperature_units(c.t_parsed())[0],
        "M08 gold": features.build_gold(sensors, inc, L.fixture_weather_hourly(spark, sf)),
    }
    for name, df in plans.items():
        print(f"== {name}\n{skeleton(df)}\n")


if __name__ == "__main__":
    main()
