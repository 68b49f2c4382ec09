"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPS (default 3).  Each figure is the median of the repetitions after the first
(warm); the first is reported under "cold".  Results go to the noop sink.

`extract` derives the domain tables from the generated files and writes them as zstd
parquet, once.  Everything after it reads that snapshot: `*_raw` and the other source
queries join its tables, `build_marts` writes and publishes all marts, and the `*_mart`
queries read the published marts, as their readers do.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid
from datetime import datetime

CPUS = os.environ.get("BENCH_CPUS", "8")
FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
REPS = max(2, int(os.environ.get("BENCH_REPS", "3")))

RAW = [
    "facility_metrics",
    "market_summary",
    "market_flows",
    "identity_crosswalk",
    "observations_monthly",
    "build_metadata",
    "out_of_market_dollars",
    "owned_share_by_market",
    "top_destinations",
    "clinic_facts",
    "active_member_acute_miles",
    "corridor_catchment",
    "claims_lag",
    "member_months",
    "condition_prevalence",
    "link_recall",
    "destained_documents",
    "clinic_comparison_raw",
    "market_ranking_raw",
    "leakage_raw",
]
MART = [
    "clinic_comparison_mart",
    "market_ranking_mart",
    "leakage_mart",
    "market_access",
    "share_served_in_corridor",
    "recapture_by_line",
    "capacity_sizing",
]


def main() -> None:
    from sitelens.functions.scale import shared_dir
    from sitelens.plans import catalog, publish
    from sitelens.plans.workspace import Workspace
    from sitelens.session import local_session
    from sitelens.sources.extract import extract_network
    from sitelens.sources.network import ParquetNetwork
    from sitelens.sources.stand_in import AS_OF, SPAN, StandIn

    spark = local_session(CPUS, shuffle_partitions=int(CPUS))
    scratch = f"{shared_dir(spark)}/bench-{uuid.uuid4().hex}"
    cold: dict[str, float] = {}
    warm: dict[str, float] = {}

    def measure(name: str, run) -> None:
        spent = []
        for _ in range(REPS):
            start = time.perf_counter()
            run()
            spent.append(time.perf_counter() - start)
        cold[name] = round(spent[0], 4)
        warm[name] = round(statistics.median(spent[1:]), 4)
        print(f"{name}: cold {cold[name]} warm {warm[name]}", file=sys.stderr, flush=True)

    def sink(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    start = time.perf_counter()
    _, snapshot = extract_network(StandIn(spark, FOLDER), StandIn.NAMES, f"{scratch}/raw")
    extract_seconds = round(time.perf_counter() - start, 3)
    print(f"extract: {extract_seconds}", file=sys.stderr, flush=True)

    def workspace(published=None) -> Workspace:
        net = ParquetNetwork(spark, snapshot.root, snapshot.schemas)
        return Workspace(net, SPAN, AS_OF, published)

    for name in RAW:
        query = catalog.QUERIES[name]
        measure(name, lambda: sink(query(workspace())))

    versions = iter(range(1, REPS + 1))

    def build() -> None:
        w = workspace()
        publish.publish(w, f"{scratch}/marts", f"{next(versions):04d}", datetime(2001, 6, 1))

    measure("build_marts", build)
    marts = publish.open_marts(spark, f"{scratch}/marts")
    for name in MART:
        query = catalog.QUERIES[name]
        measure(name, lambda: sink(query(workspace(marts))))

    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_warm_total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "extract": extract_seconds,
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
