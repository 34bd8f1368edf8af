"""Benchmark: headline routing queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is built and fully executed into Spark's ``noop`` sink (every row computed,
nothing collected). One warm-up pass, then the median of $BENCH_RUNS timed passes.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from poolwright.plans.nightly import from_fixtures, run_nightly  # noqa: E402
from poolwright.registry import APPLY, QUERIES  # noqa: E402
from poolwright.session import local_session  # noqa: E402
from poolwright.sources.fixtures import Fixtures  # noqa: E402

HEADLINE = {
    "resolve_clock": "c03_company_clock",        # C1 three-path resolution + clock (C3)
    "best_end_date": "c02_best_end_date",        # C1 + best-row pick (C2)
    "features": "c20_features_all",              # C20: 13-way company assembly
    "tag_batch_parked": "t06_batch_parked",      # features + T1-T6
    "propose_live": "t04_propose_live",          # live proposals (mappings scope)
    "fair_share": "fs_fair_share",               # FS distributed rank + closed form
    "apply": "ap6_placements_refreshed",         # AP1-AP6 on the fair-share batch
    "provider_sync": "m04_rules",                # M3 + M4
    "reclaim": "m05_reclaim",                    # M5
    "reports_by_parent": "r04_by_parent",        # R4 after fair share
    "nightly_pipeline": "nightly",               # janitor -> ... -> apply, all stages written
}


def run_once(spark, sf_dir: str, name: str) -> float:
    t0 = time.perf_counter()
    if name == "nightly":
        # the whole job, every stage written to a fresh scratch directory
        out = tempfile.mkdtemp(prefix="poolwright-bench-")
        run_nightly(spark, from_fixtures(Fixtures(spark, sf_dir, APPLY)), APPLY, out).collect()
    else:
        df = QUERIES[name][0](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="poolwright-bench")
    for name in HEADLINE.values():  # warm-up: JIT, file listing, broadcast paths
        run_once(spark, sf_dir, name)
    results = {}
    for key, name in HEADLINE.items():
        results[key] = round(statistics.median(run_once(spark, sf_dir, name) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "routing_headline_total", "value": round(sum(results.values()), 3), "unit": "sec",
        "queries": results, "sf": sf, "cpus": cpus, "runs": runs,
    }))


if __name__ == "__main__":
    main()
